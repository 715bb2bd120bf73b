"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

from tarn.llm import chat_format, mixing, resample, secret_scan, sharding

_CONTROLS = "|".join(
    c.replace("[", r"\[").replace("]", r"\]")
    for c in [chat_format.BOS, *(m for pair in chat_format.MARKS.values() for m in pair), *chat_format.OTHER]
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


def _escaped(text: str) -> str:
    return rf"regexp_replace({text}, '(\\*)({_CONTROLS})', '\\\1\2', 'g')"


def chat_sql() -> str:
    around = " ".join(
        f"WHEN '{role}' THEN {len(opened) + len(closed) + 3}" for role, (opened, closed) in chat_format.MARKS.items()
    )
    other = sum(len(m) for m in chat_format.OTHER) + 5
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length({_escaped("text")}) + CASE role {around}
    ELSE {other} + length({_escaped("role")}) END AS formatted FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(formatted) AS BIGINT) + {len(chat_format.BOS)} AS formatted_chars
FROM sized GROUP BY conv_id"""


def sharding_sql(limit: int = sharding.SHARD_BYTES, deepest: int = 40) -> str:
    bits = sharding.HASH_BITS
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents
), keys AS (SELECT h, sum(n_bytes) AS bytes, count(*) AS docs FROM docs GROUP BY h),
nodes AS (
  SELECT d.depth, h >> ({bits} - d.depth) AS prefix, sum(bytes) AS bytes, sum(docs) AS docs
  FROM keys, (SELECT unnest(range({deepest + 1})) AS depth) d GROUP BY ALL
), leaf AS (
  SELECT h, min(n.depth) AS depth FROM keys JOIN nodes n ON n.prefix = h >> ({bits} - n.depth)
  WHERE n.bytes <= {limit} OR n.docs = 1 GROUP BY h
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes,
  CASE WHEN leaf.depth = 0 THEN '' ELSE lpad(bin(docs.h >> ({bits} - leaf.depth)), CAST(leaf.depth AS INTEGER), '0') END AS shard,
  CAST(leaf.depth AS INTEGER) AS depth, CAST(nodes.bytes AS BIGINT) AS shard_bytes
FROM docs JOIN leaf ON docs.h = leaf.h
JOIN nodes ON nodes.depth = leaf.depth AND nodes.prefix = docs.h >> ({bits} - leaf.depth)"""


def decontaminate_sql() -> str:
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lower("text")}, {word}) AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lower("text")}, {word}) AS w FROM documents
), sizes AS (SELECT DISTINCT size FROM windows),
spans AS (
  SELECT r, size, k, array_to_string(w[k : k + size - 1], ' ') AS gram
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM doc, sizes WHERE len(w) >= size)
), hits AS (SELECT r, k, size, item FROM spans JOIN windows USING (size, gram)),
spots AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS p FROM hits) GROUP BY r),
owners AS (
  SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN spots USING (r) LEFT JOIN owners USING (r)"""


def line_dedup_sql(min_words: int = 50) -> str:
    return f"""
WITH doc AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, md5(text)) AS r, doc_id, text FROM documents),
line AS (
  SELECT r, i, s, len(list_filter(string_split_regex(s, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS words
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS s, unnest(range(len(string_split(text, chr(10))))) AS i FROM doc)
), whole AS (
  SELECT *, row_number() OVER w AS k, CAST(sum(words) OVER w AS BIGINT) AS upto FROM line WHERE words > 0
  WINDOW w AS (PARTITION BY r ORDER BY i)
), sequence AS (SELECT r, list(s ORDER BY k) AS lines, list(upto ORDER BY k) AS upto, list(words ORDER BY k) AS words FROM whole GROUP BY r),
spans AS (
  SELECT w.r, w.k AS a, q.n AS b FROM whole w JOIN sequence s USING (r),
    LATERAL (SELECT min(n) AS n FROM (SELECT unnest(range(w.k, len(s.upto) + 1)) AS n) WHERE s.upto[n] >= w.upto - w.words + {min_words}) q
  WHERE q.n IS NOT NULL
  UNION
  SELECT w.r, q.n, w.k FROM whole w JOIN sequence s USING (r),
    LATERAL (SELECT max(n) AS n FROM (SELECT unnest(range(1, w.k + 1)) AS n) WHERE s.upto[n] - s.words[n] <= w.upto - {min_words}) q
  WHERE q.n IS NOT NULL
), content AS (
  SELECT r, a, b, array_to_string(lines[a:b], chr(10)) AS run, b - a AS d FROM spans JOIN sequence USING (r)
), head AS (SELECT run, d, min((r, a)) AS h FROM content GROUP BY run, d),
gone AS (
  SELECT DISTINCT r, unnest(range(a, b + 1)) AS k FROM content JOIN head USING (run, d) WHERE (r, a) > h
), begins AS (SELECT r, count(*) AS n_deleted, count(*) FILTER (WHERE k - coalesce(p, -1) <> 1) AS n_runs
  FROM (SELECT r, k, lag(k) OVER (PARTITION BY r ORDER BY k) AS p FROM gone) GROUP BY r),
kept AS (
  SELECT l.r, string_agg(l.s, chr(10) ORDER BY l.i) AS text FROM line l
  LEFT JOIN whole w ON w.r = l.r AND w.i = l.i LEFT JOIN gone g ON g.r = w.r AND g.k = w.k
  WHERE g.r IS NULL GROUP BY l.r
), n AS (SELECT r, count(*) AS n_lines FROM whole GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted, coalesce(n_runs, 0) AS n_runs,
  CASE WHEN doc.text IS NOT NULL THEN md5(coalesce(kept.text, '')) END AS kept_md5
FROM doc LEFT JOIN n USING (r) LEFT JOIN begins USING (r) LEFT JOIN kept USING (r)"""


def near_dup_sql() -> str:
    return f"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lower("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT r, array_to_string(w[k : k + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS k FROM doc WHERE len(w) > 0)
), sizes AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.r <> b.r GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (SELECT r AS a, r AS b FROM doc UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
smallest AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN doc ON doc.r = b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM doc JOIN smallest USING (r) LEFT JOIN sizes USING (r)"""


def mixing_sql(targets: dict = mixing.TARGETS, rounds: int = mixing.ROUNDS) -> str:
    names = list(targets)
    steps = []
    for name, target in targets.items():
        own = f"(SELECT {name}, sum(tokens) AS own FROM cells GROUP BY {name})"
        if isinstance(target, dict):
            listed = "CASE " + " ".join(f"WHEN {name} = '{v}' THEN {w:.17g}e0" for v, w in target.items()) + " END"
            steps.append(f"""t_{name} AS (SELECT {name}, coalesce((1 - sum(CASE WHEN listed IS NULL THEN share ELSE 0.0 END) OVER ())
  * listed / sum(listed) OVER (), share) AS goal
  FROM (SELECT {name}, own / sum(own) OVER () AS share, {listed} AS listed FROM {own}))""")
        else:
            steps.append(f"""t_{name} AS (SELECT {name}, powered / sum(powered) OVER () AS goal
  FROM (SELECT {name}, pow(own / sum(own) OVER (), {target}e0) AS powered FROM {own}))""")
    goals = ", ".join(f"t_{n}.goal AS g_{n}" for n in names)
    joins = " ".join(f"JOIN t_{n} USING ({n})" for n in names)
    steps.append(f"w0 AS (SELECT {', '.join(names)}, tokens, CAST(tokens AS DOUBLE) AS w, {goals} FROM cells {joins})")
    k = 0
    for _ in range(rounds):
        for name in names:
            steps.append(f"w{k + 1} AS MATERIALIZED (SELECT * REPLACE (w * g_{name} / sum(w) OVER (PARTITION BY {name}) AS w) FROM w{k})")
            k += 1
    keyed = " AND ".join(f"f.{n} = coalesce(r.{n}, '')" for n in names)
    return f"""
WITH r AS (
  SELECT *, CASE WHEN contains(lower(coalesce(text, '')), 'license') OR contains(lower(coalesce(text, '')), 'rights reserved') THEN 'licence'
    WHEN contains(coalesce(text, ''), '@') OR contains(coalesce(text, ''), '://') THEN 'contact' ELSE 'prose' END AS topic,
    CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS BIGINT) AS n_tokens
  FROM documents
), cells AS (
  SELECT {", ".join(f"coalesce({n}, '') AS {n}" for n in names)}, CAST(sum(n_tokens) AS DOUBLE) AS tokens
  FROM r WHERE n_tokens > 0 GROUP BY {", ".join(str(i + 1) for i in range(len(names)))}
), {", ".join(steps)},
f AS (SELECT {", ".join(names)}, w / tokens / max(w / tokens) OVER () AS p FROM w{k}),
drawn AS (
  SELECT r.*, CASE WHEN n_tokens = 0 THEN 1.0e0 ELSE f.p END AS prob,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13) AS BIGINT)
      / {float(1 << 52)!r}e0 AS u
  FROM r LEFT JOIN f ON {keyed}
)
SELECT doc_id, source, lang, topic, n_tokens, round(prob, 6) AS p, u < prob AS kept FROM drawn"""


def resample_sql() -> str:
    b, word = resample.BUCKETS, r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    noise = "floor(-1000 * ln(-ln((h + 0.5e0) / 4294967296e0)))"
    return f"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS byte
  FROM (SELECT unnest(range(256)) AS i)
), doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lower("text")}, {word}) AS w FROM documents),
own AS (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(w) AS w FROM doc) GROUP BY ALL),
aim AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all({_lower("text")}, {word})) AS w FROM benchmark) GROUP BY ALL),
bucket AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(w)), lambda i: CAST('0x' || substr(hex(w), 2 * i + 1, 2) AS BIGINT))),
    lambda c, x: xor(c >> 8, byte[(xor(c, x) & 255) + 1])), 4294967295) % {b} AS b
  FROM (SELECT w FROM own UNION SELECT w FROM aim), crc
), gain AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + {b}) / ((s + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM aim), 0) + {b})))) AS g
  FROM (SELECT b, sum(n) AS s FROM own JOIN bucket USING (w) GROUP BY b)
  LEFT JOIN (SELECT b, sum(n) AS t FROM aim JOIN bucket USING (w) GROUP BY b) USING (b)
), weighed AS (
  SELECT r, floor(sum(own.n * g)::DOUBLE / sum(own.n)) AS weight FROM own JOIN bucket USING (w) JOIN gain USING (b) GROUP BY r
), scored AS (
  SELECT r, doc_id, len(w) AS n, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('{resample.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM doc LEFT JOIN weighed USING (r)
), able AS (
  SELECT r, row_number() OVER (ORDER BY weight + {noise} DESC, doc_id NULLS LAST, n) AS rank, count(*) OVER () AS docs FROM scored WHERE n >= {resample.MIN_WORDS}
)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(weight + {noise} AS BIGINT) AS score,
  CASE WHEN rank <= {resample.PERCENT} * docs // 100 THEN CAST(rank AS BIGINT) END AS rank
FROM scored LEFT JOIN able USING (r)"""


def secret_scan_sql() -> str:
    quoted = {k: "'" + p.replace("'", "''") + "'" for k, (p, _, _) in secret_scan.KINDS.items()}
    found = " UNION ALL ".join(
        f"""SELECT r, owner, doc_id, {n} AS kind, k, length(string_split_regex(text, {quoted[kind]})[k]) AS gap,
    length(regexp_extract_all(text, {quoted[kind]})[k]) AS size, regexp_extract_all(text, {quoted[kind]}, {group})[k] AS value, {least} AS least
  FROM (SELECT *, unnest(range(1, len(regexp_extract_all(text, {quoted[kind]})) + 1)) AS k FROM doc WHERE regexp_matches(text, {quoted[kind]}))"""
        for n, (kind, (_, group, least)) in enumerate(secret_scan.KINDS.items())
    )
    names = "[" + ", ".join(f"'{k}'" for k in secret_scan.KINDS) + "]"
    last = len(secret_scan.KINDS) - 1
    line = f"{names}[kind + 1] || ':' || a || ':' || b"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {n}) AS n_{k}" for n, k in enumerate(list(secret_scan.KINDS)[:last]))
    return f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS owner, coalesce(text, '') AS text FROM documents
), found AS ({found}),
placed AS (
  SELECT r, owner, doc_id, kind, value, b - size AS a, b
  FROM (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY r, kind ORDER BY k) AS BIGINT) AS b FROM found)
  WHERE length(value) >= least AND (kind < {last} OR regexp_matches(value, '[A-Za-z]') AND regexp_matches(value, '[0-9].*[0-9].*[0-9]'))
), uncovered AS (
  SELECT * FROM placed p WHERE kind < {last} OR NOT EXISTS (SELECT 1 FROM placed q WHERE q.r = p.r AND q.kind < {last} AND q.a < p.b AND q.b > p.a)
), held AS (
  SELECT value, count(DISTINCT owner) <= {secret_scan.MOST_OWNERS}
    AND count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) <= {secret_scan.MOST_REPOSITORIES} AS live FROM uncovered GROUP BY value
), spans AS (SELECT * FROM uncovered JOIN held USING (value) WHERE kind < {last} OR live),
told AS (
  SELECT r, {counts}, string_agg({line}, ',' ORDER BY a, kind) FILTER (WHERE kind < {last}) AS base, string_agg({line}, ',' ORDER BY a, kind) AS spans,
    count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example
  FROM spans GROUP BY r
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in list(secret_scan.KINDS)[:last])}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM doc LEFT JOIN told USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": chat_sql(),
        "op3_sharding": sharding_sql(),
        "op4_decontaminate": decontaminate_sql(),
        "op5_line_dedup": line_dedup_sql(),
        "op8_mixing": mixing_sql(),
        "op9_near_dup": near_dup_sql(),
        "op11_resample": resample_sql(),
        "op12_secret_scan": secret_scan_sql(),
    }
