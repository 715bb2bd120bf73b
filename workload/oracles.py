"""The expected result of each query, stated in SQL over the same tables."""

from __future__ import annotations

# Events with the fault put in their document (none from 4 on).
DOCS = """
WITH d AS (
  SELECT event_id, event_id % 11 AS f, event_id % 3 AS n, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
), good AS (SELECT * FROM d WHERE f >= 4)
"""

# Events as patches, with what they do.
PATCHES = """
WITH p AS (
  SELECT user_id AS c_custkey, event_id AS seq, event_type AS t, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
), q AS (
  SELECT *, CASE WHEN t = 'purchase' THEN k % 5 END AS i,
    CASE t WHEN 'click' THEN '/profile/segment' WHEN 'view' THEN '/profile/balance'
           WHEN 'purchase' THEN '/scores/' || (k % 5) WHEN 'signup' THEN '/profile/nope'
           ELSE '/active' END AS path
  FROM p
), fits AS (SELECT * FROM q WHERE t IN ('click', 'view', 'purchase')
), applied AS (SELECT * FROM fits WHERE i IS NULL OR i < 3
), state AS (
  SELECT c.c_custkey, c_name AS name,
    coalesce(arg_max(CAST(k AS VARCHAR), seq) FILTER (t = 'click'), any_value(c_mktsegment)) AS segment,
    coalesce(arg_max(value, seq) FILTER (t = 'view'), any_value(c_acctbal)) AS balance,
    coalesce(arg_max(k, seq) FILTER (i = 0), 1) || ',' || coalesce(arg_max(k, seq) FILTER (i = 1), 2) || ',' ||
    coalesce(arg_max(k, seq) FILTER (i = 2), 3) AS scores,
    true AS active
  FROM customer c LEFT JOIN applied a ON a.c_custkey = c.c_custkey
  GROUP BY c.c_custkey, c_name
)
"""

LAKE = DOCS + """
SELECT event_id, f >= 4 AS ok, CASE WHEN f <> 1 THEN event_type END AS kind,
       CASE WHEN f <> 1 THEN value END AS amount,
       CAST(CASE WHEN f >= 4 THEN 0 WHEN f = 1 THEN 2 ELSE 1 END AS INTEGER) AS n_errors
FROM d
"""

SHAPE = """
'OBJECT<amount: ' || CASE WHEN f = 1 THEN 'VOID' ELSE 'DOUBLE' END || ', at: STRING, big: BOOLEAN, id: BIGINT, items: ' ||
CASE WHEN n = 0 THEN 'ARRAY<VOID>' ELSE 'ARRAY<OBJECT<p: BIGINT, q: STRING>>' END ||
CASE WHEN f = 1 THEN '' ELSE ', kind: STRING' END || ', ratio: DOUBLE, tags: ARRAY<STRING>, user: OBJECT<id: BIGINT, k: ' ||
CASE WHEN f = 0 THEN 'STRING' ELSE 'BIGINT' END || '>' || CASE WHEN f = 10 THEN ', zz: BOOLEAN' ELSE '' END || '>'
"""

# For each rule, the fields of the event documents that pass it.
RULE_PASSES = {
    "rule_boolean": ["big"],
    "rule_integer": ["id"],
    "rule_long": ["id"],
    "rule_double": ["id", "amount"],
    "rule_float": ["id", "amount"],
    "rule_string": ["at", "kind"],
    "rule_date": ["at"],
    "rule_struct": ["user"],
    "rule_array": ["tags"],
}


def _rule_sql(rule: str) -> str:
    rows = []
    for field in ("id", "at", "kind", "amount", "big", "user", "tags", "absent"):
        code = "NULL" if field in RULE_PASSES[rule] else "'type'"
        if rule == "rule_date" and field == "kind":
            code = "'date_format'"
        if rule == "rule_date" and field == "at":
            code = "CASE WHEN f = 2 THEN 'date_format' END"
        if field == "kind":
            code = f"CASE WHEN f = 1 THEN 'required' ELSE {code} END"
        if field == "amount":
            code = f"CASE WHEN f = 1 THEN 'null' ELSE {code} END"
        if field == "absent":
            code = "'required'"
        rows.append(f"SELECT event_id, '/{field}' AS path, {code} AS code FROM d")
    return DOCS + "SELECT * FROM (" + " UNION ALL ".join(rows) + ") WHERE code IS NOT NULL"


ITEMS_JSON = """CASE n WHEN 0 THEN '[]' WHEN 1 THEN '[{"p":1,"q":"i1"}]' ELSE '[{"p":1,"q":"i1"},{"p":2,"q":"i2"}]' END"""

ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"

LEAVES = DOCS + f"""
, item AS (SELECT g.event_id, i FROM good g, range(1, 3) r(i) WHERE i <= g.n)
SELECT event_id, '/id' AS path, 'long' AS type, NULL AS txt, CAST(event_id AS DOUBLE) AS num FROM good
UNION ALL SELECT event_id, '/at', 'timestamp', {ISO}, NULL FROM good
UNION ALL SELECT event_id, '/kind', 'string', event_type, NULL FROM good
UNION ALL SELECT event_id, '/amount', 'double', NULL, value FROM good
UNION ALL SELECT event_id, '/ratio', 'float', NULL,
  CAST(CAST(CAST(value / 100 AS FLOAT) AS VARCHAR) AS DOUBLE) FROM good
UNION ALL SELECT event_id, '/big', 'boolean', CASE WHEN value > 50 THEN 'true' ELSE 'false' END, NULL FROM good
UNION ALL SELECT event_id, '/user/id', 'integer', NULL, user_id FROM good
UNION ALL SELECT event_id, '/user/k', 'integer', NULL, k FROM good
UNION ALL SELECT event_id, '/items/' || (i - 1) || '/p', 'integer', NULL, i FROM item
UNION ALL SELECT event_id, '/items/' || (i - 1) || '/q', 'string', 'i' || i, NULL FROM item
UNION ALL SELECT event_id, '/tags/0', 'string', event_type, NULL FROM good
"""

REJECTS = PATCHES + """
SELECT c_custkey, seq, 'replace' AS op, path,
       CASE WHEN t = 'error' THEN 'invalid_patch' ELSE 'invalid_path' END AS code
FROM q WHERE t IN ('signup', 'error') OR i >= 3
"""

STATE = PATCHES + "SELECT * FROM state"


def oracle_sql() -> dict[str, str]:
    sql = {
        "read_json_docs": DOCS
        + """SELECT event_id, CASE WHEN f <> 1 THEN event_type END AS kind, CASE WHEN f = 10 THEN true END AS extra FROM d""",
        "read_parquet_as": "SELECT * REPLACE (epoch_ms(l_shipdate) AS l_shipdate) FROM lineitem",
        "read_patch_log": PATCHES
        + """SELECT c_custkey, seq, 'replace' AS op, path, CASE t WHEN 'click' THEN CAST(k AS VARCHAR) WHEN 'error' THEN 'yes' END AS txt,
          CAST(CASE t WHEN 'view' THEN value WHEN 'purchase' THEN k WHEN 'signup' THEN k END AS DOUBLE) AS num FROM q""",
        "write_lake": LAKE,
        "write_lake_batches": LAKE,
        "stream_ingest": LAKE,
        "decode": DOCS
        + """SELECT event_id, CASE WHEN f >= 4 THEN event_id END AS id, CASE WHEN f >= 4 THEN epoch_us(ts) END AS at_us,
          CASE WHEN f >= 4 THEN event_type END AS kind, CASE WHEN f >= 4 THEN value END AS amount,
          CASE WHEN f >= 4 THEN CAST(CAST(value / 100 AS FLOAT) AS DOUBLE) END AS ratio,
          CASE WHEN f >= 4 THEN value > 50 END AS big, CASE WHEN f >= 4 THEN CAST(user_id AS INTEGER) END AS user_id,
          CASE WHEN f >= 4 THEN k END AS user_k, CASE WHEN f >= 4 THEN CASE n WHEN 0 THEN '' WHEN 1 THEN '1:i1' ELSE '1:i1,2:i2' END END AS items,
          CASE WHEN f >= 4 THEN event_type END AS tag FROM d""",
        "to_rows": DOCS
        + """SELECT event_id AS id, epoch_us(ts) AS at_us, event_type AS kind, value AS amount, CAST(CAST(value / 100 AS FLOAT) AS DOUBLE) AS ratio, value > 50 AS big,
          CAST(user_id AS INTEGER) AS user_id, k AS user_k, CASE n WHEN 0 THEN '' WHEN 1 THEN '1:i1' ELSE '1:i1,2:i2' END AS items, event_type AS tags FROM good""",
        "flatten_paths": DOCS
        + """SELECT event_id AS id, epoch_us(ts) AS at_us, event_type AS kind, value AS amount, CAST(CAST(value / 100 AS FLOAT) AS DOUBLE) AS ratio, value > 50 AS big,
          CAST(user_id AS INTEGER) AS user_id, k AS user_k,
          CASE n WHEN 0 THEN '' WHEN 1 THEN '1' ELSE '1,2' END AS items_p,
          CASE n WHEN 0 THEN '' WHEN 1 THEN 'i1' ELSE 'i1,i2' END AS items_q, event_type AS tags FROM good""",
        "explode_nodes": LEAVES,
        "avro_layout": "SELECT * REPLACE (epoch_ms(l_shipdate) AS l_shipdate) FROM lineitem",
        "from_avro_layout": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM lineitem",
        "avro_layout_nested": """SELECT o.* REPLACE (epoch_ms(o_orderdate) AS o_orderdate), l.* EXCLUDE (l_orderkey) REPLACE (epoch_ms(l_shipdate) AS l_shipdate)
          FROM orders o LEFT JOIN lineitem l ON l_orderkey = o_orderkey""",
        "from_avro_layout_nested": """SELECT o.* REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate),
          l.* EXCLUDE (l_orderkey) REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate)
          FROM orders o LEFT JOIN lineitem l ON l_orderkey = o_orderkey""",
        "to_json_docs": DOCS
        + f"SELECT event_id AS id, {ISO} AS at, event_type AS kind, value AS amount, CAST(CAST(CAST(value / 100 AS FLOAT) AS VARCHAR) AS DOUBLE) AS ratio, value > 50 AS big, "
        + f"CAST(user_id AS INTEGER) AS user_id, k AS user_k, {ITEMS_JSON} AS items, event_type AS tag FROM good",
        "round_trip_documents": "SELECT doc_id, lang, source, CAST(length(text) AS INTEGER) AS n, md5(text) AS md5 FROM documents",
        "round_trip_conversations": "SELECT conv_id, turn, role, md5(text) AS md5 FROM conversations",
        "round_trip_embeddings": """SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
          CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings""",
        "validate": DOCS
        + """SELECT event_id, CAST(CASE WHEN f = 1 THEN 2 WHEN f < 4 THEN 1 ELSE 0 END AS INTEGER) AS n_errors,
          CASE f WHEN 0 THEN '/user/k' WHEN 1 THEN '/kind,/amount' WHEN 2 THEN '/at' WHEN 3 THEN '/user/id' ELSE '' END AS paths,
          CASE f WHEN 0 THEN 'type' WHEN 1 THEN 'required,null' WHEN 2 THEN 'date_format' WHEN 3 THEN 'range' ELSE '' END AS codes
          FROM d""",
        "split_valid": DOCS
        + """SELECT event_id, f >= 4 AS ok,
          CASE f WHEN 0 THEN 'type' WHEN 1 THEN 'required,null' WHEN 2 THEN 'date_format' WHEN 3 THEN 'range' ELSE '' END AS codes
          FROM d""",
        "first_incompatibility": DOCS
        + """SELECT event_id, CASE f WHEN 0 THEN '/user/k' WHEN 1 THEN '/kind' WHEN 2 THEN '/at' ELSE '/user/id' END AS path,
          CASE f WHEN 0 THEN 'integer' WHEN 1 THEN 'string' WHEN 2 THEN 'timestamp' ELSE 'integer' END AS expected,
          CASE f WHEN 0 THEN 'STRING' WHEN 1 THEN 'MISSING' WHEN 2 THEN 'STRING' ELSE 'BIGINT' END AS found
          FROM d WHERE f < 4""",
        "conform_table": """SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, l_orderkey, l_quantity,
          epoch_ms(l_shipdate) AS l_shipdate FROM lineitem""",
        "error_report": DOCS
        + """SELECT path, code, count(*) AS n, min(event_id) AS example FROM (
          SELECT event_id, '/user/k' AS path, 'type' AS code FROM d WHERE f = 0
          UNION ALL SELECT event_id, '/kind', 'required' FROM d WHERE f = 1
          UNION ALL SELECT event_id, '/amount', 'null' FROM d WHERE f = 1
          UNION ALL SELECT event_id, '/at', 'date_format' FROM d WHERE f = 2
          UNION ALL SELECT event_id, '/user/id', 'range' FROM d WHERE f = 3) GROUP BY path, code""",
        "shape_registry": DOCS
        + f"""SELECT sha256(shape) AS fingerprint, shape, count(*) AS n, min(event_id) AS example
          FROM (SELECT event_id, {SHAPE} AS shape FROM d) GROUP BY shape""",
        "shape_registry_nested": DOCS
        + """SELECT sha256(shape) AS fingerprint, shape, CAST(sum(n) AS BIGINT) AS n, CAST(1 AS BIGINT) AS n_paths,
          min(path) AS example_path, min(event_id) AS example FROM (
            SELECT event_id, '/user' AS path, 1 AS n,
              'OBJECT<id: BIGINT, k: ' || CASE WHEN f = 0 THEN 'STRING' ELSE 'BIGINT' END || '>' AS shape FROM d
            UNION ALL SELECT event_id, '/items/*', n, 'OBJECT<p: BIGINT, q: STRING>' FROM d WHERE n > 0
            UNION ALL SELECT event_id, '', 1, """
        + SHAPE
        + " FROM d) GROUP BY shape",
        "sort_values": "SELECT row_number() OVER (ORDER BY l_quantity) - 1 AS place, l_quantity FROM lineitem",
        "sort_arrays": """SELECT vec_id, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS pos, CAST(unnest(s) AS DOUBLE) AS v
          FROM (SELECT vec_id, list_sort(embedding) AS s FROM embeddings)""",
        "resolve_paths": PATCHES
        + """SELECT c_custkey, seq, path, t <> 'signup' AS known,
          CAST(CASE WHEN t IN ('signup', 'error') THEN 1 ELSE 2 END AS INTEGER) AS depth FROM q""",
        "validate_patches": PATCHES
        + """SELECT c_custkey, seq, CASE t WHEN 'signup' THEN 'invalid_path' WHEN 'error' THEN 'invalid_patch' END AS code,
          CASE WHEN t = 'error' THEN '/active' ELSE '' END AS error_paths,
          CASE WHEN t = 'error' THEN 'type' ELSE '' END AS error_codes FROM q""",
        "path_in_data": PATCHES + "SELECT c_custkey, seq, path, i IS NULL OR i < 3 AS in_data FROM fits",
        "apply_patch": """SELECT c_custkey, c_name AS name, 'NEW' AS segment, c_acctbal AS balance,
          CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '1' WHEN 2 THEN '1,42' ELSE '1,42,3' END AS scores,
          true AS active, CAST(NULL AS VARCHAR) AS first_code,
          CASE WHEN c_custkey % 4 < 2 THEN 'invalid_path' END AS patch_code FROM customer""",
        "patch_outcomes": PATCHES
        + """, b AS (
          SELECT CASE WHEN seq % 97 <> 0 THEN c_custkey END AS k1,
            CASE WHEN seq % 89 = 1 THEN NULL WHEN seq % 7 = 3 THEN seq - seq % 300 ELSE seq END AS s1,
            seq % 61 = 5 AS oops, t, i, path,
            CASE WHEN seq % 61 <> 5 THEN path || ' ' || CASE WHEN t = 'view' THEN CAST(value AS VARCHAR)
              WHEN t = 'click' THEN 'k' || k WHEN t IN ('purchase', 'signup') THEN CAST(k AS VARCHAR) ELSE 'yes' END END AS says FROM q
        ), once AS (
          SELECT * FROM b WHERE k1 IS NULL OR s1 IS NULL
          UNION ALL SELECT DISTINCT ON (k1, s1, says) * FROM b WHERE k1 IS NOT NULL AND s1 IS NOT NULL
        ), judged AS (
          SELECT *, CASE WHEN k1 IS NULL THEN 'no_key' WHEN s1 IS NULL THEN 'no_seq'
            WHEN count(*) OVER (PARTITION BY k1, s1) > 1 THEN 'duplicate_seq' WHEN oops THEN 'malformed'
            WHEN t = 'signup' OR i >= 3 THEN 'invalid_path' WHEN t = 'error' THEN 'invalid_patch' END AS code FROM once
        )
        SELECT outcome, count(*) AS n FROM (
          SELECT coalesce(code, CASE WHEN s1 = max(s1) FILTER (code IS NULL) OVER (PARTITION BY k1, path)
            THEN 'applied' ELSE 'overwritten' END) AS outcome FROM judged) GROUP BY outcome""",
        "patch_embeddings": """WITH p AS (
          SELECT vec_id, m, CAST((vec_id * 7 + m * m) % 70 AS INTEGER) AS pos FROM embeddings, range(10) r(m)
        ), last AS (SELECT vec_id, pos, max(m) AS m FROM p GROUP BY ALL), item AS (
          SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS v FROM embeddings
        )
        SELECT vec_id, pos, CAST(coalesce(last.m, v) AS DOUBLE) AS v FROM item LEFT JOIN last USING (vec_id, pos)""",
        "compact_patch_log": PATCHES + "SELECT c_custkey, max(seq) AS seq, path FROM fits GROUP BY c_custkey, path",
        "attach_patches": PATCHES
        + """, latest AS (SELECT c_custkey, path, max(seq) AS seq FROM applied GROUP BY ALL)
          SELECT c.c_custkey, CAST(count(path) AS INTEGER) AS n, max(seq) AS last_seq, string_agg(path, ',' ORDER BY seq) AS paths
          FROM customer c LEFT JOIN latest l ON l.c_custkey = c.c_custkey GROUP BY c.c_custkey""",
        "apply_patch_log": STATE,
        "apply_redelivered_log": STATE,
        "stream_patch_log": STATE,
        "stream_latest_patches": STATE,
        "stream_redelivered": STATE,
        "stream_apply_patches": PATCHES
        + """SELECT s.*, coalesce(p, 0) AS bad_paths, coalesce(v, 0) AS bad_values FROM state s LEFT JOIN (
          SELECT c_custkey, count(*) FILTER (t = 'signup' OR i >= 3) AS p, count(*) FILTER (t = 'error') AS v FROM q GROUP BY c_custkey
        ) r ON r.c_custkey = s.c_custkey""",
        "patch_rejects": REJECTS,
        "patch_orphans": PATCHES
        + """SELECT q.c_custkey * 11 AS c_custkey, seq, path,
          CASE WHEN t = 'error' THEN 'invalid_patch' WHEN t = 'signup' THEN 'invalid_path'
               WHEN c.c_custkey IS NULL THEN 'unknown_entity' ELSE 'invalid_path' END AS code
          FROM q LEFT JOIN customer c ON c.c_custkey = q.c_custkey * 11
          WHERE t IN ('signup', 'error') OR c.c_custkey IS NULL OR i >= 3""",
        "duplicate_seqs": """SELECT user_id AS c_custkey, epoch_us(ts) // 3600000000 AS seq, count(*) AS n
          FROM events GROUP BY ALL HAVING count(*) > 1""",
        "generate_rows": "SELECT event_id, CAST(0 AS INTEGER) AS n_errors FROM events",
        "generate_patches": "SELECT c_custkey, CAST(3 AS BIGINT) AS n_patches, true AS first_in_data FROM customer",
        "corrupt_docs": "SELECT event_id, true AS agrees FROM events",
    }
    sql.update({rule: _rule_sql(rule) for rule in RULE_PASSES})
    return sql
