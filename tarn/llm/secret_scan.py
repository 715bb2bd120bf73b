r"""Secret scans with corpus-wide ownership frequency.

Patterns find candidates in whole texts: assignments (``assign``), access keys (``access``), hexadecimal strings (``hex``) and
other long strings of mixed letters and digits. The hashes of their values are counted over the corpus by distinct
repositories and owners. A value that many owners or repositories hold is a widely copied example; one that few hold
looks live, and is its owners' own. Spans of the first three kinds are always reported, with that verdict; strings of the last kind
are reported, as ``owned``, only where they look live and no other span covers part of them.

All of it is DataFrame functions. Positions come from the lengths of the matches and of the text between them, summed in
order within a document. Values are kept as SHA-256 only. Few values can be frequent: those with more than
one in ``HOT_PARTS`` of all spans are at most ``HOT_PARTS``, so their counts are broadcast; the others are joined by a shuffle
in which no value holds more than that part.

Defined cases: a null or empty text has no span; a null owner or repository counts as one further owner or repository;
rows that repeat a document are each reported, and count once if their repository and owner repeat; an empty
table gives no row; columns named as the added ones are replaced (whatever the case of their letters), other columns are kept and
the text is left out; texts of any length are scanned whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.columns import place, sheltered
from tarn.session import staged


def _either_case(word: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", word)


_NAMES = "|".join(_either_case(w) for w in "password passwd secret token api_?key".split())

# Kinds in their order, each with its pattern, the group that holds the value, and how long that is at least.
# A match that is too short still takes its text where a longer one could begin inside it, so its length is judged after.
KINDS = {
    "assign": (rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
    "owned": ("[A-Za-z0-9_-]{20,}", 0, 20),
}
#: More distinct owners or repositories than these make a value an example.
MOST_OWNERS = 2
MOST_REPOSITORIES = 20
#: A value in more than one of so many spans is looked up by broadcast.
HOT_PARTS = 1000
ADDED = ("spans", "n_live", "n_example")


def _looks_random(value: Column) -> Column:
    """Letters and at least three digits."""
    return value.rlike("[A-Za-z]") & value.rlike("[0-9].*[0-9].*[0-9]")


def _matches(kind: str, text: Column) -> Column:
    """The matches of a kind in order, as (number, characters before it since the last one, its characters, those of its
    value, the value's hash). The first scan tells whether there is any."""
    pattern, group, _ = KINDS[kind]
    regex = F.lit(pattern)
    zipped = F.arrays_zip(
        F.split(text, regex, -1).alias("gap"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, regex, F.lit(group)).alias("value"),
    )

    def entry(m: Column, i: Column) -> Column:
        fits = F.length(m["value"]) >= KINDS[kind][2]
        if kind == "owned":
            fits = fits & _looks_random(m["value"])
        return F.struct(
            F.lit(list(KINDS).index(kind)).alias("kind"),
            i.alias("k"),
            F.length(m["gap"]).alias("gap"),
            F.length(m["whole"]).alias("size"),
            F.when(fits, F.unhex(F.sha2(m["value"].cast("binary"), 256))).alias("hash"),
        )

    # What follows the last match has no match of its own; runs of letters without digits, nearly all matches of ``owned``, go
    # by their lengths alone.
    found = F.filter(F.transform(zipped, entry), lambda e: e["size"].isNotNull())
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<kind:int,k:int,gap:int,size:int,hash:binary>>"))


def _spans(found: DataFrame) -> DataFrame:
    """The spans of all documents: ``_row, kind, start, end, hash`` and where they were found."""
    each = found.select("_row", "_owner", "_repository", F.inline(F.flatten(F.array(*[F.col(f"_{k}") for k in KINDS]))))
    order = Window.partitionBy("_row", "kind").orderBy("k")
    upto = F.sum(F.col("gap") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = each.withColumn("end", upto).withColumn("start", F.col("end") - F.col("size")).where("hash IS NOT NULL")
    other = len(KINDS) - 1
    base = F.col("kind") < other
    by_start = Window.partitionBy("_row").orderBy("start")
    before = F.max(F.when(base, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(base, F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    covered = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    marked = placed.withColumn("_covered", ~base & covered).where("NOT _covered")
    return marked.select("_row", "_owner", "_repository", "kind", "start", "end", "hash")


def ownership(spans: DataFrame) -> DataFrame:
    """For each hash, its spans and the distinct owners and repositories that hold it. Repeats go in partial aggregations, so a
    value found everywhere arrives as a few rows per task."""
    return spans.groupBy("hash").agg(
        F.count_distinct("_owner").alias("owners"), F.count_distinct("_repository").alias("repositories"), F.count("*").alias("n")
    )


def _with_verdicts(spans: DataFrame) -> DataFrame:
    counts = staged(ownership(spans), "secret-owners")
    total = counts.agg(F.sum("n")).first()[0] or 0
    live = (F.col("owners") <= MOST_OWNERS) & (F.col("repositories") <= MOST_REPOSITORIES)
    known = counts.select("hash", "n", live.alias("live"))
    hot = known.where(F.col("n") * HOT_PARTS > F.lit(total)).select("hash", F.col("live").alias("_hot"))
    rest = known.where(F.col("n") * HOT_PARTS <= F.lit(total)).select("hash", "live")
    marked = spans.join(F.broadcast(hot), "hash", "left")
    frequent = marked.where("_hot IS NOT NULL").withColumnRenamed("_hot", "live")
    return frequent.unionByName(marked.where("_hot IS NULL").drop("_hot").join(rest, "hash"))


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without their text, with ``spans``: kind, start, end (in code points, the end exclusive) and whether the value looks
    ``live``, by start, then kind; ``n_live`` and ``n_example`` count them."""
    docs = docs.drop(*ADDED)
    rows, held = sheltered(docs), F.coalesce(F.col(place(docs, text)).cast("string"), F.lit(""))
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(place(docs, c)).cast("string")), F.lit(""))
    found = rows.select(
        *[c for c in rows.columns if c != place(docs, text)],
        F.monotonically_increasing_id().alias("_row"),
        named(owner).alias("_owner"),
        named(repository).alias("_repository"),
        *[_matches(k, held).alias(f"_{k}") for k in KINDS],
    )
    found = staged(found, "secret-matches")
    spans = _with_verdicts(staged(_spans(found), "secret-spans"))
    spans = spans.where((F.col("kind") < len(KINDS) - 1) | F.col("live"))
    entry = F.struct("start", "kind", "end", "live")
    by_row = spans.groupBy("_row").agg(F.array_sort(F.collect_list(entry)).alias("_spans"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>")
    listed = F.transform(
        F.coalesce("_spans", none),
        lambda s: F.struct(F.get(kinds, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["live"].alias("live")),
    )
    joined = found.drop("_owner", "_repository", *[f"_{k}" for k in KINDS]).join(by_row, "_row", "left").withColumn("spans", listed)
    return joined.select(
        *[F.col(place(docs, c)).alias(c) for c in docs.columns if c != text],
        "spans",
        F.size(F.filter("spans", lambda s: s["live"])).alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).alias("n_example"),
    )


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
