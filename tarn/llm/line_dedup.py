r"""Line deduplication by a suffix array over line numbers, with DataFrame functions only.

A text is a sequence of lines, and each line that occurs twice or more has a name:
the place (document, line) of its first occurrence. Prefix doubling names longer
runs: the name of ``2**(j+1)`` lines is the first place with the same two names of
``2**j`` lines. Sorted by names, suffixes with a common prefix stand together, and
a group of equal names is a longest-common-prefix interval of at least that many
lines, whose earliest member is the name itself. Suffixes without a partner leave
after each round, so the rounds get smaller.

A repeated run counts if it has ``min_words`` words. All such runs follow from the
shortest ones: from each line the shortest run onwards with that many words, and to
each line the shortest one backwards. A run of d lines is named by the names of its
first and last ``2**j`` lines, ``2**j <= d``. Where that name is an earlier place, the
lines are a later copy and are deleted; what joins up is one maximal run.

Copies of a whole text take part once; they are later copies from end to end.

Defined cases: documents are ordered by ``doc_id`` (nulls last), then by the text's
MD5; rows that repeat both are one document; lines that overlap
their own copy (one line many times over) keep the first of them; blank lines belong to no run
and stay; a null text has no lines and stays null; a text in one line is a run of one
line; a very long text is split into lines within one row; an empty table gives no
row; further columns are kept, but columns named
``n_lines``, ``n_deleted`` or ``n_runs`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarn.llm.columns import place, restored, sheltered
from tarn.llm.mixing import count_tokens
from tarn.session import staged

MIN_WORDS = 50

_DOC = ["no_id", "first_id", "text_key"]


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per line of each distinct text: document, line, hashes, words."""
    parts = F.transform(
        F.split(F.col(text), "\n"),
        lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(x, F.lit("line")).alias("h2"), count_tokens(x).alias("words")),
    )
    rows = docs.where(F.col(text).isNotNull()).select(
        F.col(key).cast("bigint").alias("id"), _text_key(F.col(text)).alias("text_key"), parts.alias("parts")
    )
    rows = rows.groupBy("text_key").agg(F.min("id").alias("first_id"), F.first("parts").alias("parts"))
    rows = rows.select(
        F.col("first_id").isNull().alias("no_id"), "first_id", "text_key", F.posexplode("parts").alias("line", "part")
    )
    return rows.select(*_DOC, "line", "part.*")


def _repeated(lines: DataFrame) -> DataFrame:
    """Lines that occur twice or more, with the place of the first one as name,
    cut into chains of lines that follow each other (blank ones left out)."""
    place = F.struct(*_DOC, "line")
    full = lines.where("words > 0").withColumn("ord", F.row_number().over(Window.partitionBy(*_DOC).orderBy("line")))
    full = staged(full, "line-rows")
    names = full.groupBy("h1", "h2").agg(F.min(place).alias("name"), F.count("*").alias("n")).where("n > 1").drop("n")
    live = full.join(names, ["h1", "h2"]).drop("h1", "h2")
    doc = Window.partitionBy(*_DOC).orderBy("ord")
    chain = [*_DOC, "chain"]
    live = live.withColumn("chain", F.col("ord") - F.row_number().over(doc))
    upto = Window.partitionBy(*chain).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return staged(live.withColumn("after", F.sum("words").over(upto)), "line-live")


def _shortest_runs(live: DataFrame, min_words: int) -> DataFrame:
    """(chain, from, to): for each line, the shortest run onwards and the shortest
    run backwards with ``min_words`` words, if its chain is long enough."""
    chain = [*_DOC, "chain"]
    before = F.col("after") - F.col("words")
    event = lambda value, line, asks: F.struct(
        value.cast("bigint").alias("value"), line.alias("seen"), asks.alias("asks")
    )
    none, own = F.lit(None).cast("int"), F.col("ord")

    def answers(seen_at: Column, asked: Column, onwards: bool) -> DataFrame:
        rows = live.select(*chain, F.explode(F.array(event(seen_at, own, none), event(asked, none, own))).alias("e"))
        rows = rows.select(*chain, "e.*")
        # At equal values, a line that is seen comes before those that ask.
        value = F.col("value").desc() if onwards else F.col("value")
        seen = F.col("seen").desc_nulls_last() if onwards else F.col("seen").asc_nulls_last()
        upto = Window.partitionBy(*chain).orderBy(value, seen).rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("found", F.last("seen", ignorenulls=True).over(upto))
        return rows.where("asks IS NOT NULL AND found IS NOT NULL").select(*chain, "asks", "found")

    onwards = answers(F.col("after"), before + min_words, True)
    backwards = answers(before, F.col("after") - min_words, False)
    return (
        onwards.select(*chain, F.col("asks").alias("from"), F.col("found").alias("to"))
        .unionByName(backwards.select(*chain, F.col("found").alias("from"), F.col("asks").alias("to")))
        .distinct()
        .withColumn("depth", F.col("to") - F.col("from") + 1)
    )


def _doubled(live: DataFrame, top: int) -> DataFrame:
    """Names of all runs of 1, 2, 4, ... ``2**top`` lines that occur twice."""
    chain = [*_DOC, "chain"]
    level = live.select(*chain, "ord", "line", "name")
    found = level.withColumn("j", F.lit(0))
    for j in range(top):
        ahead = F.lead(F.struct("ord", "name"), 1 << j).over(Window.partitionBy(*chain).orderBy("ord"))
        pairs = level.withColumn("ahead", ahead).where(F.col("ahead.ord") == F.col("ord") + (1 << j))
        pairs = pairs.select(*chain, "ord", "line", F.col("name").alias("l"), F.col("ahead.name").alias("r"))
        names = pairs.groupBy("l", "r").agg(F.min(F.struct(*_DOC, "line")).alias("name"), F.count("*").alias("n"))
        level = staged(pairs.join(names.where("n > 1").drop("n"), ["l", "r"]).drop("l", "r"), "line-names")
        found = found.unionByName(level.withColumn("j", F.lit(j + 1)))
    return found


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All lines of the distinct texts, and ``(document, line)`` of each line to delete."""
    lines = staged(_lines(docs, text, key), "lines")
    live = _repeated(lines)
    runs = staged(_shortest_runs(live, min_words), "line-runs")
    deepest = runs.agg(F.max("depth")).first()[0] or 1
    names = _doubled(live, deepest.bit_length() - 1)
    chain = [*_DOC, "chain"]
    j = F.floor(F.log2("depth")).cast("int")
    runs = runs.withColumn("j", j).withColumn("second", F.col("to") + 1 - F.expr("shiftleft(1, j)"))
    first = names.select(*chain, "j", F.col("ord").alias("from"), "line", F.col("name").alias("l"))
    last = names.select(*chain, "j", F.col("ord").alias("second"), F.col("name").alias("r"))
    named = runs.join(first, [*chain, "j", "from"]).join(last, [*chain, "j", "second"])
    place = F.struct(*_DOC, "line")
    heads = named.groupBy("depth", "l", "r").agg(F.min(place).alias("head"))
    copies = named.join(heads, ["depth", "l", "r"]).where(place > F.col("head"))
    spots = copies.select(*chain, F.explode(F.sequence("from", "to")).alias("ord")).distinct()
    return lines, spots.join(live.select(*chain, "ord", "line"), [*chain, "ord"]).select(*_DOC, "line")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with later copies of repeated line runs cut from the text, and
    ``n_lines`` (not blank), ``n_deleted`` and ``n_runs`` (maximal deleted runs)."""
    lines, gone = later_copies(docs, min_words, text, key)
    gone = staged(gone.withColumn("gone", F.lit(True)), "lines-gone")
    touched = lines.join(gone.select("text_key").distinct(), "text_key", "left_semi")
    null_safe = (touched["text_key"] == gone["text_key"]) & (touched["line"] == gone["line"])
    flags = touched.join(gone, null_safe, "left").select(touched["text_key"], touched["line"], F.coalesce("gone", F.lit(False)).alias("gone"))
    flags = flags.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("line", "gone"))).alias("_f"))
    flags = flags.select("text_key", F.col("_f.gone").alias("_gone"))
    totals = lines.groupBy("text_key").agg(
        F.first("first_id").alias("_first"), F.sum("words").alias("_words"), F.count_if(F.col("words") > 0).alias("_full")
    )
    facts = totals.join(flags, "text_key", "left").withColumnRenamed("text_key", "_text_key")
    docs = docs.drop("n_lines", "n_deleted", "n_runs")
    key, text = place(docs, key), place(docs, text)
    rows = sheltered(docs).withColumn("_text_key", _text_key(F.col(text))).join(facts, "_text_key", "left")
    parts = F.split(F.col(text), "\n")
    again = ~F.col(key).cast("bigint").eqNullSafe(F.col("_first")) & (F.col("_words") >= min_words)
    blank = F.transform(parts, lambda x: count_tokens(x) == 0)
    gone_now = F.when(again, F.transform(blank, lambda b: ~b)).otherwise(F.col("_gone"))
    rows = rows.withColumn("_now", F.when(F.col(text).isNotNull(), gone_now))
    kept = F.filter(parts, lambda x, i: ~F.element_at(F.col("_now"), i + 1))
    # A run begins where the line before, blank ones aside, is not deleted.
    full = F.filter(F.transform(blank, lambda b, i: F.when(~b, F.element_at(F.col("_now"), i + 1))), lambda b: b.isNotNull())
    rows = rows.withColumn("_full_gone", F.when(F.col("_now").isNotNull(), full))
    begins = F.filter("_full_gone", lambda g, i: g & ((i == 0) | ~F.element_at(F.col("_full_gone"), F.greatest(i, F.lit(1)))))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    whole = [c for c in rows.columns if c.startswith("_kept_") and c != text]
    rows = rows.select(
        *whole,
        F.when(F.col("_now").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias(text),
        count(F.col("_full")).alias("n_lines"),
        count(F.when(F.col("_now").isNotNull(), F.size(F.filter("_now", lambda g: g)))).alias("n_deleted"),
        count(F.when(F.col("_now").isNotNull(), F.size(begins))).alias("n_runs"),
    )
    return restored(rows, docs, "n_lines", "n_deleted", "n_runs")
