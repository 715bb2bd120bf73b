"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed over the cells of source, language and topic. Each round rakes
the cells' weights to the target share of every source, then language, then
topic; after ``rounds`` rounds, a cell's weight over its tokens is the
calibration factor of its documents.

How much is kept is a parameter. With ``share``, the sample's expected tokens are
that share of all tokens: a cell is raked to at most its own tokens, so a rare cell
is held whole and the rest is raked again, and at the end all cells below that are
scaled alike to meet the share. So a rare cell's shortfall goes to the others and
never lowers them. Without ``share`` a document is kept with probability
``factor / largest factor``: the expected tokens have exactly the raked shares, but
the rarest cell decides how much is kept.

Only the cells take part in the rounds, never documents; totals, the largest
factor and the scale, single numbers, go through the driver. The draw is a hash of
id and text, so a lost task draws the same again.

Defined cases: a null category is the category ``''``; a null or wordless text
has 0 tokens and is kept (it costs nothing); repeated rows are drawn alike;
a very long text is split into words within one row; an empty table gives no row;
further columns are kept, but columns named ``topic``,
``n_tokens``, ``p`` or ``kept`` are replaced (``topic`` only if it is derived here).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarn.llm.columns import place, restored, sheltered
from tarn.session import staged

#: A margin's target: an exponent on its own shares, or weights by value.
Target = float | dict[str, float]

ROUNDS = 10
TARGETS: dict[str, Target] = {
    "source": 0.7,
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
    "topic": 0.9,
}

_CELL, _WEIGHT = "_mix_tokens", "_mix_weight"


def topic_of(text: Column) -> Column:
    """A coarse topic by marker words."""
    lower = F.lower(text)
    return (
        F.when(lower.contains("license") | lower.contains("rights reserved"), F.lit("licence"))
        .when(text.contains("@") | text.contains("://"), F.lit("contact"))
        .otherwise(F.lit("prose"))
    )


def count_tokens(text: Column) -> Column:
    """Words between runs of ASCII white space."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \t-\r]+")
    return F.size(F.filter(parts, lambda x: x != "")).cast("bigint")


def _margin(cells: DataFrame, name: str, target: Target) -> DataFrame:
    """``(name, target share)``; the shares sum to 1. A value that a weight table
    does not list keeps its own share, and the listed ones divide the rest."""
    own = cells.groupBy(name).agg(F.sum(_CELL).alias("own"))
    total = cells.agg(F.sum(_CELL)).first()[0] or 1
    own = own.withColumn("share", F.col("own") / F.lit(total))
    if isinstance(target, dict):
        listed = F.lit(None).cast("double")
        for value, weight in target.items():
            listed = F.when(F.col(name) == value, F.lit(float(weight))).otherwise(listed)
        own = own.withColumn("listed", listed)
        unlisted = F.sum(F.when(F.col("listed").isNull(), F.col("share")).otherwise(0.0))
        kept, weights = own.agg(unlisted, F.sum("listed")).first()
        goal = F.coalesce((1 - F.lit(kept or 0.0)) * F.col("listed") / F.lit(weights or 1.0), F.col("share"))
    else:
        own = own.withColumn("powered", F.pow("share", F.lit(float(target))))
        goal = F.col("powered") / F.lit(own.agg(F.sum("powered")).first()[0] or 1.0)
    return own.select(name, goal.alias(f"_mix_{name}"))


def calibrate(
    cells: DataFrame, targets: dict[str, Target], rounds: int = ROUNDS, budget: float | None = None
) -> DataFrame:
    """Cells ``(categories, _mix_tokens)`` with ``_mix_weight``: shares of all
    tokens whose margins are the targets; with ``budget``, tokens that add up to it,
    in no cell more than it has."""
    weights = cells
    for name, target in targets.items():
        weights = weights.join(_margin(cells, name, target), name)
    weights = staged(weights.withColumn(_WEIGHT, F.col(_CELL).cast("double")), "mix-cells")
    for k in range(rounds):
        for name in targets:
            total = F.sum(_WEIGHT).over(Window.partitionBy(name))
            raked = F.col(_WEIGHT) * F.col(f"_mix_{name}") / total
            if budget is not None:
                raked = F.least(raked * F.lit(float(budget)), F.col(_CELL).cast("double"))
            weights = weights.withColumn(_WEIGHT, raked)
        if k % 5 == 4:
            weights = staged(weights, "mix-round")
    weights = weights.drop(*[f"_mix_{name}" for name in targets])
    return weights if budget is None else _filled(staged(weights, "mix-raked"), float(budget))


def _filled(weights: DataFrame, budget: float) -> DataFrame:
    """Weights scaled alike, but none above its cell's tokens, to add up to ``budget``.

    Newton's steps on a sum of ``min(tokens, scale * weight)``: it is concave in the
    scale, so they only rise, and end when no further cell becomes whole."""
    tokens, weight, scale, held = F.col(_CELL).cast("double"), F.col(_WEIGHT), 1.0, -1
    while True:
        whole = weight * F.lit(scale) >= tokens
        n, full, free = weights.agg(
            F.count(F.when(whole, 1)), F.sum(F.when(whole, tokens)), F.sum(F.when(~whole, weight))
        ).first()
        if n == held or not free:
            return weights.withColumn(_WEIGHT, F.least(weight * F.lit(scale), tokens))
        held, scale = n, max(scale, (budget - (full or 0.0)) / free)


def mix(
    docs: DataFrame,
    targets: dict[str, Target] = TARGETS,
    rounds: int = ROUNDS,
    text: str = "text",
    key: str = "doc_id",
    share: float | None = None,
) -> DataFrame:
    """``docs`` with ``topic`` (where it is a target and not a column yet),
    ``n_tokens``, the probability ``p`` and the draw ``kept``; ``share`` is the part
    of all tokens to keep, above 0 and up to 1."""
    if share is not None and not 0 < share <= 1:
        raise ValueError(f"share must be above 0 and at most 1: {share}")
    docs = docs.drop("n_tokens", "p", "kept")
    if "topic" in targets and "topic" not in docs.columns:
        docs = docs.withColumn("topic", topic_of(F.coalesce(F.col(text), F.lit(""))))
    key, text = place(docs, key), place(docs, text)
    rows = sheltered(docs).withColumn("n_tokens", count_tokens(F.col(text)))
    named = {f"_mix_key_{name}": F.coalesce(F.col(place(docs, name)).cast("string"), F.lit("")) for name in targets}
    rows = rows.withColumns(named)
    cells = staged(
        rows.where("n_tokens > 0")
        .groupBy(*[F.col(k).alias(name) for k, name in zip(named, targets)])
        .agg(F.sum("n_tokens").alias(_CELL)),
        "mix-cells",
    )
    budget = None if share is None else share * (cells.agg(F.sum(_CELL)).first()[0] or 0)
    factors = calibrate(cells, targets, rounds, budget).select(
        *[F.col(n).alias(k) for k, n in zip(named, targets)], (F.col(_WEIGHT) / F.col(_CELL)).alias("_mix_factor")
    )
    factors = staged(factors, "mix-factors")
    top = (factors.agg(F.max("_mix_factor")).first()[0] or 1.0) if share is None else 1.0
    factors = factors.withColumn("_mix_p", F.col("_mix_factor") / F.lit(top)).drop("_mix_factor")
    joined = rows.join(factors, list(named), "left")
    p = F.when(F.col("n_tokens") == 0, F.lit(1.0)).otherwise(F.col("_mix_p"))
    drawn = joined.withColumn("p", p).withColumn("kept", draw(F.col(key), F.col(text)) < F.col("p"))
    return restored(drawn, docs, "n_tokens", "p", "kept")


def draw(key: Column, text: Column) -> Column:
    """A number in [0, 1) fixed by id and text."""
    seed = F.concat(F.lit("mix:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(seed.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))
