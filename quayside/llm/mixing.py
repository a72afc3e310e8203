"""Mixing sources to target weights by Poisson replication.

A source of ``size`` characters that is to make up ``share`` of a corpus of ``total``
gets the mean repetition rate ``share * total / size``. Each document is repeated as
often as a Poisson distribution of that mean says, inverted at a number in [0, 1) that
the document's id and the seed give. So a run repeated after a failure draws the same
copies. Rates above ``PART`` are drawn as a sum of equal parts, as exp(-rate) would
vanish. The copies are then put in the order of a hash, across all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import by_rows, sent_if_small
from quayside.session import stage

SEED = 17
#: Without given weights a source weighs its size to this power, so that small ones gain.
POWER = 0.5
#: Largest mean that is drawn at once, and the counts at which its distribution is cut:
#: beyond them less than 2**-60 is left, below the resolution of the draw.
PART, COUNTS = 8.0, 64
TASK_CHARS = 16_000_000


def uniform(*parts: Column | str) -> Column:
    """52 bits of the md5 of the parts, as a number in [0, 1)."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def size_of() -> Column:
    """Characters of a document, and one more: a source of empty texts has a size too."""
    return F.length(F.coalesce(F.col("text"), F.lit(""))) + 1


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``source, size, rate``; null is a source like any other.

    ``weights`` names target weights, and sources it does not name get none of the
    corpus. Sizes are counted over all documents, once: a row per source is staged.
    """
    sizes = stage(docs.groupBy("source").agg(F.sum(size_of()).alias("size")), "source-sizes")
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(POWER))
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(value))).otherwise(weight)
    weighed = sizes.withColumn("weight", weight)
    total, whole = weighed.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.col("weight") / F.lit(float(whole or 1.0) or 1.0) * F.lit(float(total or 0)) / F.col("size")
    return weighed.select("source", "size", rate.alias("rate"))


def distributions(rates: DataFrame) -> DataFrame:
    """``source, parts, cdf``: the cumulated Poisson distribution of one part of each rate."""
    first = F.expr("exp(-part)")
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(COUNTS - 1)),
        F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("cdf")),
        lambda state, k: F.struct(
            (state["p"] * F.col("part") / k).alias("p"),
            (state["c"] + state["p"] * F.col("part") / k).alias("c"),
            F.concat(state["cdf"], F.array(state["c"] + state["p"] * F.col("part") / k)).alias("cdf"),
        ),
    )
    parts = F.greatest(F.ceil(F.col("rate") / PART).cast("int"), F.lit(1))
    return (
        rates.withColumn("parts", parts)
        .withColumn("part", F.col("rate") / F.col("parts"))
        .select("source", "parts", steps["cdf"].alias("cdf"))
    )


def mix(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """Columns of ``docs``, ``copy`` (from 1) and ``shuffle_key``, in the order of that key.

    Rows without doc_id or with a null or empty text are drawn like others; rows that
    share a doc_id are drawn alike. Columns of ``docs`` that are called copy or
    shuffle_key, in whatever case, are replaced; all others keep name and value, as the
    operator's own columns live beside numbered ones.
    """
    spark = docs.sparkSession
    rates = stage(source_rates(docs, weights), "source-rates")
    total = rates.agg(F.sum("size")).first()[0] or 0
    drawn = sent_if_small(distributions(rates).select(F.struct("*").alias("dealt")))
    kept = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    plain = {f"in_{i}": c for i, c in enumerate(kept)}
    inner = docs.select(*[quoted(c).alias(i) for i, c in plain.items()], doc_key().alias("key"), F.col("source").alias("of"))
    numbers = F.transform(
        F.sequence(F.lit(0), F.col("dealt.parts") - 1),
        lambda part: uniform(F.lit(str(seed)), F.col("key"), part.cast("string")),
    )
    draws = F.aggregate(numbers, F.lit(0), lambda n, u: n + F.size(F.filter("dealt.cdf", lambda c: c <= u)))
    copies = (
        inner.join(drawn, F.col("of").eqNullSafe(F.col("dealt.source")))
        .withColumn("n", draws)
        .filter("n > 0")
        .select(*plain, "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
        .withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.col("key"), F.col("copy").cast("string"))))
        .drop("key")
    )
    dealt = copies.repartitionByRange(by_rows(spark, total, TASK_CHARS), "shuffle_key").sortWithinPartitions("shuffle_key")
    return dealt.select(*[F.col(i).alias(c) for i, c in plain.items()], "copy", "shuffle_key")


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
