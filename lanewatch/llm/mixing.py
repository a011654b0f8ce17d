"""Mix sources to target weights by Poisson replication.  DataFrame functions only.

A document of a source with mean rate r is repeated k times, k drawn from the
Poisson distribution of mean r.  The draw inverts the distribution at a number
in [0, 1) that a hash of seed and id gives, so a lost task repeats it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lanewatch.llm.common import written

#: A rate above this is drawn as a sum of Poisson parts, each of at most this mean.
PART = 16.0
#: Terms of a part's distribution: the tail beyond 100 at mean 16 is below 1e-45.
TERMS = 100


def hashed_unit(*parts: Column) -> Column:
    """A number in [0, 1) from the first 48 bits of the parts' MD5."""
    digest = F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_rates(docs: DataFrame, source_col: str = "source",
                 weights: dict[str, float] | None = None, temperature: float = 0.7,
                 total: float | None = None) -> DataFrame:
    """``(source, n_docs, rate)``: mean repeats that bring each source to its weight.

    ``weights`` names target weights (unnamed sources: 0); without it a source
    of n documents weighs n ** temperature.  Weights are scaled to sum to one,
    and the expected size of the mixture is ``total`` or else that of the input.
    Null is a source of its own.
    """
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            same = F.col("source").eqNullSafe(F.lit(name))
            weight = F.when(same, F.lit(float(value))).otherwise(weight)
    weighted = counts.withColumn("weight", weight)
    all_weight = weighted.agg(F.sum("weight")).scalar()
    size = counts.agg(F.sum("n_docs").cast("double")).scalar() if total is None else F.lit(
        float(total))
    return weighted.select(
        "source", "n_docs",
        F.when(all_weight > 0, F.col("weight") * size / (all_weight * F.col("n_docs")))
        .otherwise(F.lit(0.0)).alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """``P(X <= k)`` of a part for k = 0 ... TERMS - 1, smallest first."""
    start = F.struct(
        F.exp(-rate).alias("p"), F.lit(0.0).alias("sum"),
        F.array().cast("array<double>").alias("steps"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)), start,
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"), (acc["sum"] + acc["p"]).alias("sum"),
            F.array_append(acc["steps"], acc["sum"] + acc["p"]).alias("steps")),
        lambda acc: acc["steps"])


def mix_sources(docs: DataFrame, seed: int = 17, id_col: str = "doc_id",
                source_col: str = "source", weights: dict[str, float] | None = None,
                temperature: float = 0.7, total: float | None = None) -> DataFrame:
    """The mixture in shuffled order: the columns of ``docs``, ``copy_no`` and ``shuffle_key``.

    A document drawn k times comes k times, ``copy_no`` 1 to k; with k = 0 not at
    all, which is what the method does with a source above its weight.  The
    draw depends on seed and id alone, so rows that repeat an id are drawn
    alike.  Rows are ordered by ``shuffle_key``, a hash of seed, id and copy, in
    one range exchange.  Columns of the input called ``copy_no`` or
    ``shuffle_key`` are replaced.
    """
    rates = source_rates(docs, source_col, weights, temperature, total)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(PART)).cast("int"))
    steps = written(
        rates.select(F.col("source").alias("_source"), parts.alias("_parts"), "rate").select(
            "_source", "_parts", poisson_steps(F.col("rate") / F.col("_parts")).alias("_steps")),
        "mix-rates")
    kept = [c for c in docs.columns if c not in ("copy_no", "shuffle_key")]
    row = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"))
    # Sources number few: their table's size is known, and Spark joins by it.
    drawn = row.join(steps, row["_source"].eqNullSafe(steps["_source"]))
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("_parts")), F.lit(0),
        lambda acc, j: acc + F.size(F.filter(
            F.col("_steps"), lambda s: s <= hashed_unit(F.lit(seed), F.col("_id"), j))))
    copies = drawn.select("_row", "_id", count.alias("_n")).where("_n > 0").select(
        "_row", "_id", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy_no"))
    key = F.md5(F.concat_ws(
        ":", F.lit("order"), F.lit(str(seed)), F.coalesce(F.col("_id").cast("string"), F.lit("")),
        F.col("copy_no").cast("string")))
    return (
        copies.select("_row", "copy_no", key.alias("shuffle_key"))
        .orderBy("shuffle_key")
        .select("_row.*", "copy_no", "shuffle_key"))
