"""What the operators of this subpackage share: tables, written steps, id lists."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import lanewatch
from lanewatch.session import pin_utc, working_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started.

    Spark's own file server hands the package out, once per application.
    """
    context = spark.sparkContext
    root = os.path.dirname(os.path.abspath(lanewatch.__file__))
    if context.applicationId in _SHIPPED or not os.path.isdir(root):
        return
    packed = os.path.join(tempfile.mkdtemp(prefix="lanewatch-"), "lanewatch.zip")
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(files):
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    archive.write(whole, os.path.relpath(whole, os.path.dirname(root)))
    context.addPyFile(packed)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the jobs inside go when each job ends, not at some later time."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


_KEY_FILTER = "spark.sql.optimizer.runtime.bloomFilter."


@contextmanager
def keys_filtered(spark: SparkSession):
    """Joins inside drop rows without a partner before they are shuffled, by Spark's own Bloom filter.

    The filter's size is bounded by Spark's settings; by default Spark builds it for large tables only.
    """
    settings = {_KEY_FILTER + "applicationSideScanSizeThreshold": "10MB",
                _KEY_FILTER + "creationSideThreshold": "1GB"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows as a table in the shared folder: later reads never repeat the work.

    The folder is the one that ``spark.checkpoint.dir`` names, so a lost
    executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = working_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The whole text, a null one as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of undirected ``(a, b)`` links: ``(node, component)``, a row per node.

    Alternates two steps on pairs written to the shared folder.  In the first,
    every node hands its larger neighbours to its smallest one; in the second,
    its smaller neighbours.  Both keep the components, and the pairs end as
    stars around the smallest node after about log(n) rounds.  A round is a
    group-by with map-side minimum and one equi-join, so neither a hub nor a
    long chain is ever held in one task.  Neither step makes more rows than it
    reads, so pairs that repeat are not looked for.  Links that are stars take no round.
    """
    pairs = edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = written(pairs, f"{label}-links")
    while True:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that the joins below have two exchanges and a hub can be split.
        least = written(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.max("b").alias("most")),
            f"{label}-least")
        # Pairs are stars once no node with a smaller neighbour has another one.
        if least.where("m < a and m < most").isEmpty():
            return least.select(F.col("a").alias("node"), F.col("m").alias("component"))
        large = written(
            both.where("b > a").join(least.select("a", "m"), "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"), f"{label}-large")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), f"{label}-least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = written(
            small.where("a <> b").unionAll(least.select("a", F.col("m").alias("b"))), f"{label}-small")
