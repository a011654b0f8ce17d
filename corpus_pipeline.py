"""From raw documents to packed sequences, in five written steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanewatch.llm.common import table, written
from lanewatch.llm.exact_dedup import drop_copies
from lanewatch.llm.jaccard_join import one_per_group
from lanewatch.llm.mixing import mix_sources
from lanewatch.llm.packing import pack_documents
from lanewatch.llm.queries import vocabulary_path
from lanewatch.llm.toxicity import drop_toxic


def _release_shuffles(spark: SparkSession, release: bool = True) -> None:
    """A stage's rows are written once, so its shuffle files may go when they are."""
    spark.conf.set(
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled", str(release).lower())


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject; it learns from ``labels``."""
    _release_shuffles(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of equal texts."""
    _release_shuffles(spark)
    return drop_copies(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each near-duplicate group: five-word shingles, similarity 0.8."""
    _release_shuffles(spark)
    return one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in shuffled order."""
    _release_shuffles(spark)
    return mix_sources(docs).drop("copy_no", "shuffle_key")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    _release_shuffles(spark, False)  # the caller may read these rows more than once
    return pack_documents(docs, vocabulary_path())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mixing", mixing),
    ("packing", packing),
]

#: A trained classifier and tokens cannot be stated in SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
