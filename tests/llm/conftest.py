import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def rows(spark: SparkSession):
    """A table from tuples, with clashing extra columns beside the named ones."""
    def make(schema: str, data, extra: str | None = None):
        from lanewatch.llm.common import ship_package

        ship_package(spark)
        frame = spark.createDataFrame(data, schema)
        if extra:
            for name in extra.split():
                frame = frame.selectExpr("*", f"'x' as {name}")
        return frame
    return make


ODD_TEXTS = [
    (1, "one two three four five six"), (2, None), (3, ""), (4, " \t\n "), (5, "one"),
    (6, "one  two three four\nfive six"), (6, "one two three four five six"), (None, "one"),
    (8, "word " * 30_000), (9, "word " * 30_000 + "end"), (10, "é" * 300), (11, "é" * 300),
    (12, "A b C d E f G h"), (13, "a B c D e F g H"),
]


@pytest.fixture(scope="session")
def odd(rows):
    """Null, empty and very long texts, ties, repeated rows and ids, clashing columns."""
    return rows("doc_id long, text string", ODD_TEXTS,
                "keep_id kept component_id _id _text _hash copy_no source rank unit")


@pytest.fixture(scope="session")
def empty(rows):
    return rows("doc_id long, text string", [], "source keep_id")
