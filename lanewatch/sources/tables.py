"""Delimited tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lanewatch.functions.values import number_or_null

# Texts that stand for a missing value in a delimited table.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


_WHOLE_TEXT = r"^[+-]?\d+$"


def _nulls_cleaned(table: DataFrame, null_texts: tuple[str, ...]) -> DataFrame:
    cleaned = {}
    for f in table.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            cleaned[f.name] = F.when(~c.isin(*null_texts), c)
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cleaned[f.name] = F.when(~F.isnan(c), c)
    return table.withColumns(cleaned) if cleaned else table


def _numbers_typed(texts: DataFrame) -> DataFrame:
    """Columns of text that hold only whole numbers as long, only numbers as double."""
    counts = []
    for i, name in enumerate(texts.columns):
        c = F.col(f"`{name}`")
        whole = F.when(F.trim(c).rlike(_WHOLE_TEXT), F.trim(c).try_cast("long"))
        counts += [F.count(c).alias(f"present_{i}"), F.count(whole).alias(f"whole_{i}"),
                   F.count(number_or_null(c, T.StringType())).alias(f"numeric_{i}")]
    seen = texts.agg(*counts).first()
    typed = {}
    for i, name in enumerate(texts.columns):
        c, present = F.col(f"`{name}`"), seen[f"present_{i}"]
        if present and seen[f"whole_{i}"] == present:
            typed[name] = F.trim(c).try_cast("long")
        elif present and seen[f"numeric_{i}"] == present:
            typed[name] = number_or_null(c, T.StringType())
    return texts.withColumns(typed) if typed else texts


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    null_texts: tuple[str, ...] = NULL_TEXTS,
    multi_line: bool = False,
) -> DataFrame:
    """A CSV table with a header line; quotes within quoted text are doubled.

    ``multi_line`` allows line breaks within quoted text, but then a file is read by
    one task, as it cannot be split.

    With a schema the file is read once, and a value that does not fit its
    numeric column is null.  Without one, an extra pass over the file finds the
    columns in which every value but the null texts is a number; whole numbers
    stay whole even where some are missing.
    """
    reader = spark.read.options(
        header=True, mode="PERMISSIVE", quote='"', escape='"', multiLine=multi_line)
    if schema:
        return _nulls_cleaned(reader.schema(schema).csv(path), null_texts)
    return _numbers_typed(_nulls_cleaned(reader.csv(path), null_texts))
