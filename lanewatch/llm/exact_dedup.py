"""Exact copies: groups by a 128-bit hash, with the texts inside a group compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lanewatch.llm.common import text_of, written

# The classes of white space that count as one blank.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normal_text(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), WHITE_SPACE, " ")


def content_hash(text: Column) -> Column:
    """MD5 as 16 bytes."""
    return F.unhex(F.md5(text))


def _keepers(rows: DataFrame, label: str) -> DataFrame:
    """One row per hash: smallest id, rows, and how many different texts share it.

    Grouping by hash and text compares the bytes.  Copies collapse before the
    shuffle, so a group of copies costs one row per task, however large it is.
    """
    texts = rows.groupBy("_hash", "_text").agg(
        F.min("_id").alias("_keep"), F.count("*").alias("_rows"))
    return written(texts.groupBy("_hash").agg(
        F.min("_keep").alias("_keep"), F.sum("_rows").alias("_rows"),
        F.count("*").alias("_texts")), label)


def _texts_that_clash(rows: DataFrame, keepers: DataFrame, label: str) -> DataFrame | None:
    """Smallest id and rows of each text whose hash another text shares; None if none is."""
    clashes = keepers.where("_texts > 1").select("_hash")
    if clashes.isEmpty():
        return None
    return written(
        rows.join(clashes, "_hash", "left_semi").groupBy("_hash", "_text").agg(
            F.min("_id").alias("_keep"), F.count("*").alias("_rows")), label)


def _prepared(docs: DataFrame, id_col: str, text_col: str,
              hasher: Callable[[Column], Column]) -> DataFrame:
    text = docs.select(F.col(id_col).alias("_id"), normal_text(text_col).alias("_text"))
    return text.withColumn("_hash", hasher(F.col("_text")))


def copy_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hasher: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Each row's id, the id that stays, group size, whether it stays, SHA-256 of its text.

    Texts are equal if they are after each run of white space became one blank;
    null counts as empty.  Only the two named columns are read, so other
    columns may have any name.  Rows that repeat an id and its text all count in
    ``group_size`` and are all marked as staying.  A null id is larger than any
    other; if all ids of a group are null, ``keep_id`` is null and all stay.
    """
    rows = _prepared(docs, id_col, text_col, hasher)
    keepers = _keepers(rows, "copies")
    out = [
        F.col("_id").alias("doc_id"), F.col("_keep").alias("keep_id"),
        F.col("_rows").alias("group_size"), F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.sha2("_text", 256).alias("text_sha256")]
    slim = rows.withColumn("_text", F.sha2("_text", 256))
    out[-1] = F.col("_text").alias("text_sha256")
    plain = slim.join(keepers.where("_texts = 1"), "_hash").select(out)
    clashing = _texts_that_clash(rows, keepers, "clashing-copies")
    if clashing is None:
        return plain
    return plain.unionByName(rows.join(clashing, ["_hash", "_text"]).select(
        *out[:-1], F.sha2("_text", 256).alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hasher: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows that stay, with the columns of ``docs``.

    As :func:`copy_report`; of rows that repeat an id and its text one stays.
    """
    rows = _prepared(docs, id_col, text_col, hasher)
    keepers = _keepers(rows, "copies")
    stay = keepers.where("_texts = 1").select("_hash", "_keep")
    clashing = _texts_that_clash(rows, keepers, "clashing-copies")
    names = docs.columns
    # A struct keeps the columns apart from ours, whatever their names.
    whole = docs.select(
        F.col(id_col).alias("_keep"), hasher(normal_text(text_col)).alias("_hash"),
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"))

    def first_of(joined: DataFrame, keys: list[str]) -> DataFrame:
        return joined.dropDuplicates(keys).select("_row.*")

    def same(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
        on = [a[k].eqNullSafe(b[k]) for k in keys]
        return a.join(b, on, "left_semi")

    kept = first_of(same(whole, stay, ["_hash", "_keep"]), ["_hash", "_keep"])
    if clashing is not None:
        texts = whole.withColumn("_text", F.regexp_replace(
            F.coalesce(F.col("_row").getField(text_col).cast("string"), F.lit("")),
            WHITE_SPACE, " "))
        keys = ["_hash", "_keep", "_text"]
        kept = kept.unionByName(first_of(same(texts, clashing.select(keys), keys), keys))
    return kept
