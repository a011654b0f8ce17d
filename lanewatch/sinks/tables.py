"""Delimited tables and feature files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def write_csv_table(df: DataFrame, path: str) -> None:
    """CSV part files, each with a header; nulls are empty, quotes doubled, blanks kept."""
    df.write.options(
        header=True, emptyValue="", quote='"', escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False).csv(path)


def write_features(features: DataFrame, path: str) -> None:
    """One GeoJSON feature per line, in as many files as there are tasks."""
    features.select("feature").write.text(path)


def write_frame_collections(features: DataFrame, path: str) -> None:
    """One GeoJSON FeatureCollection per time frame: a file in the folder ``frame=<time>``.

    A feature is a line, so no task holds a document; frames are spread over tasks, and only
    the order within a frame is made.  Frames that are written again replace the earlier
    document, others stay as they are.  Features without a time have no frame.
    """
    timed = features.where("time is not null").select(
        F.col("time").alias("frame"), "feature", "analysis_type", "location_x", "location_y")
    order = ["analysis_type", "location_x", "location_y", "feature"]
    number = F.row_number().over(Window.partitionBy("frame").orderBy(*order))
    after = F.lead(F.lit(1)).over(Window.partitionBy("frame").orderBy(*order))
    line = F.concat(
        F.when(number == 1, F.lit('{"type":"FeatureCollection","features":[\n')).otherwise(""),
        F.col("feature"), F.when(after.isNull(), F.lit("\n]}")).otherwise(","))
    lines = timed.select("frame", number.alias("number"), line.alias("value"))
    (lines.sortWithinPartitions("frame", "number").select("value", "frame")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("frame").text(path))
