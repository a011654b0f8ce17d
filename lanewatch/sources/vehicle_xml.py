"""Vehicle XML exports: timesteps that hold vehicles.

Spark's own XML source reads a file in one task.  Here the file is text whose
lines end in ``</timestep>``: the text source splits it into many tasks, and
each line holds at most one non-empty timestep, which ``from_xml`` parses.
Attributes are read as text, because one blank number among typed attributes
would make Spark drop its whole timestep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lanewatch.plans.events import build_events, xml_attributes

_OPEN, _CLOSE = "<timestep", "</timestep>"


def _timestep_schema(kind: str) -> T.StructType:
    text = T.StringType()
    vehicle = T.StructType([T.StructField(f"_{name}", text) for name in xml_attributes(kind)])
    return T.StructType([
        T.StructField("_time", text), T.StructField("vehicle", T.ArrayType(vehicle)),
    ])


def vehicles_from_chunks(chunks: DataFrame, kind: str) -> DataFrame:
    """Text chunks (column ``value``), each ending where a timestep ended, to
    one row per vehicle: ``time`` and the attributes, all as text.

    Timesteps without vehicles before the last opening tag of a chunk are
    empty elements and yield nothing.  Other elements are ignored.
    """
    element = F.concat(
        F.lit(_OPEN), F.substring_index("value", _OPEN, -1), F.lit(_CLOSE))
    parsed = chunks.filter(F.col("value").contains(_OPEN)).select(
        F.from_xml(element, _timestep_schema(kind), {"rowTag": "timestep"}).alias("step"))
    each = parsed.select(F.col("step._time").alias("time"), F.explode("step.vehicle").alias("v"))
    return each.select(
        "time", *(F.col(f"v._{name}").alias(name) for name in xml_attributes(kind)))


def read_vehicle_xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Events of all XML files under a path; ``kind`` is ``fcd`` or ``emission``."""
    chunks = spark.read.option("lineSep", _CLOSE).text(path)
    return build_events(vehicles_from_chunks(chunks, kind), kind)


def stream_vehicle_xml(spark: SparkSession, path: str, kind: str, **options: str) -> DataFrame:
    """The same as a stream over files as they arrive."""
    chunks = spark.readStream.option("lineSep", _CLOSE).options(**options).text(path)
    return build_events(vehicles_from_chunks(chunks, kind), kind)


def malformed_timesteps(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Timesteps that give no events, or wrong ones: ``file, block_start, block_bytes, kind, text``.

    ``block_start`` and ``block_bytes`` tell the part of the file in which the timestep's chunk
    begins.  Kinds: ``unclosed`` (another timestep begins before it ends), ``no_opening``
    (vehicles and an end without a beginning), ``not_xml``, ``no_time`` and ``bad_time``.
    Empty timesteps are sound.  One pass, nothing is shuffled.
    """
    schema = T.StructType([*_timestep_schema(kind).fields, T.StructField("_corrupt", T.StringType())])
    chunks = spark.read.option("lineSep", _CLOSE).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_block_length").alias("block_bytes"), "value")
    # What stands before the first opening, then a piece per opening.
    pieces = chunks.select(
        "file", "block_start", "block_bytes",
        F.posexplode(F.split("value", r"(?=<timestep[\s/>])")).alias("at", "text"),
        F.size(F.split("value", r"(?=<timestep[\s/>])")).alias("pieces"))
    text = F.col("text")
    opened = F.regexp_like(text, F.lit(r"^<timestep[\s/>]"))
    empty = F.regexp_like(text, F.lit(r"^<timestep[^>]*/>"))
    last = F.col("at") == F.col("pieces") - 1
    step = F.from_xml(F.concat(text, F.lit(_CLOSE)), schema,
                      {"rowTag": "timestep", "columnNameOfCorruptRecord": "_corrupt"})
    looked = pieces.where(~empty).withColumn("step", F.when(opened & last, step))
    time = F.trim(F.col("step._time"))
    fault = (
        F.when(~opened, F.when(last & text.contains("<vehicle"), "no_opening"))
        .when(~last, "unclosed")
        .when(F.col("step").isNull() | F.col("step._corrupt").isNotNull(), "not_xml")
        .when(time.isNull() | (time == ""), "no_time")
        .when(time.try_cast("double").isNull(), "bad_time"))
    return looked.withColumn("kind", fault).where("kind is not null").select(
        "file", "block_start", "block_bytes", "kind", "text")


def malformed_counts(bad: DataFrame) -> DataFrame:
    """Bad timesteps per file and kind."""
    return bad.groupBy("file", "kind").agg(F.count(F.lit(1)).alias("timesteps"))
