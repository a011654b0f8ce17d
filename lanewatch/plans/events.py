"""Vehicle events: from XML attributes, to and from JSON records, to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lanewatch.functions.times import millis_to_timestamp, simulation_millis
from lanewatch.functions.values import decimal_attribute
from lanewatch.operators.filters import required_fields, route_topic
from lanewatch.operators.once import computed_once
from lanewatch.places import EMISSIONS_TOPIC, FCD_TOPIC
from lanewatch.schemas import EMISSION_EVENT, FCD_EVENT, POLLUTANTS

EVENT_SCHEMAS = {"fcd": FCD_EVENT, "emission": EMISSION_EVENT}
REQUIRED = ("vehicleId", "x", "y", "timestamp")

# XML attributes per kind, numeric ones and text ones.
XML_NUMBERS = {
    "fcd": ("x", "y", "angle", "speed", "pos", "slope"),
    "emission": ("CO2", "CO", "HC", "NOx", "PMx", "fuel", "electricity", "noise",
                 "waiting", "pos", "speed", "angle", "x", "y"),
}
XML_TEXTS = {
    "fcd": ("id", "type", "lane"),
    "emission": ("id", "eclass", "route", "type", "lane"),
}


def xml_attributes(kind: str) -> tuple[str, ...]:
    return XML_TEXTS[kind] + XML_NUMBERS[kind]


def build_events(vehicles: DataFrame, kind: str) -> DataFrame:
    """(time, attributes as text) to events of the kind's fixed schema."""
    by_name = {name.lower(): decimal_attribute(F.col(name)) for name in XML_NUMBERS[kind]}
    by_name |= {name: F.col(name) for name in XML_TEXTS[kind]}
    by_name["timestep"] = simulation_millis(decimal_attribute(F.col("time")))
    return with_record_fields(vehicles.select(
        *(by_name[f.name].alias(f.name) for f in EVENT_SCHEMAS[kind].fields if f.name in by_name)
    ))


def with_record_fields(events: DataFrame) -> DataFrame:
    """Add ``key``, ``timestamp`` and ``vehicleId``, which repeat id and timestep."""
    return events.withColumns({
        "key": F.col("id"), "timestamp": F.col("timestep"), "vehicleId": F.col("id"),
    })


def event_records(events: DataFrame, topic: str) -> DataFrame:
    """Events as keyed records: key = vehicle, value = JSON with explicit nulls."""
    value = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    return events.select(
        F.col("id").alias("key"), value.alias("value"), F.lit(topic).alias("topic")
    )


def decode_records(
    records: DataFrame, topic: str, kind: str, fields: tuple[str, ...] | None = None
) -> DataFrame:
    """One topic's records as events; malformed values leave all fields null.

    Only the named ``fields`` are parsed, by default all, and each value once.
    """
    schema = EVENT_SCHEMAS[kind]
    if fields:
        schema = T.StructType([f for f in schema.fields if f.name in fields])
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return computed_once(route_topic(records, topic), {"data": parsed}, keep=[]).select("data.*")


def _record_counts() -> list[Column]:
    lacking = F.lit(False)
    for name in REQUIRED:
        lacking = lacking | F.col(name).isNull()
    return [F.count(F.lit(1)).alias("records"), F.count_if(lacking).alias("malformed")]


def malformed_counts(events: DataFrame) -> DataFrame:
    """Decoded records in total, and how many lack a required field."""
    return events.agg(*_record_counts())


def observe_malformed(events: DataFrame, name: str) -> DataFrame:
    """The same counts taken while the events pass by.

    In a stream they stand in each progress report's ``observedMetrics`` under
    the name, for every batch.
    """
    return events.observe(name, *_record_counts())


def vehicle_positions(events: DataFrame) -> DataFrame:
    """(vehicle_id, vehicle_lat, vehicle_lon, event_time) of complete events."""
    return required_fields(events, *REQUIRED).select(
        F.col("vehicleId").alias("vehicle_id"),
        F.col("y").alias("vehicle_lat"),
        F.col("x").alias("vehicle_lon"),
        millis_to_timestamp(F.col("timestamp")).alias("event_time"),
    )


def vehicle_emissions(events: DataFrame) -> DataFrame:
    """As :func:`vehicle_positions`, with the six pollutants."""
    return required_fields(events, *REQUIRED).select(
        F.col("vehicleId").alias("vehicle_id"),
        F.col("y").alias("vehicle_lat"),
        F.col("x").alias("vehicle_lon"),
        *POLLUTANTS,
        millis_to_timestamp(F.col("timestamp")).alias("event_time"),
    )


def positions_from_records(records: DataFrame, topic: str = FCD_TOPIC) -> DataFrame:
    return vehicle_positions(decode_records(records, topic, "fcd", REQUIRED))


def emissions_from_records(records: DataFrame, topic: str = EMISSIONS_TOPIC) -> DataFrame:
    return vehicle_emissions(decode_records(records, topic, "emission", REQUIRED + POLLUTANTS))
