"""Fixed schemas of the packet table, vehicle events, stream records and results."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    """``"name type, ..."`` as a nullable StructType."""
    kinds = {
        "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
        "double": T.DoubleType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(),
    }
    fields = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, kinds[kind], True) for name, kind in fields])


# One captured frame as the capture reader yields it.
CAPTURED_FRAME = _struct(
    "file_name string, packet_no long, timestamp double, link_type int, frame binary"
)

# One decoded packet; packet_no is unique only together with file_name.
PACKET = _struct(
    "file_name string, category string, sub_category string, label string,"
    "packet_no long, timestamp double, datetime string,"
    "src_mac string, dst_mac string, src_ip string, dst_ip string,"
    "src_port int, dst_port int, protocol string, length int,"
    "tcp_flags string, ttl int, window_size int, payload_len int"
)

# Vehicle position event (JSON value); x is longitude, y is latitude.
FCD_EVENT = _struct(
    "timestep long, id string, x double, y double, angle double, type string,"
    "speed double, pos double, lane string, slope double,"
    "key string, timestamp long, vehicleId string"
)

# Vehicle emission event (JSON value).
EMISSION_EVENT = _struct(
    "timestep long, id string, eclass string, co2 double, co double, hc double,"
    "nox double, pmx double, fuel double, electricity double, noise double,"
    "route string, type string, waiting double, lane string, pos double,"
    "speed double, angle double, x double, y double,"
    "key string, timestamp long, vehicleId string"
)

# A record of an event topic, after its bytes were read as text.
STREAM_RECORD = _struct("key string, value string, topic string, timestamp timestamp")

POLLUTANTS = ("co2", "co", "hc", "nox", "pmx", "noise")

TRAFFIC_RESULT = _struct(
    "window_start string, window_end string, location_x double, location_y double,"
    "distinct_cars_count long, analysis_type string"
)

POLLUTION_RESULT = _struct(
    "window_start string, window_end string, location_x double, location_y double,"
    + ",".join(f"avg_{p} double" for p in POLLUTANTS) + ","
    + ",".join(f"max_{p} double" for p in POLLUTANTS)
    + ",analysis_type string"
)

# Any result message: the union of both result shapes.
ANY_RESULT = _struct(
    "window_start string, window_end string, location_x double, location_y double,"
    "distinct_cars_count long,"
    + ",".join(f"avg_{p} double" for p in POLLUTANTS) + ","
    + ",".join(f"max_{p} double" for p in POLLUTANTS)
    + ",analysis_type string"
)
