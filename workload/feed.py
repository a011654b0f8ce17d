"""Vehicle events and packets derived from the ``events`` table.

Every value is plain arithmetic on a row, so the feed grows with the table and
SQL can state it independently.  Thirty days become one hour, so that windows
of a minute hold data; rows are spread over the places, two in ten far away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lanewatch.operators.once import computed_once
from lanewatch.places import EMISSIONS_TOPIC, FCD_TOPIC, PLACES
from lanewatch.plans.events import (
    XML_NUMBERS, XML_TEXTS, event_records, vehicle_emissions, vehicle_positions,
    with_record_fields,
)
from lanewatch.schemas import CAPTURED_FRAME
from lanewatch.session import pin_utc

BASE_MS = 1_777_593_600_000
BASE_TS_US = 1_704_067_200_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table, a file or a folder of part files, as a stream of bounded batches."""
    schema = table(spark, sf_dir, name).schema
    # As a pattern, the path may name one file as well as a folder.
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000)
        .parquet(f"{sf_dir}/{name}.parque[t]")
    )


def _position(events: DataFrame) -> dict[str, Column]:
    eid = F.col("event_id")
    idx = (eid % 10).cast("int")
    lat = F.get(F.array(*(F.lit(p[1]) for p in PLACES)), idx)
    lon = F.get(F.array(*(F.lit(p[2]) for p in PLACES)), idx)
    shifted_us = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(BASE_TS_US)
    north = ((eid * 7919) % 1001 - 500).cast("double") * F.lit(0.000005)
    east = ((eid * 104729) % 1009 - 504).cast("double") * F.lit(0.000005)
    return {
        "id": F.concat(F.lit("veh"), F.col("user_id").cast("string")),
        "timestep": F.lit(BASE_MS) + F.floor(shifted_us / 720_000),
        "y": F.coalesce(lat, F.lit(43.30)) + north,
        "x": F.coalesce(lon, F.lit(21.85)) + east,
    }


def fcd_events(events: DataFrame, *keep: str) -> DataFrame:
    eid = F.col("event_id")
    fields = _position(events) | {
        "angle": (eid % 360).cast("double"),
        "type": F.col("event_type"),
        "speed": F.col("value") / 10,
        "pos": (eid % 97).cast("double"),
        "lane": F.concat(F.lit("lane_"), (eid % 13).cast("string")),
        "slope": F.when(eid % 5 != 0, (eid % 7).cast("double")),
    }
    order = ["timestep", "id", "x", "y", "angle", "type", "speed", "pos", "lane", "slope"]
    return with_record_fields(events.select(*keep, *(fields[c].alias(c) for c in order)))


def emission_events(events: DataFrame, *keep: str) -> DataFrame:
    eid, value = F.col("event_id"), F.col("value")
    fields = _position(events) | {
        "eclass": F.concat(F.lit("HBEFA3/"), F.col("event_type")),
        "co2": F.when(eid % 11 != 0, value * 10),
        "co": value,
        "hc": value / 100,
        "nox": F.when(eid % 17 != 0, value / 10),
        "pmx": value / 1000,
        "fuel": value * 3,
        "electricity": F.lit(0.0),
        "noise": F.lit(50.0) + (eid % 300).cast("double") / 10,
        "route": F.concat(F.lit("route_"), (eid % 19).cast("string")),
        "type": F.col("event_type"),
        "waiting": (eid % 30).cast("double"),
        "lane": F.concat(F.lit("lane_"), (eid % 13).cast("string")),
        "pos": (eid % 97).cast("double"),
        "speed": value / 10,
        "angle": (eid % 360).cast("double"),
    }
    order = ["timestep", "id", "eclass", "co2", "co", "hc", "nox", "pmx", "fuel",
             "electricity", "noise", "route", "type", "waiting", "lane", "pos", "speed",
             "angle", "x", "y"]
    return with_record_fields(events.select(*keep, *(fields[c].alias(c) for c in order)))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicle_positions(fcd_events(table(spark, sf_dir, "events")))


def emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicle_emissions(emission_events(table(spark, sf_dir, "events")))


def records(events: DataFrame) -> DataFrame:
    """Records of both topics, as a topic's consumer sees them."""
    both = event_records(fcd_events(events), FCD_TOPIC).unionByName(
        event_records(emission_events(events), EMISSIONS_TOPIC))
    return both.withColumn("timestamp", F.timestamp_millis(
        F.get_json_object("value", "$.timestep").cast("long")))


def topic_records(events: DataFrame, topic: str) -> DataFrame:
    """Records of one topic; the other one is not even built."""
    made = fcd_events(events) if topic == FCD_TOPIC else emission_events(events)
    return event_records(made, topic).withColumn("timestamp", F.lit(None).cast("timestamp"))


# --- packets ---------------------------------------------------------------

PACKETS_PER_FILE = 4096


def _hex(value: Column, size: int) -> Column:
    return F.lpad(F.hex(value.cast("long")), size * 2, "0")


def packet_frames(events: DataFrame) -> DataFrame:
    """One Ethernet frame per event: TCP, UDP, ICMP, ARP or an unknown ethertype.

    Frames of a file are numbered in event order.
    """
    eid, user = F.col("event_id"), F.col("user_id")
    macs = F.concat(F.lit("020001"), _hex(eid % 16777216, 3), F.lit("020000"),
                    _hex(user % 16777216, 3))
    src = F.concat(F.lit("0A"), _hex(user % 16777216, 3))
    dst = F.concat(F.lit("C0A8"), _hex(eid % 7, 1), _hex(eid % 251, 1))
    ports = F.concat(_hex(F.lit(1024) + user % 50000, 2),
                     _hex(F.when(eid % 2 == 0, 443).otherwise(80), 2))
    body_size = (eid % 50).cast("int")
    body = F.repeat(F.lit("AB"), body_size)
    tcp = F.concat(ports, F.lit("0000000000000000"),
                   _hex(F.lit(0x5000) + eid % 512, 2), _hex(eid % 65536, 2), F.lit("00000000"))
    udp = F.concat(ports, _hex(body_size + 8, 2), F.lit("0000"))
    icmp = F.lit("0800000000010001")

    def ipv4(proto: int, inner: Column, inner_size: Column) -> Column:
        head = F.concat(F.lit("0800"), F.lit("4500"), _hex(inner_size + 20, 2),
                        F.lit("00000000"), _hex(F.lit(32) + eid % 200, 1),
                        _hex(F.lit(proto), 1), F.lit("0000"), src, dst)
        return F.concat(macs, head, inner)

    arp = F.concat(macs, F.lit("0806"), F.lit("0001080006040001"), F.lit("020000000001"), src,
                   F.lit("000000000000"), dst)
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", ipv4(6, F.concat(tcp, body), body_size + 20))
        .when(kind == "view", ipv4(17, F.concat(udp, body), body_size + 8))
        .when(kind == "signup", ipv4(1, F.concat(icmp, body), body_size + 8))
        .when(kind == "purchase", arp)
        .otherwise(F.concat(macs, F.lit("88B5"), body))
    )
    part = F.floor(eid / PACKETS_PER_FILE)
    category = F.when(part % 3 == 0, "benign").otherwise("scan")
    name = F.concat(category, F.lit("-sub"), (part % 5).cast("string"), F.lit("-"),
                    part.cast("string"), F.lit(".pcap"))
    made = computed_once(events, {
        "file_name": name,
        "packet_no": eid % PACKETS_PER_FILE + 1,
        "timestamp": F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000,
        "link_type": F.lit(1),
        "frame": F.unhex(text),
    }, keep=[])
    return made.select(*(F.col(f.name).cast(f.dataType).alias(f.name)
                         for f in CAPTURED_FRAME.fields))


def layered_frames(events: DataFrame) -> DataFrame:
    """The packets again, one in two behind tags, labels, tunnels or extension headers."""
    frames = packet_frames(events)
    frame = F.col("_frame")
    number = F.col("packet_no") % 8

    def at(start: int, size: int) -> Column:
        return F.substring(frame, start + 1, size)

    macs, behind, size = at(0, 12), F.expr("substring(_frame, 13)"), F.length(frame)
    packet = F.expr("substring(_frame, 15)")
    is_ip = at(12, 2) == F.lit(bytes.fromhex("0800"))

    def word(value: Column) -> Column:
        return F.unhex(_hex(value, 2))

    def fixed(digits: str) -> Column:
        return F.lit(bytes.fromhex(digits))

    tagged = F.concat(macs, fixed("88a80001" "81000002"), behind)
    labelled = F.concat(macs, fixed("8847" "0001000a" "0002010a"), packet)
    extended = F.concat(  # IPv6, hop by hop, then the IPv4 packet
        macs, fixed("86dd" "60000000"), word(size - 14 + 8), fixed("0040" + "00" * 32),
        fixed("0400000000000000"), packet)
    bridged = F.concat(  # IPv4, GRE with a key, then the whole frame
        macs, fixed("0800" "4500"), word(size + 28), fixed("00000000" "402f0000" "01020304" "05060708"),
        fixed("20006558" "00000007"), frame)
    wrapped = F.when(number == 1, tagged).when(is_ip & (number == 3), labelled).when(
        is_ip & (number == 5), extended).when(number == 7, bridged).otherwise(frame)
    return computed_once(frames.withColumnRenamed("frame", "_frame"), {
        "frame": wrapped}, keep=["file_name", "packet_no", "timestamp", "link_type"])


def _file_writer(folder: str):
    """Write one capture per group; made here so that it travels whole."""

    def write(pdf):
        import struct

        import pandas as pd
        from pyarrow import fs

        name = pdf["file_name"].iloc[0]
        if folder.startswith("file:/") or folder.startswith("/"):
            system, inner = fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
        else:
            system, inner = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
        system.create_dir(inner, recursive=True)
        ordered = pdf.sort_values("packet_no")
        with system.open_output_stream(f"{inner}/{name}") as out:
            out.write(struct.pack("<IHHIIII", 0xA1B2C3D4, 2, 4, 0, 0, 262144, 1))
            for seconds, frame in zip(ordered["timestamp"], ordered["frame"]):
                micros = round(seconds * 1_000_000)
                out.write(struct.pack("<IIII", micros // 1_000_000, micros % 1_000_000,
                                      len(frame), len(frame)) + bytes(frame))
        return pd.DataFrame({"file_name": [name], "packets": [len(pdf)]})

    return write


def _block_writer(folder: str):
    """Write one block-format capture per group; made here so that it travels whole.

    Every 500 packets a section of the other byte order begins, with two interfaces: one of
    microseconds, one of nanoseconds counted from a later second.
    """

    def write(pdf):
        import struct

        import pandas as pd
        from pyarrow import fs

        def block(order, kind, body):
            body += b"\0" * (-len(body) % 4)
            size = struct.pack(order + "I", len(body) + 12)
            return struct.pack(order + "I", kind) + size + body + size

        def option(order, code, value):
            return struct.pack(order + "HH", code, len(value)) + value + b"\0" * (-len(value) % 4)

        name = pdf["file_name"].iloc[0]
        if folder.startswith("file:/") or folder.startswith("/"):
            system, inner = fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
        else:
            system, inner = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
        system.create_dir(inner, recursive=True)
        ordered = pdf.sort_values("packet_no")
        later = 1_600_000_000
        with system.open_output_stream(f"{inner}/{name}") as out:
            for n, (seconds, frame) in enumerate(zip(ordered["timestamp"], ordered["frame"])):
                if n % 500 == 0:
                    order = "<>"[n // 500 % 2]
                    out.write(block(order, 0x0A0D0D0A, struct.pack(
                        order + "IHHq", 0x1A2B3C4D, 1, 0, -1)))
                    out.write(block(order, 1, struct.pack(order + "HHI", 1, 0, 0)))
                    out.write(block(order, 1, struct.pack(order + "HHI", 1, 0, 0)
                                    + option(order, 9, b"\x09")
                                    + option(order, 14, struct.pack(order + "q", later))
                                    + option(order, 0, b"")))
                micros = round(seconds * 1_000_000)
                units = micros if n % 2 == 0 else (micros - later * 1_000_000) * 1000
                out.write(block(order, 6, struct.pack(
                    order + "IIIII", n % 2, units >> 32, units & 0xFFFFFFFF, len(frame), len(frame))
                    + bytes(frame)))
                if n % 100 == 0:  # a block of statistics, which holds no packet
                    out.write(block(order, 5, struct.pack(order + "III", 0, 0, n)))
        return pd.DataFrame({"file_name": [name], "packets": [len(pdf)]})

    return write


def write_captures(frames: DataFrame, folder: str, blocks: bool = False) -> int:
    """One capture file per file name, of at most :data:`PACKETS_PER_FILE` frames.

    A group is that small by the way names are made.  A repeated task writes
    the same file again.
    """
    written = frames.groupBy("file_name").applyInPandas(
        _block_writer(folder) if blocks else _file_writer(folder),
        "file_name string, packets long")
    return written.agg(F.sum("packets")).first()[0]


# --- XML -------------------------------------------------------------------

def write_vehicle_xml(events: DataFrame, kind: str, folder: str) -> None:
    """Export the ``events`` table as timesteps of at most 64 vehicles.

    A second with more vehicles is written as several timesteps of one time:
    one per 64 consecutive events.  Null numbers are blank attributes, and
    every 50th second also holds a person and comes after an empty timestep.
    """
    made = (fcd_events if kind == "fcd" else emission_events)(events, "event_id")
    parts = [F.lit("<vehicle")]
    for name in XML_TEXTS[kind] + XML_NUMBERS[kind]:
        value = F.coalesce(F.col(name.lower()).cast("string"), F.lit(""))
        parts += [F.lit(f' {name}="'), value, F.lit('"')]
    rows = made.select(
        F.floor((F.col("timestep") - BASE_MS) / 1000).alias("second"),
        F.floor(F.col("event_id") / 64).alias("chunk"),
        F.concat(*parts, F.lit("/>")).alias("vehicle"),
    )
    steps = rows.groupBy("second", "chunk").agg(
        F.array_join(F.sort_array(F.collect_list("vehicle")), "\n").alias("vehicles"))
    marked = F.col("second") % 50 == 0
    text = F.concat(
        F.when(marked, '<timestep time="0.5"/>\n').otherwise(""),
        F.lit('<timestep time="'), F.col("second").cast("string"), F.lit('.75">\n'),
        F.when(marked, '<person id="p" x="1" y="1"/>\n').otherwise(""),
        F.col("vehicles"), F.lit("\n</timestep>"))
    steps.select(text.alias("value")).write.mode("overwrite").text(folder)


def write_broken_xml(events: DataFrame, folder: str) -> None:
    """Timesteps of at most 16 vehicles; five in ten chunks hold a fault of their own kind.

    Chunk 0 of ten has no time, 1 a time that is no number, 2 a tag that is not closed, 3 a
    timestep without its end before a sound one, 4 an end without a beginning.
    """
    number = F.floor(F.col("event_id") / 16)
    fault = number % 10
    vehicle = F.concat(F.lit('<vehicle id="v'), F.col("event_id").cast("string"), F.lit('" x="1"/>'))
    chunks = events.groupBy(number.alias("number"), fault.alias("fault")).agg(
        F.concat_ws("", F.sort_array(F.collect_list(vehicle))).alias("vehicles"))
    timed = F.concat(F.lit('<timestep time="'), F.col("number").cast("string"), F.lit('.00">'))
    vehicles, end = F.col("vehicles"), F.lit("</timestep>")
    text = (
        F.when(F.col("fault") == 0, F.concat(F.lit("<timestep>"), vehicles, end))
        .when(F.col("fault") == 1, F.concat(F.lit('<timestep time="soon">'), vehicles, end))
        .when(F.col("fault") == 2, F.concat(timed, vehicles, F.lit('<vehicle id="'), end))
        .when(F.col("fault") == 3, F.concat(timed, vehicles, timed, vehicles, end))
        .when(F.col("fault") == 4, F.concat(vehicles, end))
        .otherwise(F.concat(F.lit('<timestep time="7.00"/>'), timed, vehicles, end)))
    chunks.select(text.alias("value")).write.text(folder)
