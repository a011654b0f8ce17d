"""Captured frames to packet rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lanewatch.functions import frames as fr
from lanewatch.functions.times import epoch_seconds_to_iso
from lanewatch.operators.once import computed_once
from lanewatch.schemas import PACKET


def capture_labels(file_name: Column) -> dict[str, Column]:
    """Category, sub-category and label out of a name such as ``benign-camera-1.pcap``.

    A name without a dash has no sub-category.
    """
    pieces = F.split(file_name, "-")
    category = F.get(pieces, 0)
    return {
        "category": category,
        "sub_category": F.get(pieces, 1),
        "label": F.when(category == "benign", "benign").otherwise("attack"),
    }


def decode_packets(frames: DataFrame, with_types: bool = False) -> DataFrame:
    """(file_name, packet_no, timestamp, link_type, frame) to the packet table.

    Narrow projections over the frame bytes: nothing is shuffled, no Python
    runs, and columns that are not asked for are not decoded.  ``with_types``
    adds ``ethertype`` and ``ip_proto``, which tell ``OTHER`` and ``IP`` rows apart.
    """
    frame, ethernet = F.col("frame"), F.col("link_type") == fr.LINK_ETHERNET
    size, at, kind = F.length(frame), F.col("network_at"), F.col("network_type")

    def present(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    network_at = fr.network_offset(frame, F.col("link_type"))
    placed = frames.withColumn("network_at", network_at).withColumn(
        "network_type", fr.network_type(frame, F.col("link_type"), at))
    network = computed_once(placed, {
        "is_ipv4": present((kind == fr.ETHERTYPE_IPV4) & (size >= at + 20)),
        "is_ipv6": present((kind == fr.ETHERTYPE_IPV6) & (size >= at + 40)),
        "is_arp": present((kind == fr.ETHERTYPE_ARP) & (size >= at + 28)),
    })

    is_ipv4, is_ipv6, is_arp = F.col("is_ipv4"), F.col("is_ipv6"), F.col("is_arp")
    # Fragment word, time to live and protocol stand side by side.
    middle = F.col("ipv4_middle")
    first_fragment = fr.high_half(middle).bitwiseAND(F.lit(0x1FFF)) == 0
    ipv4_size = fr.unsigned(frame, at, 1).bitwiseAND(F.lit(0x0F)) * 4
    read = network.withColumn("ipv4_middle", F.when(is_ipv4, fr.unsigned(frame, at + 6, 4)))
    transported = computed_once(read, {
        "ip_proto": F.when(is_ipv4 & first_fragment, middle.bitwiseAND(F.lit(255)))
        .when(is_ipv6, fr.unsigned(frame, at + 6, 1)),
        "transport_at": F.when(is_ipv4, (at + ipv4_size).cast("int")).when(is_ipv6, at + 40),
        "address_at": F.when(is_ipv4, at + 12).when(is_arp, at + 14),
        "address_step": F.when(is_ipv4, 4).otherwise(10),
    })
    transport, proto = F.col("transport_at"), F.col("ip_proto")
    layered = computed_once(transported, {
        "has_tcp": present((proto == fr.PROTO_TCP) & (size >= transport + 20)),
        "has_udp": present((proto == fr.PROTO_UDP) & (size >= transport + 8)),
        "has_icmp": present(is_ipv4 & (proto == fr.PROTO_ICMP) & (size >= transport + 8)),
    })
    has_tcp, has_udp, has_icmp = F.col("has_tcp"), F.col("has_udp"), F.col("has_icmp")

    words = layered.withColumns({
        "src_address": fr.unsigned(frame, F.col("address_at"), 4),
        "dst_address": fr.unsigned(frame, F.col("address_at") + F.col("address_step"), 4),
        "ports": F.when(has_tcp | has_udp, fr.unsigned(frame, transport, 4)),
        # Header size, flags and window stand side by side.
        "tcp_word": F.when(has_tcp, fr.unsigned(frame, transport + 12, 4)),
    })
    ports, tcp_word = F.col("ports"), F.col("tcp_word")
    tcp_size = F.shiftright(tcp_word, 28) * 4
    columns = {
        "file_name": F.col("file_name"),
        **capture_labels(F.col("file_name")),
        "packet_no": F.col("packet_no"),
        "timestamp": F.col("timestamp"),
        "datetime": epoch_seconds_to_iso(F.col("timestamp")),
        "src_mac": F.when(ethernet, fr.mac_address(frame, 6)),
        "dst_mac": F.when(ethernet, fr.mac_address(frame, 0)),
        "src_ip": fr.ipv4_text(F.col("src_address")),
        "dst_ip": fr.ipv4_text(F.col("dst_address")),
        "src_port": fr.high_half(ports),
        "dst_port": fr.low_half(ports),
        "protocol": F.when(has_tcp, "TCP").when(has_udp, "UDP").when(has_icmp, "ICMP")
        .when(is_arp, "ARP").when(is_ipv4, "IP").otherwise("OTHER"),
        "length": size,
        "tcp_flags": fr.tcp_flag_letters(fr.high_half(tcp_word).bitwiseAND(F.lit(0x01FF))),
        "ttl": F.shiftright(middle, 8).bitwiseAND(F.lit(255)),
        "window_size": fr.low_half(tcp_word),
        # Whatever was captured behind the header, link padding included.
        "payload_len": F.when(has_tcp, F.greatest(F.lit(0), size - transport - tcp_size))
        .when(has_udp, size - transport - 8).otherwise(0),
    }
    types = [kind.cast("int").alias("ethertype"), proto.cast("int").alias("ip_proto")]
    return words.select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in PACKET.fields),
        *(types if with_types else []),
    )


def number_packets(
    packets: DataFrame, file: str = "file_name", offset: str = "offset", step: int = 1 << 20
) -> DataFrame:
    """Add ``packet_no``, from 1 in each file, by a whole-number offset.

    Numbers are counted within steps of the offset and moved on by the counts
    of the steps before, so no task sorts more than one step of one file, nor
    sees a whole large capture.  Offsets must be unique in their file.
    """
    stepped = packets.withColumn("_step", F.floor(F.col(offset) / step))
    counts = stepped.groupBy(file, "_step").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(file).orderBy("_step").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(
        file, "_step", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy(file, "_step").orderBy(offset))
    return (
        stepped.withColumn("_here", here).join(starts, [file, "_step"])
        .withColumn("packet_no", F.col("_before") + F.col("_here"))
        .drop("_step", "_here", "_before")
    )


def summarise_by_label(packets: DataFrame) -> DataFrame:
    """Packets and bytes per category, sub-category and label."""
    return packets.groupBy("category", "sub_category", "label").agg(
        F.count(F.lit(1)).alias("packets"), F.sum("length").alias("bytes")
    )
