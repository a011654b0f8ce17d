"""Frames walked header by header: stacked tags, extension headers and tunnels.

Every step of the walk is one narrow projection over the layer reached so far, so any number
of frames is decoded in one compiled pass, without Python and without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lanewatch.functions import frames as fr
from lanewatch.functions.times import epoch_seconds_to_iso
from lanewatch.operators.once import computed_once
from lanewatch.plans.packets import capture_labels
from lanewatch.schemas import PACKET

# Ethertypes and IP protocol numbers, the latter from IP_PROTO on.
IP_PROTO = 0x10000
VLANS = (0x8100, 0x88A8, 0x9100)
MPLS = (0x8847, 0x8848)
PPPOE, BRIDGED = 0x8864, 0x6558
HOP_BY_HOP, IGMP, IP_IN_IP, EGP, IPV6_IN_IP, ROUTING, FRAGMENT, GRE, ESP, AH, ICMPV6 = (
    IP_PROTO + p for p in (0, 2, 4, 8, 41, 43, 44, 47, 50, 51, 58))
NO_NEXT, DESTINATION, EIGRP, OSPF, PIM, VRRP, L2TP, SCTP, MOBILITY, UDP_LITE = (
    IP_PROTO + p for p in (59, 60, 88, 89, 103, 112, 115, 132, 135, 136))
TCP, UDP, ICMP = (IP_PROTO + p for p in (fr.PROTO_TCP, fr.PROTO_UDP, fr.PROTO_ICMP))
# Layers that end a walk by their name.
END_NAMES = {
    IGMP: "IGMP", EGP: "EGP", ESP: "ESP", EIGRP: "EIGRP", OSPF: "OSPF", PIM: "PIM", VRRP: "VRRP",
    L2TP: "L2TP", SCTP: "SCTP", UDP_LITE: "UDP-Lite",
    0x0842: "Wake-on-LAN", 0x8035: "RARP", 0x8137: "IPX", 0x8808: "Flow control",
    0x8809: "Slow protocols", 0x8863: "PPPoE discovery", 0x888E: "EAPOL", 0x88CC: "LLDP",
    0x88E5: "MACsec", 0x88F7: "PTP",
}
OPTION_NAMES = {
    HOP_BY_HOP: "HopByHop", ROUTING: "Routing", DESTINATION: "Destination", MOBILITY: "Mobility",
    AH: "AH",
}

STEPS = 8


def _first_layer(frame: Column, link_type: Column) -> tuple[Column, Column, Column]:
    """What stands first, where, and the names so far."""
    version = F.shiftright(fr.unsigned(frame, 0, 1), 4)
    raw = F.when(version == 4, fr.ETHERTYPE_IPV4).when(version == 6, fr.ETHERTYPE_IPV6)
    ethernet = (link_type == fr.LINK_ETHERNET) & (F.length(frame) >= 14)
    kind = F.when(ethernet, fr.unsigned(frame, 12, 2)).when(link_type == fr.LINK_RAW_IP, raw)
    at = F.when(ethernet, 14).otherwise(0)
    return kind.cast("int"), at, F.when(ethernet, F.lit("Ethernet")).otherwise(F.lit(""))


def walk_layers(frames: DataFrame, steps: int = STEPS) -> DataFrame:
    """Add where a frame's headers lead: ``kind``, ``at``, ``layers``, ``ipv4_at``, ``arp_at``.

    ``kind`` is the ethertype, or ``IP_PROTO`` and the protocol number, of the layer at ``at``
    that ends the walk; ``layers`` names all headers in order, joined by ``/``, with ``Raw`` for
    bytes that none explains.  ``ipv4_at`` and ``arp_at`` are the first such headers.  A header
    that the capture cuts off, or that is not what its number says, ends the walk as ``Raw``; so
    do later fragments.  A frame of more than ``steps`` headers has ``done`` false.
    """
    frame, size = F.col("frame"), F.length(F.col("frame"))
    kind, at, names = _first_layer(frame, F.col("link_type"))
    walked = computed_once(frames, {
        "kind": kind, "at": at, "layers": names, "done": kind.isNull(),
        "ipv4_at": F.lit(None).cast("int"), "arp_at": F.lit(None).cast("int")})
    # The same expressions over the columns of each step: they are made only once.
    read, seen, moved = _step(frame, size)
    for _ in range(steps):
        walked = computed_once(
            computed_once(walked.withColumns(read), seen), moved, keep=frames.columns)
    return walked


def _step(frame: Column, size: Column) -> tuple[dict[str, Column], ...]:
    """What a step reads, which layer that shows, and where the walk stands behind it."""
    kind, at, done = F.col("kind"), F.col("at"), F.col("done")
    left = size - at
    head, rest = F.col("_head"), F.col("_rest")

    def byte(word: Column, shift: int) -> Column:
        return F.shiftright(word, shift).bitwiseAND(F.lit(255))

    def is_a(*kinds: int) -> Column:
        return kind.isin(*kinds)

    def present(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    read = {
        "_head": F.when(~done, fr.unsigned(frame, at, 4)),
        "_rest": F.when(~done, fr.unsigned(frame, at + 4, 6)),
    }
    version = F.shiftright(head, 28)
    header = byte(head, 24).bitwiseAND(F.lit(15)) * 4
    fragment = F.shiftright(rest, 16).bitwiseAND(F.lit(0x1FFF))
    seen = {
        "_vlan": present(is_a(*VLANS) & (left >= 4)),
        "_mpls": present(is_a(*MPLS) & (left >= 4)),
        "_ppp": present(is_a(PPPOE) & (left >= 8)),
        "_bridged": present(is_a(BRIDGED) & (left >= 14)),
        "_ipv4": present(is_a(fr.ETHERTYPE_IPV4, IP_IN_IP) & (left >= 20) & (version == 4)
                         & (header >= 20)),
        "_ipv6": present(is_a(fr.ETHERTYPE_IPV6, IPV6_IN_IP) & (left >= 40) & (version == 6)),
        "_option": present(is_a(*OPTION_NAMES) & (left >= 8)),
        "_piece": present(is_a(FRAGMENT) & (left >= 8)),
        "_gre": present(is_a(GRE) & (left >= 4) & (F.shiftright(head, 16).bitwiseAND(F.lit(7)) == 0)),
        "_arp": present(is_a(fr.ETHERTYPE_ARP) & (left >= 28)),
        "_named": present(
            (is_a(TCP) & (left >= 20)) | (is_a(UDP, ICMP) & (left >= 8))
            | (is_a(ICMPV6) & (left >= 4)) | (is_a(*END_NAMES) & (left > 0))
            | (kind.between(0, 1500) & (left >= 3))),
    }
    vlan, mpls, ppp, bridged, ipv4, ipv6, option, piece, gre, arp, named = (
        F.col(f"_{name}") for name in (
            "vlan", "mpls", "ppp", "bridged", "ipv4", "ipv6", "option", "piece", "gre", "arp",
            "named"))
    inner_version = byte(rest, 40)
    by_version = F.when(F.shiftright(inner_version, 4) == 4, fr.ETHERTYPE_IPV4).when(
        F.shiftright(inner_version, 4) == 6, fr.ETHERTYPE_IPV6)
    ppp_kind = F.shiftright(rest, 16).bitwiseAND(F.lit(0xFFFF))
    gre_flags = F.shiftright(head, 16)
    gre_size = F.lit(4) + sum(
        F.when(gre_flags.bitwiseAND(F.lit(flag)) != 0, 4).otherwise(0)
        for flag in (0x8000, 0x2000, 0x1000))
    # The next layer's kind; null where none follows that can be told.
    following = (
        F.when(vlan, fr.low_half(head))
        .when(mpls, F.when(byte(head, 8).bitwiseAND(F.lit(1)) == 0, kind).otherwise(by_version))
        .when(ppp, F.when(ppp_kind == 0x21, fr.ETHERTYPE_IPV4).when(ppp_kind == 0x57, fr.ETHERTYPE_IPV6))
        .when(bridged, fr.unsigned(frame, at + 12, 2))
        .when(ipv4, F.when(fragment == 0, IP_PROTO + byte(rest, 0)))
        .when(ipv6, IP_PROTO + byte(rest, 24))
        .when(option, IP_PROTO + byte(head, 24))
        .when(piece, F.when(fr.low_half(head).bitwiseAND(F.lit(0xFFF8)) == 0, IP_PROTO + byte(head, 24)))
        .when(gre, fr.low_half(head)))
    moved = (
        F.when(vlan | mpls, 4).when(ppp, 8).when(bridged, 14).when(ipv4, header).when(ipv6, 40)
        .when(option, F.when(kind == AH, (byte(head, 16) + 2) * 4).otherwise((byte(head, 16) + 1) * 8))
        .when(piece, 8).when(gre, gre_size))
    def named_by(names: dict[int, str]) -> Column:
        return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[kind]

    name = (
        F.when(vlan, "802.1Q").when(mpls, "MPLS").when(ppp, "PPPoE").when(bridged, "Ethernet")
        .when(ipv4, "IPv4").when(ipv6, "IPv6").when(piece, "Fragment").when(gre, "GRE")
        .when(arp, "ARP").when(option, named_by(OPTION_NAMES))
        .when(named, F.coalesce(named_by(
            {TCP: "TCP", UDP: "UDP", ICMP: "ICMP", ICMPV6: "ICMPv6", **END_NAMES}), F.lit("LLC")))
        .when((left > 0) & ~present(kind == NO_NEXT), "Raw"))
    goes_on = moved.isNotNull()
    prefix = F.when(F.col("layers") == "", "").otherwise("/")
    return read, seen, {
        "kind": F.when(done | ~goes_on, kind).otherwise(following).cast("int"),
        "at": F.when(done | ~goes_on, at).otherwise(at + moved).cast("int"),
        "layers": F.when(done | name.isNull(), F.col("layers")).otherwise(
            F.concat(F.col("layers"), prefix, name)),
        "done": done | ~goes_on,
        "ipv4_at": F.coalesce(F.col("ipv4_at"), F.when(~done & ipv4, at)).cast("int"),
        "arp_at": F.coalesce(F.col("arp_at"), F.when(~done & arp, at)).cast("int"),
    }


def packet_layers(frames: DataFrame, steps: int = STEPS) -> DataFrame:
    """The packet table of frames whose headers are walked, with ``layers`` and ``last_layer``.

    Columns as of ``decode_packets``.  Transport fields are those of the innermost TCP or UDP
    header that the walk reaches; addresses and time to live those of the first IPv4 header.
    ``protocol`` is TCP, UDP, ICMP, ARP or IP if there is such a header, in this order, or else
    the last layer's name; empty frames and unread link types are ``OTHER``.  Packets quoted in
    ICMP errors are not followed.
    """
    walked = walk_layers(frames, steps)
    frame, size, at = F.col("frame"), F.length(F.col("frame")), F.col("at")
    ipv4_at, arp_at = F.col("ipv4_at"), F.col("arp_at")

    def reached(kind: int, least: int) -> Column:
        return F.coalesce((F.col("kind") == kind) & (size >= at + least), F.lit(False))

    tests = computed_once(walked, {
        "has_tcp": reached(TCP, 20), "has_udp": reached(UDP, 8), "has_icmp": reached(ICMP, 8),
        "last_layer": F.nullif(F.substring_index("layers", "/", -1), F.lit("")),
        "address_at": F.coalesce(arp_at + 14, ipv4_at + 12),
        "address_step": F.when(arp_at.isNotNull(), 10).otherwise(4),
    })
    has_tcp, has_udp, has_icmp = F.col("has_tcp"), F.col("has_udp"), F.col("has_icmp")
    words = tests.withColumns({
        "src_address": fr.unsigned(frame, F.col("address_at"), 4),
        "dst_address": fr.unsigned(frame, F.col("address_at") + F.col("address_step"), 4),
        "ports": F.when(has_tcp | has_udp, fr.unsigned(frame, at, 4)),
        "tcp_word": F.when(has_tcp, fr.unsigned(frame, at + 12, 4)),
    })
    ports, tcp_word = F.col("ports"), F.col("tcp_word")
    ethernet = F.col("link_type") == fr.LINK_ETHERNET
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
        .when(arp_at.isNotNull(), "ARP").when(ipv4_at.isNotNull(), "IP")
        .otherwise(F.coalesce("last_layer", F.lit("OTHER"))),
        "length": size,
        "tcp_flags": fr.tcp_flag_letters(fr.high_half(tcp_word).bitwiseAND(F.lit(0x01FF))),
        "ttl": fr.unsigned(frame, ipv4_at + 8, 1),
        "window_size": fr.low_half(tcp_word),
        "payload_len": F.when(
            has_tcp, F.greatest(F.lit(0), size - at - F.shiftright(tcp_word, 28) * 4))
        .when(has_udp, size - at - 8).otherwise(0),
    }
    return words.select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in PACKET.fields),
        F.nullif(F.col("layers"), F.lit("")).alias("layers"), "last_layer")
