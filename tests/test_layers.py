"""Frames walked header by header."""

import struct

import pytest

from lanewatch.plans.layers import packet_layers, walk_layers
from lanewatch.plans.packets import decode_packets
from test_packets import ARP, CASES, ICMP, ether, ipv4, ipv6, tcp, udp

SCHEMA = "file_name string, packet_no long, timestamp double, link_type int, frame binary"


def option(following: int, size: int = 8) -> bytes:
    return bytes([following, size // 8 - 1]) + bytes(size - 2)


def piece(following: int, offset: int) -> bytes:
    return struct.pack(">BBHI", following, 0, offset << 3, 7)


def gre(kind: int, flags: int = 0) -> bytes:
    return struct.pack(">HH", flags, kind) + bytes(4 * bin(flags & 0xB000).count("1"))


SYN = tcp(0x002, b"abc")
INNER = ipv4(17, udp(b"in"), ttl=9)
LAYERED = {
    "hop": (ether(0x86DD, ipv6(0, option(6) + SYN)), "Ethernet/IPv6/HopByHop/TCP", "TCP"),
    "chain": (ether(0x86DD, ipv6(0, option(43, 16) + option(60, 24) + option(44) + piece(17, 0) + udp(b"q"))),
              "Ethernet/IPv6/HopByHop/Routing/Destination/Fragment/UDP", "UDP"),
    "late": (ether(0x86DD, ipv6(44, piece(6, 10) + SYN)), "Ethernet/IPv6/Fragment/Raw", "Raw"),
    "ah": (ether(0x0800, ipv4(51, bytes([6, 4]) + bytes(22) + SYN)), "Ethernet/IPv4/AH/TCP", "TCP"),
    "ip_in_ip": (ether(0x0800, ipv4(4, INNER)), "Ethernet/IPv4/IPv4/UDP", "UDP"),
    "six_in_four": (ether(0x0800, ipv4(41, ipv6(6, SYN))), "Ethernet/IPv4/IPv6/TCP", "TCP"),
    "four_in_six": (ether(0x86DD, ipv6(4, INNER)), "Ethernet/IPv6/IPv4/UDP", "UDP"),
    "gre": (ether(0x0800, ipv4(47, gre(0x0800, 0xB000) + INNER)), "Ethernet/IPv4/GRE/IPv4/UDP", "UDP"),
    "bridged": (ether(0x0800, ipv4(47, gre(0x6558) + ether(0x0800, INNER))),
                "Ethernet/IPv4/GRE/Ethernet/IPv4/UDP", "UDP"),
    "gre_other": (ether(0x0800, ipv4(47, gre(0x0800, 1) + INNER)), "Ethernet/IPv4/Raw", "IP"),
    "tags": (ether(0x0800, INNER, tags=bytes.fromhex("88a80001" "81000002" "81000003")),
             "Ethernet/802.1Q/802.1Q/802.1Q/IPv4/UDP", "UDP"),
    "mpls": (ether(0x8847, bytes.fromhex("0001000a" "0002010a") + INNER),
             "Ethernet/MPLS/MPLS/IPv4/UDP", "UDP"),
    "pppoe": (ether(0x8864, bytes.fromhex("11000001" "0020" "0057") + ipv6(6, SYN)),
              "Ethernet/PPPoE/IPv6/TCP", "TCP"),
    "icmpv6": (ether(0x86DD, ipv6(58, ICMP)), "Ethernet/IPv6/ICMPv6", "ICMPv6"),
    "no_next": (ether(0x86DD, ipv6(59, b"")), "Ethernet/IPv6", "IPv6"),
    "sctp": (ether(0x0800, ipv4(132, bytes(12))), "Ethernet/IPv4/SCTP", "IP"),
    "ospf6": (ether(0x86DD, ipv6(89, bytes(12))), "Ethernet/IPv6/OSPF", "OSPF"),
    "lldp": (ether(0x88CC, b"x"), "Ethernet/LLDP", "LLDP"),
    "llc": (ether(0x0026, bytes(38)), "Ethernet/LLC", "LLC"),
    "unknown": (ether(0x88B5, b"what"), "Ethernet/Raw", "Raw"),
    "arp": (ether(0x0806, ARP, tags=bytes.fromhex("81000005")), "Ethernet/802.1Q/ARP", "ARP"),
    "not_ip": (ether(0x0800, b"\x00" * 30), "Ethernet/Raw", "Raw"),
    "cut": (ether(0x86DD, ipv6(0, option(6)[:5])), "Ethernet/IPv6/Raw", "Raw"),
    "empty": (b"", None, "OTHER"),
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(name, 1, 1.5, 1, bytearray(frame)) for name, (frame, _, _) in LAYERED.items()]
    return {r["file_name"]: r for r in packet_layers(spark.createDataFrame(data, SCHEMA)).collect()}


@pytest.mark.parametrize("name", LAYERED)
def test_layers_and_protocol(rows, name):
    assert (rows[name]["layers"], rows[name]["protocol"]) == LAYERED[name][1:]


def test_fields_behind_other_headers(rows):
    assert (rows["hop"]["src_port"], rows["hop"]["tcp_flags"], rows["hop"]["payload_len"]) == (51000, "S", 3)
    assert rows["hop"]["src_ip"] is None and rows["hop"]["ttl"] is None
    assert (rows["ip_in_ip"]["ttl"], rows["ip_in_ip"]["dst_port"], rows["ip_in_ip"]["payload_len"]) == (64, 53, 2)
    assert (rows["four_in_six"]["ttl"], rows["four_in_six"]["src_ip"]) == (9, "10.0.0.1")
    assert (rows["arp"]["src_ip"], rows["arp"]["dst_ip"], rows["arp"]["ttl"]) == ("10.0.0.7", "10.0.0.9", None)
    assert rows["late"]["src_port"] is None and rows["empty"]["length"] == 0


def test_plain_frames_decode_as_before(spark):
    data = [(name, 1, 1.5, 1, bytearray(frame)) for name, frame in CASES.items()]
    data += [("raw", 1, 1.5, 101, bytearray(INNER)), ("radio", 1, 1.5, 127, bytearray(CASES["syn"]))]
    frames = spark.createDataFrame(data, SCHEMA)
    plain = {r["file_name"]: r.asDict() for r in decode_packets(frames).collect()}
    for row in packet_layers(frames).drop("layers", "last_layer").collect():
        expected = plain[row["file_name"]]
        if expected["protocol"] == "OTHER":
            expected["protocol"] = row["protocol"]
        assert row.asDict() == expected


def test_bounded_walk_in_one_compiled_pass(spark, tmp_path, capsys):
    tags = bytes.fromhex("81000001") * 6
    frames = spark.createDataFrame(
        [("a.pcap", 1, 0.0, 1, bytearray(ether(0x0800, INNER, tags=tags)))], SCHEMA)
    assert [r["done"] for r in walk_layers(frames, 3).collect()] == [False]
    assert [r["done"] for r in walk_layers(frames, 8).collect()] == [True]
    frames.write.parquet(str(tmp_path / "frames"))
    packet_layers(spark.read.parquet(str(tmp_path / "frames"))).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Exchange" not in plan
    tree = [line for line in plan.split("\n\n")[0].splitlines() if "(" in line]
    assert tree and all("* " in line for line in tree if "Scan" not in line)
