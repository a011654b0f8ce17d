"""Frame decoding on hand-made frames, and capture files of every header form."""

import struct

import pytest
from pyspark.sql import functions as F

from lanewatch.plans.packets import decode_packets, number_packets
from lanewatch.sources.captures import read_captures

DST, SRC = bytes.fromhex("aabbccddee01"), bytes.fromhex("aabbccddee02")


def ether(kind: int, body: bytes, tags: bytes = b"") -> bytes:
    return DST + SRC + tags + struct.pack(">H", kind) + body


def ipv4(proto: int, body: bytes, ttl: int = 64, options: bytes = b"", fragment: int = 0) -> bytes:
    words = 5 + len(options) // 4
    return struct.pack(
        ">BBHHHBBH4s4s", 0x40 | words, 0, words * 4 + len(body), 1, fragment, ttl, proto, 0,
        bytes([10, 0, 0, 1]), bytes([192, 168, 1, 254])) + options + body


def ipv6(proto: int, body: bytes) -> bytes:
    return struct.pack(">IHBB", 6 << 28, len(body), proto, 64) + bytes(32) + body


def tcp(flags: int, payload: bytes = b"", words: int = 5) -> bytes:
    return struct.pack(">HHIIHHHH", 51000, 443, 1, 2, words << 12 | flags, 1024, 0, 0) + bytes(
        words * 4 - 20) + payload


def udp(payload: bytes = b"") -> bytes:
    return struct.pack(">HHHH", 5353, 53, 8 + len(payload), 0) + payload


ICMP = bytes([8, 0, 0, 0, 0, 1, 0, 1])
ARP = struct.pack(">HHBBH6s4s6s4s", 1, 0x0800, 6, 4, 1, SRC, bytes([10, 0, 0, 7]), bytes(6),
                  bytes([10, 0, 0, 9]))

CASES = {
    "syn": ether(0x0800, ipv4(6, tcp(0x002))),
    "data": ether(0x0800, ipv4(6, tcp(0x018, b"hello"), ttl=3)),
    "all_flags": ether(0x0800, ipv4(6, tcp(0x1FF))),
    "tcp_options": ether(0x0800, ipv4(6, tcp(0x010, b"xy", words=8), options=bytes(8))),
    "padded_ack": ether(0x0800, ipv4(6, tcp(0x010))) + bytes(6),
    "udp": ether(0x0800, ipv4(17, udp(b"abc"))),
    "icmp": ether(0x0800, ipv4(1, ICMP)),
    "other_ip": ether(0x0800, ipv4(47, b"gre.")),
    "fragment": ether(0x0800, ipv4(6, tcp(0x010), fragment=100)),
    "first_fragment": ether(0x0800, ipv4(17, udp(b"abc"), fragment=0x2000)),
    "arp": ether(0x0806, ARP),
    "vlan": ether(0x0800, ipv4(6, tcp(0x002)), tags=bytes.fromhex("81000005")),
    "two_vlans": ether(0x0800, ipv4(17, udp(b"q")), tags=bytes.fromhex("8100000581000006")),
    "ipv6_tcp": ether(0x86DD, ipv6(6, tcp(0x012, b"z"))),
    "unknown": ether(0x88B5, b"whatever"),
    "cut_tcp": ether(0x0800, ipv4(6, tcp(0x002)))[:40],
    "cut_ip": ether(0x0800, ipv4(6, tcp(0x002)))[:20],
    "tiny": b"\x01\x02",
    "empty": b"",
}


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(name, 1, 1.5, 1, bytearray(frame)) for name, frame in CASES.items()]
    rows.append(("raw", 1, 1.5, 101, bytearray(ipv4(17, udp(b"raw")))))
    rows.append(("radio", 1, 1.5, 127, bytearray(CASES["syn"])))
    frames = spark.createDataFrame(
        rows, "file_name string, packet_no long, timestamp double, link_type int, frame binary")
    return {r["file_name"]: r.asDict() for r in decode_packets(frames).collect()}


@pytest.mark.parametrize("name, protocol", [
    ("syn", "TCP"), ("data", "TCP"), ("udp", "UDP"), ("icmp", "ICMP"), ("arp", "ARP"),
    ("other_ip", "IP"), ("fragment", "IP"), ("first_fragment", "UDP"), ("vlan", "TCP"),
    ("two_vlans", "UDP"), ("ipv6_tcp", "TCP"), ("unknown", "OTHER"), ("cut_tcp", "IP"),
    ("cut_ip", "OTHER"), ("tiny", "OTHER"), ("empty", "OTHER"), ("raw", "UDP"),
    ("radio", "OTHER"),
])
def test_protocol(decoded, name, protocol):
    assert decoded[name]["protocol"] == protocol
    assert decoded[name]["length"] == len(CASES.get(name, CASES["syn"] if name == "radio"
                                                    else ipv4(17, udp(b"raw"))))


def test_tcp_fields(decoded):
    row = decoded["data"]
    assert (row["src_ip"], row["dst_ip"], row["ttl"]) == ("10.0.0.1", "192.168.1.254", 3)
    assert (row["src_port"], row["dst_port"], row["window_size"]) == (51000, 443, 1024)
    assert (row["tcp_flags"], row["payload_len"]) == ("PA", 5)
    assert (row["src_mac"], row["dst_mac"]) == ("aa:bb:cc:dd:ee:02", "aa:bb:cc:dd:ee:01")
    assert row["datetime"] == "1970-01-01T00:00:01.500000"
    assert decoded["syn"]["tcp_flags"] == "S" and decoded["syn"]["payload_len"] == 0
    assert decoded["all_flags"]["tcp_flags"] == "FSRPAUECN"
    assert decoded["tcp_options"]["payload_len"] == 2
    assert decoded["padded_ack"]["payload_len"] == 6
    assert decoded["vlan"]["src_ip"] == "10.0.0.1" and decoded["vlan"]["dst_port"] == 443


def test_other_fields(decoded):
    assert decoded["udp"]["payload_len"] == 3 and decoded["udp"]["tcp_flags"] is None
    assert (decoded["arp"]["src_ip"], decoded["arp"]["dst_ip"]) == ("10.0.0.7", "10.0.0.9")
    assert decoded["arp"]["ttl"] is None and decoded["arp"]["payload_len"] == 0
    assert decoded["icmp"]["src_port"] is None and decoded["icmp"]["payload_len"] == 0
    assert decoded["ipv6_tcp"]["src_ip"] is None and decoded["ipv6_tcp"]["tcp_flags"] == "SA"
    assert decoded["cut_tcp"]["src_port"] is None and decoded["cut_tcp"]["src_ip"] == "10.0.0.1"
    assert decoded["raw"]["src_mac"] is None and decoded["raw"]["src_port"] == 5353
    assert decoded["tiny"]["src_mac"] is None


def test_types_of_other_packets(spark):
    frames = spark.createDataFrame(
        [(n, 1, 0.0, 1, bytearray(CASES[n])) for n in ("unknown", "other_ip", "vlan", "tiny")],
        "file_name string, packet_no long, timestamp double, link_type int, frame binary")
    got = {r["file_name"]: (r["ethertype"], r["ip_proto"])
           for r in decode_packets(frames, with_types=True).collect()}
    assert got == {"unknown": (0x88B5, None), "other_ip": (0x0800, 47), "vlan": (0x0800, 6),
                   "tiny": (None, None)}


def test_only_wanted_columns_are_decoded(spark):
    frames = spark.createDataFrame(
        [], "file_name string, packet_no long, timestamp double, link_type int, frame binary")
    plan = decode_packets(frames).select("length", "label")._jdf.queryExecution()
    assert "regexp_replace" not in plan.optimizedPlan().toString()


def test_file_name_labels(spark):
    names = ["benign-camera-1.pcap", "benign.pcap", "mirai-udp.pcap", "Benign-x-y.pcap"]
    frames = spark.createDataFrame(
        [(n, 1, 0.0, 1, bytearray(CASES["syn"])) for n in names],
        "file_name string, packet_no long, timestamp double, link_type int, frame binary")
    got = {r["file_name"]: (r["category"], r["sub_category"], r["label"])
           for r in decode_packets(frames).collect()}
    assert got == {
        "benign-camera-1.pcap": ("benign", "camera", "benign"),
        "benign.pcap": ("benign.pcap", None, "attack"),
        "mirai-udp.pcap": ("mirai", "udp.pcap", "attack"),
        "Benign-x-y.pcap": ("Benign", "x", "attack"),
    }


def test_numbering_crosses_steps(spark):
    rows = [("a", o) for o in (24, 90, 1_500, 3_000, 3_001)] + [("b", 24), ("b", 9_999)]
    numbered = number_packets(spark.createDataFrame(rows, "file_name string, offset long"), step=1000)
    assert sorted((r["file_name"], r["offset"], r["packet_no"]) for r in numbered.collect()) == [
        ("a", 24, 1), ("a", 90, 2), ("a", 1500, 3), ("a", 3000, 4), ("a", 3001, 5),
        ("b", 24, 1), ("b", 9999, 2)]


def capture(frames, order="<", nano=False, snap=262144, seconds=None, link=1, tail=b""):
    magic = 0xA1B23C4D if nano else 0xA1B2C3D4
    data = struct.pack(order + "IHHIIII", magic, 2, 4, 0, 0, snap, link)
    for i, frame in enumerate(frames):
        at = seconds[i] if seconds else 1_700_000_000 + i
        part = 250_000_000 if nano else 250_000
        data += struct.pack(order + "IIII", at, part, len(frame), len(frame)) + frame
    return data + tail


FRAMES = list(CASES.values())[:15] * 8


def read_back(spark, path, split_bytes):
    return {(r["file_name"], r["packet_no"]): (r["timestamp"], bytes(r["frame"]))
            for r in read_captures(spark, str(path), split_bytes).collect()}


@pytest.mark.parametrize("split_bytes", [61, 700, 1 << 20])
def test_all_header_forms_read_alike(spark, tmp_path, split_bytes):
    for order, nano in (("<", False), (">", False), ("<", True), (">", True)):
        name = f"x-{'le' if order == '<' else 'be'}-{nano}.pcap"
        (tmp_path / name).write_bytes(capture(FRAMES, order, nano))
    (tmp_path / "notes.txt").write_text("not a capture")
    (tmp_path / "none-a.pcap").write_bytes(capture([]))
    got = read_back(spark, tmp_path, split_bytes)
    assert len(got) == 4 * len(FRAMES)
    for (_, number), (seconds, frame) in got.items():
        assert seconds == 1_700_000_000 + number - 1 + 0.25 and frame == FRAMES[number - 1]


@pytest.mark.parametrize("split_bytes", [97, 1000])
def test_captures_inside_captures_do_not_mislead(spark, tmp_path, split_bytes):
    inner = capture([b"decoy" * 3] * 20)
    frames = [inner, b"a" * 40, inner[24:], b"b"] * 5
    (tmp_path / "x-y.pcap").write_bytes(capture(frames))
    got = read_back(spark, tmp_path, split_bytes)
    assert [got[("x-y.pcap", i + 1)][1] for i in range(len(frames))] == frames
    assert len(got) == len(frames)


def test_a_clock_that_jumps(spark, tmp_path):
    seconds = [5 + i if i < 3 else 1_700_000_000 - i for i in range(60)]
    frames = [bytes([i]) * 50 for i in range(60)]
    (tmp_path / "x-y.pcap").write_bytes(capture(frames, seconds=seconds))
    got = read_back(spark, tmp_path, 300)
    assert [got[("x-y.pcap", i + 1)] for i in range(60)] == [
        (s + 0.25, f) for s, f in zip(seconds, frames)]


@pytest.mark.parametrize("bad", [range(20, 22), range(20, 60)])
def test_implausible_records_are_read_all_the_same(spark, tmp_path, bad):
    """Two records that claim to be longer than they were sent, or all from one on."""
    data = capture([])
    frames = [bytes([65 + i]) * 50 for i in range(60)]
    for i, frame in enumerate(frames):
        data += struct.pack("<IIII", 1_700_000_000 + i, 0, 50, 3 if i in bad else 50) + frame
    (tmp_path / "x-y.pcap").write_bytes(data)
    got = read_back(spark, tmp_path, 300)
    assert [got[("x-y.pcap", i + 1)][1] for i in range(60)] == frames and len(got) == 60


def test_cut_off_last_frame(spark, tmp_path):
    whole = capture(FRAMES[:30])
    tail = struct.pack("<IIII", 1_700_000_100, 0, 500, 500) + b"part"
    (tmp_path / "x-y.pcap").write_bytes(whole + tail)
    (tmp_path / "x-z.pcap").write_bytes(whole + b"\x01\x02\x03")
    got = read_back(spark, tmp_path, 256)
    assert got[("x-y.pcap", 31)][1] == b"part"
    assert len(got) == 61


def test_other_files_are_refused(spark, tmp_path):
    (tmp_path / "x-y.pcap").write_bytes(b"\x0a\x0d\x0d\x0a" + bytes(60))
    with pytest.raises(Exception, match="not a packet capture"):
        read_captures(spark, str(tmp_path)).count()
