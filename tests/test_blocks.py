"""Captures of the block format."""

import struct

import pytest

from lanewatch.sources.captures import read_captures


def block(order: str, kind: int, body: bytes) -> bytes:
    body += b"\0" * (-len(body) % 4)
    size = struct.pack(order + "I", len(body) + 12)
    return struct.pack(order + "I", kind) + size + body + size


def section(order: str) -> bytes:
    return block(order, 0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1))


def option(order: str, code: int, value: bytes) -> bytes:
    return struct.pack(order + "HH", code, len(value)) + value + b"\0" * (-len(value) % 4)


def interface(order: str, link: int = 1, snap: int = 0, options: bytes = b"") -> bytes:
    return block(order, 1, struct.pack(order + "HHI", link, 0, snap) + options)


def packet(order: str, frame: bytes, units: int, which: int = 0) -> bytes:
    return block(order, 6, struct.pack(
        order + "IIIII", which, units >> 32, units & 0xFFFFFFFF, len(frame), len(frame)) + frame)


def read_back(spark, path, split_bytes, form="block"):
    rows = read_captures(spark, str(path), split_bytes, form).collect()
    return {(r["file_name"], r["packet_no"]): (r["timestamp"], r["link_type"], bytes(r["frame"]))
            for r in rows}


SPLITS = [61, 200, 1 << 20]


@pytest.mark.parametrize("split_bytes", SPLITS)
def test_state_is_handed_on_through_ranges(spark, tmp_path, split_bytes):
    data, expected = b"", []
    for n, order in enumerate("<><"):
        data += section(order) + interface(order, 1) + interface(
            order, 101, 0, option(order, 9, bytes([9])) + option(order, 14, struct.pack(order + "q", 5))
            + option(order, 0, b""))
        for k in range(20):
            frame = bytes([n, k]) * (k % 7 + 1)
            if k == 10:  # one more interface, of halves of a second to the power 10
                data += interface(order, 113, 0, option(order, 9, bytes([0x80 | 10])))
            which = k % (3 if k > 10 else 2)
            units, seconds = [(1_500_000, 1.5), (2_250_000_000, 7.25), (1024 + 512, 1.5)][which]
            data += packet(order, frame, units, which)
            data += block(order, 5, bytes(8)) if k % 5 == 0 else b""
            expected.append((seconds, (1, 101, 113)[which], frame))
    (tmp_path / "a-b.pcap").write_bytes(data)
    assert read_back(spark, tmp_path, split_bytes) == {
        ("a-b.pcap", n): row for n, row in enumerate(expected, 1)}


@pytest.mark.parametrize("split_bytes", SPLITS)
def test_other_packet_blocks_and_odd_files(spark, tmp_path, split_bytes):
    start = section(">") + interface(">", 1, snap=4)
    old = block(">", 2, struct.pack(">HHIIII", 0, 0, 0, 3_000_000, 3, 3) + b"old")
    simple = block(">", 3, struct.pack(">I", 9) + b"long")
    (tmp_path / "kinds.pcap").write_bytes(
        start + old + simple + packet(">", b"lost", 1_000_000, 7) + packet(">", b"", 2_000_000))
    (tmp_path / "cut.pcap").write_bytes(start + packet(">", b"ab", 0) + packet(">", b"cd", 0)[:-3])
    (tmp_path / "only.pcap").write_bytes(section("<"))
    got = read_back(spark, tmp_path, split_bytes)
    assert got == {
        ("kinds.pcap", 1): (3.0, 1, b"old"), ("kinds.pcap", 2): (None, 1, b"long"),
        ("kinds.pcap", 3): (1.0, -1, b"lost"), ("kinds.pcap", 4): (2.0, 1, b""),
        ("cut.pcap", 1): (0.0, 1, b"ab")}


@pytest.mark.parametrize("split_bytes", [100, 2048])
def test_captures_inside_captures_do_not_mislead(spark, tmp_path, split_bytes):
    inner = section(">") + interface(">") + b"".join(packet(">", b"x" * 30, 0) for _ in range(60))
    frames = [b"plain", inner, inner, b"end"]
    (tmp_path / "a.pcap").write_bytes(
        section("<") + interface("<") + b"".join(packet("<", f, 0) for f in frames))
    got = read_back(spark, tmp_path, split_bytes)
    assert [got[("a.pcap", n)][2] for n in range(1, 5)] == frames and len(got) == 4


def test_forms_of_a_folder(spark, tmp_path):
    (tmp_path / "new.pcap").write_bytes(section("<") + interface("<") + packet("<", b"new", 0))
    (tmp_path / "old.pcap").write_bytes(
        struct.pack("<IHHIIII", 0xA1B2C3D4, 2, 4, 0, 0, 100, 1) + struct.pack("<IIII", 1, 0, 3, 3) + b"old")
    got = read_back(spark, tmp_path, 1 << 20, "any")
    assert {k: v[2] for k, v in got.items()} == {("new.pcap", 1): b"new", ("old.pcap", 1): b"old"}
    with pytest.raises(Exception, match="block format"):
        read_back(spark, tmp_path, 1 << 20, "block")
    with pytest.raises(ValueError, match="unknown capture form"):
        read_captures(spark, str(tmp_path), form="new")


@pytest.mark.parametrize("form", ["block", "classic"])
def test_small_ranges_share_tasks(spark, tmp_path, form):
    """A task per range made exchanges of as many blocks as the square of the ranges."""
    frames = [bytes([k % 251]) * 40 for k in range(300)]
    if form == "block":
        data = section("<") + interface("<") + b"".join(packet("<", f, 0) for f in frames)
    else:
        data = struct.pack("<IHHIIII", 0xA1B2C3D4, 2, 4, 0, 0, 0, 1) + b"".join(
            struct.pack("<IIII", 0, 0, len(f), len(f)) + f for f in frames)
    (tmp_path / "a-b.pcap").write_bytes(data)
    found = read_captures(spark, str(tmp_path), 80, form)
    assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism < len(data) // 80
    assert [bytes(r["frame"]) for r in found.orderBy("packet_no").collect()] == frames
