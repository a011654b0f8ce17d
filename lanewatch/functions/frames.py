"""Header fields of captured frames, read from the raw bytes.

The outermost headers are decoded: Ethernet (with up to two VLAN tags) or raw
IP, then IPv4, IPv6 or ARP, then TCP, UDP or ICMP.  Later fragments carry no
transport header, so they count as plain IP; a header cut off by the capture
counts as absent.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Link types, ethertypes, IP protocol numbers, flag letters from
# the lowest bit up.
LINK_ETHERNET = 1
LINK_RAW_IP = 101
ETHERTYPE_IPV4 = 0x0800
ETHERTYPE_ARP = 0x0806
ETHERTYPE_VLAN = 0x8100
ETHERTYPE_IPV6 = 0x86DD
PROTO_ICMP = 1
PROTO_TCP = 6
PROTO_UDP = 17
TCP_FLAG_LETTERS = "FSRPAUECN"


def unsigned(frame: Column, offset: Column | int, size: int) -> Column:
    """``size`` bytes (at most 7) at a 0-based offset, big-endian; null past the end.

    Neighbouring fields are best read together and taken apart by shifting:
    a plan with few reads compiles to code small enough to be optimised.
    """
    at = F.lit(offset) if isinstance(offset, int) else offset
    digits = F.conv(F.hex(F.substring(frame, at + 1, F.lit(size))), 16, 10)
    return F.when(at + size <= F.length(frame), digits.cast("long"))


def high_half(word: Column) -> Column:
    """The upper 16 of 32 bits."""
    return F.shiftright(word, 16)


def low_half(word: Column) -> Column:
    return word.bitwiseAND(F.lit(0xFFFF))


def mac_address(frame: Column, offset: int) -> Column:
    digits = F.lower(F.hex(F.substring(frame, offset + 1, 6)))
    return F.when(
        F.length(frame) >= offset + 6, F.regexp_replace(digits, "(..)(?=.)", "$1:"))


def ipv4_text(address: Column) -> Column:
    """A 32-bit address as four decimal numbers."""
    parts = [F.shiftright(address, shift).bitwiseAND(F.lit(255)) for shift in (24, 16, 8, 0)]
    return F.when(address.isNotNull(), F.concat_ws(".", *(p.cast("string") for p in parts)))


def network_offset(frame: Column, link_type: Column) -> Column:
    """Where the network header starts; null for link types that are not read."""
    ethernet = F.when(unsigned(frame, 12, 2) != ETHERTYPE_VLAN, 14).when(
        unsigned(frame, 16, 2) != ETHERTYPE_VLAN, 18).otherwise(22)
    return F.when(link_type == LINK_ETHERNET, ethernet).when(link_type == LINK_RAW_IP, 0)


def network_type(frame: Column, link_type: Column, network: Column) -> Column:
    """Ethertype of the payload; raw IP tells its version by its first half-byte."""
    version = F.shiftright(unsigned(frame, 0, 1), 4)
    raw = F.when(version == 4, ETHERTYPE_IPV4).when(version == 6, ETHERTYPE_IPV6)
    return F.when(link_type == LINK_ETHERNET, unsigned(frame, network - 2, 2)).when(
        link_type == LINK_RAW_IP, raw)


def tcp_flag_letters(bits: Column) -> Column:
    """``0x12 -> 'SA'``: one letter per set bit, lowest bit first."""
    letters = [
        F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, letter).otherwise("")
        for i, letter in enumerate(TCP_FLAG_LETTERS)]
    return F.when(bits.isNotNull(), F.concat(*letters))
