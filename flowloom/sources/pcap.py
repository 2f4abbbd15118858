"""Packet captures: framing and decoding.

Framing walks the record headers of one capture; decoding is array arithmetic over whole
Arrow batches and returns numbers, which the JVM renders as text.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.columns import timestamp_of

# File signature -> (byte order, fraction in nanoseconds).
MAGICS = {
    bytes.fromhex("d4c3b2a1"): ("<", False),
    bytes.fromhex("a1b2c3d4"): (">", False),
    bytes.fromhex("4d3cb2a1"): ("<", True),
    bytes.fromhex("a1b23c4d"): (">", True),
}
# Accepted link types.
LINK_TYPES = (0, 1, 6, 9, 10, 12, 14, 50, 105, 113, 127, 143)
# Registered protocol numbers and their names; others show as their number.
PROTOCOLS = {
    1: "icmp",
    2: "igmp",
    4: "ipv4",
    6: "tcp",
    17: "udp",
    41: "ipv6",
    47: "gre",
    50: "esp",
    51: "ah",
    58: "icmpv6",
    89: "ospf",
    103: "pim",
    112: "vrrp",
    132: "sctp",
}
_IPV4, _IPV6 = 0x0800, 0x86DD

FRAME_SCHEMA = (
    "source_file string, member string, frame_no long, ts_ns long, incl_len long, orig_len long, "
    "link_type int, precision string, reference string, sensor string, data binary, error string"
)
_FRAME_TYPES = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.int32(), *[pa.string()] * 3, pa.binary(), pa.string()]
_FRAMES_PER_BATCH, _BATCH_BYTES = 8192, 4 << 20


def _rejected(reason: str):
    return (None, None, None, None, None, None, reason)


def _frames(content: bytes, precision: str) -> Iterator[tuple]:
    """(ts_ns, incl_len, orig_len, link_type, precision, data, error) of each record, in order."""
    if len(content) < 24 or content[:4] not in MAGICS:
        yield _rejected("truncated capture header" if content[:4] in MAGICS else "not a capture")
        return
    order, nano = MAGICS[content[:4]]
    sigfigs, _, link = struct.unpack_from(order + "3I", content, 12)
    link &= 0xFFFF
    if precision == "header":
        nano = nano or sigfigs == 1
    if link not in LINK_TYPES:
        yield _rejected(f"unsupported link type {link}")
        return
    unit, name = (1, "nano") if nano else (1000, "micro")
    record, at, end = struct.Struct(order + "4I"), 24, len(content)
    while at + 16 <= end:
        sec, frac, incl, orig = record.unpack_from(content, at)
        if at + 16 + incl > end:
            break
        yield sec * 1_000_000_000 + frac * unit, incl, orig, link, name, content[at + 16 : at + 16 + incl], None
        at += 16 + incl
    if at < end:
        yield _rejected("truncated record")


def frame_batches(source_file: str, member: str, reference: str, sensor: str, numbered: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in FRAME_SCHEMA of (frame number, frame) pairs of one capture."""
    names = [part.split(" ")[0] for part in FRAME_SCHEMA.split(", ")]
    while made := list(_up_to_bytes(islice(numbered, _FRAMES_PER_BATCH), source_file, member, reference, sensor)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), _FRAME_TYPES)], names=names)


def _up_to_bytes(numbered: Iterator[tuple], source_file: str, member: str, reference: str, sensor: str) -> Iterator[tuple]:
    """Rows of the next frames, until their data reach ``_BATCH_BYTES``."""
    size = 0
    for n, f in numbered:
        yield source_file, member, n, *f[:5], reference, sensor, *f[5:]
        size += len(f[5] or b"")
        if size >= _BATCH_BYTES:
            return


def read_pcap(captures: DataFrame, precision: str = "header") -> DataFrame:
    """One row per frame; a reject has ``error`` and the place where framing stopped.

    Needs source_file, member, reference, sensor and content. ``precision='header'`` also
    accepts a 1 in the header's fourth field for nanoseconds, ``'magic'`` only the signature.
    """

    def run(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):  # one capture at a time
                frames = enumerate(_frames(row["content"], precision))
                yield from frame_batches(row["source_file"], row["member"], row["reference"], row["sensor"], frames)

    needed = captures.select("source_file", "member", "reference", "sensor", "content")
    return needed.mapInArrow(run, FRAME_SCHEMA)


class _Bytes:
    """Frames of one batch as a flat byte array with big-endian gathers that never overrun."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        body = column.buffers()[2]
        flat = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        self.flat = np.concatenate([flat, np.zeros(64, np.uint8)])
        self.start, self.end = offsets[:-1].copy(), offsets[1:].copy()

    def u8(self, at):
        return self.flat[np.minimum(at, len(self.flat) - 1)].astype(np.int64)

    def u16(self, at):
        return self.u8(at) << 8 | self.u8(at + 1)

    def u32(self, at):
        return self.u16(at) << 16 | self.u16(at + 2)

    def u64(self, at):
        return (self.u32(at) << 32) | self.u32(at + 4)


def _snap(b: _Bytes, at):
    """(network layer offset, ethertype) behind an 802.2 SNAP header."""
    is_snap = (b.u16(at) == 0xAAAA) & (b.u8(at + 2) == 3)
    return at + 8, np.where(is_snap, b.u16(at + 6), 0)


def _ethernet(b: _Bytes, at):
    at, kind = at + 12, b.u16(at + 12)
    while True:  # stacked VLAN tags
        tagged = np.isin(kind, (0x8100, 0x88A8, 0x9100)) & (at < b.end)
        if not tagged.any():
            break
        at = np.where(tagged, at + 4, at)
        kind = b.u16(at)
    length_field = kind < 0x0600
    behind, inner = _snap(b, at + 2)
    return np.where(length_field, behind, at + 2), np.where(length_field, inner, kind)


def _ppp(b: _Bytes, at):
    at = np.where(b.u16(at) == 0xFF03, at + 2, at)
    kind = b.u16(at)
    return at + 2, np.select([kind == 0x0021, kind == 0x0057], [_IPV4, _IPV6], 0)


def _wireless(b: _Bytes, at):
    control, flags = b.u8(at), b.u8(at + 1)
    data = (control & 0x0C) == 0x08
    header = 24 + np.where((flags & 3) == 3, 6, 0) + np.where((control & 0x80) > 0, 2, 0)
    behind, kind = _snap(b, at + header)
    return behind, np.where(data & ((flags & 0x40) == 0), kind, 0)


def _by_version(b: _Bytes, at):
    version = b.u8(at) >> 4
    return at, np.select([version == 4, version == 6], [_IPV4, _IPV6], 0)


def _network_layer(b: _Bytes, link: int, at):
    """Offset and ethertype of the network layer for one accepted link type."""
    if link in (12, 14):
        return _by_version(b, at)
    if link == 0:
        return _by_version(b, at + 4)
    if link == 1:
        return _ethernet(b, at)
    if link == 6:
        routed = np.where((b.u8(at + 8) & 0x80) > 0, b.u8(at + 14) & 0x1F, 0)
        return _snap(b, at + 14 + routed)
    if link == 10:
        return _snap(b, at + 13)
    if link in (9, 50):
        return _ppp(b, at)
    if link == 105:
        return _wireless(b, at)
    if link == 127:
        return _wireless(b, at + (b.u8(at + 2) | b.u8(at + 3) << 8))
    if link == 143:
        extended = np.where((b.u8(at) & 1) > 0, b.u8(at + 1), 0)
        return _ethernet(b, at + 6 + extended)
    return at + 16, b.u16(at + 14)  # 113, cooked


_DECODED = {
    "version": pa.int32(),
    "proto": pa.int32(),
    "src_hi": pa.int64(),
    "src_lo": pa.int64(),
    "dst_hi": pa.int64(),
    "dst_lo": pa.int64(),
    "id_orig_p": pa.int32(),
    "id_resp_p": pa.int32(),
    "flag_bits": pa.int32(),
    "seq_num": pa.int64(),
    "ack_num": pa.int64(),
    "icmp_type_number": pa.int32(),
    "icmp_code_number": pa.int32(),
    "bytes": pa.int64(),
    "error": pa.string(),
}


def _decode(data: pa.Array, links: np.ndarray) -> list[pa.Array]:
    b = _Bytes(data)
    at, kind = b.start.copy(), np.zeros(len(links), np.int64)
    for link in np.unique(links):
        these = links == link
        at[these], kind[these] = (x[these] for x in _network_layer(b, link, b.start))
    v4 = (kind == _IPV4) & (b.u8(at) >> 4 == 4) & (at + 20 <= b.end)
    v6 = (kind == _IPV6) & (b.u8(at) >> 4 == 6) & (at + 40 <= b.end)
    header4 = (b.u8(at) & 15) * 4
    v4 &= (header4 >= 20) & (at + header4 <= b.end)
    proto = np.where(v4, b.u8(at + 9), b.u8(at + 6))
    body = at + np.where(v4, header4, 40)
    total = np.where(v4, b.u16(at + 2), b.u16(at + 4) + 40)
    # A zero length means that the sender left segmentation to the network card.
    stop = np.where(total > 0, np.minimum(at + total, b.end), b.end)
    fragment = v4 & ((b.u16(at + 6) & 0x3FFF) > 0)
    while True:  # IPv6 extension headers
        step = v6 & ~fragment & np.isin(proto, (0, 43, 60, 44, 51)) & (body + 8 <= stop)
        if not step.any():
            break
        fragment |= step & (proto == 44) & ((b.u16(body + 2) & 0xFFF9) > 0)
        size = np.where(proto == 44, 8, np.where(proto == 51, (b.u8(body + 1) + 2) * 4, (b.u8(body + 1) + 1) * 8))
        proto = np.where(step, b.u8(body), proto)
        body = np.where(step, body + size, body)
    ip = v4 | v6
    room = stop - body
    data_at = (b.u8(body + 12) >> 4) * 4
    tcp = ip & ~fragment & (proto == 6) & (room >= 20) & (data_at >= 20)
    udp = ip & ~fragment & (proto == 17) & (room >= 8)
    icmp = ip & ~fragment & np.isin(proto, (1, 58)) & (room >= 4)
    head = np.select([tcp, udp, icmp], [data_at, 8, 4], 0)
    size = np.maximum(room - head, 0)
    udp_len = b.u16(body + 4)
    size = np.where(udp & (udp_len >= 8), np.minimum(size, udp_len - 8), size)

    def numbers(values, valid, name):
        return pa.array(values, mask=~valid).cast(_DECODED[name], safe=False)

    ports = tcp | udp
    zero = np.zeros_like(at)
    columns = {
        "version": (np.where(v4, 4, 6), ip),
        "proto": (proto, ip),
        "src_hi": (np.where(v4, zero, b.u64(at + 8)), ip),
        "src_lo": (np.where(v4, b.u32(at + 12), b.u64(at + 16)), ip),
        "dst_hi": (np.where(v4, zero, b.u64(at + 24)), ip),
        "dst_lo": (np.where(v4, b.u32(at + 16), b.u64(at + 32)), ip),
        "id_orig_p": (b.u16(body), ports),
        "id_resp_p": (b.u16(body + 2), ports),
        "flag_bits": (b.u8(body + 13), tcp),
        "seq_num": (b.u32(body + 4), tcp),
        "ack_num": (b.u32(body + 8), tcp),
        "icmp_type_number": (b.u8(body), icmp),
        "icmp_code_number": (b.u8(body + 1), icmp),
        "bytes": (size, ip),
    }
    out = [numbers(values, valid, name) for name, (values, valid) in columns.items()]
    out.append(pa.array(np.where(ip, None, "no IP layer"), pa.string()))
    return out


def _address(hi: str, lo: str) -> Column:
    def part(word: str, shift: int, mask: int) -> Column:
        return F.shiftrightunsigned(word, shift).bitwiseAND(F.lit(mask).cast("bigint"))

    v4 = F.concat_ws(".", *[part(lo, s, 255).cast("string") for s in (24, 16, 8, 0)])
    v6 = F.concat_ws(":", *[F.lower(F.hex(part(w, s, 0xFFFF))) for w in (hi, lo) for s in (48, 32, 16, 0)])
    return F.when(F.col("version") == 4, v4).when(F.col("version") == 6, v6)


# Bit of each TCP flag in the header's flag byte.
_FLAG_BITS = {"fin": 1, "syn": 2, "rst": 4, "psh": 8, "ack": 16, "urg": 32}


def decode_packets(frames: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Frames to packets. Frames without an IP layer and framing rejects keep their ``error``.

    The frame bytes go no further than the decoding stage unless ``keep_payload`` is set.
    """
    carried = [c for c in frames.columns if c not in ("data", "error")] + (["data"] if keep_payload else [])
    schema = frames.select(*carried).schema
    for name, kind in _DECODED.items():
        schema = schema.add(name, {"int32": T.IntegerType(), "int64": T.LongType()}.get(str(kind), T.StringType()))

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = [table.column(c).combine_chunks() for c in carried]
            data = pc.fill_null(table.column("data").combine_chunks(), b"")
            links = table.column("link_type").combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False)
            decoded = _decode(data, links)
            framing = table.column("error").combine_chunks()
            decoded[-1] = pc.coalesce(framing, decoded[-1])
            yield pa.RecordBatch.from_arrays(kept + decoded, names=carried + list(_DECODED))

    numbers = frames.mapInArrow(run, schema)
    names = F.create_map(*[F.lit(x) for item in PROTOCOLS.items() for x in item])
    flags = {n: F.col("flag_bits").bitwiseAND(F.lit(bit)) != 0 for n, bit in _FLAG_BITS.items()}
    text = {
        "id_orig_h": _address("src_hi", "src_lo"),
        "id_resp_h": _address("dst_hi", "dst_lo"),
        "ip_version": F.concat(F.lit("ipv"), F.col("version").cast("string")),
        "protocol": F.coalesce(F.try_element_at(names, F.col("proto")), F.col("proto").cast("string")),
        "ts": timestamp_of("ts_ns"),
    }
    return numbers.withColumns({**flags, **text}).drop(
        "flag_bits", "version", "proto", "src_hi", "src_lo", "dst_hi", "dst_lo"
    )
