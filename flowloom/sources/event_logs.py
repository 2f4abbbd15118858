"""Windows event logs: rendered XML and binary log files to flat field maps.

Both forms give ``fields MAP<name, STRUCT<value, type>>`` with names SECTION_TAG, plus the
attribute or the element's ``Name`` key, in upper case. A log file is split into its 64 KiB
chunks by the JVM; chunks are independent and are decoded in parallel.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = "map<string, struct<value: string, type: string>>"
SECTIONS = ("System", "EventData")
TEXT_TYPE = "WStringTypeNode"
# Layout of a log file.
_FILE_HEADER, _CHUNK, _FIRST_RECORD = 4096, 65536, 512
_CHUNK_SIGNATURE, _RECORD_SIGNATURE = "456c6643686e6b00", 0x2A2A
# Type code -> (type name, struct format of a plain number).
VALUE_TYPES = {
    0x00: ("NullTypeNode", None),
    0x01: (TEXT_TYPE, None),
    0x02: ("StringTypeNode", None),
    0x03: ("SignedByteTypeNode", "<b"),
    0x04: ("UnsignedByteTypeNode", "<B"),
    0x05: ("SignedWordTypeNode", "<h"),
    0x06: ("UnsignedWordTypeNode", "<H"),
    0x07: ("SignedDWordTypeNode", "<i"),
    0x08: ("UnsignedDWordTypeNode", "<I"),
    0x09: ("SignedQWordTypeNode", "<q"),
    0x0A: ("UnsignedQWordTypeNode", "<Q"),
    0x0B: ("FloatTypeNode", "<f"),
    0x0C: ("DoubleTypeNode", "<d"),
    0x0D: ("BooleanTypeNode", None),
    0x0E: ("BinaryTypeNode", None),
    0x0F: ("GuidTypeNode", None),
    0x10: ("SizeTypeNode", None),
    0x11: ("FiletimeTypeNode", None),
    0x12: ("SystemtimeTypeNode", None),
    0x13: ("SIDTypeNode", None),
    0x14: ("Hex32TypeNode", None),
    0x15: ("Hex64TypeNode", None),
    0x21: ("BXmlTypeNode", None),
    0x20: ("HandleTypeNode", None),
    0x23: ("EvtXmlTypeNode", None),
}
# Bytes of an array's value, where they are no plain number.
ITEM_SIZES = {0x0D: 4, 0x0F: 16, 0x10: 8, 0x11: 8, 0x12: 16, 0x14: 4, 0x15: 8}


def _name(section: str, tag: str, part: str = "") -> str:
    return "_".join(x for x in (section, tag, part) if x).upper()


def _strip_line_end(text: str) -> str:
    return text[:-2] if text.endswith("\r\n") else text.removesuffix("\n")


# --- rendered XML -----------------------------------------------------------------------


def _xml_fields(text: str | None) -> tuple[dict | None, str | None]:
    if text is None:
        return None, "no event text"
    try:
        root = ElementTree.fromstring(text)
    except ElementTree.ParseError as problem:
        return None, f"not well-formed: {problem}"
    fields: dict[str, tuple[str, str]] = {}

    def visit(element, section):
        tag = element.tag.rpartition("}")[2]
        section = tag if tag in SECTIONS else section
        key = element.get("Name", "") if tag == "Data" else ""
        for attribute, value in element.attrib.items():
            if attribute == "SystemTime":
                value = value.replace("T", " ").removesuffix("Z")
            if not (tag == "Data" and attribute == "Name"):
                fields[_name(section, tag, attribute)] = (_strip_line_end(value), TEXT_TYPE)
        if len(element) == 0 and element.text is not None and element.text.strip():
            fields[_name(section, tag, key)] = (_strip_line_end(element.text), TEXT_TYPE)
        for child in element:
            visit(child, section)

    visit(root, "Event")
    return fields, None


def flatten_event(df: DataFrame, xml: str) -> DataFrame:
    """Add ``fields`` and ``error`` from rendered event XML."""

    @F.pandas_udf("fields array<struct<key: string, value: string, type: string>>, error string")
    def parse(texts: pd.Series) -> pd.DataFrame:
        parsed = [_xml_fields(t) for t in texts]
        entries = [None if f is None else [{"key": k, "value": v, "type": t} for k, (v, t) in f.items()] for f, _ in parsed]
        return pd.DataFrame({"fields": entries, "error": [e for _, e in parsed]})

    out = df.withColumn("_parsed", parse(F.col(xml)))
    entry = F.transform("_parsed.fields", lambda e: F.struct(e["key"], F.struct(e["value"], e["type"])))
    return out.withColumns({"fields": F.map_from_entries(entry), "error": F.col("_parsed.error")}).drop("_parsed")


# --- binary logs ------------------------------------------------------------------------


def _filetime(ticks: int) -> str:
    if ticks >= 0x24C85A5ED1C04000:  # past the year 9999, such as the "never" time
        return f"0x{ticks:016x}"
    moment = datetime(1601, 1, 1) + timedelta(microseconds=ticks // 10)
    return f"{moment:%Y-%m-%d %H:%M:%S.%f}{ticks % 10}"


def _render(kind: int, raw: bytes) -> str:
    """Text of a typed value."""
    fmt = VALUE_TYPES[kind][1]
    if fmt:
        return str(struct.unpack(fmt, raw)[0])
    if kind == 0x01:
        return raw.decode("utf-16-le").rstrip("\0")
    if kind == 0x02:
        return raw.decode("latin-1").rstrip("\0")
    if kind == 0x0D:
        return "true" if any(raw) else "false"
    if kind == 0x0F:
        return f"{{{uuid.UUID(bytes_le=raw)}}}"
    if kind in (0x10, 0x14, 0x15):
        return f"0x{int.from_bytes(raw, 'little'):0{len(raw) * 2}x}"
    if kind == 0x11:
        return _filetime(int.from_bytes(raw, "little"))
    if kind == 0x12:
        y, mo, _, d, h, mi, s, ms = struct.unpack("<8H", raw)
        return f"{y:04}-{mo:02}-{d:02} {h:02}:{mi:02}:{s:02}.{ms:03}"
    if kind == 0x13:
        parts = struct.unpack_from(f"<{raw[1]}I", raw, 8)
        return "-".join(["S", str(raw[0]), str(int.from_bytes(raw[2:8], "big")), *map(str, parts)])
    return raw.hex().upper()


def _array_items(kind: int, raw: bytes) -> list[bytes]:
    """The values of an array of ``kind``: texts end with a zero, the others have one size or say their own."""
    if kind == 0x01:
        return [t.encode("utf-16-le") for t in raw.decode("utf-16-le").removesuffix("\0").split("\0")]
    if kind == 0x02:
        return raw.removesuffix(b"\0").split(b"\0")
    if kind == 0x13:
        out, at = [], 0
        while at + 8 <= len(raw):
            out.append(raw[at : at + 8 + 4 * raw[at + 1]])
            at += len(out[-1])
        return out
    size = struct.calcsize(VALUE_TYPES[kind][1]) if VALUE_TYPES[kind][1] else ITEM_SIZES.get(kind, len(raw) or 1)
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def _typed(kind: int, raw: bytes) -> tuple[str, str]:
    """(text, type name) of a value; one that does not fit its type is given as its bytes."""
    if kind == 0x01:  # most values are texts
        try:
            return raw.decode("utf-16-le").rstrip("\0"), TEXT_TYPE
        except UnicodeDecodeError:
            return raw.hex().upper(), TEXT_TYPE
    if kind & 0x80:
        base = kind & 0x7F
        name = VALUE_TYPES.get(base, (f"Type{base:#04x}", None))[0].removesuffix("TypeNode") + "ArrayTypeNode"
        try:
            return ",".join(_render(base, item) for item in _array_items(base, raw)), name
        except Exception:
            return raw.hex().upper(), name
    name = VALUE_TYPES.get(kind, (f"Type{kind:#04x}", None))[0]
    try:
        return _render(kind, raw), name
    except Exception:
        return raw.hex().upper(), name


class _Xml:
    """Reader of one chunk's binary XML. Names and the elements of templates are read once a chunk, as records repeat them."""

    def __init__(self, chunk: bytes):
        self.chunk, self.names, self.elements, self.keys = chunk, {}, {}, {}

    def _key(self, section: str, tag: str, part: str) -> str:
        known = self.keys.get((section, tag, part))
        if known is None:
            known = self.keys[section, tag, part] = _name(section, tag, part)
        return known

    def _text_name(self, at: int) -> tuple[str, int]:
        """Name referred to at ``at``, and where reading goes on: names may be stored inline."""
        (offset,) = struct.unpack_from("<I", self.chunk, at)
        known = self.names.get(offset)
        if known is None:
            (count,) = struct.unpack_from("<H", self.chunk, offset + 6)
            known = self.names[offset] = (self.chunk[offset + 8 : offset + 8 + 2 * count].decode("utf-16-le"), 10 + 2 * count)
        return known[0], at + 4 + (known[1] if offset == at + 4 else 0)

    def fields(self, at: int) -> dict[str, tuple[str, str]]:
        found: dict[str, tuple[str, str]] = {}
        self._fragment(at, [], "Event", found)
        return found

    def _fragment(self, at: int, subs: list, section: str, found: dict, template: bool = False) -> int:
        """Read nodes until the end mark; returns the position behind it."""
        while True:
            token = self.chunk[at] & 0x0F if self.chunk[at] != 0x0F else 0x0F
            if token == 0x00:
                return at + 1
            if token == 0x0F:
                at += 4
            elif token == 0x0C:
                return self._template(at, section, found)
            elif token == 0x01:
                element, begin = self.elements.get(at), at
                if element is None:
                    element = self._element(at)
                    if template:
                        self.elements[begin] = element
                self._put(element, subs, section, found)
                at = element[3]
            else:
                raise ValueError(f"unexpected token {token:#x} at {at}")

    def _template(self, at: int, section: str, found: dict) -> int:
        (definition,) = struct.unpack_from("<I", self.chunk, at + 6)
        at += 10
        if definition == at:
            at += 24 + struct.unpack_from("<I", self.chunk, at + 20)[0]
        (count,) = struct.unpack_from("<I", self.chunk, at)
        at, subs, sizes = at + 4, [], []
        for i in range(count):
            sizes.append(struct.unpack_from("<HB", self.chunk, at + 4 * i))
        at += 4 * count
        for size, kind in sizes:
            subs.append((kind, at, self.chunk[at : at + size]))
            at += size
        self._fragment(definition + 24, subs, section, found, template=True)
        return at

    def _content(self, at: int) -> tuple[list, int]:
        """Parts up to the next structural token: (value, type, None), or (None, is_optional, number) of a substitution."""
        parts = []
        while True:
            token = self.chunk[at] & 0x3F
            if token == 0x05:
                size = 2 * struct.unpack_from("<H", self.chunk, at + 2)[0]
                parts.append((*_typed(self.chunk[at + 1], self.chunk[at + 4 : at + 4 + size]), None))
                at += 4 + size
            elif token in (0x0D, 0x0E):
                parts.append((None, token == 0x0E, struct.unpack_from("<H", self.chunk, at + 1)[0]))
                at += 4
            elif token == 0x08:
                parts.append((chr(struct.unpack_from("<H", self.chunk, at + 1)[0]), TEXT_TYPE, None))
                at += 3
            elif token == 0x09:
                entity, at = self._text_name(at + 1)
                known = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
                parts.append((known.get(entity, f"&{entity};"), TEXT_TYPE, None))
            else:
                return parts, at

    @staticmethod
    def _value(part: tuple, subs: list) -> tuple | None:
        """(value, type) of a part, a substitution in place; a nested position has no type, an absent optional one is None."""
        value, kind, number = part
        if number is None:
            return value, kind
        optional, (kind, where, raw) = kind, subs[number]
        if kind == 0x21:
            return where, None
        if kind:
            return _typed(kind, raw)
        return None if optional else ("", VALUE_TYPES[kind][0])

    def _element(self, at: int) -> tuple[str, list, list, int]:
        """(tag, attributes, children, position behind it); a child is an element or a part of the text."""
        has_attributes = self.chunk[at] & 0x40
        tag, at = self._text_name(at + 7)
        attributes, children = [], []
        if has_attributes:
            at += 4
            while self.chunk[at] & 0x3F == 0x06:
                attribute, at = self._text_name(at + 1)
                parts, at = self._content(at)
                attributes.append((attribute, parts))
        if self.chunk[at] == 0x03:
            return tag, attributes, children, at + 1
        at += 1
        while self.chunk[at] != 0x04:
            if self.chunk[at] & 0x3F == 0x01:
                children.append(self._element(at))
                at = children[-1][3]
                continue
            before = at
            parts, at = self._content(at)
            if at == before:
                raise ValueError(f"unexpected token {self.chunk[at]:#x} at {at}")
            children += parts
        return tag, attributes, children, at + 1

    def _put(self, element: tuple, subs: list, section: str, found: dict) -> None:
        """Add the fields of an element to ``found``."""
        tag, attributes, children, _ = element
        section = tag if tag in SECTIONS else section
        key = ""
        for attribute, parts in attributes:
            known = [(self._value(p, subs), p[2] is None) for p in parts]
            known = [(*v, constant) for v, constant in known if v and v[1] is not None]  # a nested value has no place in an attribute
            if known and not known[0][2]:
                found[self._key(section, tag, attribute)] = (_strip_line_end(known[0][0]), known[0][1])
            elif attribute == "Name":
                key = "".join(value for value, _, _ in known)
        texts = []
        for child in children:
            if len(child) == 4:
                self._put(child, subs, section, found)
                continue
            value = self._value(child, subs)
            if value and value[1] is None:
                self._fragment(value[0], [], section, found)
            elif value:
                texts.append(value)
        if texts:
            text = _strip_line_end(texts[0][0] if len(texts) == 1 else "".join(value for value, _ in texts))
            found[self._key(section, tag, key)] = (text, texts[0][1])


def _next_record(chunk: bytes, at: int, end: int) -> int:
    """Where the next record begins at or behind ``at``, at an 8-byte border; ``end`` if none does."""
    mark = struct.pack("<I", _RECORD_SIGNATURE)
    while at < end:
        at = chunk.find(mark, at, end)
        if at < 0:
            return end
        if at % 8 == 0 and at + 28 <= end:
            size = struct.unpack_from("<I", chunk, at + 4)[0]
            # A record repeats its size at its end.
            if 28 <= size <= end - at and chunk[at + size - 4 : at + size] == chunk[at + 4 : at + 8]:
                return at
        at += 1
    return end


def _records(chunk: bytes) -> Iterator[tuple]:
    """(record_id, written_ns, fields, error) of each record; a bad one or a gap is one reject and the rest goes on."""
    if chunk[:8] != bytes.fromhex(_CHUNK_SIGNATURE):
        if any(chunk):
            yield None, None, None, "damaged chunk header"
        end = len(chunk)
        at = _next_record(chunk, min(_FIRST_RECORD, end), end)
    elif len(chunk) < _FIRST_RECORD:
        yield None, None, None, "truncated chunk"
        return
    else:
        (used,) = struct.unpack_from("<I", chunk, 48)
        end, at = min(used, len(chunk)), _FIRST_RECORD
    reader = _Xml(chunk)
    while at + 28 <= end:
        signature, size, number, ticks = struct.unpack_from("<IIQQ", chunk, at)
        if signature != _RECORD_SIGNATURE or size < 28:
            if not any(chunk[at:end]):  # nothing was written here
                break
            yield None, None, None, "damaged record header"
            at = _next_record(chunk, at + 8, end)
            continue
        if at + size > end:
            yield number if number < 1 << 63 else None, None, None, "truncated record"
            at = _next_record(chunk, at + 8, end)
            continue
        try:
            fields, error = reader.fields(at + 24), None
        except Exception as problem:  # damaged records take many forms
            fields, error = None, f"{type(problem).__name__}: {problem}"
        written = (ticks - 116444736000000000) * 100
        in_range = -(1 << 63) <= written < 1 << 63
        yield number if number < 1 << 63 else None, written if in_range else None, fields, error
        at += size
    if len(chunk) < _CHUNK:
        yield None, None, None, "truncated chunk"


_LOG_SCHEMA = f"source_file string, member string, chunk_no int, record_id long, written_ns long, fields {FIELDS}, error string"
_LOG_TYPES = [
    pa.string(),
    pa.string(),
    pa.int32(),
    pa.int64(),
    pa.int64(),
    pa.map_(pa.string(), pa.struct([("value", pa.string()), ("type", pa.string())])),
    pa.string(),
]


#: Capture tags that a log's records keep.
TAGS = ("reference", "sensor")


def log_chunks(logs: DataFrame) -> DataFrame:
    """One row per chunk of each log file (needs source_file, member, content), a last partial one included.

    Chunks of zeros are unused and go; what else lacks the signature stays, as its rejects must be told.
    """
    starts = F.sequence(F.lit(_FILE_HEADER), F.length("content") - 1, F.lit(_CHUNK))
    starts = F.when(F.length("content") > _FILE_HEADER, starts)
    tags = [c for c in TAGS if c in logs.columns]
    chunks = logs.select("source_file", "member", *tags, "content", F.posexplode(starts).alias("chunk_no", "start"))
    body: Column = F.substring("content", F.col("start") + 1, F.lit(_CHUNK))
    chunks = chunks.select("source_file", "member", *tags, "chunk_no", body.alias("chunk"))
    return chunks.filter(F.hex("chunk").rlike("[^0]"))


def read_evtx(logs: DataFrame, rebalance: bool = True, tasks: int | None = None) -> DataFrame:
    """One row per record with its ``fields``, or ``error`` where it does not decode.

    ``rebalance`` spreads chunks evenly first, so that one large log is not one task, by bytes or, with ``tasks``, over
    that many tasks: chunks compress well, so that few bytes may be many records. ``reference`` and ``sensor`` of the
    logs, where they have them, are kept.
    """
    tags = [c for c in TAGS if c in logs.columns]
    names = ["source_file", "member", "chunk_no", "record_id", "written_ns", "fields", "error", *tags]

    def run(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                found = [
                    (row["source_file"], row["member"], row["chunk_no"], number, written, _entries(fields), error, *(row[c] for c in tags))
                    for number, written, fields, error in _records(row["chunk"])
                ]
                if found:
                    columns = [pa.array(c, t) for c, t in zip(zip(*found), [*_LOG_TYPES, *[pa.string()] * len(tags)])]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    def _entries(fields):
        return None if fields is None else [(k, {"value": v, "type": t}) for k, (v, t) in fields.items()]

    chunks = log_chunks(logs)
    if rebalance:
        chunks = chunks.repartition(tasks, "source_file", "member", "chunk_no") if tasks else chunks.hint("rebalance")
    return chunks.mapInArrow(run, _LOG_SCHEMA + "".join(f", {c} string" for c in tags))
