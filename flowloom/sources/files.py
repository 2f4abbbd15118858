"""Opaque capture files: type by signature, unpacking of containers, inventory.

Files come from ``spark.read.format('binaryFile')``, one row per file with its content.
"""

from __future__ import annotations

import bz2
import io
import re
import tarfile
import zipfile
import zlib
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (file type, offset, signature in hex), tried in this order.
SIGNATURES = (
    ("evtx", 0, "456c6646696c6500"),
    ("pcap", 0, "d4c3b2a1"),
    ("pcap", 0, "a1b2c3d4"),
    ("pcap", 0, "4d3cb2a1"),
    ("pcap", 0, "a1b23c4d"),
    ("zip", 0, "504b0304"),
    ("zip", 0, "04034b50"),
    ("gzip", 0, "1f8b08"),
    ("bzip2", 0, "425a68"),
    ("tar", 257, "7573746172"),
)
UNSUPPORTED = "unsupported"

_BATCH_BYTES = 4 << 20

#: Larger files are digested by range: Spark's text reader cuts a file at about this size too.
WHOLE_BYTES = 128 << 20
#: What the text reader unpacks by name, and the mark that it drops at a file's begin.
_UNPACKED, _MARK = r"\.(gz|bz2|deflate|lz4|snappy|zst)$", b"\xef\xbb\xbf"
#: Covers every signature.
_HEAD_BYTES = 512
_BLOCK_SCHEMA = "file string, length long, start long, number long, content binary"
_BLOCK_NAMES = ["file", "length", "start", "number", "content"]
_BLOCK_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_DIGEST_TYPES = pa.schema([("file", pa.string()), ("length", pa.int64()), ("head", pa.binary()), ("digest", pa.string())])

MEMBER_SCHEMA = "path string, length long, member string, depth int, chain array<string>, file_type string, content binary, error string"


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Batch read of a directory; the glob and length filters act before any file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return files.load(path).filter("length > 0").select("path", "length", "content")


def classify_magic(content: Column | str = "content", signatures=SIGNATURES) -> Column:
    """File type by the first matching signature, ``unsupported`` if none matches."""
    c = F.col(content) if isinstance(content, str) else content
    kind = F.lit(None).cast("string")
    for name, offset, signature in reversed(signatures):
        there = F.substring(c, offset + 1, len(signature) // 2) == F.unhex(F.lit(signature))
        kind = F.when(there, F.lit(name)).otherwise(kind)
    return F.coalesce(kind, F.lit(UNSUPPORTED))


def fits_row(spark: SparkSession) -> Column:
    """Whether a file is digested as one row with its content; others are not opened, as the file index decides it."""
    limit = min(WHOLE_BYTES, int(spark.conf.get("spark.sql.sources.binaryFile.maxLength")))
    return (F.col("_metadata.file_size") <= limit) | F.col("_metadata.file_name").rlike(_UNPACKED)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each split joined again, numbered in the order of the file."""
    number = 0
    for batch in batches:
        *keys, lines = (column.to_pylist() for column in batch.columns)
        for (file, length, start), run in groupby(zip(*keys, lines), lambda row: row[:3]):
            rows = [[file], [length], [start], [number], [b"\n".join(row[3] for row in run)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _BLOCK_TYPES)], names=_BLOCK_NAMES)
            number += 1


def _file_digest(file: str, length: int, blocks: Iterator[bytes]) -> tuple:
    """(file, length, head, digest) of a file's blocks in order; a line end lies between two.

    Its length tells whether it ends with a line end and whether it begins with the mark that the reader dropped.
    """
    plain, marked, head, size = sha256(), sha256(_MARK), b"", -1
    for block in blocks:
        for piece in (b"\n", block) if size >= 0 else (block,):
            plain.update(piece)
            marked.update(piece)
            head = head if len(head) >= _HEAD_BYTES else head + piece[:_HEAD_BYTES]
        size += 1 + len(block)
    missing = length - size
    if missing not in (0, 1, len(_MARK), len(_MARK) + 1):
        raise ValueError(f"{file} changed while it was read")
    digest, begin = (marked, _MARK) if missing >= len(_MARK) else (plain, b"")
    if missing % len(_MARK):
        digest.update(b"\n")
        head += b"\n"
    return file, length, (begin + head)[:_HEAD_BYTES], digest.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each file of a partition of blocks in order."""
    blocks = (row for batch in batches for row in batch.to_pylist())
    for (file, length), rows in groupby(blocks, lambda row: (row["file"], row["length"])):
        row = _file_digest(file, length, (r["content"] for r in rows))
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "length", "head", "digest"), row))], schema=_DIGEST_TYPES)


def range_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Type and SHA-256 of files of any size, ``file`` being their URI as in ``_metadata.file_path``.

    Tasks read ranges of a file through Spark's text reader, as raw bytes between line ends, so that any store that
    Spark reads will do and no row holds a file. SHA-256 is one state that takes the bytes in order: the ranges of a file
    then pass through one task, a block at a time. The longest run without a line end must fit a row.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    lines = reader.text([re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths])
    place = ["_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start"]
    blocks = lines.select(*place, F.col("value").cast("binary")).mapInArrow(_blocks, _BLOCK_SCHEMA)
    ordered = blocks.repartition("file").sortWithinPartitions("file", "start", "number")
    found = ordered.mapInArrow(_digests, "file string, length long, head binary, digest string")
    return found.select("file", "length", classify_magic("head").alias("file_type"), "digest")


def _kind(head: bytes) -> str:
    for name, offset, signature in SIGNATURES:
        if head[offset:].startswith(bytes.fromhex(signature)):
            return name
    return UNSUPPORTED


def _streams(kind: str, content: bytes, budget: int | None) -> bytes:
    """All gzip members or bzip2 streams of a file, one after the other; zero padding behind them is ignored."""
    parts, size, rest = [], 0, content
    while rest:
        unpack = zlib.decompressobj(wbits=31) if kind == "gzip" else bz2.BZ2Decompressor()
        most = 0 if budget is None and kind == "gzip" else -1 if budget is None else budget - size + 1
        out = unpack.decompress(rest, most)
        parts.append(out)
        size += len(out)
        if budget is not None and size > budget:
            raise ValueError("unpacks to too many bytes")
        if not unpack.eof:
            raise ValueError(f"truncated {kind} stream")
        rest = unpack.unused_data.lstrip(b"\0")
    return b"".join(parts)


def _members(kind: str, content: bytes, budget: int | None) -> Iterator[tuple[str, bytes]]:
    """Direct members of a container, one at a time; at most ``budget`` bytes in all, if it is set."""
    left = budget

    def take(size: int) -> None:
        nonlocal left
        if left is not None:
            left -= size
            if left < 0:
                raise ValueError("unpacks to too many bytes")

    if kind in ("gzip", "bzip2"):
        yield "", _streams(kind, content, budget)
    elif kind == "tar":
        with tarfile.open(fileobj=io.BytesIO(content), mode="r:") as archive:
            for entry in archive:
                if entry.isfile():
                    take(entry.size)
                    yield entry.name, archive.extractfile(entry).read()
    else:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for entry in archive.infolist():
                if not entry.is_dir():
                    take(entry.file_size)
                    yield entry.filename, archive.read(entry)


def _unpack(content: bytes, max_depth: int | None, max_bytes: int | None, at: tuple = ("", 0, ())) -> Iterator[tuple]:
    """(member, depth, chain, file_type, content, error) of every leaf, each before the next member is unpacked."""
    member, depth, chain = at
    kind = _kind(content[:512])
    if kind not in ("gzip", "bzip2", "tar", "zip"):
        yield member, depth, list(chain), kind, content, None
    elif max_depth is not None and depth >= max_depth:
        yield member, depth, list(chain), kind, None, "nested too deep"
    else:
        found = _members(kind, content, max_bytes)
        while True:
            try:
                name, inner = next(found)
            except StopIteration:
                return
            except Exception as problem:  # damaged containers take many forms
                yield member, depth, list(chain), kind, None, f"{type(problem).__name__}: {problem}"
                return
            yield from _unpack(inner, max_depth, max_bytes, ("/".join(x for x in (member, name) if x), depth + 1, (*chain, kind)))


def expand_containers(files: DataFrame, max_depth: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """One row per leaf member at any nesting depth; a damaged one carries ``error``.

    There are no limits unless the caller sets them, against decompression bombs: nesting levels, and bytes unpacked
    per container. What exceeds them is a reject with its path.
    """
    names = [part.split(" ")[0] for part in MEMBER_SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for path, length, content in zip(*(batch.column(i) for i in range(3))):
                for leaf in _unpack(content.as_py(), max_depth, max_bytes):
                    rows.append((path.as_py(), length.as_py(), *leaf))
                    size += len(leaf[4] or b"")
                    del leaf  # the list holds it until it is sent
                    if size > _BATCH_BYTES:
                        yield _to_batch(rows)
                        rows, size = [], 0
            if rows:
                yield _to_batch(rows)

    def _to_batch(rows):
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return files.select("path", "length", "content").mapInArrow(run, MEMBER_SCHEMA)


def file_inventory(files: DataFrame, wanted: list[str]) -> DataFrame:
    """The files that are, or contain at any depth, one of the wanted types."""
    leaves = expand_containers(files)
    found = leaves.filter(F.col("file_type").isin(wanted) & F.col("error").isNull()).select("path").distinct()
    return files.join(found, "path", "left_semi")
