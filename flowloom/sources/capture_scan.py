"""Plain captures of any size, read by byte range.

``binaryFile`` holds a file in one row, which ends at 2 GB. Here tasks open captures themselves. A larger one is cut
into ranges of equal size; a task looks for the first record of its range by itself, and walks the record headers to
the first one behind it. The first range is right, and so is each that begins where the one before it ends; only
others are walked again, from the place that is then known. Memory stays at one block.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from flowloom.operators.quality import tag_source
from flowloom.sources.pcap import FRAME_SCHEMA, LINK_TYPES, MAGICS, frame_batches

SPLIT_BYTES = 256 << 20
_BLOCK = 8 << 20
#: Record headers in a row that must look right where a range begins, and the longest record that looks right. They
#: decide how often a guess is wrong, never the result.
_CHAIN, _LONGEST = 16, 1 << 18
_SYNC_BLOCK = 64 << 10
_ROWS = 1024
_SPLIT_SCHEMA = "path string, length long, start long, stop long, first_frame long, byte_order string, unit int, link_type int, error string"
_RANGE_SCHEMA = (
    "path string, length long, part long, high long, start long, stop long, frames long, byte_order string, unit int, link_type int, error string"
)
_SPLIT_TYPES = [pa.string(), *[pa.int64()] * 4, pa.string(), pa.int32(), pa.int32(), pa.string()]
_RANGE_TYPES = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.int32(), pa.int32(), pa.string()]


def _names(schema: str) -> list[str]:
    return [part.split(" ")[0] for part in schema.split(", ")]


def _open(path: str) -> pa.NativeFile:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    system, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1)) if "://" in path else (pafs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def _header(handle: pa.NativeFile, precision: str) -> tuple:
    """(byte order, fraction unit, link type, error) of a capture."""
    head = handle.read_at(24, 0)
    if len(head) < 24 or head[:4] not in MAGICS:
        return None, None, None, "truncated capture header" if head[:4] in MAGICS else "not a capture"
    order, nano = MAGICS[head[:4]]
    sigfigs, _, link = struct.unpack_from(order + "3I", head, 12)
    nano = nano or (precision == "header" and sigfigs == 1)
    error = None if link & 0xFFFF in LINK_TYPES else f"unsupported link type {link & 0xFFFF}"
    return order, 1 if nano else 1000, link & 0xFFFF, error


def _walk(handle: pa.NativeFile, order: str, start: int, stop: int) -> Iterator[tuple]:
    """(position, header, bytes) of the records in a range; a last (position, None, None) if cut short."""
    record, at, block, block_at = struct.Struct(order + "4I"), start, b"", start
    while at < stop:
        if at + 16 > block_at + len(block):
            block, block_at = handle.read_at(_BLOCK, at), at
        if at + 16 > block_at + len(block):
            yield at, None, None
            return
        header = record.unpack_from(block, at - block_at)
        size = header[2]
        if at + 16 + size > block_at + len(block):
            block, block_at = handle.read_at(max(_BLOCK, 16 + size), at), at
        begin = at - block_at + 16
        if begin + size > len(block):
            yield at, None, None
            return
        yield at, header, block[begin : begin + size]
        at += 16 + size


def _hop(handle: pa.NativeFile, order: str, start: int, stop: int) -> tuple[int, int]:
    """Place of the first record at or behind ``stop`` and the records before it; the file's end where it cuts a record."""
    size, length, at, block, block_at, count = struct.Struct(order + "I"), handle.size(), start, b"", start, 0
    while at < stop:
        if at + 16 > length:
            return length, count
        if at + 16 > block_at + len(block):
            block, block_at = handle.read_at(min(_BLOCK, stop - at + 15), at), at
        after = at + 16 + size.unpack_from(block, at - block_at + 8)[0]
        if after > length:
            return length, count
        at, count = after, count + 1
    return at, count


def _synchronise(handle: pa.NativeFile, order: str, low: int, high: int, unit: int) -> int | None:
    """The first place in a range from which ``_CHAIN`` records in a row look right, or all up to the file's end."""
    length, fractions = handle.size(), 1_000_000_000 if unit == 1 else 1_000_000
    record = struct.Struct(order + "4I")

    def holds(at: int) -> bool:
        for _ in range(_CHAIN):
            if at == length:
                return True
            head = handle.read_at(16, at) if at + 16 <= length else b""
            if len(head) < 16:
                return False
            _, frac, incl, orig = record.unpack(head)
            if frac >= fractions or incl > min(orig, _LONGEST):
                return False
            at += 16 + incl
        return True

    for base in range(low, high, _SYNC_BLOCK):
        block = np.frombuffer(handle.read_at(min(_SYNC_BLOCK, high - base) + 15, base), np.uint8)
        n = len(block) - 15
        if n <= 0:
            return None

        def word(at: int) -> np.ndarray:
            parts = [block[at + i : at + i + n].astype(np.uint32) << (8 * (i if order == "<" else 3 - i)) for i in range(4)]
            return parts[0] | parts[1] | parts[2] | parts[3]

        incl = word(8)
        likely = (word(4) < fractions) & (incl > 0) & (incl <= _LONGEST) & (incl <= word(12))
        for at in np.flatnonzero(likely):
            if holds(base + int(at)):
                return base + int(at)
    return None


def _range(path: str, length: int, part: int, low: int, high: int, precision: str) -> Iterator[tuple]:
    """What a range of a capture finds by itself; of a file that is no capture only the first says so."""
    with _open(path) as handle:
        order, unit, link, error = _header(handle, precision)
        if error:
            if part == 0:
                yield path, length, part, high, low, length, 0, order, unit, link, error
            return
        start = low if part == 0 else _synchronise(handle, order, low, high, unit)
        if part == 0 and high == length:  # a file of one range needs no count
            stop, frames = length, 0
        else:
            stop, frames = (None, None) if start is None else _hop(handle, order, start, high)
        yield path, length, part, high, start, stop, frames, order, unit, link, None


def _chained(ranges: Iterator[dict]) -> Iterator[tuple]:
    """Numbered splits of the ranges of captures, in order; a range that does not begin where the last one ended is mended."""
    path, due, number = None, None, 0
    for r in ranges:
        if r["part"] == 0:
            path, due, number = r["path"], r["start"], 0
        start, stop, frames = r["start"], r["stop"], r["frames"]
        if start != due:
            start, stop, frames = due, due, 0
            if due < r["high"]:
                with _open(path) as handle:
                    stop, frames = _hop(handle, r["byte_order"], due, r["high"])
        if start < stop or r["error"]:
            yield path, r["length"], start, stop, number, r["byte_order"], r["unit"], r["link_type"], r["error"]
        due, number = stop, number + frames


def _whole_file(path: str, length: int, precision: str) -> tuple:
    with _open(path) as handle:
        order, unit, link, error = _header(handle, precision)
    return path, length, 24, length, 0, order, unit, link, error


def _split_frames(split: dict) -> Iterator[tuple]:
    """Numbered frame tuples of one range, in the layout of ``pcap.frame_batches``."""
    if split["error"]:
        yield 0, (None, None, None, None, None, None, split["error"])
        return
    unit, number = split["unit"], split["first_frame"]
    with _open(split["path"]) as handle:
        for _, header, data in _walk(handle, split["byte_order"], split["start"], split["stop"]):
            if header is None:
                yield number, (None, None, None, None, None, None, "truncated record")
                return
            sec, frac, incl, orig = header
            name = "nano" if unit == 1 else "micro"
            yield number, (sec * 1_000_000_000 + frac * unit, incl, orig, split["link_type"], name, data, None)
            number += 1


def _mapped(df: DataFrame, made: Callable[[Iterator[dict]], Iterator[tuple]], schema: str, types: list) -> DataFrame:
    """What ``made`` yields for the rows of each partition of ``df``."""

    def run(batches):
        found = made(row for batch in batches for row in batch.to_pylist())
        while rows := list(islice(found, _ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_names(schema))

    return df.mapInArrow(run, schema)


def _guesses(rows: Iterator[dict], precision: str) -> Iterator[tuple]:
    for row in rows:
        yield from _range(**row, precision=precision)


def capture_splits(files: DataFrame, split_bytes: int = SPLIT_BYTES, precision: str = "header", tasks: int | None = None) -> DataFrame:
    """Ranges of at most about ``split_bytes`` for each capture in ``files(path, length)``.

    Each range is looked through by a task that reads its headers and no further. One small row per range then goes to
    a task of its file, which checks them in order, numbers their frames, and reads only what was guessed wrong.
    """
    tasks = tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    zero = F.lit(0).cast("long")
    part = F.explode(F.sequence(zero, F.greatest(zero, F.floor((F.col("length") - 25) / split_bytes))))
    low = F.col("part") * split_bytes + 24
    ranges = files.select("path", "length", part.alias("part")).select("*", low.alias("low"), F.least(low + split_bytes, "length").alias("high"))
    found = _mapped(ranges.repartition(tasks, "path", "part"), partial(_guesses, precision=precision), _RANGE_SCHEMA, _RANGE_TYPES)
    ordered = found.repartition(tasks, "path").sortWithinPartitions("path", "part")
    return _mapped(ordered, _chained, _SPLIT_SCHEMA, _SPLIT_TYPES)


def scan_captures(
    spark: SparkSession,
    path: str,
    reference: str,
    pattern: str,
    glob: str = "*",
    split_bytes: int = SPLIT_BYTES,
    precision: str = "header",
    tasks: int | None = None,
) -> DataFrame:
    """Frames of all plain captures under ``path``, in the layout of ``read_pcap``.

    The listing reads no content. ``tasks`` is the number of reading tasks; by default as
    many as the session has shuffle partitions.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = tag_source(capture_splits(files.filter("length > 0"), split_bytes, precision, tasks), reference, pattern=pattern)
    spread = tagged.repartition(tasks, "path", "start")

    def run(batches):
        for batch in batches:
            for split in batch.to_pylist():
                yield from frame_batches(split["source_file"], "", split["reference"], split["sensor"], _split_frames(split))

    return spread.mapInArrow(run, FRAME_SCHEMA)


class _File(InputPartition):
    def __init__(self, path: str, length: int):
        self.path, self.length = path, length


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[_File]:
        """One partition per file below the path; only names and sizes are looked at."""
        path = self.options["path"]
        system, inner = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        info = system.get_file_info(inner)
        found = [info] if info.is_file else system.get_file_info(pafs.FileSelector(inner, recursive=True))
        prefix = path[: path.index("://") + 3] if "://" in path else ""
        return [_File(prefix + f.path, f.size) for f in found if f.is_file and f.size]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        reference, precision = self.options.get("reference", ""), self.options.get("precision", "header")
        split = dict(zip(_names(_SPLIT_SCHEMA), _whole_file(partition.path, partition.length, precision)))
        source = f"{partition.path}|{partition.length}"
        yield from frame_batches(source, "", reference, self.options.get("sensor", reference), _split_frames(split))


class PcapDataSource(DataSource):
    """``spark.read.format('pcap').option('reference', ...).load(path)``; one task per file."""

    @classmethod
    def name(cls) -> str:
        return "pcap"

    def schema(self) -> str:
        return FRAME_SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))
