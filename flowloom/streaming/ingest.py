"""Watched directories as streams of capture files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowloom.operators.quality import tag_source
from flowloom.sources.event_logs import TAGS, read_evtx
from flowloom.sources.files import classify_magic, expand_containers, fits_row, range_digests
from flowloom.sources.pcap import decode_packets, read_pcap
from flowloom.streaming.routing import replace_parts

# Poll interval and files taken per poll.
POLL = {"processingTime": "60 seconds"}
MAX_FILES = 1000
_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
_DIGESTS = "path string, length long, file_type string, digest string, batch string"


def parse_sources(config: str) -> list[tuple[str, str]]:
    """``path|reference`` entries, separated by commas."""
    entries = [entry.strip().split("|") for entry in config.split(",") if entry.strip()]
    for entry in entries:
        if len(entry) != 2 or not all(entry):
            raise ValueError(f"expected path|reference, got {'|'.join(entry)!r}")
    return [(path, reference) for path, reference in entries]


def stream_directory(spark: SparkSession, path: str, glob: str = "*", max_files: int = MAX_FILES) -> DataFrame:
    """New files of a directory, each taken once; the rate is bounded in files per poll."""
    reader = spark.readStream.format("binaryFile").schema(_SCHEMA)
    reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.option("maxFilesPerTrigger", max_files).load(path).filter("length > 0")


def write_digests(files: DataFrame, folder: str, checkpoint: str, name: str, **trigger) -> StreamingQuery:
    """Start a query that stores type and SHA-256 of the files of ``stream_directory``, kept per micro-batch.

    Files that fit a row are digested as they come in, larger ones by range. A replayed batch replaces its earlier try.
    """
    spark = files.sparkSession
    spark.createDataFrame([], _DIGESTS).write.mode("append").partitionBy("batch").parquet(folder)
    known, none = ["path", F.col("_metadata.file_path").alias("file"), "length"], F.lit(None).cast("string")
    whole = files.filter(fits_row(spark)).select(*known, classify_magic().alias("file_type"), F.sha2("content", 256).alias("digest"))
    large = files.filter(~fits_row(spark)).select(*known, none.alias("file_type"), none.alias("digest"))

    def put(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        found, large = batch.filter("digest is not null"), batch.filter("digest is null")
        if paths := [row.path for row in large.select("path").collect()]:  # as many as a poll takes
            digests = range_digests(batch.sparkSession, paths)
            found = found.unionByName(large.select("path", "file").join(digests, "file"))
        label = F.lit(f"{name}-{number:012d}").alias("batch")
        replace_parts(found.select("path", "length", "file_type", "digest", label), folder, ["batch"])
        batch.unpersist()

    writer = whole.unionByName(large).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger or {"availableNow": True}).start()


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, file_type, digest) of all files that came in."""
    return spark.read.schema(_DIGESTS).parquet(folder).drop("batch")


def stream_event_logs(spark: SparkSession, config: str, pattern: str, glob: str = "*", max_files: int = MAX_FILES) -> DataFrame:
    """Decoded records and rejects of all event logs arriving in the configured directories, packed or not.

    The rows are the input of ``events.typed_events``. Each damaged container is one row with its ``error``.
    """

    def one(path: str, reference: str) -> DataFrame:
        leaves = tag_source(expand_containers(stream_directory(spark, path, glob, max_files)), reference, pattern)
        records = read_evtx(leaves.filter((F.col("file_type") == "evtx") & F.col("error").isNull()), rebalance=False)
        broken = leaves.filter(F.col("error").isNotNull()).select("source_file", "member", "error", *TAGS)
        return records.unionByName(broken, allowMissingColumns=True)

    return reduce(DataFrame.unionByName, [one(*source) for source in parse_sources(config)])


def stream_captures(
    spark: SparkSession, config: str, pattern: str, glob: str = "*", max_files: int = MAX_FILES
) -> DataFrame:
    """Packets and rejects of all captures arriving in the configured directories."""

    def one(path: str, reference: str) -> DataFrame:
        leaves = expand_containers(stream_directory(spark, path, glob, max_files))
        tagged = tag_source(leaves, reference, pattern)
        broken = tagged.filter(F.col("error").isNotNull()).select("source_file", "member", "error", *TAGS)
        frames = read_pcap(tagged.filter((F.col("file_type") == "pcap") & F.col("error").isNull()))
        return frames.unionByName(broken, allowMissingColumns=True)

    frames = [one(*source) for source in parse_sources(config)]
    return decode_packets(reduce(DataFrame.unionByName, frames))
