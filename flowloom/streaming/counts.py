"""Ingest counts of a stream: total, good and bad records per file, kept per micro-batch so that a replay counts once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators.quality import ingest_counts
from flowloom.streaming.routing import replace_parts

_FIELDS = "total bigint, good bigint, bad bigint, batch string"


def count_batch(batch: DataFrame, folder: str, label: str, by: str = "source_file", error: str = "error") -> None:
    """Store the counts of one batch; an earlier try of the same label is replaced."""
    counts = ingest_counts(batch, by, error).select(F.col(by).cast("string").alias("source_file"), "total", "good", "bad", F.lit(label).alias("batch"))
    replace_parts(counts, folder, ["batch"])


def write_counts(records: DataFrame, folder: str, checkpoint: str, name: str, by: str = "source_file", error: str = "error", **trigger):
    """Start a query that counts the records of every micro-batch. Streams of other names may share the folder."""

    def put(batch: DataFrame, number: int) -> None:
        count_batch(batch, folder, f"{name}-{number:012d}", by, error)

    writer = records.select(by, error).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger or {"availableNow": True}).start()


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, total, good, bad) over all batches."""
    stored = spark.read.schema(f"source_file string, {_FIELDS}").parquet(folder)
    return stored.groupBy("source_file").agg(*(F.sum(c).alias(c) for c in ("total", "good", "bad")))
