"""Cells of packets, flows and events routed to many tables from one stream, each batch once.

A batch has a label. Its rows go below ``data`` in directories by table, day and label, replacing what an earlier try
of the same label left there; afterwards ``log`` gets one row per table with the label and its number of rows. Readers
take only what the log names. So a batch that is replayed, after a lost driver or a restart from the checkpoint, writes
nothing twice, and one that fails half-way is not seen.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_batch(routed: DataFrame, folder: str, label: str, persist: bool = True) -> None:
    """Store ``routed`` cells, which have a ``table`` and ``cell_ts``, as the batch ``label``.

    Rows without a table are an error. The rebalance splits a table that holds most of the rows. An empty batch writes
    nothing. The rows are read for the data and for the log, so they are kept in between; without ``persist`` they are
    derived again, which is cheaper for cells of stored records, many to a record.
    """
    kept = routed.persist(StorageLevel.MEMORY_AND_DISK) if persist else routed
    try:
        told = F.coalesce("table", F.raise_error(F.lit("a cell has no table")).cast("string"))
        dated = kept.select(told.alias("table"), F.to_date(F.timestamp_millis("cell_ts")).alias("date"), F.lit(label).alias("batch"), *(c for c in kept.columns if c != "table"))
        replace_parts(dated.hint("rebalance", "table", "date"), f"{folder}/data", ["table", "date", "batch"])
        replace_parts(kept.groupBy("table").agg(F.count("*").alias("rows")).withColumn("batch", F.lit(label)), f"{folder}/log", ["table", "batch"])
    finally:
        if persist:
            kept.unpersist()


def replace_parts(df: DataFrame, path: str, parts: list[str]) -> None:
    """Write ``df`` partitioned by ``parts``, in place of what lies in the partitions that it has."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(path)


def write_routed(routed: DataFrame, folder: str, checkpoint: str, name: str, **trigger):
    """Start a query that writes each micro-batch of ``routed`` once, labelled by ``name`` and its number.

    Several streams may write to one folder under different names.
    """

    def put(batch: DataFrame, number: int) -> None:
        write_batch(batch, folder, f"{name}-{number:012d}")

    writer = routed.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger or {"availableNow": True}).start()


def read_routed(spark: SparkSession, folder: str, table: str | None = None) -> DataFrame:
    """The cells of all batches in the log, of one table or of all; with ``table``, ``date`` and ``batch``."""
    data, log = (_stored(spark, f"{folder}/{part}", kinds) for part, kinds in (("data", "table string, date date, batch string"), ("log", "table string, batch string")))
    if table is not None:
        data, log = (df.filter(F.col("table") == table) for df in (data, log))
    return data.join(log.select("table", "batch"), ["table", "batch"], "left_semi")


def _stored(spark: SparkSession, path: str, parts: str) -> DataFrame:
    """A folder whose partition values keep their types, whatever they look like."""
    found = spark.read.parquet(path)
    return spark.read.schema(", ".join([parts, *(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name not in ("table", "date", "batch"))])).parquet(path)


def written(spark: SparkSession, folder: str) -> DataFrame:
    """(table, batches, rows) of the log."""
    log = _stored(spark, f"{folder}/log", "table string, batch string")
    return log.groupBy("table").agg(F.count("*").alias("batches"), F.sum("rows").alias("rows"))

