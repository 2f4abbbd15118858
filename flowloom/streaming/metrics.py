"""Continuous metric roll-up."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowloom.functions.columns import timestamp_of
from flowloom.operators.metrics import POINT, UNITS_NS, metrics_to_messages

# Idle time before a point is flushed, and the pause between flush checks.
PACKET_IDLE, EVENT_IDLE = "30 seconds", "70 seconds"
FLUSH = {"processingTime": "5 seconds"}


def stream_metrics(points: DataFrame, fields: list[str], unit: str = "minutes", idle: str = EVENT_IDLE) -> DataFrame:
    """Merged points, each emitted once the watermark is past its bucket by the idle time.

    Sums are formed partially before the shuffle, so a tag that most records carry is cheap.
    """
    grouping = [c for c in (*POINT, "mtype") if c != "ts_ns"]
    width = f"{UNITS_NS[unit] // 1_000_000} milliseconds"
    merged = (
        points.withColumn("ts", timestamp_of("ts_ns"))
        .withWatermark("ts", idle)
        .groupBy(*grouping, F.window("ts", width))
        .agg(*[F.sum(f).alias(f) for f in fields])
    )
    return merged.select(*grouping, (F.unix_micros("window.start") * 1000).alias("ts_ns"), *fields)


def stream_metrics_idle(points: DataFrame, fields: list[str], idle_ms: int = 70_000) -> DataFrame:
    """Merged points, each emitted when nothing was added to it for ``idle_ms`` of real time.

    A point can come more than once if records arrive after its flush, as adding up points
    of one key allows. Memory per point is a few numbers, whatever the number of records.
    """
    keys = [*POINT, "mtype"]
    sums = ", ".join(f"{f} double" for f in fields)
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.select(*keys).schema)

    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            values = state.get
            state.remove()
            yield pd.DataFrame([[*key, *values]], columns=[*keys, *fields])
            return
        total = list(state.get) if state.exists else [0.0] * len(fields)
        for pdf in batches:
            total = [t + float(pdf[f].sum()) for t, f in zip(total, fields)]
        state.update(tuple(total))
        state.setTimeoutDuration(idle_ms)

    return (
        points.select(*keys, *fields)
        .groupBy(*keys)
        .applyInPandasWithState(
            run, f"{key_schema}, {sums}", sums, "append", GroupStateTimeout.ProcessingTimeTimeout
        )
    )


def write_messages(points: DataFrame, fields: list[str], servers: str, checkpoint: str, **trigger):
    """Send merged points to the message topic; needs the Kafka connector on the cluster."""
    writer = metrics_to_messages(points, fields).writeStream.format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger or FLUSH).start()
