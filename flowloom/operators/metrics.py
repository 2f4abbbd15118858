"""Time-bucketed metric points from packets and events.

A point is a row (database, retention, measurement, ts_ns, reference, sensor, tag_value,
fields..., mtype); the tag map is rendered only at the sink, because grouping works on plain
columns. All merging is associative, so hot tags are pre-aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.columns import int_div

# Truncation units in nanoseconds.
UNITS_NS = {
    "nanos": 1,
    "micros": 1_000,
    "millis": 1_000_000,
    "seconds": 1_000_000_000,
    "minutes": 60_000_000_000,
    "hours": 3_600_000_000_000,
    "half_days": 43_200_000_000_000,
    "days": 86_400_000_000_000,
}
# Where event points go, and the topic of flushed points.
EVENT_DATABASE, EVENT_RETENTION, EVENT_MEASUREMENT = "IpMetrics", "indefinite", "evtx_event_id"
TOPIC = "metrics"
# Measurements per packet; those that do not apply to a protocol are NULL and left out.
DIMENSIONS = ("ip_version", "protocol", "service", "icmp_type", "icmp_code")
POINT = ["database", "retention", "measurement", "ts_ns", "reference", "sensor", "tag_value"]


def truncate_time(ts_ns: Column | str, unit: str = "seconds") -> Column:
    """Start of the unit the instant falls in, in nanoseconds since the epoch (UTC)."""
    size = UNITS_NS[unit]
    return int_div(ts_ns, size) * F.lit(size).cast("bigint")


def packet_metrics(
    packets: DataFrame, unit: str = "seconds", database: str = EVENT_DATABASE, retention: str = EVENT_RETENTION
) -> DataFrame:
    """One point per packet and applicable dimension."""
    present = [c for c in DIMENSIONS if c in packets.columns]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("measurement"), F.col(c).cast("string").alias("tag_value")) for c in present]
    )
    points = packets.select(
        F.lit(database).alias("database"),
        F.lit(retention).alias("retention"),
        truncate_time("ts_ns", unit).alias("ts_ns"),
        "reference",
        "sensor",
        F.lit(1.0).alias("packets"),
        F.col("bytes").cast("double").alias("bytes"),
        F.lit("PACKET").alias("mtype"),
        "frame_no",
        F.inline(F.filter(pairs, lambda p: p["tag_value"].isNotNull())),
    )
    return points.select(*POINT, "packets", "bytes", "mtype", "frame_no")


def event_metrics(events: DataFrame, unit: str = "minutes") -> DataFrame:
    """One point per event, tagged with its event id."""
    return events.select(
        F.lit(EVENT_DATABASE).alias("database"),
        F.lit(EVENT_RETENTION).alias("retention"),
        F.lit(EVENT_MEASUREMENT).alias("measurement"),
        truncate_time("ts_ns", unit).alias("ts_ns"),
        "reference",
        "sensor",
        F.col("event_id").cast("string").alias("tag_value"),
        F.lit(1.0).alias("count"),
        F.lit("EVTX").alias("mtype"),
    )


def merge_fields(points: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """Merge points of one key: DOUBLE fields add up, STRING fields keep the last written value.

    Other types are refused before anything runs.
    """
    merged = []
    for name in fields:
        kind = points.schema[name].dataType.simpleString()
        if kind == "double":
            merged.append(F.sum(name).alias(name))
        elif kind == "string":
            written = F.when(F.col(name).isNotNull(), F.col(order))
            merged.append(F.max_by(name, written).alias(name))
        else:
            raise TypeError(f"field {name} is {kind}; only double and string fields can be merged")
    return points.groupBy(*keys).agg(*merged)


def rollup_metrics(points: DataFrame, fields: list[str], key_mode: str = "tag_values", order: str = "frame_no") -> DataFrame:
    """Merge points that share a key.

    ``tag_values`` groups by what the tags say. ``tag_names`` groups by measurement and time
    only, so points with other tag values merge and the last written tags remain.
    """
    if key_mode == "tag_values":
        return merge_fields(points, [*POINT, "mtype"], fields, order)
    last = F.max_by(F.struct("database", "retention", "reference", "sensor", "tag_value", "mtype"), order)
    sums = [F.sum(f).alias(f) for f in fields]
    merged = points.groupBy("measurement", "ts_ns").agg(last.alias("last"), *sums)
    return merged.select("measurement", "ts_ns", "last.*", *fields)


def tag_map() -> Column:
    return F.create_map(
        F.lit("reference"), "reference", F.lit("sensor"), "sensor", _tag_name(), F.col("tag_value")
    )


def _tag_name() -> Column:
    return F.when(F.col("measurement") == EVENT_MEASUREMENT, "event_id").otherwise(F.col("measurement"))


def metrics_to_messages(points: DataFrame, fields: list[str]) -> DataFrame:
    """(topic, key, value) rows in the shape the Kafka sink takes."""
    key = F.concat_ws("|", "measurement", F.col("ts_ns").cast("string"), "reference", "sensor", "tag_value")
    body = F.struct(
        "database", "retention", "measurement", "ts_ns", tag_map().alias("tags"), *fields, "mtype"
    )
    return points.select(F.lit(TOPIC).alias("topic"), key.alias("key"), F.to_json(body).alias("value"))
