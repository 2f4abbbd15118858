"""Key-value layout of packets, flows and events, and their routing and storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.columns import epoch_millis, flag_string, nano_of_second, timestamp_of
from flowloom.functions.encode import ENCODERS
from flowloom.operators.packets import packet_row_key, with_optional_columns

# Fixed values: (family, qualifier, column, encoding) of each stored record kind.
PACKET_CELLS = (
    ("PLD", "PACKET", "data", "raw"),
    ("PM", "TS", "ts_ns", "instant"),
    ("PM", "TS_NANOS", "nanos", "int32"),
    ("PM", "REFERENCE", "reference", "text"),
    ("PM", "SENSOR", "sensor", "text"),
    ("PM", "ID_ORIG_H", "id_orig_h", "text"),
    ("PM", "ID_ORIG_P", "id_orig_p", "int32"),
    ("PM", "ID_ICMP_TYPE", "icmp_type", "text"),
    ("PM", "ID_RESP_H", "id_resp_h", "text"),
    ("PM", "ID_RESP_P", "id_resp_p", "int32"),
    ("PM", "ID_ICMP_CODE", "icmp_code", "text"),
    ("PM", "SERVICE_NAME", "service", "text"),
    ("PM", "IP_VERSION", "ip_version", "text"),
    ("PM", "PROTO", "protocol", "text"),
    ("PM", "BYTES", "bytes", "float32"),
    ("PM", "SOURCE_FILE", "source_file", "text"),
    ("PM", "FLAGS", "flags", "text"),
    ("PM", "SEQ_NUM", "seq_num", "int64"),
    ("PM", "ACK_NUM", "ack_num", "int64"),
)
FLOW_CELLS = (
    ("PM", "TS", "ts_ns", "instant"),
    ("PM", "TS_END", "ts_end_ns", "instant"),
    ("PM", "TS_DURATION", "duration_s", "float32"),
    ("PM", "TS_NANOS", "nanos", "int32"),
    ("PM", "REFERENCE", "reference", "text"),
    ("PM", "SENSOR", "sensor", "text"),
    ("PM", "ID_ORIG_H", "id_orig_h", "text"),
    ("PM", "ID_RESP_H", "id_resp_h", "text"),
    ("PM", "ID_ORIG_P", "id_orig_p", "int32"),
    ("PM", "ID_RESP_P", "id_resp_p", "int32"),
    ("PM", "SERVICE", "service", "text"),
    ("PM", "ID_ICMP_TYPE", "icmp_type", "text"),
    ("PM", "ID_ICMP_CODE", "icmp_code", "text"),
    ("PM", "IP_VERSION", "ip_version", "text"),
    ("PM", "PROTO", "protocol", "text"),
    ("PM", "ORIG_BYTES", "orig_bytes", "float32"),
    ("PM", "RESP_BYTES", "resp_bytes", "float32"),
    ("PM", "ORIG_PKTS", "orig_pkts", "float32"),
    ("PM", "RESP_PKTS", "resp_pkts", "float32"),
    ("PM", "CONN_STATE", "conn_state", "text"),
    ("PM", "SOURCE_FILE", "source_file", "text"),
    ("PM", "BYTES_MIN", "bytes_min", "float32"),
    ("PM", "BYTES_MEAN", "bytes_mean", "float32"),
    ("PM", "BYTES_MEDIAN", "bytes_median", "float32"),
    ("PM", "BYTES_MAX", "bytes_max", "float32"),
    ("PM", "BYTES_STD_DEV", "bytes_std_dev", "float32"),
)
EVENT_CELLS = (
    ("ED", "SYSTEM_PROVIDER_NAME", "provider_name", "text"),
    ("ED", "SYSTEM_PROVIDER_GUID", "provider_guid", "text"),
    ("ED", "SYSTEM_EVENTID", "event_id", "int32"),
    ("ED", "SYSTEM_EVENTID_DESCRIPTION", "description", "text"),
    ("ED", "SYSTEM_EVENTID_QUALIFIERS", "qualifiers", "text"),
    ("ED", "SYSTEM_VERSION", "version", "int32"),
    ("ED", "SYSTEM_LEVEL", "level", "int32"),
    ("ED", "SYSTEM_TASK", "task", "int32"),
    ("ED", "SYSTEM_OPCODE", "opcode", "int32"),
    ("ED", "SYSTEM_KEYWORDS", "keywords", "text"),
    ("ED", "SYSTEM_SYSTEMTIME", "ts_ns", "instant"),
    ("ED", "SYSTEM_EVENTRECORDID", "record_id", "int64"),
    ("ED", "SYSTEM_PROCESSID", "process_id", "int32"),
    ("ED", "SYSTEM_THREADID", "thread_id", "int32"),
    ("ED", "SYSTEM_CHANNEL", "channel", "text"),
    ("ED", "SYSTEM_COMPUTER", "computer", "text"),
    ("ED", "SYSTEM_CORRELATION_ACTIVITYID", "activity_id", "text"),
    ("ED", "SYSTEM_CORRELATION_RELATEDACTIVITYID", "related_activity_id", "text"),
    ("ED", "SYSTEM_SECURITY_USERID", "user_id", "text"),
    ("ED", "SYSTEM_SITE_CODE", "computer_site", "text"),
    ("ED", "SYSTEM_FUNCTIONAL_CODE", "computer_code", "text"),
    ("ED", "SYSTEM_FUNCTIONAL_CODE_DESCRIPTION", "computer_code_description", "text"),
    ("ED", "SYSTEM_CUSTOM_ID", "computer_number", "text"),
)
TIME_TYPE = "SystemtimeTypeNode"


def to_cells(
    df: DataFrame, row_key: Column, spec: tuple, ts_ns: str = "ts_ns", more: Column | None = None, table: Column | None = None
) -> DataFrame:
    """(row_key, family, qualifier, value, cell_ts) rows; a NULL value makes no cell.

    ``more`` is an optional array of further (family, qualifier, value) cells. With ``table``
    every cell comes with the table that it goes to. Rows are expanded in place, nothing is shuffled.
    """
    # What the cells of a record share is computed below the generator, once a record and not once a cell.
    shared = {"_row_key": row_key, "_cell_ts": epoch_millis(ts_ns)} | ({} if table is None else {"_table": table})
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier"), ENCODERS[e](c).alias("value"))
            for f, q, c, e in spec
            if c in df.columns
        ]
    )
    if more is not None:
        cells = F.concat(cells, more)
    made = df.select(*(c.alias(n) for n, c in shared.items()), F.filter(cells, lambda c: c["value"].isNotNull()).alias("_cells"))
    return made.select(*shared, F.inline("_cells")).select(
        *([] if table is None else [F.col("_table").alias("table")]),
        F.col("_row_key").alias("row_key"), "family", "qualifier", "value", F.col("_cell_ts").alias("cell_ts"),
    )


def packet_cells(packets: DataFrame, table: Column | None = None) -> DataFrame:
    out = with_optional_columns(packets).withColumn("nanos", nano_of_second("ts_ns"))
    if "syn" in packets.columns:
        out = out.withColumn("flags", F.when(F.col("syn").isNotNull(), flag_string()))
    return to_cells(out, packet_row_key(), PACKET_CELLS, table=table)


def flow_cells(flows: DataFrame, row_key: Column, table: Column | None = None) -> DataFrame:
    return to_cells(flows.withColumn("nanos", nano_of_second("ts_ns")), row_key, FLOW_CELLS, table=table)


def flow_payload_cells(flow_packets: DataFrame, flow_key: str, packet_key: str, payload: str, flow_ts: str) -> DataFrame:
    """One payload cell per packet of a flow, under the flow's key."""
    return flow_packets.select(
        F.col(flow_key).alias("row_key"),
        F.lit("PLD").alias("family"),
        F.col(packet_key).alias("qualifier"),
        F.col(payload).cast("binary").alias("value"),
        epoch_millis(flow_ts).alias("cell_ts"),
    )


def event_cells(events: DataFrame, row_key: Column, table: Column | None = None) -> DataFrame:
    """Named system fields plus one cell per open field; time-typed ones as instants.

    The decoded parts of the computer's name, where the columns of ``events.computer_parts`` are there, are cells too.
    """

    def field(entry: Column) -> Column:
        value = entry["value"]["value"]
        as_time = F.try_to_timestamp(F.concat(F.replace(value, F.lit(" "), F.lit("T")), F.lit("Z")))
        encoded = F.when(
            entry["value"]["type"] == TIME_TYPE, ENCODERS["instant"](F.unix_micros(as_time) * 1000)
        ).otherwise(ENCODERS["text"](value))
        return F.struct(F.lit("ED").alias("family"), entry["key"].alias("qualifier"), encoded.alias("value"))

    timed = events.withColumn("ts_ns", F.unix_micros("ts") * 1000)
    return to_cells(timed, row_key, EVENT_CELLS, more=F.transform(F.map_entries("data"), field), table=table)


def upsert_latest(cells: DataFrame, order: str) -> DataFrame:
    """A later write of the same (key, family, qualifier, time) replaces the earlier one."""
    return cells.groupBy("row_key", "family", "qualifier", "cell_ts").agg(F.max_by("value", order).alias("value"))


def packet_table() -> Column:
    return F.concat(F.col("reference"), F.lit("-packets"))


def event_table() -> Column:
    return F.concat(F.lit("default:"), F.col("reference"), F.lit("-evtx"))


def write_records(df: DataFrame, path: str, ts_ns: str = "ts_ns", mode: str = "append") -> None:
    """Parquet partitioned by reference and day.

    The rebalance lets Spark merge small output partitions and split a reference that holds
    most of the data, so that neither tiny files nor one giant task result.
    """
    dated = df.withColumn("date", F.to_date(timestamp_of(ts_ns)))
    dated.hint("rebalance", "reference", "date").write.mode(mode).partitionBy("reference", "date").parquet(path)


def write_stream(df: DataFrame, path: str, checkpoint: str, ts_ns: str = "ts_ns", **trigger):
    """The same layout from a stream; the file sink's log makes each batch visible once."""
    dated = df.withColumn("date", F.to_date(timestamp_of(ts_ns)))
    writer = dated.writeStream.format("parquet").partitionBy("reference", "date")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start(path)
