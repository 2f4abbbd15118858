"""Registered streaming queries: each drains the given table as a stream into files."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.lineage import shared_folder
from flowloom.operators import metrics as metric_op
from flowloom.operators.cells import PACKET_CELLS, packet_cells, packet_table, write_records
from flowloom.operators.events import typed_fields
from flowloom.plans import inputs
from flowloom.plans.event_queries import ORACLES as EVENT_ORACLES
from flowloom.plans.flow_queries import _ID, _ID_SQL, _KEY_SQL, _PLAIN_SRC, ARRIVAL_SQL, _keyed, _sessions, _tcp_flows
from flowloom.plans.inputs import DUCK_MIXED_PACKETS, DUCK_PACKETS
from flowloom.plans.metric_queries import _SQL_EVENT_POINTS
from flowloom.streaming.counts import read_counts, write_counts
from flowloom.streaming.flows import stream_flows
from flowloom.streaming.ingest import read_digests, stream_directory, write_digests
from flowloom.streaming.metrics import stream_metrics
from flowloom.streaming.routing import read_routed, write_routed, written
from flowloom.streaming.sessions import stream_counters, stream_sessions

QUERIES, ORACLES = {}, {}


def _add(name, query, sql=None):
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def drain(df: DataFrame) -> DataFrame:
    """Run a stream until its input is used up and read back what its file sink got."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    writer = df.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start(f"{folder}/rows").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream, whether it is one file or, like any large table, a folder of part files."""
    stored = inputs.table(spark, sf_dir, "events")
    files, reader = stored.inputFiles(), spark.readStream.schema(stored.schema)
    if len(files) == 1 and files[0].endswith("/events.parquet"):  # streams watch folders only
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(f"{sf_dir}/events.parquet")


def _packet_stream(spark, sf_dir):
    return inputs.packets(spark, sf_dir, _event_stream(spark, sf_dir))


_STATES = ["conn_state", "ts_end_ns", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes", "first_frame"]
# The watermark is the newest packet, in whole milliseconds; sessions still open then stay in state.
_CLOSED = "{last} // 1000000 + 4000 <= (select max(ts_ns) // 1000000 from sess)"
_SQL_CLOSED = f"""with recursive {_tcp_flows(_PLAIN_SRC)}, later as (select *, lead(ts_ns) over (
  partition by least(id_orig_h, id_resp_h), greatest(id_orig_h, id_resp_h), least(id_orig_p, id_resp_p), greatest(id_orig_p, id_resp_p) order by ts_ns) as next_ts from tcp)
 select {_ID_SQL}, {', '.join(_STATES)} from later where next_ts is not null or {_CLOSED.format(last='ts_end_ns')}"""
_add(
    "d9_stream_sessions",
    lambda s, d: drain(stream_sessions(_packet_stream(s, d)).select(*_ID, *_STATES)),
    _SQL_CLOSED,
)
_COUNTER_COLS = ["host_lo", "port_lo", "host_hi", "port_hi", "session_ts", "last_ts", "lo_pkts", "lo_bytes", "hi_pkts", "hi_bytes"]
_add(
    "d9_stream_counters",
    lambda s, d: drain(stream_counters(_packet_stream(s, d)).select(*_COUNTER_COLS)),
    f"""with recursive {_sessions(_PLAIN_SRC)}, counted as (select {_KEY_SQL}, session_ts, max(ts_ns) as last_ts,
      count(*) filter (where id_orig_h = host_lo) as lo_pkts, coalesce(sum(bytes) filter (where id_orig_h = host_lo), 0)::bigint as lo_bytes,
      count(*) filter (where id_orig_h <> host_lo) as hi_pkts, coalesce(sum(bytes) filter (where id_orig_h <> host_lo), 0)::bigint as hi_bytes
      from sess group by all)
     select {', '.join(_COUNTER_COLS)} from counted
     where (last_ts // 1000 + 3999999) // 1000 <= (select max(ts_ns) // 1000000 from sess)""",
)


def _flow_stream(s, d):
    stored = inputs.mixed_packets(s, d)
    return drain(stream_flows(s.readStream.schema(stored.schema).parquet(os.path.dirname(stored.inputFiles()[0]))).select(*_FLOW_COLS))


_FLOW_COLS = [*_ID, "ts_end_ns", "first_frame", "icmp_type", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes"]
_OF_FIRST = ["frame_no", "id_orig_h", "id_resp_h", "id_orig_p", "id_resp_p", "icmp_type"]
_SENT = "id_orig_h = host_lo"
_add(
    "d9_stream_flows",
    _flow_stream,
    f"""with mixed as ({DUCK_MIXED_PACKETS}), untimed as (select * from mixed where protocol in ('udp', 'icmp') or (protocol <> 'tcp' and ip_version = 'ipv4')),
     {_keyed("select * from untimed")},
     cuts as (select *, coalesce(ts_ns - lag(ts_ns) over w >= 5000000000, true) as cut, row_number() over w as place from keyed
      window w as (partition by {_KEY_SQL} order by ts_ns, {ARRIVAL_SQL})),
     starts as (select *, max(case when cut then ts_ns end) over (partition by {_KEY_SQL} order by place) as session_ts from cuts),
     silent as (select {_KEY_SQL}, session_ts, max(ts_ns) as ts_end_ns, {", ".join(f"arg_min_null({c}, place) as f_{c}" for c in _OF_FIRST)},
      count(*) filter (where {_SENT}) as lo_pkts, coalesce(sum(bytes) filter (where {_SENT}), 0)::bigint as lo_bytes,
      count(*) filter (where not {_SENT}) as hi_pkts, coalesce(sum(bytes) filter (where not {_SENT}), 0)::bigint as hi_bytes from starts group by all),
     turned as (select *, case protocol when 'udp' then f_id_orig_p < f_id_resp_p when 'icmp' then f_icmp_type like '%reply' else false end as swap from silent),
     sided as (select *, (f_id_orig_h = host_lo) <> swap as orig_lo from turned)
    select reference, sensor, protocol, case when swap then f_id_resp_h else f_id_orig_h end as id_orig_h, case when swap then f_id_orig_h else f_id_resp_h end as id_resp_h,
     case when swap then f_id_resp_p else f_id_orig_p end as id_orig_p, case when swap then f_id_orig_p else f_id_resp_p end as id_resp_p,
     session_ts as ts_ns, ts_end_ns, f_frame_no as first_frame, f_icmp_type as icmp_type,
     case when orig_lo then lo_pkts else hi_pkts end as orig_pkts, case when orig_lo then hi_pkts else lo_pkts end as resp_pkts,
     case when orig_lo then lo_bytes else hi_bytes end as orig_bytes, case when orig_lo then hi_bytes else lo_bytes end as resp_bytes
    from sided where (ts_end_ns // 1000 + 4999999) // 1000 <= (select max(ts_ns) // 1000000 from untimed)""",
)


def _metric_stream(s, d):
    points = metric_op.event_metrics(inputs.event_points(s, d, _event_stream(s, d)))
    return drain(stream_metrics(points, ["count"]))


_add(
    "e6_stream_metrics",
    _metric_stream,
    f"""select database, retention, measurement, reference, sensor, tag_value, mtype, ts_ns, sum(count) as count from {_SQL_EVENT_POINTS}
     group by all having ts_ns // 1000000 + 60000 + 70000 <= (select max(epoch_us(date_trunc('minute', ts))) // 1000 from events)""",
)


def _stream_counts(s, d):
    """Counts per log of an event stream, kept per micro-batch."""
    rows = typed_fields(inputs.event_fields(s, d, _event_stream(s, d))).withColumn("source_file", F.concat("sensor", F.lit(".evtx")))
    folder = f"{shared_folder(s)}/counts-{uuid.uuid4().hex}"
    write_counts(rows, f"{folder}/counts", f"{folder}/checkpoint", "logs").awaitTermination()
    return read_counts(s, f"{folder}/counts")


_add("a11_stream_counts", _stream_counts, EVENT_ORACLES["a11_ingest_counts"])


def _routed_packets(s, d):
    """Cells of a packet stream in the tables of their references."""
    cells = packet_cells(_packet_stream(s, d).withColumn("reference", F.when(F.col("pkt_id") % 2 == 0, "even").otherwise("odd")), table=packet_table())
    folder = f"{shared_folder(s)}/tables-{uuid.uuid4().hex}"
    write_routed(cells, folder, f"{folder}/checkpoint", "packets").awaitTermination()
    return written(s, folder).join(read_routed(s, folder).groupBy("table").agg(F.countDistinct("row_key").alias("records"), F.count("*").alias("cells")), "table").select("table", "records", "cells", "rows")


_CELLS = len([c for _, _, c, _ in PACKET_CELLS if c in {
    "ts_ns", "nanos", "reference", "sensor", "id_orig_h", "id_orig_p", "id_resp_h", "id_resp_p", "ip_version", "protocol", "bytes", "flags"}])
_add(
    "g3_routed_stream",
    _routed_packets,
    f"""select case when pkt_id % 2 = 0 then 'even' else 'odd' end || '-packets' as "table", count(*) as records,
     {_CELLS} * count(*) as cells, ({_CELLS} * count(*))::bigint as rows from ({DUCK_PACKETS}) as p group by all""",
)


def _directory(s, d):
    """The table files themselves as opaque arrivals of a watched directory."""
    folder = f"{shared_folder(s)}/digests-{uuid.uuid4().hex}"
    write_digests(stream_directory(s, d, glob="*.parquet"), f"{folder}/digests", f"{folder}/checkpoint", "files").awaitTermination()
    name = F.element_at(F.split("path", "/"), -1)
    return read_digests(s, f"{folder}/digests").select(name.alias("file"), "length", "file_type", "digest")


_add("a8_stream_directory", _directory)


def _written(s, d):
    """Packets written by reference and day, read back through their partitions."""
    folder = f"{shared_folder(s)}/packets-{uuid.uuid4().hex}"
    write_records(inputs.mixed_packets(s, d), folder)
    back = s.read.parquet(folder)
    return back.select("pkt_id", "reference", F.date_format("date", "yyyy-MM-dd").alias("date"), "protocol", "bytes")


_add(
    "g5_write_records",
    _written,
    f"""select pkt_id, reference, strftime(make_timestamp(ts_us), '%Y-%m-%d') as date, protocol, bytes from ({inputs.DUCK_MIXED}) as m""",
)
