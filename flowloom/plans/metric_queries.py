"""Registered metric queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import metrics as op
from flowloom.operators import packets as packet_op
from flowloom.plans import dims
from flowloom.plans.inputs import DUCK_MIXED_PACKETS, event_points, mixed_packets

QUERIES, ORACLES = {}, {}


def _add(name, query, sql):
    QUERIES[name] = query
    ORACLES[name] = sql


_FIELDS = ["packets", "bytes"]
_COLS = [*op.POINT, *_FIELDS, "mtype"]


def _points(s, d):
    named = packet_op.service_name(mixed_packets(s, d), dims.dim(s, dims.PORTS))
    return op.packet_metrics(named)


_SQL_POINTS = rf"""(with p as (select m.*, regexp_replace(lower(service), '\s+', '_', 'g') as service
  from ({DUCK_MIXED_PACKETS}) as m left join {dims.PORTS} on port = case when id_orig_p < id_resp_p then id_orig_p else id_resp_p end),
 u as (select *, 'ip_version' as measurement, ip_version as tag_value from p union all
  select *, 'protocol', protocol from p union all select *, 'service', service from p where service is not null union all
  select *, 'icmp_type', icmp_type from p where icmp_type is not null union all
  select *, 'icmp_code', icmp_code from p where icmp_code is not null)
 select 'IpMetrics' as database, 'indefinite' as retention, measurement, ts_ns // 1000000000 * 1000000000 as ts_ns, reference, sensor,
  tag_value, 1.0::double as packets, bytes::double as bytes, 'PACKET' as mtype, frame_no from u) as points"""

_add(
    "e1_packet_metrics",
    lambda s, d: _points(s, d).select(*_COLS, "frame_no"),
    f"select * from {_SQL_POINTS}",
)
_SQL_EVENT_POINTS = """(select 'IpMetrics' as database, 'indefinite' as retention, 'evtx_event_id' as measurement,
  epoch_us(ts) // 60000000 * 60000000000 as ts_ns, case when user_id % 2 = 0 then 'alpha' else 'beta' end as reference,
  'aa-0' || (1 + user_id % 3)::varchar as sensor, (100 + json_extract_string(props,'$.k')::bigint % 6)::varchar as tag_value,
  1.0::double as count, 'EVTX' as mtype from events) as points"""
_add(
    "e2_event_metrics",
    lambda s, d: op.event_metrics(event_points(s, d)),
    f"select * from {_SQL_EVENT_POINTS}",
)
_UNITS = ["micros", "millis", "seconds", "minutes", "hours", "half_days", "days"]
_add(
    "e3_truncate_time",
    lambda s, d: event_points(s, d).select("row_id", *[op.truncate_time("ts_ns", u).alias(u) for u in _UNITS]),
    """select event_id as row_id, epoch_us(ts) * 1000 as micros, epoch_us(ts) // 1000 * 1000000 as millis,
     epoch_us(date_trunc('second', ts)) * 1000 as seconds, epoch_us(date_trunc('minute', ts)) * 1000 as minutes,
     epoch_us(date_trunc('hour', ts)) * 1000 as hours,
     epoch_us(date_trunc('day', ts) + case when hour(ts) >= 12 then interval 12 hours else interval 0 hours end) * 1000 as half_days,
     epoch_us(date_trunc('day', ts)) * 1000 as days from events""",
)


def _merged(s, d):
    p = event_points(s, d).withColumn("note", F.when(F.col("value") < 50, F.col("event_type")))
    merged = op.merge_fields(p, ["user_id"], ["value", "event_type", "note"], "row_id")
    return merged.select("user_id", F.round("value", 4).alias("value"), "event_type", "note")


_add(
    "e4_merge_fields",
    _merged,
    """select user_id, round(sum(value), 4) as value, arg_max(event_type, event_id) as event_type,
     arg_max(event_type, event_id) filter (where value < 50) as note from events group by user_id""",
)
_add(
    "e5_rollup_metrics",
    lambda s, d: op.rollup_metrics(_points(s, d), _FIELDS).select(*_COLS),
    f"select database, retention, measurement, ts_ns, reference, sensor, tag_value, sum(packets) as packets, sum(bytes) as bytes, mtype from {_SQL_POINTS} group by all",
)


def _by_names(s, d):
    return op.rollup_metrics(_points(s, d), _FIELDS, key_mode="tag_names").select(*_COLS)


_add(
    "e5_rollup_metrics_tag_names",
    _by_names,
    f"""select arg_max(database, frame_no) as database, arg_max(retention, frame_no) as retention, measurement, ts_ns,
     arg_max(reference, frame_no) as reference, arg_max(sensor, frame_no) as sensor, arg_max(tag_value, frame_no) as tag_value,
     sum(packets) as packets, sum(bytes) as bytes, arg_max(mtype, frame_no) as mtype from {_SQL_POINTS} group by measurement, ts_ns""",
)
_add(
    "e5_rollup_event_metrics",
    lambda s, d: op.rollup_metrics(op.event_metrics(event_points(s, d)), ["count"], order="ts_ns"),
    f"select * exclude (count), sum(count) as count from {_SQL_EVENT_POINTS} group by all",
)


def _messages(s, d):
    rolled = op.rollup_metrics(_points(s, d), _FIELDS)
    whole = rolled.withColumns({f: F.col(f).cast("bigint") for f in _FIELDS})
    return op.metrics_to_messages(whole, _FIELDS)


_add(
    "e7_metrics_to_kafka",
    _messages,
    f"""with r as (select database, retention, measurement, ts_ns, reference, sensor, tag_value, sum(packets)::bigint as packets,
      sum(bytes)::bigint as bytes, mtype from {_SQL_POINTS} group by all)
     select 'metrics' as topic, concat_ws('|', measurement, ts_ns::varchar, reference, sensor, tag_value) as key,
      '{{"database":"' || database || '","retention":"' || retention || '","measurement":"' || measurement || '","ts_ns":' || ts_ns::varchar
      || ',"tags":{{"reference":"' || reference || '","sensor":"' || sensor || '","' || measurement || '":"' || tag_value
      || '"}},"packets":' || packets::varchar || ',"bytes":' || bytes::varchar || ',"mtype":"' || mtype || '"}}' as value from r""",
)
