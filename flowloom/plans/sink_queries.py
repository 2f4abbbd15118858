"""Registered layout and domain queries and their oracle SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowloom.functions import encode
from flowloom.functions.columns import stable_uid
from flowloom.functions.lineage import shared_folder, shared_table
from flowloom.operators import cells as op
from flowloom.operators import domains
from flowloom.operators import events as event_op
from flowloom.operators import flows as flow_op
from flowloom.operators import packets as packet_op
from flowloom.plans import dims
from flowloom.plans.event_queries import _RAW, _SQL_IP, _sql_decoded
from flowloom.plans.flow_queries import _ALL_FLOWS, _FLOWS_WITH_STATS, _LISTED, _SQL_FLOW_ROW_KEY
from flowloom.plans.inputs import (
    DUCK_MIXED_PACKETS,
    EVENT_FIELD_NAMES,
    event_fields,
    mixed_packets,
    table,
)
from flowloom.plans.packet_queries import SQL_ROW_KEY
from flowloom.streaming.routing import read_routed, write_batch

QUERIES, ORACLES = {}, {}
_MIXED = f"({DUCK_MIXED_PACKETS}) as p"


def _add(name, query, sql):
    QUERIES[name] = query
    ORACLES[name] = sql


def _hexed(cells):
    return cells.withColumn("value", F.hex("value"))


_SQL_ENCODE = {
    "text": "hex(encode({c}::varchar))",
    "int32": "hex({c}::integer::bit::blob)",
    "int64": "hex({c}::bigint::bit::blob)",
    "float32": "hex({c}::float::bit::blob)",
    "instant": "hex(({c} // 1000000)::bigint::bit::blob) || hex(({c} % 1000000000)::integer::bit::blob)",
}


def _sql_cells(src: str, row_key: str, spec, columns, ts: str = "ts_ns", first: str = "") -> str:
    parts = [
        f"select {first}{row_key} as row_key, '{f}' as family, '{q}' as qualifier, {_SQL_ENCODE[e].format(c=c)} as value, {ts} // 1000000 as cell_ts"
        f" from {src} where {c} is not null"
        for f, q, c, e in spec
        if c in columns
    ]
    return " union all ".join(parts)


_PACKET_COLUMNS = {
    "ts_ns", "nanos", "reference", "sensor", "id_orig_h", "id_orig_p", "icmp_type", "id_resp_h", "id_resp_p", "icmp_code",
    "ip_version", "protocol", "bytes", "source_file", "flags", "seq_num", "ack_num",
}
_SQL_PACKETS = f"""with cell_src as (select *, (ts_ns % 1000000000)::integer as nanos, case when protocol = 'tcp' then ' '
 || (case when ack then 'A' else ' ' end) || (case when event_psh then 'P' else ' ' end) || (case when rst then 'R' else ' ' end)
 || (case when syn then 'S' else ' ' end) || (case when fin then 'F' else ' ' end) end as flags
 from ({DUCK_MIXED_PACKETS.replace("select pkt_id, origin_id,", "select pkt_id, origin_id, psh as event_psh,")}) as m)"""
_add(
    "g1_packet_cells",
    lambda s, d: _hexed(op.packet_cells(mixed_packets(s, d))),
    f"{_SQL_PACKETS} {_sql_cells('cell_src', SQL_ROW_KEY, op.PACKET_CELLS, _PACKET_COLUMNS)}",
)
_FLOW_COLUMNS = {
    "ts_ns", "ts_end_ns", "nanos", "reference", "sensor", "id_orig_h", "id_resp_h", "id_orig_p", "id_resp_p", "icmp_type",
    "icmp_code", "protocol", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts", "conn_state", "duration_s", "ip_version",
    "source_file", "bytes_min", "bytes_mean", "bytes_median", "bytes_max", "bytes_std_dev",
}


def _flow_cells(s, d):
    """Every qualifier of a flow; the derived packets know no service, so that one stays empty."""
    rows = mixed_packets(s, d)
    pieces = flow_op.tcp_pieces(rows)
    flows = flow_op.add_stats(flow_op.summarise(rows, pieces=pieces), flow_op.flow_stats(rows, pieces=pieces))
    return _hexed(op.flow_cells(flows, flow_op.flow_row_key()))


_add(
    "g1_flow_cells",
    _flow_cells,
    f"""{_FLOWS_WITH_STATS}, cell_src as (select *, (ts_ns % 1000000000)::integer as nanos, (ts_end_ns - ts_ns) / 1e9 as duration_s from with_stats)
     {_sql_cells('cell_src', _SQL_FLOW_ROW_KEY, op.FLOW_CELLS, _FLOW_COLUMNS)}""",
)


def _payload_cells(s, d):
    """Payload cells of all flows: every packet, TCP copies once, under its flow's key."""
    rows = mixed_packets(s, d)
    pieces = flow_op.tcp_pieces(rows)
    listed = flow_op.with_flow_key(flow_op.flow_packets(rows, pieces=pieces), flow_op.summarise(rows, pieces=pieces))
    listed = listed.withColumns({"packet_key": packet_op.packet_row_key(), "payload": F.col("bytes").cast("string")})
    return _hexed(op.flow_payload_cells(listed, "flow_row_key", "packet_key", "payload", "session_ts"))


_add(
    "g1_payload_cells",
    _payload_cells,
    f"""{_ALL_FLOWS}, {_LISTED},
     keyed_flows as (select *, {_SQL_FLOW_ROW_KEY} as flow_row_key, case when id_orig_h < id_resp_h then id_orig_p else id_resp_p end as p_lo,
      case when id_orig_h < id_resp_h then id_resp_p else id_orig_p end as p_hi from flows)
     select flow_row_key as row_key, 'PLD' as family, p.row_key as qualifier, hex(encode(p.bytes::varchar)) as value, session_ts // 1000000 as cell_ts
     from flow_packets p join keyed_flows f on f.reference = p.reference and f.sensor = p.sensor and f.protocol = p.protocol and f.ts_ns = p.session_ts
      and host_lo = least(f.id_orig_h, f.id_resp_h) and host_hi = greatest(f.id_orig_h, f.id_resp_h)
      and port_lo is not distinct from p_lo and port_hi is not distinct from p_hi""",
)


def _stored_events(s, d):
    rows = event_op.describe_events(event_op.residual_fields(event_op.typed_fields(event_fields(s, d))), dims.dim(s, dims.EVENTS))
    rows = event_op.drop_empty(rows.withColumn("data", event_op.normalise_ips("data")))
    rows = rows.filter("error is null and ts is not null")
    return event_op.computer_parts(rows, dims.NAME_PATTERN, dims.dim(s, dims.NAME_CODES))


def _event_cells(s, d):
    return _hexed(op.event_cells(_stored_events(s, d), stable_uid("sensor", "row_id")))


_EVENT_SQL_COLUMNS = {c: n.lower() for c, n, _ in event_op.SYSTEM_FIELDS if c != "ts"}


_COMPUTER_SQL = {"computer_code": "code_", "computer_site": "site_", "computer_number": "number_", "computer_code_description": "description_"}


def _event_cells_sql(first: str = "") -> str:
    default = {c: "''" if k == "string" else "0" for c, _, k in event_op.SYSTEM_FIELDS}
    kinds = {c: k for c, _, k in event_op.SYSTEM_FIELDS}
    cols = []
    for c, n in _EVENT_SQL_COLUMNS.items():
        value = n if kinds[c] == "string" else f"try_cast({n} as bigint)"
        value = f"coalesce({value}, {default[c]})"
        cols.append(f"nullif({value}, '') as {c}" if c in event_op.OMITTED_WHEN_EMPTY else f"{value} as {c}")
    opened = [n for n in EVENT_FIELD_NAMES if n.startswith("eventdata_")]
    src = f"""with described as (select event_id as d_id, arg_max(description, rank) as d_text from {dims.EVENTS} group by event_id),
     cell_src as (select row_id, sensor, reference, {', '.join(f'{v} as {c}' for c, v in _COMPUTER_SQL.items())}, coalesce(d_text, '') as description, {', '.join(cols)}, {', '.join(o + ' as o_' + o for o in opened)},
      epoch_us(try_cast(system_timecreated_systemtime as timestamp)) * 1000 as ts_ns from {_sql_decoded('(select * from ' + _RAW + ')', 'system_computer')} left join described on d_id = coalesce(try_cast(system_eventid as bigint), 0)
      where try_cast(system_timecreated_systemtime as timestamp) is not null
       and (system_eventid is null or try_cast(system_eventid as integer) is not null)
       and (system_task is null or try_cast(system_task as integer) is not null))"""
    key = "sha256(sensor || '|' || row_id::varchar)"
    named = _sql_cells("cell_src", key, op.EVENT_CELLS, {*_EVENT_SQL_COLUMNS, *_COMPUTER_SQL, "ts_ns", "description"}, first=first)
    more = []
    for o in opened:
        value = _SQL_ENCODE["text"].format(c=f"o_{o}")
        if o == "eventdata_data_ipaddress":
            value = _SQL_ENCODE["text"].format(c=_SQL_IP.replace(o, f"o_{o}"))
        if o == "eventdata_data_starttime":
            value = _SQL_ENCODE["instant"].format(c=f"(epoch_us(o_{o}::timestamp) * 1000)")
        more.append(
            f"select {first}{key}, 'ED', '{o.upper()}', {value}, ts_ns // 1000000 from cell_src where o_{o} is not null"
        )
    return f"{src} {named} union all {' union all '.join(more)}"


_add("g1_event_cells", _event_cells, _event_cells_sql())


def _through_tables(s, cells, persist=True):
    """Cells written twice under one label, as after a lost driver, and read back from their tables."""
    folder = f"{shared_folder(s)}/tables-{uuid.uuid4().hex}"
    for _ in range(2):
        write_batch(cells, folder, "whole", persist)
    return _hexed(read_routed(s, folder)).select("table", "row_key", "family", "qualifier", "value", "cell_ts")


def _written_flows(s, d):
    rows = mixed_packets(s, d)
    pieces = flow_op.tcp_pieces(rows)
    flows = flow_op.add_stats(flow_op.summarise(rows, pieces=pieces), flow_op.flow_stats(rows, pieces=pieces))
    return _through_tables(s, op.flow_cells(flows, flow_op.flow_row_key(), table=op.packet_table()))


_PACKET_TABLE_SQL, _EVENT_TABLE_SQL = """reference || '-packets' as "table", """, """'default:' || reference || '-evtx' as "table", """
_add(
    "g5_write_packets",
    lambda s, d: _through_tables(s, op.packet_cells(mixed_packets(s, d), table=op.packet_table()), persist=False),
    f"{_SQL_PACKETS} {_sql_cells('cell_src', SQL_ROW_KEY, op.PACKET_CELLS, _PACKET_COLUMNS, first=_PACKET_TABLE_SQL)}",
)
_add(
    "g5_write_flows",
    _written_flows,
    f"""{_FLOWS_WITH_STATS}, cell_src as (select *, (ts_ns % 1000000000)::integer as nanos, (ts_end_ns - ts_ns) / 1e9 as duration_s from with_stats)
     {_sql_cells('cell_src', _SQL_FLOW_ROW_KEY, op.FLOW_CELLS, _FLOW_COLUMNS, first=_PACKET_TABLE_SQL)}""",
)
_add(
    "g5_write_events",
    lambda s, d: _through_tables(s, op.event_cells(shared_table(_stored_events(s, d)), stable_uid("sensor", "row_id"), table=op.event_table()), persist=False),
    _event_cells_sql(_EVENT_TABLE_SQL),
)


def _encoded(s, d):
    p = mixed_packets(s, d)
    signed = F.col("pkt_id") - 5000
    return p.select(
        "pkt_id",
        F.hex(encode.int32(signed)).alias("as_int32"),
        F.hex(encode.int64(signed * 1_000_003)).alias("as_int64"),
        F.hex(encode.float32(signed / F.lit(7.0))).alias("as_float32"),
        F.hex(encode.text("protocol")).alias("as_text"),
        F.hex(encode.instant("ts_ns")).alias("as_instant"),
    )


_add(
    "g2_encode_value",
    _encoded,
    f"""select pkt_id, hex((pkt_id - 5000)::integer::bit::blob) as as_int32, hex(((pkt_id - 5000) * 1000003)::bigint::bit::blob) as as_int64,
     hex(((pkt_id - 5000) / 7.0::double)::float::bit::blob) as as_float32, hex(encode(protocol)) as as_text,
     {_SQL_ENCODE['instant'].format(c='ts_ns')} as as_instant from {_MIXED}""",
)
_add(
    "g3_route_table",
    lambda s, d: mixed_packets(s, d)
    .groupBy(op.packet_table().alias("packet_table"), op.event_table().alias("event_table"))
    .agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")),
    f"""select reference || '-packets' as packet_table, 'default:' || reference || '-evtx' as event_table, count(*) as rows,
     sum(bytes)::bigint as bytes from {_MIXED} group by reference""",
)


def _upserted(s, d):
    """Copies share the key of their original; the last copy written stays."""
    p = mixed_packets(s, d)
    cells = p.select(
        stable_uid("source_file", "origin_id").alias("row_key"), F.lit("PM").alias("family"),
        F.explode(F.array(F.lit("FRAME"), F.lit("BYTES"))).alias("qualifier"),
        F.col("pkt_id").alias("written"), F.col("bytes"), F.expr("ts_ns div 1000000").alias("cell_ts"),
    )
    value = F.when(F.col("qualifier") == "FRAME", encode.int64("written")).otherwise(encode.float32("bytes"))
    return _hexed(op.upsert_latest(cells.withColumn("value", value), "written"))


_add(
    "g4_upsert_latest",
    _upserted,
    f"""select sha256(source_file || '|' || origin_id::varchar) as row_key, 'PM' as family, qualifier, ts_ns // 1000000 as cell_ts,
      case when qualifier = 'FRAME' then hex(max(pkt_id)::bigint::bit::blob) else hex(arg_max(bytes, pkt_id)::float::bit::blob) end as value
     from {_MIXED}, (values ('FRAME'), ('BYTES')) as q(qualifier) group by source_file, origin_id, qualifier, ts_ns // 1000000""",
)

# --- domains ----------------------------------------------------------------------------


def _hosts(s, d):
    return table(s, d, "pages").select("page_id", domains.url_host("url").alias("host"))


_SQL_DOMAINS = f"""(with hosts as (select page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) as host from pages),
 cand as (select page_id, host, string_split(host, '.') as labels, unnest(range(1, len(string_split(host, '.')) + 1)) as depth from hosts),
 hit as (select page_id, rule, depth, len(labels) as size from cand join {dims.SUFFIXES}
  on suffix = array_to_string(labels[len(labels) - depth + 1 :], '.')),
 best as (select page_id, max(case when rule = 'exception' then depth - 1 end) as exc,
  max(case when rule = 'exact' then depth when rule = 'wildcard' and size > depth then depth + 1 end) as reg from hit group by page_id),
 n as (select h.page_id, host, string_split(host, '.') as labels, coalesce(exc, reg, 1) as n from hosts h left join best using (page_id))
 select page_id, host, case when len(labels) >= n then array_to_string(labels[len(labels) - n + 1 :], '.') end as suffix,
  case when len(labels) > n then array_to_string(labels[len(labels) - n :], '.') end as domain from n) as d"""
_add(
    "h1_registrable_domain",
    lambda s, d: domains.registrable_domain(_hosts(s, d), "host", dims.dim(s, dims.SUFFIXES)),
    f"select * from {_SQL_DOMAINS}",
)


def _suffix_ids(s, d):
    found = domains.registrable_domain(_hosts(s, d), "host", dims.dim(s, dims.SUFFIXES))
    return found.groupBy("suffix").agg(F.count("*").alias("pages")).withColumn("suffix_id", domains.suffix_id("suffix"))


_add(
    "h2_suffix_ids",
    _suffix_ids,
    f"""select suffix, pages, (case when h >= 2147483648 then h - 4294967296 else h end)::bigint as suffix_id from (
      select suffix, count(*) as pages, list_reduce(list_prepend(0::hugeint, list_transform(string_split(suffix, ''), lambda c: ascii(c)::hugeint)),
       lambda a, c: (a * 31 + c) % 4294967296) as h from {_SQL_DOMAINS} group by suffix)""",
)
