"""Registered flow and session queries and their oracle SQL.

The oracle works on whole flow keys and folds sessions with a recursive query, so it shares
neither the slicing nor the run merging of the Spark plans.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import flows as op
from flowloom.operators import packets as packet_op
from flowloom.operators.max_span import split_sessions
from flowloom.operators.sessions import KEY, cut_pieces, fill_key, flow_key, order_packets, split_idle
from flowloom.plans.inputs import DUCK_MIXED_PACKETS, DUCK_PACKETS, mixed_packets, packets, table
from flowloom.plans.packet_queries import SQL_ROW_KEY

QUERIES, ORACLES = {}, {}
MAX_SPAN_MS = 5000
_READY_MS = 30_000


def _add(name, query, sql):
    QUERIES[name] = query
    ORACLES[name] = sql


# --- oracle building blocks -------------------------------------------------------------

# Packets of equal time, in the order of their files, members and frames; Spark sorts NULLs first.
ARRIVAL_SQL = "source_file nulls first, member nulls first, frame_no"


def _arrival_sql(direction: str) -> str:
    return ARRIVAL_SQL if direction == "asc" else "source_file desc nulls last, member desc nulls last, frame_no desc"


_PLAIN_SRC = f"""select *, null::varchar as source_file, null::varchar as member, 'ipv4' as ip_version, '' as reference, '' as sensor, 'tcp' as protocol, pkt_id as frame_no, ts_us * 1000 as ts_ns,
 null::bigint as seq_num, null::bigint as ack_num from ({DUCK_PACKETS}) as ep"""
_KEY_SQL = "reference, sensor, protocol, host_lo, port_lo, host_hi, port_hi"


def _keyed(src: str) -> str:
    return f"""keyed as (select *, least(id_orig_h, id_resp_h) as host_lo, greatest(id_orig_h, id_resp_h) as host_hi,
 case when id_orig_h < id_resp_h then id_orig_p else id_resp_p end as port_lo,
 case when id_orig_h < id_resp_h then id_resp_p else id_orig_p end as port_hi from ({src}) as src)"""


def _sessions(src: str, max_span_ms: int | None = None) -> str:
    """CTE chain ending in ``sess``: TCP packets with session_ts and their number in the session."""
    idle = f"""{_keyed(src)},
cuts as (select *, coalesce(ts_ns - lag(ts_ns) over w >= 4000000000, true) as cut,
 row_number() over w as flow_rn from keyed where protocol = 'tcp'
 window w as (partition by {_KEY_SQL} order by ts_ns, {ARRIVAL_SQL}))"""
    if max_span_ms is None:
        starts = """,
starts as (select *, max(case when cut then ts_ns end) over (partition by {k} order by flow_rn) as session_ts from cuts)"""
    else:
        starts = """,
chain as (select {k}, flow_rn, ts_ns as session_ts from cuts where flow_rn = 1
 union all select c.reference, c.sensor, c.protocol, c.host_lo, c.port_lo, c.host_hi, c.port_hi, c.flow_rn,
  case when c.cut or (c.ts_ns - x.session_ts) // 1000000 > {ms} then c.ts_ns else x.session_ts end
 from chain x join cuts c on c.reference = x.reference and c.sensor = x.sensor and c.host_lo = x.host_lo and c.port_lo = x.port_lo
  and c.host_hi = x.host_hi and c.port_hi = x.port_hi and c.flow_rn = x.flow_rn + 1),
starts as (select cuts.*, chain.session_ts from cuts join chain using (reference, sensor, protocol, host_lo, port_lo, host_hi, port_hi, flow_rn))"""
        starts = starts.replace("{ms}", str(max_span_ms))
    return (
        idle
        + starts.replace("{k}", _KEY_SQL)
        + f""",
sess as (select *, row_number() over (partition by {_KEY_SQL}, session_ts order by ts_ns, {ARRIVAL_SQL}) as rn from starts)"""
    )


def _fold(src: str, max_span_ms: int | None = None) -> str:
    """CTE chain ending in ``fold``: orientation and state after every packet of every session."""
    step_state = """case when s.syn and not s.ack then 'S0' when s.syn and s.ack then 'S1'
   when f.state = 'S0' and s.id_orig_h = o.orig and s.fin then 'SH'
   when f.state in ('S0','S1') and s.fin then 'SF'
   when f.state = 'S0' and s.id_orig_h <> o.orig and s.rst then 'REJ'
   when f.state = 'S1' and s.id_orig_h = o.orig and s.rst then 'RSTO'
   when f.state = 'S1' and s.id_orig_h <> o.orig and s.rst then 'RSTR'
   when f.state = 'S0' and s.id_orig_h = o.orig and s.rst then 'RSTOS0'
   when f.state = 'OTH' and s.id_orig_h <> o.orig and s.rst then 'RSTRH'
   when f.state = 'OTH' and s.fin then 'SHR' else f.state end"""
    return f"""{_sessions(src, max_span_ms)},
hits as (select *, case when syn and ack then id_resp_h when syn then id_orig_h
  when id_orig_p > id_resp_p then id_orig_h when id_orig_p < id_resp_p then id_resp_h end as seed_hit,
 case when ack_num = 0 then id_resp_h when seq_num = 0 then id_orig_h end as number_hit from sess),
fold as (select {_KEY_SQL}, session_ts, rn, coalesce(seed_hit, id_orig_h) as orig, seed_hit is not null as known,
  case when syn and ack then 'S1' when syn then 'S0' else 'OTH' end as state from hits where rn = 1
 union all
 select s.reference, s.sensor, s.protocol, s.host_lo, s.port_lo, s.host_hi, s.port_hi, s.session_ts, s.rn, o.orig, o.known, {step_state}
 from fold f join hits s on s.reference = f.reference and s.sensor = f.sensor and s.host_lo = f.host_lo and s.port_lo = f.port_lo
   and s.host_hi = f.host_hi and s.port_hi = f.port_hi and s.session_ts = f.session_ts and s.rn = f.rn + 1,
  lateral (select case when f.known then f.orig else coalesce(s.seed_hit, s.number_hit, f.orig) end as orig,
   f.known or coalesce(s.seed_hit, s.number_hit) is not null as known) as o)"""


def _tcp_flows(src: str, max_span_ms: int | None = None) -> str:
    """CTE chain ending in ``tcp``: one row per session."""
    return f"""{_fold(src, max_span_ms)},
ends as (select {_KEY_SQL}, session_ts, arg_max(orig, rn) as orig, arg_max(state, rn) as conn_state
 from fold group by all),
tcp as (select s.reference, s.sensor, s.protocol, e.orig as id_orig_h,
 case when e.orig = s.host_lo then s.host_hi else s.host_lo end as id_resp_h,
 case when e.orig = s.host_lo then s.port_lo else s.port_hi end as id_orig_p,
 case when e.orig = s.host_lo then s.port_hi else s.port_lo end as id_resp_p,
 s.session_ts as ts_ns, max(s.ts_ns) as ts_end_ns, arg_min(s.frame_no, s.rn) as first_frame, e.conn_state,
 arg_min(s.source_file, s.rn) as source_file, arg_min(s.ip_version, s.rn) as ip_version,
 count(*) filter (where s.id_orig_h = e.orig) as orig_pkts, count(*) filter (where s.id_orig_h <> e.orig) as resp_pkts,
 coalesce(sum(s.bytes) filter (where s.id_orig_h = e.orig), 0)::bigint as orig_bytes,
 coalesce(sum(s.bytes) filter (where s.id_orig_h <> e.orig), 0)::bigint as resp_bytes
 from sess s join ends e using ({_KEY_SQL}, session_ts) group by all)"""


def _untimed(protocol: str) -> str:
    where = "protocol not in ('tcp','udp','icmp') and ip_version = 'ipv4'" if protocol == "ip" else f"protocol = '{protocol}'"
    swap = {"udp": "f.id_orig_p < f.id_resp_p", "icmp": "f.icmp_type like '%reply'", "ip": "false"}[protocol]
    flow_key = "reference, sensor, protocol, least(id_orig_h, id_resp_h), greatest(id_orig_h, id_resp_h)"
    if protocol == "udp":
        flow_key += """, case when id_orig_h < id_resp_h then id_orig_p else id_resp_p end,
  case when id_orig_h < id_resp_h then id_resp_p else id_orig_p end"""
    return f"""select f.reference, f.sensor, f.protocol, case when {swap} then f.id_resp_h else f.id_orig_h end as id_orig_h,
 case when {swap} then f.id_orig_h else f.id_resp_h end as id_resp_h,
 case when {swap} then f.id_resp_p else f.id_orig_p end as id_orig_p,
 case when {swap} then f.id_orig_p else f.id_resp_p end as id_resp_p,
 f.ts_ns, max(p.ts_ns) as ts_end_ns, f.frame_no as first_frame, null::varchar as conn_state,
 count(*) filter (where p.id_orig_h = f.id_orig_h) as a_pkts, count(*) filter (where p.id_orig_h <> f.id_orig_h) as b_pkts,
 coalesce(sum(p.bytes) filter (where p.id_orig_h = f.id_orig_h), 0)::bigint as a_bytes,
 coalesce(sum(p.bytes) filter (where p.id_orig_h <> f.id_orig_h), 0)::bigint as b_bytes,
 {swap} as swapped, f.source_file, f.ip_version, f.icmp_type, f.icmp_code, f.icmp_type_number, f.icmp_code_number
 from (select *, dense_rank() over (order by {flow_key}) as flow_no from mixed where {where}) p
 join (select *, dense_rank() over (order by {flow_key}) as flow_no from mixed where {where}
  qualify row_number() over (partition by {flow_key} order by ts_ns, {ARRIVAL_SQL}) = 1) f using (flow_no) group by all"""


def _untimed_flows(protocol: str) -> str:
    return f"""select reference, sensor, protocol, id_orig_h, id_resp_h, id_orig_p, id_resp_p, ts_ns, ts_end_ns, first_frame, conn_state,
 case when swapped then b_pkts else a_pkts end as orig_pkts, case when swapped then a_pkts else b_pkts end as resp_pkts,
 case when swapped then b_bytes else a_bytes end as orig_bytes, case when swapped then a_bytes else b_bytes end as resp_bytes,
 icmp_type, icmp_code, icmp_type_number, icmp_code_number, source_file, ip_version from ({_untimed(protocol)}) as u"""


_WITH_MIXED = f"with recursive mixed as ({DUCK_MIXED_PACKETS})"
_ALL_FLOWS = f"""{_WITH_MIXED}, {_tcp_flows("select * from mixed")},
flows as (select reference, sensor, protocol, id_orig_h, id_resp_h, id_orig_p, id_resp_p, ts_ns, ts_end_ns, first_frame, conn_state,
  orig_pkts, resp_pkts, orig_bytes, resp_bytes, null::varchar as icmp_type, null::varchar as icmp_code,
  null::integer as icmp_type_number, null::integer as icmp_code_number, source_file, ip_version from tcp
 union all {_untimed_flows("udp")} union all {_untimed_flows("icmp")} union all {_untimed_flows("ip")})"""
_ID = ["reference", "sensor", "protocol", "id_orig_h", "id_resp_h", "id_orig_p", "id_resp_p", "ts_ns"]
_ID_SQL = ", ".join(_ID)


def _flows(s, d):
    return op.summarise(mixed_packets(s, d))


# --- aggregations over flows ------------------------------------------------------------

_add(
    "c1_flow_counts",
    lambda s, d: _flows(s, d).select(*_ID, "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes"),
    f"{_ALL_FLOWS} select {_ID_SQL}, orig_pkts, resp_pkts, orig_bytes, resp_bytes from flows",
)
_add(
    "c2_flow_totals",
    lambda s, d: _flows(s, d).select(
        *_ID,
        (F.col("orig_pkts") + F.col("resp_pkts")).alias("packets"),
        (F.col("orig_bytes") + F.col("resp_bytes")).alias("bytes"),
    ),
    f"{_ALL_FLOWS} select {_ID_SQL}, orig_pkts + resp_pkts as packets, orig_bytes + resp_bytes as bytes from flows",
)
_add(
    "c3_flow_span",
    lambda s, d: _flows(s, d).select(*_ID, "ts_end_ns", F.round("duration_s", 6).alias("duration_s")),
    f"{_ALL_FLOWS} select {_ID_SQL}, ts_end_ns, round((ts_end_ns - ts_ns) / 1e9, 6) as duration_s from flows",
)
_STATS = ["bytes_min", "bytes_mean", "bytes_median", "bytes_max", "bytes_std_dev"]


def _rounded(df, keys):
    return df.select(*keys, *[F.round(c, 6).alias(c) for c in _STATS])


_STAT_SQL = {"min": "min", "mean": "avg", "median": "median", "max": "max", "std_dev": "stddev_pop"}


def _exact_stats_sql(v: str) -> str:
    return ", ".join(f"case when count(*) > 1 then {f}({v})::double end as bytes_{n}" for n, f in _STAT_SQL.items())


def _stats_sql(v: str) -> str:
    return ", ".join(f"case when count(*) > 1 then round({f}({v})::double, 6) end as bytes_{n}" for n, f in _STAT_SQL.items())


_add(
    "c4_feature_stats",
    lambda s, d: _rounded(
        split_idle(op.tcp_pieces(packets(s, d))).groupBy(*KEY, "session_ts").agg(*op.feature_stats("bytes")),
        ["host_lo", "port_lo", "host_hi", "port_hi", "session_ts"],
    ),
    f"with recursive {_sessions(_PLAIN_SRC)} select host_lo, port_lo, host_hi, port_hi, session_ts, {_stats_sql('bytes')} from sess group by all",
)
_add(
    "c4_feature_stats_volume",
    lambda s, d: _rounded(
        table(s, d, "lineitem").groupBy("l_suppkey").agg(*op.feature_stats("l_quantity")), ["l_suppkey"]
    ),
    f"select l_suppkey, {_stats_sql('l_quantity')} from lineitem group by l_suppkey",
)
for _name, _protocol in (("c5_orient_first", "ip"), ("c6_orient_udp", "udp"), ("c7_orient_icmp", "icmp")):
    _add(
        _name,
        lambda s, d, p=_protocol: op.summarise_untimed(mixed_packets(s, d), p).select(
            *_ID, "first_frame", "orig_pkts", "resp_pkts"
        ),
        f"{_WITH_MIXED} select {_ID_SQL}, first_frame, orig_pkts, resp_pkts from ({_untimed_flows(_protocol)}) as u",
    )


_PACKET_ROW = ["reference", "sensor", "protocol", "host_lo", "port_lo", "host_hi", "port_hi", "session_ts", "ts_ns", "frame_no", "bytes"]


def _flow_packets(s, d):
    return op.flow_packets(mixed_packets(s, d)).select(*_PACKET_ROW, packet_op.packet_row_key().alias("row_key"))


_LISTED = f"""listed as (select * from sess qualify row_number() over (
      partition by {_KEY_SQL}, session_ts, id_orig_h, ts_ns // 1000000, seq_num, ack_num order by {ARRIVAL_SQL}) = 1),
    others as (select *, min(ts_ns) over (partition by {_KEY_SQL}) as session_ts from (with {_keyed("select * from mixed")} select * from keyed)
      where protocol in ('udp','icmp') or (protocol = 'gre' and ip_version = 'ipv4')),
    flow_packets as (select {', '.join(_PACKET_ROW)}, {SQL_ROW_KEY} as row_key from listed
     union all select {', '.join(_PACKET_ROW)}, {SQL_ROW_KEY} as row_key from others)"""
_add(
    "c8_flow_packets",
    _flow_packets,
    f"""{_WITH_MIXED}, {_sessions("select * from mixed")}, {_LISTED} select * from flow_packets""",
)
_SQL_FLOW_UID = """sha256(concat_ws('|', reference, sensor, protocol, id_orig_h, id_resp_h, coalesce(id_orig_p::varchar, '\\N'),
 coalesce(id_resp_p::varchar, '\\N'), first_frame::varchar, ts_ns::varchar))"""
_SQL_FLOW_ROW_KEY = f"""concat_ws('|', reference, sensor, id_orig_h, id_resp_h,
 case when protocol in ('tcp','udp') then id_orig_p::varchar || '|' || id_resp_p::varchar
      when protocol = 'icmp' then icmp_type_number::varchar || '|' || icmp_code_number::varchar end,
 protocol, (ts_ns // 1000000000)::varchar, (ts_ns % 1000000000)::varchar, {_SQL_FLOW_UID})"""
_add(
    "c9_flow_row_key",
    lambda s, d: _flows(s, d).select(op.flow_row_key().alias("row_key")),
    f"{_ALL_FLOWS} select {_SQL_FLOW_ROW_KEY} as row_key from flows",
)
_add(
    "c10_summarise_dispatch",
    lambda s, d: _flows(s, d).select(
        *_ID, "ts_end_ns", "first_frame", "conn_state", "icmp_type", "icmp_code",
        "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes",
    ),
    f"""{_ALL_FLOWS} select {_ID_SQL}, ts_end_ns, first_frame, conn_state, icmp_type, icmp_code,
     orig_pkts, resp_pkts, orig_bytes, resp_bytes from flows""",
)

# --- sessions and states ----------------------------------------------------------------

_add(
    "d1_split_idle",
    lambda s, d: split_idle(op.tcp_pieces(packets(s, d))).select("pkt_id", "session_ts"),
    f"with recursive {_sessions(_PLAIN_SRC)} select pkt_id, session_ts from sess",
)
_add(
    "d2_split_max_span",
    lambda s, d: split_sessions(op.tcp_pieces(mixed_packets(s, d)), max_span_ms=MAX_SPAN_MS).select(
        "pkt_id", "session_ts"
    ),
    f"{_WITH_MIXED}, {_sessions('select * from mixed', MAX_SPAN_MS)} select pkt_id, session_ts from sess",
)
_add(
    "d3_orient_tcp",
    lambda s, d: op.summarise_tcp(mixed_packets(s, d), MAX_SPAN_MS).select(*_ID, "first_frame"),
    f"{_WITH_MIXED}, {_tcp_flows('select * from mixed', MAX_SPAN_MS)} select {_ID_SQL}, first_frame from tcp",
)
_add(
    "d4_conn_state",
    lambda s, d: op.summarise_tcp(packets(s, d)).select(*_ID, "conn_state"),
    f"with recursive {_tcp_flows(_PLAIN_SRC)} select {_ID_SQL}, conn_state from tcp",
)
_add(
    "d4_conn_state_mixed",
    lambda s, d: op.summarise_tcp(mixed_packets(s, d)).select(*_ID, "conn_state"),
    f"{_WITH_MIXED}, {_tcp_flows('select * from mixed')} select {_ID_SQL}, conn_state from tcp",
)
_STATE_VALUES = ", ".join(f"('{c}', '{t}')" for c, t in op.CONN_STATES.items())
_add(
    "d5_conn_state_text",
    lambda s, d: op.describe_states(op.summarise_tcp(packets(s, d))).select(*_ID, "conn_state", "conn_state_text"),
    f"""with recursive {_tcp_flows(_PLAIN_SRC)} select {_ID_SQL}, conn_state, text as conn_state_text
     from tcp join (values {_STATE_VALUES}) as states(code, text) on code = conn_state""",
)


def _deduped(s, d, match):
    rows = split_idle(op.tcp_pieces(mixed_packets(s, d)))
    return op.drop_duplicates_per_direction(rows, match=match)


def _dedupe_sql(match: str) -> str:
    ms = "ts_ns // 1000000"
    same = f"{ms} + seq_num + ack_num" if match == "sum" else f"{ms}, seq_num, ack_num"
    return f"""{_WITH_MIXED}, {_sessions("select * from mixed")}, kept as (select * from sess
     qualify row_number() over (partition by {_KEY_SQL}, session_ts, id_orig_h, {same} order by {ARRIVAL_SQL}) = 1)"""


_add(
    "d6_dedupe_direction",
    lambda s, d: _deduped(s, d, "fields").select("pkt_id", "session_ts"),
    f"{_dedupe_sql('fields')} select pkt_id, session_ts from kept",
)
_add(
    "d6_dedupe_direction_sum",
    lambda s, d: _deduped(s, d, "sum").select("pkt_id", "session_ts"),
    f"{_dedupe_sql('sum')} select pkt_id, session_ts from kept",
)
_SESSION_COLS = ["reference", "sensor", "host_lo", "port_lo", "host_hi", "port_hi", "session_ts"]
_add(
    "d6_session_stats",
    lambda s, d: _rounded(
        _deduped(s, d, "fields").groupBy(*_SESSION_COLS).agg(*op.feature_stats("bytes")), _SESSION_COLS
    ),
    f"{_dedupe_sql('fields')} select {', '.join(_SESSION_COLS)}, {_stats_sql('bytes')} from kept group by all",
)
for _name, _tie, _dir in (("d7_order_packets", "arrival", "asc"), ("d7_order_packets_later_first", "later_first", "desc")):
    _add(
        _name,
        lambda s, d, t=_tie: order_packets(cut_pieces(fill_key(flow_key(mixed_packets(s, d)))), tie=t).select("pkt_id", "position"),
        f"""with {_keyed(DUCK_MIXED_PACKETS)} select pkt_id,
         row_number() over (partition by {_KEY_SQL} order by ts_ns, {_arrival_sql(_dir)}) as position from keyed""",
    )
_add(
    "d8_flow_ready",
    lambda s, d: _flows(s, d).select(*_ID, op.flow_ready(_READY_MS).alias("ready")),
    f"""{_ALL_FLOWS} select {_ID_SQL}, protocol <> 'tcp' and (ts_end_ns - ts_ns) // 1000000 > {_READY_MS} as ready from flows""",
)


def _ready_at_the_end(s, d):
    """Flows due by span, or by over five seconds of silence at the moment of the capture's last packet."""
    rows = mixed_packets(s, d)
    now = rows.agg(F.max("ts_ns")).first()[0]
    idle_ms = F.floor((F.lit(now) - F.col("ts_end_ns")) / F.lit(1_000_000))
    return op.summarise(rows).select(*_ID, op.flow_ready(_READY_MS, idle_ms).alias("ready"))


_add(
    "d8_flow_ready_idle",
    _ready_at_the_end,
    f"""{_ALL_FLOWS} select {_ID_SQL}, (protocol <> 'tcp' and (ts_end_ns - ts_ns) // 1000000 > {_READY_MS})
      or ((select max(ts_ns) from mixed) - ts_end_ns) // 1000000 > 5000 as ready from flows""",
)


def _flow_table_with_stats(s, d):
    rows = mixed_packets(s, d)
    pieces = op.tcp_pieces(rows)
    return _rounded(op.add_stats(op.summarise(rows, pieces=pieces), op.flow_stats(rows, pieces=pieces)), [*_ID, "first_frame"])


_FLOWS_WITH_STATS = f"""{_ALL_FLOWS}, kept as (select * from sess qualify row_number() over (
      partition by {_KEY_SQL}, session_ts, id_orig_h, ts_ns // 1000000, seq_num, ack_num order by {ARRIVAL_SQL}) = 1),
    untimed as (select reference, sensor, protocol, least(id_orig_h, id_resp_h) as host_lo, greatest(id_orig_h, id_resp_h) as host_hi,
      least(id_orig_p, id_resp_p) as p1, greatest(id_orig_p, id_resp_p) as p2, min(ts_ns) as session_ts, {_exact_stats_sql('bytes')}
      from mixed where protocol in ('udp','icmp') or (protocol = 'gre' and ip_version = 'ipv4') group by all),
    timed as (select reference, sensor, protocol, host_lo, host_hi, least(port_lo, port_hi) as p1, greatest(port_lo, port_hi) as p2,
      session_ts, {_exact_stats_sql('bytes')} from kept group by all),
    with_stats as (select f.*, bytes_min, bytes_mean, bytes_median, bytes_max, bytes_std_dev
    from flows f join (select * from untimed union all select * from timed) t on t.reference = f.reference and t.sensor = f.sensor
     and t.protocol = f.protocol and t.session_ts = f.ts_ns and host_lo = least(id_orig_h, id_resp_h) and host_hi = greatest(id_orig_h, id_resp_h)
     and p1 is not distinct from least(id_orig_p, id_resp_p) and p2 is not distinct from greatest(id_orig_p, id_resp_p))"""
_add(
    "c4_flow_table_stats",
    _flow_table_with_stats,
    f"""{_FLOWS_WITH_STATS} select {_ID_SQL}, first_frame, {", ".join(f"round({c}, 6) as {c}" for c in _STATS)} from with_stats""",
)


def session_table(s, d):
    """Flagship: TCP sessions with orientation, state, counters, span and byte statistics."""
    rows = packets(s, d)
    flows = op.summarise_tcp(rows)
    return op.describe_states(flows).select(
        *_ID, "ts_end_ns", F.round("duration_s", 6).alias("duration_s"), "conn_state", "conn_state_text",
        "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes",
        op.flow_uid().alias("flow_id"),
    )


_add(
    "tcp_sessions",
    session_table,
    f"""with recursive {_tcp_flows(_PLAIN_SRC)} select {_ID_SQL}, ts_end_ns, round((ts_end_ns - ts_ns) / 1e9, 6) as duration_s,
     conn_state, text as conn_state_text, orig_pkts, resp_pkts, orig_bytes, resp_bytes, {_SQL_FLOW_UID} as flow_id
     from tcp join (values {_STATE_VALUES}) as states(code, text) on code = conn_state""",
)
