"""Registered packet-level queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.functions import columns as fc
from flowloom.operators import packets as op
from flowloom.plans import dims
from flowloom.plans.inputs import DUCK_MIXED_PACKETS, DUCK_PACKETS, mixed_packets, packets, table

QUERIES, ORACLES = {}, {}
_MIXED = f"({DUCK_MIXED_PACKETS}) as p"
_PLAIN = f"({DUCK_PACKETS}) as p"


def _add(name, query, sql):
    QUERIES[name] = query
    ORACLES[name] = sql


_add(
    "b1_filter_ipv4",
    lambda s, d: op.filter_ipv4(mixed_packets(s, d)).select("pkt_id", "ip_version", "protocol", "bytes"),
    f"select pkt_id, ip_version, protocol, bytes from {_MIXED} where ip_version = 'ipv4'",
)
_add(
    "b2_dispatch_protocol",
    lambda s, d: op.dispatch_protocol(mixed_packets(s, d)).select("pkt_id", "record_type", "reason"),
    f"""select pkt_id, t as record_type, case when t is null then 'unsupported protocol' end as reason
    from (select pkt_id, case when protocol in ('tcp','udp','icmp') then protocol
                              when ip_version = 'ipv4' then 'ip' end as t from {_MIXED})""",
)


def _payload(s, d):
    p = packets(s, d)
    seen = F.when(F.col("bytes") % 5 != 0, F.col("bytes"))
    return p.withColumn("tcp_len", F.when(~F.col("rst"), seen)).withColumn(
        "ip_len", F.when(F.col("bytes") % 7 != 0, F.col("bytes") + 20)
    ).select("pkt_id", op.payload_bytes("tcp_len", "ip_len").alias("payload_bytes"))


_add(
    "b3_payload_bytes",
    _payload,
    f"""select pkt_id, case when not rst and bytes % 5 <> 0 then bytes
         when bytes % 7 <> 0 then bytes + 20 else 0 end as payload_bytes from {_PLAIN}""",
)
_add(
    "b4_normalise_name",
    lambda s, d: table(s, d, "part").select(
        "p_partkey",
        fc.normalise_name(F.concat_ws("  ", "p_type", "p_name")).alias("name"),
    ),
    r"select p_partkey, regexp_replace(lower(p_type || '  ' || p_name), '\s+', '_', 'g') as name from part",
)
_add(
    "b5_tcp_flags",
    lambda s, d: packets(s, d).select("pkt_id", fc.flag_string().alias("flags")),
    f"""select pkt_id, (case when urg then 'U' else ' ' end) || (case when ack then 'A' else ' ' end)
     || (case when psh then 'P' else ' ' end) || (case when rst then 'R' else ' ' end)
     || (case when syn then 'S' else ' ' end) || (case when fin then 'F' else ' ' end) as flags from {_PLAIN}""",
)
_add(
    "b6_service_name",
    lambda s, d: op.service_name(mixed_packets(s, d), dims.dim(s, dims.PORTS)).select("pkt_id", "service"),
    rf"""select pkt_id, regexp_replace(lower(service), '\s+', '_', 'g') as service
     from {_MIXED} left join {dims.PORTS} on port = case when id_orig_p < id_resp_p then id_orig_p else id_resp_p end""",
)
_add(
    "b7_icmp_names",
    lambda s, d: op.icmp_names(
        mixed_packets(s, d).filter("protocol = 'icmp'"), dims.dim(s, dims.ICMP)
    ).select("pkt_id", "icmp_type_number", "icmp_code_number", "icmp_type", "icmp_code"),
    f"""select pkt_id, icmp_type_number, icmp_code_number, replace(lower(type_name), ' ', '_') as icmp_type,
     replace(lower(code_name), ' ', '_') as icmp_code from {_MIXED} left join {dims.ICMP}
     on icmp.ip_version = p.ip_version and type = icmp_type_number and code = icmp_code_number
     where protocol = 'icmp'""",
)
_SQL_IP_KEY = "'|' || reference || '|' || sensor || least(id_orig_h, id_resp_h) || greatest(id_orig_h, id_resp_h)"
_SQL_PORTS = "least(id_orig_p, id_resp_p)::varchar || greatest(id_orig_p, id_resp_p)::varchar"
_add(
    "b8_ip_key",
    lambda s, d: mixed_packets(s, d).select("pkt_id", fc.ip_key().alias("ip_key")),
    f"select pkt_id, {_SQL_IP_KEY} as ip_key from {_MIXED}",
)
_add(
    "b9_ip_port_key",
    lambda s, d: mixed_packets(s, d).select("pkt_id", fc.ip_port_key().alias("ip_port_key")),
    f"select pkt_id, {_SQL_IP_KEY} || case when protocol in ('tcp','udp') then {_SQL_PORTS} else '' end as ip_port_key from {_MIXED}",
)
SQL_UID = "sha256(source_file || '|' || coalesce(member, '\\N') || '|' || frame_no::varchar)"
SQL_ROW_KEY = f"""concat_ws('|', reference, sensor, id_orig_h, id_resp_h,
 case when protocol in ('tcp','udp') then id_orig_p::varchar || '|' || id_resp_p::varchar
      when protocol = 'icmp' then icmp_type_number::varchar || '|' || icmp_code_number::varchar end,
 protocol, (ts_ns // 1000000000)::varchar, (ts_ns % 1000000000)::varchar, bytes::float::varchar, {SQL_UID})"""
_add(
    "b10_packet_row_key",
    lambda s, d: mixed_packets(s, d).select("pkt_id", op.packet_row_key().alias("row_key")),
    f"select pkt_id, {SQL_ROW_KEY} as row_key from {_MIXED}",
)


def _instants(s, d):
    """Both precisions: the fraction of even packets is read as nanoseconds."""
    p = packets(s, d).select(
        "pkt_id",
        fc.int_div("ts_us", 1_000_000).alias("ts_sec"),
        (F.col("ts_us") % 1_000_000).alias("ts_frac"),
        F.when(F.col("pkt_id") % 2 == 0, "nano").otherwise("micro").alias("precision"),
    )
    p = p.withColumn("ts_ns", op.instant_ns("ts_sec", "ts_frac", "precision"))
    return p.select("pkt_id", "precision", "ts_ns", *op.split_instant())


_add(
    "b11_split_instant",
    _instants,
    f"""select pkt_id, precision, ts_ns, ts_ns // 1000000 as epoch_ms, (ts_ns % 1000000000)::integer as nanos
     from (select pkt_id, case when pkt_id % 2 = 0 then 'nano' else 'micro' end as precision,
      (ts_us // 1000000) * 1000000000 + (ts_us % 1000000) * case when pkt_id % 2 = 0 then 1 else 1000 end as ts_ns from {_PLAIN})""",
)
_add(
    "b12_frame_uid",
    lambda s, d: mixed_packets(s, d).select("pkt_id", op.frame_uid().alias("frame_uid")),
    f"select pkt_id, {SQL_UID} as frame_uid from {_MIXED}",
)
