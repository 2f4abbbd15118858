"""Registered byte-level source queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import flows as flow_op
from flowloom.operators import quality
from flowloom.plans.captures import DUCK_CAPTURED, DUCK_LEAVES, capture_files, packed_files
from flowloom.plans.flow_queries import _ID, _ID_SQL, _tcp_flows
from flowloom.plans.inputs import table
from flowloom.sources import files as file_src
from flowloom.sources import pcap

# How the captures of the queries name their sensor.
NAMES = "([a-z]+-[0-9]+)-[0-9]+"
QUERIES, ORACLES = {}, {}


def _add(name, query, sql=None):
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def _signed(s, d):
    """Texts behind a signature chosen per document."""
    kinds = F.array(*[F.lit("00" * off + sig) for _, off, sig in file_src.SIGNATURES], F.lit(""))
    head = F.element_at(kinds, (F.col("doc_id") % 11 + 1).cast("int"))
    content = F.concat(F.unhex(head), F.encode(F.concat(F.lit("text "), F.col("text")), "UTF-8"))
    return table(s, d, "documents").select("doc_id", file_src.classify_magic(content).alias("file_type"))


_add(
    "a1_classify_magic",
    _signed,
    """select doc_id, case when doc_id % 11 = 0 then 'evtx' when doc_id % 11 <= 4 then 'pcap' when doc_id % 11 <= 6 then 'zip'
     when doc_id % 11 = 7 then 'gzip' when doc_id % 11 = 8 then 'bzip2' when doc_id % 11 = 9 then 'tar' else 'unsupported' end as file_type
     from documents""",
)
_add(
    "a2_file_inventory",
    lambda s, d: file_src.file_inventory(packed_files(s, d), ["pcap"]).select("path"),
    f"select distinct path from {DUCK_LEAVES} where file_type = 'pcap' and error is null",
)
_add(
    "a3_expand_containers",
    lambda s, d: file_src.expand_containers(packed_files(s, d)).select(
        "path", "member", "depth", F.array_join("chain", ",").alias("chain"), "file_type", "error"
    ),
    f"select path, member, depth, chain, file_type, error from {DUCK_LEAVES}",
)


def frames(s, d):
    """Frames of all captures, found at any nesting depth."""
    leaves = file_src.expand_containers(packed_files(s, d)).filter("file_type = 'pcap' and error is null")
    return pcap.read_pcap(quality.tag_source(leaves, "lab", NAMES))


_SQL_FRAMES = f"""(select *, file_no % 7 not in (5, 6) as kept, case when file_no % 3 = 0 then 'nano' else 'micro' end as precision,
 regexp_extract(path, '{NAMES}', 1) as sensor_name from {DUCK_CAPTURED}) as f"""


def _frame_rows(s, d):
    found = frames(s, d).withColumn("path", F.split("source_file", r"\|")[0])
    return found.select("path", "sensor", "frame_no", "ts_ns", "incl_len", "orig_len", "link_type", "precision", "error")


_add(
    "a4_read_pcap",
    _frame_rows,
    f"""select path, sensor_name as sensor, place as frame_no, ts_ns, frame_len as incl_len, frame_len as orig_len, link_type, precision,
      null::varchar as error from {_SQL_FRAMES} where kept and framed
     union all select path, sensor_name, place, null, null, null, null, null, 'truncated record' from {_SQL_FRAMES} where kept and cut
     union all select distinct path, sensor_name, 0, null, null, null, null::integer, null, 'unsupported link type 147' from {_SQL_FRAMES} where kept and link_type = 147""",
)
_SQL_HOST = "case when ip_version = 'ipv6' then replace({c}, '10.0.0.', 'fd00:0:0:0:0:0:0:') else {c} end"
_PACKET_COLS = [
    "path", "frame_no", "ip_version", "protocol", "id_orig_h", "id_resp_h", "id_orig_p", "id_resp_p", "bytes",
    "syn", "ack", "rst", "fin", "psh", "urg", "seq_num", "ack_num", "icmp_type_number", "icmp_code_number",
]


def packets(s, d):
    decoded = pcap.decode_packets(frames(s, d))
    return decoded.withColumn("path", F.split("source_file", r"\|")[0])


_add(
    "a5_decode_packets",
    lambda s, d: packets(s, d).filter("error is null").select(*_PACKET_COLS),
    f"""select path, place as frame_no, ip_version, case when ip_version = 'ipv6' and protocol = 'icmp' then 'icmpv6' else protocol end as protocol,
     {_SQL_HOST.format(c='id_orig_h')} as id_orig_h, {_SQL_HOST.format(c='id_resp_h')} as id_resp_h, id_orig_p, id_resp_p, bytes,
     syn, ack, rst, fin, case when protocol = 'tcp' then psh_raw end as psh, case when protocol = 'tcp' then false end as urg, seq_num, ack_num,
     case when ip_version = 'ipv6' and icmp_type = 'echo' then 128 when ip_version = 'ipv6' and icmp_type = 'echo_reply' then 129
      else icmp_type_number end as icmp_type_number, icmp_code_number
     from (select f.*, event_type = 'view' as psh_raw from {_SQL_FRAMES} join events on event_id = origin_id) where kept and framed""",
)


def _sessions_from_bytes(s, d):
    """Archives to TCP sessions in one plan."""
    good, _ = quality.split_bad(packets(s, d))
    return flow_op.summarise_tcp(good).select(*_ID, "conn_state", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes")


_SQL_AS_PACKETS = f"""select 'lab' as reference, sensor_name as sensor, protocol, ts_ns, place as frame_no,
 path as source_file, null::varchar as member, ip_version, {_SQL_HOST.format(c='id_orig_h')} as id_orig_h, {_SQL_HOST.format(c='id_resp_h')} as id_resp_h, id_orig_p, id_resp_p,
 syn, ack, rst, fin, seq_num, ack_num, bytes from {_SQL_FRAMES} where kept and framed"""
_add(
    "a5_capture_sessions",
    _sessions_from_bytes,
    f"""with recursive {_tcp_flows(_SQL_AS_PACKETS)} select {_ID_SQL}, conn_state, orig_pkts, resp_pkts, orig_bytes, resp_bytes from tcp""",
)
