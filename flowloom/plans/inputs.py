"""Packet and event-log views derived from the given tables.

Each view is one SQL text with three dialect holes, so Spark and the SQL oracle read the
very same rows. Everything is plain arithmetic over whole tables.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.lineage import shared_table

SPARK = {
    "US": "unix_micros(cast(ts as timestamp))",
    "K": "get_json_object(props,'$.k')",
    "DIV": "div",
}
DUCK = {"US": "epoch_us(ts)", "K": "json_extract_string(props,'$.k')", "DIV": "//"}

# Thirty days of events squeezed 3600 times, one packet per event.
PACKETS_SQL = """
with e as (select event_id, user_id, event_type, {US} us, cast({K} as bigint) k from events)
select event_id as pkt_id,
 1704067200000000 + (us - 1704067200000000) {DIV} 3600 as ts_us,
 concat('10.0.0.', cast(case when event_id % 2 = 0 then user_id % 6 else 6 + k % 3 end as varchar(10))) as id_orig_h,
 concat('10.0.0.', cast(case when event_id % 2 = 0 then 6 + k % 3 else user_id % 6 end as varchar(10))) as id_resp_h,
 cast(case when event_id % 2 = 0 then 40000 + user_id % 2 else 443 end as integer) as id_orig_p,
 cast(case when event_id % 2 = 0 then 443 else 40000 + user_id % 2 end as integer) as id_resp_p,
 event_type='signup' as syn,
 (event_type in ('view','click','purchase')) or (event_type='signup' and event_id % 2 = 1) as ack,
 event_type='error' as rst, event_type='purchase' as fin,
 event_type='view' as psh, event_type='click' and event_id % 3 = 0 as urg,
 (k * 13) % 1461 as bytes from e
"""

# Adds copies, capture tags, IPv6, other protocols, equal ports and sequence numbers.
MIXED_SQL = """
with e0 as (select event_id, user_id, event_type, {US} us, cast({K} as bigint) k from events),
e as (select event_id as pkt_id, * from e0
      union all select event_id + 1000000 as pkt_id, * from e0 where event_id % 20 = 0)
select pkt_id, event_id as origin_id,
 1704067200000000 + (us - 1704067200000000) {DIV} 3600 as ts_us,
 case when user_id % 2 = 0 then 'alpha' else 'beta' end as reference,
 concat('aa-0', cast(1 + user_id % 3 as varchar(10))) as sensor,
 case when event_id % 50 = 49 then 'ipv6' else 'ipv4' end as ip_version,
 case when event_id % 97 = 0 then 'gre' when (user_id {DIV} 6) % 10 < 7 then 'tcp'
      when (user_id {DIV} 6) % 10 < 9 then 'udp' else 'icmp' end as protocol,
 concat('10.0.0.', cast(case when event_id % 2 = 0 then user_id % 6 else 6 + k % 3 end as varchar(10))) as id_orig_h,
 concat('10.0.0.', cast(case when event_id % 2 = 0 then 6 + k % 3 else user_id % 6 end as varchar(10))) as id_resp_h,
 cast(case when user_id % 25 = 24 then 5000 when event_id % 2 = 0 then 40000 + user_id % 2 else 443 end as integer) as id_orig_p,
 cast(case when user_id % 25 = 24 then 5000 when event_id % 2 = 0 then 443 else 40000 + user_id % 2 end as integer) as id_resp_p,
 case when event_id % 2 = 0 then 'echo' else 'echo_reply' end as icmp_type,
 event_type='signup' as syn,
 (event_type in ('view','click','purchase')) or (event_type='signup' and event_id % 2 = 1) as ack,
 event_type='error' as rst, event_type='purchase' as fin,
 event_type='view' as psh, false as urg,
 (event_id * 7919) % 4294967296 as seq_num,
 case when event_type='error' or (event_type='signup' and event_id % 2 = 0) then 0 else (event_id * 104729) % 4294967296 end as ack_num,
 (k * 13) % 1461 as bytes from e
"""


def _fill(sql: str, dialect: dict[str, str]) -> str:
    for name, text in dialect.items():
        sql = sql.replace("{" + name + "}", text)
    return sql


DUCK_PACKETS = _fill(PACKETS_SQL, DUCK)
DUCK_MIXED = _fill(MIXED_SQL, DUCK)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Most rows of a table that one task derives a view from, so that its time does not grow with the table.
ROWS_PER_TASK = 1 << 15


def tasks_for(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for the rows of a stored table, whose footers tell their number; at least one per core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / rows_per_task))


def _spread(df: DataFrame) -> DataFrame:
    """A table whose scan has too few tasks for the session's cores or for its rows, dealt over enough of them.

    A small file of narrow rows may hold millions of them, and a scan counts bytes only.
    """
    tasks = tasks_for(df)
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def _over_events(spark: SparkSession, sf_dir: str, sql: str, events: DataFrame | None = None) -> DataFrame:
    # ts is stored without a zone; read it as UTC whatever the session zone is.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = _spread(table(spark, sf_dir, "events")) if events is None else events
    return spark.sql(_fill(sql, SPARK).replace("from events", "from {events}"), events=events)


def packets(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """TCP packets of one capture, in the library's packet schema.

    ``events`` may be a stream over the table.
    """
    df = _over_events(spark, sf_dir, PACKETS_SQL, events=events)
    df = df.select(
        "*",
        F.col("pkt_id").alias("frame_no"),
        (F.col("ts_us") * 1000).alias("ts_ns"),
        F.lit("").alias("reference"),
        F.lit("").alias("sensor"),
        F.lit("ipv4").alias("ip_version"),
        F.lit("tcp").alias("protocol"),
        F.lit(None).cast("bigint").alias("seq_num"),
        F.lit(None).cast("bigint").alias("ack_num"),
    )
    return shared_table(df) if events is None else df


def mixed_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All protocols, with the columns that do not apply to a protocol set to NULL, as a table of its own."""
    df = _over_events(spark, sf_dir, MIXED_SQL)
    ported = F.col("protocol").isin("tcp", "udp")
    tcp = F.col("protocol") == "tcp"
    icmp = F.col("protocol") == "icmp"
    only = {c: ported for c in ("id_orig_p", "id_resp_p")}
    only |= {c: tcp for c in ("syn", "ack", "rst", "fin", "psh", "urg", "seq_num", "ack_num")}
    only |= {"icmp_type": icmp}
    df = df.withColumns({c: F.when(cond, F.col(c)) for c, cond in only.items()})
    df = df.select(
        "*",
        F.col("pkt_id").alias("frame_no"),
        (F.col("ts_us") * 1000).alias("ts_ns"),
        F.concat("sensor", F.lit(".pcap")).alias("source_file"),
        F.expr("case when pkt_id % 3 > 0 then concat('part-', cast(pkt_id % 3 as varchar(10))) end").alias("member"),
        F.when(icmp, F.when(F.col("icmp_type") == "echo", 8).otherwise(0)).alias("icmp_type_number"),
        F.when(icmp, F.lit("no_code")).alias("icmp_code"),
        F.when(icmp, F.lit(0)).alias("icmp_code_number"),
    )
    return shared_table(df)


# The same NULLing and derived columns for the oracle.
DUCK_MIXED_PACKETS = f"""
select pkt_id, origin_id, pkt_id as frame_no, ts_us, ts_us * 1000 as ts_ns, concat(sensor, '.pcap') as source_file,
 case when pkt_id % 3 > 0 then concat('part-', (pkt_id % 3)::varchar) end as member, reference, sensor, ip_version, protocol,
 id_orig_h, id_resp_h, bytes,
 case when protocol in ('tcp','udp') then id_orig_p end as id_orig_p,
 case when protocol in ('tcp','udp') then id_resp_p end as id_resp_p,
 case when protocol = 'tcp' then syn end as syn, case when protocol = 'tcp' then ack end as ack,
 case when protocol = 'tcp' then rst end as rst, case when protocol = 'tcp' then fin end as fin,
 case when protocol = 'tcp' then seq_num end as seq_num, case when protocol = 'tcp' then ack_num end as ack_num,
 case when protocol = 'icmp' then icmp_type end as icmp_type,
 case when protocol = 'icmp' then case when icmp_type = 'echo' then 8 else 0 end end as icmp_type_number,
 case when protocol = 'icmp' then 'no_code' end as icmp_code,
 case when protocol = 'icmp' then 0 end as icmp_code_number
from ({DUCK_MIXED}) as raw_packets
"""


def event_points(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events with capture tags and a numeric event id, as the event-log operators emit them."""
    sql = """select event_id as row_id, user_id, event_type, value, {US} * 1000 as ts_ns,
     case when user_id % 2 = 0 then 'alpha' else 'beta' end as reference,
     concat('aa-0', cast(1 + user_id % 3 as varchar(10))) as sensor,
     cast(100 + cast({K} as bigint) % 6 as int) as event_id from events"""
    return _over_events(spark, sf_dir, sql, events=events)


# One wide row of raw event-log fields per event; NULL means the field is absent.
EVENT_FIELDS_SQL = """
with e as (select event_id n, user_id u, event_type t, cast({K} as bigint) k, {TEXT} as when_text,
 case when user_id % 2 = 0 then 'alpha' else 'beta' end as reference,
 concat('aa-0', cast(1 + user_id % 3 as varchar(10))) as sensor from events)
select n as row_id, reference, sensor,
 case when n % 11 <> 0 then concat('Provider ', t) end as system_provider_name,
 case when n % 7 = 0 then concat('guid-', cast(u as varchar(10))) end as system_provider_guid,
 case when n % 41 = 0 then 'n/a' when n % 43 <> 1 then cast(100 + k % 6 as varchar(10)) end as system_eventid,
 case when n % 3 = 0 then cast(k as varchar(10)) end as system_eventid_qualifiers,
 case when n % 5 <> 2 then cast(k % 3 as varchar(10)) end as system_version,
 cast(k % 5 as varchar(10)) as system_level,
 case when n % 61 = 3 then 'high' else cast(k * 2 as varchar(10)) end as system_task,
 case when n % 2 = 0 then '0' end as system_opcode,
 '0x8020000000000000' as system_keywords,
 case when n % 53 = 5 then 'yesterday' when n % 17 <> 0 then when_text end as system_timecreated_systemtime,
 cast(n + 4000000000 as varchar(20)) as system_eventrecordid,
 cast(k * 4 as varchar(10)) as system_execution_processid,
 cast(k * 4 + 1 as varchar(10)) as system_execution_threadid,
 case when n % 4 = 0 then '' when n % 4 <> 3 then 'Security' end as system_channel,
 case when u % 10 = 9 then 'unknown-host' else concat('Supplier#', right(concat('000000000', cast(u as varchar(10))), 9)) end as system_computer,
 case when n % 9 = 0 then concat('act-', cast(n as varchar(20))) end as system_correlation_activityid,
 case when n % 18 = 0 then '' end as system_correlation_relatedactivityid,
 case when n % 2 = 1 then concat('S-1-5-', cast(u as varchar(10))) end as system_security_userid,
 case when n % 6 = 0 then concat('customer#', right(concat('000000000', cast(u as varchar(10))), 9)) end as eventdata_data_targetusername,
 case when n % 6 <= 1 then case when n % 4 = 1 then 'nobody' else concat('partner#', right(concat('000000000', cast(k as varchar(10))), 9)) end end as eventdata_data_subjectusername,
 case when n % 6 = 2 then concat('\\\\', 'supplier#', right(concat('000000000', cast(k as varchar(10))), 9)) end as eventdata_data_workstation,
 cast(k % 13 as varchar(10)) as eventdata_data_logontype,
 case when n % 3 = 0 then '::1' when n % 3 = 1 then concat('ip ::ffff:10.1.2.', cast(k as varchar(10)), '!') else '10.9.8.7' end as eventdata_data_ipaddress,
 case when n % 2 = 0 then concat('%%18', cast(30 + k % 22 as varchar(10))) end as eventdata_data_impersonationlevel,
 case when n % 10 = 1 then when_text end as eventdata_data_starttime
from e
"""
_TEXT = {
    "SPARK": "date_format(cast(ts as timestamp), 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    "DUCK": "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')",
}
DUCK_EVENT_FIELDS = _fill(EVENT_FIELDS_SQL, {**DUCK, "TEXT": _TEXT["DUCK"]}).replace("'\\\\'", "'\\'")
EVENT_FIELD_NAMES = [
    line.rsplit(" as ", 1)[1].strip(", ") for line in EVENT_FIELDS_SQL.splitlines() if " as system_" in line or " as eventdata_" in line
]
# Fixed value: the type name of time-valued fields.
TIME_TYPE = "SystemtimeTypeNode"


def event_fields(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events as decoded from a log: ``fields`` maps a name to its text value and type name.

    ``events`` may be a stream over the table.
    """
    wide = _over_events(spark, sf_dir, EVENT_FIELDS_SQL.replace("{TEXT}", _TEXT["SPARK"]), events=events)
    entries = F.array(
        *[
            F.struct(
                F.lit(name.upper()).alias("key"),
                F.struct(
                    F.col(name).alias("value"),
                    F.lit(TIME_TYPE if name == "eventdata_data_starttime" else "WStringTypeNode").alias("type"),
                ).alias("value"),
            )
            for name in EVENT_FIELD_NAMES
        ]
    )
    present = F.filter(entries, lambda e: e["value"]["value"].isNotNull())
    # The map leaves a generator, which filters on it do not pass: they would build it anew for each field that they name.
    return wide.select("row_id", "reference", "sensor", F.explode(F.array(F.map_from_entries(present))).alias("fields"))
