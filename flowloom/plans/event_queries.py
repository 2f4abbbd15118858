"""Registered event-log queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.functions.columns import normalise_ip, stable_uid, system_time
from flowloom.operators import events as op
from flowloom.operators import quality
from flowloom.plans import dims
from flowloom.plans.inputs import DUCK_EVENT_FIELDS, EVENT_FIELD_NAMES, event_fields, table

QUERIES, ORACLES = {}, {}
#: When the derived events are taken to be ingested.
_INGESTED_US = 1_767_225_600_000_000
_RAW = f"({DUCK_EVENT_FIELDS}) as r"


def _add(name, query, sql):
    QUERIES[name] = query
    ORACLES[name] = sql


def _map_text(data):
    """A map as text in key order, to compare it across engines."""
    entries = F.array_sort(F.map_entries(data))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"]["value"], e["value"]["type"])), ";")


_OPEN = [n for n in EVENT_FIELD_NAMES if n.startswith("eventdata_")]


def _sql_map_text(values: dict[str, str], extra: list[str] = ()) -> str:
    parts = []
    for name, value in values.items():
        kind = op.TIME_TYPE if name == "eventdata_data_starttime" else op.TEXT_TYPE
        parts.append(f"case when {value} is not null then '{name.upper()}=' || {value} || '={kind}' end")
    return f"array_to_string(list_sort(list_filter([{', '.join([*parts, *extra])}], lambda x: x is not null)), ';')"


_ID = ["row_id"]

# --- typed fields -----------------------------------------------------------------------

_STRINGS = [c for c, _, k in op.SYSTEM_FIELDS if k == "string"]
_INTS = [(c, n, k) for c, n, k in op.SYSTEM_FIELDS if k in ("int", "bigint")]
_SQL_TS = "try_cast(system_timecreated_systemtime as timestamp)"
_SQL_BAD = ", ".join(
    [f"case when {n.lower()} is not null and try_cast({n.lower()} as bigint) is null then '{n}' end" for _, n, _ in _INTS[:5]]
    + [f"case when system_timecreated_systemtime is not null and {_SQL_TS} is null then 'SYSTEM_TIMECREATED_SYSTEMTIME' end"]
)
_SQL_ERROR = f"case when concat_ws(',', {_SQL_BAD}) <> '' then 'not convertible: ' || concat_ws(',', {_SQL_BAD}) end"
_SQL_TYPED = (
    ", ".join(f"coalesce({n.lower()}, '') as {c}" for c, n, k in op.SYSTEM_FIELDS if k == "string")
    + ", "
    + ", ".join(f"coalesce(try_cast({n.lower()} as bigint), 0) as {c}" for c, n, _ in _INTS)
    + f", epoch_us({_SQL_TS}) as ts_us, {_SQL_ERROR} as error"
)


def _typed(s, d):
    return op.typed_fields(event_fields(s, d))


def _typed_columns(df):
    return df.select(
        *_ID, *_STRINGS, *[F.col(c).cast("bigint").alias(c) for c, _, _ in _INTS], F.unix_micros("ts").alias("ts_us"), "error"
    )


_add("f1_typed_fields", lambda s, d: _typed_columns(_typed(s, d)), f"select row_id, {_SQL_TYPED} from {_RAW}")
_add(
    "f2_parse_event_time",
    lambda s, d: event_fields(s, d).select(
        "row_id", F.unix_micros(system_time(op.field_value("SYSTEM_TIMECREATED_SYSTEMTIME"))).alias("ts_us")
    ),
    f"select row_id, epoch_us({_SQL_TS}) as ts_us from {_RAW}",
)
_add(
    "f2_ingest_time",
    lambda s, d: op.typed_fields(event_fields(s, d), ingest=F.timestamp_micros(F.lit(_INGESTED_US))).select(
        "row_id", F.unix_micros("ts").alias("ts_us"), F.unix_micros("ingest_ts").alias("ingest_us")
    ),
    f"""select row_id, epoch_us({_SQL_TS}) as ts_us, case when system_timecreated_systemtime is null then {_INGESTED_US} end as ingest_us
     from {_RAW}""",
)
_add(
    "f3_describe_event",
    lambda s, d: op.describe_events(_typed(s, d), dims.dim(s, dims.EVENTS)).select("row_id", "event_id", "description"),
    f"""select row_id, t.event_id, coalesce(description, '') as description
     from (select row_id, coalesce(try_cast(system_eventid as bigint), 0) as event_id from {_RAW}) t
     left join (select event_id, arg_max(description, rank) as description from {dims.EVENTS} group by event_id) n using (event_id)""",
)
_SQL_OPEN_MAP = _sql_map_text({n: n for n in _OPEN})
_add(
    "f4_residual_fields",
    lambda s, d: op.residual_fields(event_fields(s, d)).select("row_id", _map_text("data").alias("data")),
    f"select row_id, {_SQL_OPEN_MAP} as data from {_RAW}",
)

# --- names and codes --------------------------------------------------------------------



def _sql_decoded(src: str, column: str) -> str:
    """Decode by position: the invented names are CODE#ddd... with at least four digits."""
    return f"""(select x.*, case when ok then code end as code_, case when ok then site end as site_, case when ok then number end as number_,
  case when ok then description end as description_,
  case when {column} is null then null when not matched then 'name does not match' when not ok then 'unknown code' end as decode_error_
  from (select y.*, n.description, matched and n.code is not null as ok from (
   select z.*, regexp_matches(upper({column}), '{dims.NAME_PATTERN}') as matched,
    regexp_extract(upper({column}), '{dims.NAME_PATTERN}', 1) as code, regexp_extract(upper({column}), '{dims.NAME_PATTERN}', 2) as site,
    regexp_extract(upper({column}), '{dims.NAME_PATTERN}', 3) as number from {src} as z) y
   left join {dims.NAME_CODES.replace(' as name_codes', ' as n')} on y.code = n.code) x) as decoded"""


def _enriched(s, d):
    residual = op.residual_fields(event_fields(s, d))
    return op.enrich_chain(residual, dims.NAME_PATTERN, dims.dim(s, dims.NAME_CODES))


_SQL_LOGON = "case eventdata_data_logontype " + " ".join(f"when '{k}' then '{v}'" for k, v in op.LOGON_TYPES.items()) + " else eventdata_data_logontype end"
_SQL_TARGET = "case when eventdata_data_targetusername is null and eventdata_data_workstation is null then 'EVENTDATA_DATA_SUBJECTUSERNAME' when eventdata_data_targetusername is null and eventdata_data_subjectusername is not null then 'EVENTDATA_DATA_SUBJECTUSERNAME' else 'EVENTDATA_DATA_TARGETUSERNAME' end"
_SQL_ADDED = [
    f"case when name is not null and decode_error_ is null then {_SQL_TARGET} || '_{part}=' || {col} || '={op.TEXT_TYPE}' end"
    for part, col in (("CODE", "code_"), ("SITE", "site_"), ("NUMBER", "number_"), ("CODE_DESCRIPTION", "description_"))
]
_SQL_NAMED = f"(select *, coalesce(eventdata_data_targetusername, eventdata_data_subjectusername, eventdata_data_workstation) as name from {_RAW})"
_SQL_ENRICHED_VALUES = {n: n for n in _OPEN} | {
    "eventdata_data_logontype": f"(case when name is null then {_SQL_LOGON} else eventdata_data_logontype end)"
}
_add(
    "f5_enrich_chain",
    lambda s, d: _enriched(s, d).select("row_id", _map_text("data").alias("data")),
    f"select row_id, {_sql_map_text(_SQL_ENRICHED_VALUES, _SQL_ADDED)} as data from {_sql_decoded(_SQL_NAMED, 'name')}",
)


def _names(s, d):
    supplier = table(s, d, "supplier").select(F.col("s_name").alias("name"))
    customer = table(s, d, "customer").select(F.col("c_name").alias("name"))
    part = table(s, d, "part").select(F.concat(F.lit("partner#"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("name"))
    return supplier.unionByName(customer).unionByName(part).unionByName(table(s, d, "part").select(F.col("p_name").alias("name")))


_SQL_NAMES = """(select s_name as name from supplier union all select c_name from customer
 union all select 'partner#' || lpad(p_partkey::varchar, 6, '0') from part union all select p_name from part)"""
_PARTS = ["name", "code", "site", "number", "code_description", "decode_error"]
_SQL_PART_COLS = "name, code_ as code, site_ as site, number_ as number, description_ as code_description, decode_error_ as decode_error"
_add(
    "f6_decode_name",
    lambda s, d: op.decode_name(_names(s, d), "name", dims.NAME_PATTERN, dims.dim(s, dims.NAME_CODES)).select(*_PARTS),
    f"select {_SQL_PART_COLS} from {_sql_decoded(_SQL_NAMES, 'name')}",
)
_add(
    "f7_logon_type",
    lambda s, d: event_fields(s, d).select("row_id", op.logon_type(op.field_value(op.LOGON_FIELD)).alias("logon_type")),
    f"select row_id, {_SQL_LOGON} as logon_type from {_RAW}",
)
_SQL_LEVEL = "case eventdata_data_impersonationlevel " + " ".join(f"when '{k}' then '{v}'" for k, v in op.IMPERSONATION_LEVELS.items()) + " else eventdata_data_impersonationlevel end"
_add(
    "f8_impersonation_level",
    lambda s, d: op.residual_fields(event_fields(s, d)).select("row_id", _map_text(op.impersonation_levels("data")).alias("data")),
    f"select row_id, {_sql_map_text({n: n for n in _OPEN} | {'eventdata_data_impersonationlevel': '(' + _SQL_LEVEL + ')'})} as data from {_RAW}",
)
_SQL_IP = r"""(case when eventdata_data_ipaddress = '::1' then '127.0.0.1'
 when regexp_matches(eventdata_data_ipaddress, '::ffff:\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}')
 then regexp_extract(eventdata_data_ipaddress, '::ffff:(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})', 1) else eventdata_data_ipaddress end)"""
_add(
    "f9_normalise_ip",
    lambda s, d: op.residual_fields(event_fields(s, d)).select("row_id", _map_text(op.normalise_ips("data")).alias("data")),
    f"select row_id, {_sql_map_text({n: n for n in _OPEN} | {'eventdata_data_ipaddress': _SQL_IP})} as data from {_RAW}",
)
_add(
    "f10_typed_values",
    lambda s, d: op.residual_fields(event_fields(s, d)).select(
        "row_id",
        F.array_join(
            F.transform(
                F.array_sort(F.map_entries(op.typed_times("data"))),
                lambda e: F.concat_ws("=", e["key"], F.unix_micros(e["value"]).cast("string")),
            ),
            ";",
        ).alias("times"),
    ),
    f"""select row_id, coalesce('EVENTDATA_DATA_STARTTIME=' || epoch_us(eventdata_data_starttime::timestamp)::varchar, '') as times from {_RAW}""",
)
_add(
    "f11_drop_empty",
    lambda s, d: op.drop_empty(_typed(s, d)).select("row_id", *op.OMITTED_WHEN_EMPTY),
    f"""select row_id, nullif(system_channel, '') as channel, nullif(system_computer, '') as computer,
     nullif(system_correlation_activityid, '') as activity_id, nullif(system_correlation_relatedactivityid, '') as related_activity_id,
     nullif(system_security_userid, '') as user_id from {_RAW}""",
)
_add(
    "f12_computer_parts",
    lambda s, d: op.computer_parts(_typed(s, d), dims.NAME_PATTERN, dims.dim(s, dims.NAME_CODES)).select(
        "row_id", "computer", "computer_code", "computer_site", "computer_number", "computer_code_description", "error"
    ),
    f"""select row_id, system_computer as computer, code_ as computer_code, site_ as computer_site, number_ as computer_number,
     description_ as computer_code_description, coalesce({_SQL_ERROR}, 'computer: ' || decode_error_) as error
     from {_sql_decoded('(select * from ' + _RAW + ')', 'system_computer')}""",
)
_add(
    "f13_event_row_key",
    lambda s, d: _typed(s, d).select("row_id", op.event_row_key(stable_uid("sensor", "row_id")).alias("row_key")),
    f"""select row_id, concat_ws('|', coalesce(try_cast(system_eventid as bigint), 0)::varchar, system_computer,
     system_eventrecordid, sha256(sensor || '|' || row_id::varchar)) as row_key from {_RAW}""",
)


def _report(s, d):
    rows = op.describe_events(op.residual_fields(_typed(s, d)), dims.dim(s, dims.EVENTS))
    return rows.select("row_id", op.event_report().alias("report"))


def _sql_report_line(label: str, column: str | None) -> str:
    if column is None:
        return f"'{label}'"
    value = "coalesce(strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%fZ'), '')" if column == "ts" else f"{column}::varchar"
    return f"'{label}' || {value}"


_SQL_REPORT_FIELDS = (
    "list_sort(list_filter(["
    + ", ".join(
        f"case when {v} is not null then '{n.upper()} : ' || {v} || ' -- {op.TIME_TYPE if n == 'eventdata_data_starttime' else op.TEXT_TYPE}' end"
        for n, v in ({n: n for n in _OPEN} | {"eventdata_data_impersonationlevel": f"({_SQL_LEVEL})"}).items()
    )
    + "], lambda x: x is not null))"
)
_add(
    "f14_event_report",
    _report,
    f"""select row_id, array_to_string([{', '.join(_sql_report_line(*x) for x in op.REPORT_LINES)}], chr(10)) || chr(10)
      || array_to_string(open_lines, chr(10)) || chr(10) as report
     from (select t.*, coalesce(n.description, '') as description from
      (select row_id, {_SQL_TYPED}, {_SQL_REPORT_FIELDS} as open_lines from {_RAW}) t
      left join (select event_id, arg_max(description, rank) as description from {dims.EVENTS} group by event_id) n using (event_id))""",
)

# --- origin, rejects, counts ------------------------------------------------------------

_PATH_PATTERN = r"//([a-z]+)\.([a-z-]+)\.example"


def _pages(s, d):
    return table(s, d, "pages").select("page_id", F.col("url").alias("path"), F.length("html").alias("length"))


_add(
    "a9_tag_source",
    lambda s, d: quality.tag_source(_pages(s, d), "lab", pattern=_PATH_PATTERN).select(
        "page_id", "reference", "sensor", "source_file"
    ),
    f"""select page_id, 'lab' as reference, case when regexp_extract(url, '{_PATH_PATTERN}', 1) <> ''
      then regexp_extract(url, '{_PATH_PATTERN}', 1) else 'lab' end as sensor, url || '|' || length(html)::varchar as source_file from pages""",
)
_FILE_PATTERN = r"(M|BLOG|WWW)\.([A-Z]+)\.EXAMPLE\.([A-Z]+)"
_FILE_CODES = "(values ('M', 'phone edition'), ('BLOG', 'articles')) as name_codes(code, description)"


def _origins(s, d):
    decoded = op.decode_name(_pages(s, d), "path", _FILE_PATTERN, dims.dim(s, _FILE_CODES), groups=("code", "site", "zone"))
    return decoded.select(
        "page_id", F.lit("lab").alias("reference"), F.concat_ws(".", "code", "site").alias("sensor"), "decode_error"
    )


_add(
    "f15_tag_event_origin",
    _origins,
    f"""select page_id, 'lab' as reference, case when code in ('M','BLOG') then code || '.' || site else '' end as sensor,
     case when code = '' then 'name does not match' when code not in ('M','BLOG') then 'unknown code' end as decode_error
     from (select page_id, regexp_extract(upper(url), '{_FILE_PATTERN}', 1) as code, regexp_extract(upper(url), '{_FILE_PATTERN}', 2) as site from pages)""",
)


def _rejects(s, d):
    typed = _typed(s, d).withColumn("source_file", F.concat("sensor", F.lit(".evtx")))
    return quality.bad_records(typed, "typed_fields", op.field_value("SYSTEM_EVENTID"), ordinal="row_id")


_add(
    "a10_bad_records",
    lambda s, d: _rejects(s, d).withColumn("raw", F.hex("raw")),
    f"""select sensor || '.evtx' as source_file, null::varchar as member, row_id as ordinal, 'typed_fields' as stage, error as reason,
     hex(system_eventid::blob) as raw from (select *, {_SQL_ERROR} as error from {_RAW}) where error is not null""",
)
_add(
    "a11_ingest_counts",
    lambda s, d: quality.ingest_counts(_typed(s, d).withColumn("source_file", F.concat("sensor", F.lit(".evtx")))),
    f"""select sensor || '.evtx' as source_file, count(*) as total, count(*) filter (where error is null) as good,
     count(*) filter (where error is not null) as bad from (select sensor, {_SQL_ERROR} as error from {_RAW}) group by sensor""",
)


def _whole_chain(s, d):
    """Every step from decoded fields to the stored event."""
    out = op.typed_events(event_fields(s, d), dims.dim(s, dims.EVENTS), dims.NAME_PATTERN, dims.dim(s, dims.NAME_CODES))
    return out.select("row_id", "event_id", "description", "computer", "computer_code", _map_text("data").alias("data"), "error")


_add(
    "typed_events",
    _whole_chain,
    f"""with named as {_SQL_NAMED}, typed as (select a.row_id, coalesce(try_cast(system_eventid as integer), 0) as event_id,
      nullif(system_computer, '') as computer, {_sql_map_text(_SQL_ENRICHED_VALUES | {'eventdata_data_ipaddress': _SQL_IP}, _SQL_ADDED)} as data,
      {_SQL_ERROR} as error from {_sql_decoded('named', 'name').replace(') as decoded', ') as a')}),
     machine as (select row_id, code_ as computer_code, decode_error_ from {_sql_decoded('(select * from ' + _RAW + ')', 'system_computer')})
     select t.row_id, t.event_id, coalesce(n.description, '') as description, computer, computer_code, data,
      coalesce(error, 'computer: ' || decode_error_) as error from typed t join machine using (row_id)
     left join (select event_id, arg_max(description, rank) as description from {dims.EVENTS} group by event_id) n on n.event_id = t.event_id""",
)
