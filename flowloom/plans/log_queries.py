"""Registered event-log source queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.operators import events as event_op
from flowloom.plans.captures import EVENTS_PER_FILE, event_logs, file_tasks
from flowloom.plans.event_queries import _RAW, _SQL_TYPED
from flowloom.plans.inputs import EVENT_FIELD_NAMES, event_fields, table
from flowloom.sources.event_logs import flatten_event, read_evtx

QUERIES, ORACLES = {}, {}


def _add(name, query, sql):
    QUERIES[name] = query
    ORACLES[name] = sql


def _texts(fields):
    entries = F.array_sort(F.map_entries(fields))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"]["value"])), ";")


def _sql_texts(special: dict[str, str] = {}) -> str:
    parts = [f"case when {special.get(n, n)} is not null then '{n.upper()}=' || {special.get(n, n)} end" for n in EVENT_FIELD_NAMES]
    return f"array_to_string(list_sort(list_filter([{', '.join(parts)}], lambda x: x is not null)), ';')"


_SQL_TICKS = """case when try_cast(system_timecreated_systemtime as timestamp) is not null
 then system_timecreated_systemtime || '0' else system_timecreated_systemtime end"""


def _decoded(s, d):
    found = read_evtx(event_logs(s, d), tasks=file_tasks(table(s, d, "events")))
    return found.select(
        "source_file", F.col("record_id").alias("row_id"), _texts("fields").alias("fields"),
        F.col("fields")["SYSTEM_TIMECREATED_SYSTEMTIME"]["type"].alias("time_type"), "error",
    )


_add(
    "a6_read_evtx",
    _decoded,
    f"""select '/logs/' || lpad((row_id // {EVENTS_PER_FILE})::varchar, 6, '0') || '.evtx' as source_file, row_id,
      {_sql_texts({'system_timecreated_systemtime': '(' + _SQL_TICKS + ')'})} as fields,
      case when try_cast(system_timecreated_systemtime as timestamp) is not null then 'FiletimeTypeNode'
       when system_timecreated_systemtime is not null then 'WStringTypeNode' end as time_type, null::varchar as error from {_RAW}""",
)


def _log_events(s, d):
    """Log files to typed events in one plan."""
    records = read_evtx(event_logs(s, d), tasks=file_tasks(table(s, d, "events")))
    typed = event_op.typed_fields(records.withColumn("row_id", F.col("record_id")).drop("error"))
    return typed.select("row_id", "event_id", "version", "level", "opcode", "channel", "computer", F.unix_micros("ts").alias("ts_us"), "error")


_add(
    "a6_log_events",
    _log_events,
    f"""select row_id, event_id, version, level, opcode, channel, computer, ts_us, error from (select row_id, {_SQL_TYPED} from {_RAW}) as t""",
)
_SYSTEM_TAGS = (
    ("Provider", {"Name": "SYSTEM_PROVIDER_NAME", "Guid": "SYSTEM_PROVIDER_GUID"}, None),
    ("EventID", {"Qualifiers": "SYSTEM_EVENTID_QUALIFIERS"}, "SYSTEM_EVENTID"),
    ("Task", {}, "SYSTEM_TASK"),
    ("TimeCreated", {"SystemTime": "SYSTEM_TIMECREATED_SYSTEMTIME"}, None),
    ("Execution", {"ProcessID": "SYSTEM_EXECUTION_PROCESSID", "ThreadID": "SYSTEM_EXECUTION_THREADID"}, None),
    ("Channel", {}, "SYSTEM_CHANNEL"),
    ("Computer", {}, "SYSTEM_COMPUTER"),
)
_XML_FIELDS = [f for _, attributes, text in _SYSTEM_TAGS for f in (*attributes.values(), text) if f]


def _rendered(s, d):
    """Events as XML text; one in 37 is cut short."""
    rows = event_fields(s, d)

    def value(name):
        return F.coalesce(event_op.field_value(name), F.lit(""))

    parts = [F.lit("<Event xmlns='http://schemas.microsoft.com/win/2004/08/events/event'><System>")]
    for tag, attributes, text in _SYSTEM_TAGS:
        parts.append(F.lit(f"<{tag}"))
        for attribute, name in attributes.items():
            present = F.concat(F.lit(f' {attribute}="'), value(name), F.lit('"'))
            parts.append(F.when(event_op.field_value(name).isNotNull(), present).otherwise(F.lit("")))
        parts.append(F.concat(F.lit(">"), value(text) if text else F.lit(""), F.lit(f"</{tag}>")))
    parts.append(F.lit("</System><EventData>"))
    data = F.filter(F.map_entries("fields"), lambda e: e["key"].startswith("EVENTDATA_"))
    item = lambda e: F.concat(
        F.lit('<Data Name="'), F.substring_index(e["key"], "_", -1), F.lit('">'), e["value"]["value"], F.lit("\n</Data>")
    )
    parts += [F.array_join(F.transform(data, item), ""), F.lit("</EventData></Event>")]
    whole = F.concat(*parts)
    return rows.select("row_id", F.when(F.col("row_id") % 37 == 0, F.substring(whole, 1, 200)).otherwise(whole).alias("xml"))


def _flattened(s, d):
    out = flatten_event(_rendered(s, d), "xml")
    return out.select("row_id", _texts("fields").alias("fields"), F.col("error").isNotNull().alias("rejected"))


def _sql_xml_texts() -> str:
    parts = []
    for n in EVENT_FIELD_NAMES:
        if n.startswith("eventdata_") or n.upper() in _XML_FIELDS:
            text = n in ("system_eventid", "system_task", "system_channel", "system_computer")
            parts.append(f"case when {f'nullif({n}, $$$$)' if text else n} is not null then '{n.upper()}=' || {n} end")
    return f"array_to_string(list_sort(list_filter([{', '.join(parts)}], lambda x: x is not null)), ';')".replace("$$$$", "''")


_add(
    "a7_flatten_event",
    _flattened,
    f"""select row_id, case when row_id % 37 <> 0 then {_sql_xml_texts()} end as fields, row_id % 37 = 0 as rejected from {_RAW}""",
)
