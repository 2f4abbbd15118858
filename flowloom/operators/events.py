"""Event-log records: typed system fields, open field map, enrichment and rendering.

Rows carry ``fields MAP<STRING, STRUCT<value, type>>``. Every step is a projection; lookups
join caller-supplied tables, which Spark broadcasts while they are below its limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.columns import normalise_ip, system_time

# Output column, field name and type of the named system fields.
SYSTEM_FIELDS = (
    ("provider_name", "SYSTEM_PROVIDER_NAME", "string"),
    ("provider_guid", "SYSTEM_PROVIDER_GUID", "string"),
    ("event_id", "SYSTEM_EVENTID", "int"),
    ("qualifiers", "SYSTEM_EVENTID_QUALIFIERS", "string"),
    ("version", "SYSTEM_VERSION", "int"),
    ("level", "SYSTEM_LEVEL", "int"),
    ("task", "SYSTEM_TASK", "int"),
    ("opcode", "SYSTEM_OPCODE", "int"),
    ("keywords", "SYSTEM_KEYWORDS", "string"),
    ("ts", "SYSTEM_TIMECREATED_SYSTEMTIME", "timestamp"),
    ("record_id", "SYSTEM_EVENTRECORDID", "bigint"),
    ("process_id", "SYSTEM_EXECUTION_PROCESSID", "int"),
    ("thread_id", "SYSTEM_EXECUTION_THREADID", "int"),
    ("channel", "SYSTEM_CHANNEL", "string"),
    ("computer", "SYSTEM_COMPUTER", "string"),
    ("activity_id", "SYSTEM_CORRELATION_ACTIVITYID", "string"),
    ("related_activity_id", "SYSTEM_CORRELATION_RELATEDACTIVITYID", "string"),
    ("user_id", "SYSTEM_SECURITY_USERID", "string"),
)
# Columns left out of the stored row when they are empty.
OMITTED_WHEN_EMPTY = ("channel", "computer", "activity_id", "related_activity_id", "user_id")
# Public Windows logon types.
LOGON_TYPES = {
    "2": "Interactive",
    "3": "Network",
    "4": "Batch",
    "5": "Service",
    "7": "Unlock",
    "8": "NetworkCleartext",
    "9": "NewCredentials",
    "10": "RemoteInteractive",
    "11": "CachedInteractive",
}
# Public Windows message codes of impersonation levels and related answers.
IMPERSONATION_LEVELS = {
    "%%1832": "Identification",
    "%%1833": "Impersonation",
    "%%1840": "Delegation",
    "%%1841": "Denied by Process Trust Label ACE",
    "%%1842": "Yes",
    "%%1843": "No",
    "%%1844": "System",
    "%%1845": "Not Available",
    "%%1846": "Default",
    "%%1847": "DisallowMmConfig",
    "%%1848": "Off",
    "%%1849": "Auto",
}
# Name-bearing fields in order of preference, and where decoded parts are put.
NAME_SOURCES = (
    ("EVENTDATA_DATA_TARGETUSERNAME", "EVENTDATA_DATA_TARGETUSERNAME"),
    ("EVENTDATA_DATA_SUBJECTUSERNAME", "EVENTDATA_DATA_SUBJECTUSERNAME"),
    ("EVENTDATA_DATA_WORKSTATION", "EVENTDATA_DATA_TARGETUSERNAME"),
)
LOGON_FIELD = "EVENTDATA_DATA_LOGONTYPE"
LEVEL_SUFFIX = "IMPERSONATIONLEVEL"
TEXT_TYPE, TIME_TYPE = "WStringTypeNode", "SystemtimeTypeNode"


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    return F.try_element_at(pairs, key)


def field_value(name: str) -> Column:
    return F.try_element_at(F.col("fields"), F.lit(name))["value"]


def typed_fields(events: DataFrame, ingest: Column | None = None) -> DataFrame:
    """Add the named system fields and ``error`` for values that do not convert.

    An absent field becomes '' or 0; an absent time stays NULL, for no event happened "now". With
    ``ingest``, such as ``current_timestamp()``, an event without a time has that one in ``ingest_ts``.
    """
    columns, problems = {}, []
    for column, name, kind in SYSTEM_FIELDS:
        raw = field_value(name)
        if kind == "string":
            columns[column] = F.coalesce(raw, F.lit(""))
            continue
        value = system_time(raw) if kind == "timestamp" else raw.try_cast(kind)
        problems.append(F.when(raw.isNotNull() & value.isNull(), F.lit(name)))
        columns[column] = value if kind == "timestamp" else F.coalesce(value, F.lit(0).cast(kind))
    if ingest is not None:
        times = [name for _, name, kind in SYSTEM_FIELDS if kind == "timestamp"]
        columns["ingest_ts"] = F.when(F.coalesce(*map(field_value, times)).isNull(), ingest.cast("timestamp"))
    bad = F.array_compact(F.array(*problems))
    columns["error"] = F.when(F.size(bad) > 0, F.concat(F.lit("not convertible: "), F.array_join(bad, ",")))
    return events.withColumns(columns)


def residual_fields(events: DataFrame) -> DataFrame:
    """Add ``data``: everything that is not one of the named system fields."""
    named = [name for _, name, _ in SYSTEM_FIELDS]
    return events.withColumn("data", F.map_filter("fields", lambda k, _: ~k.isin(named)))


def describe_events(events: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``description`` from ``names(event_id, description, rank)``; the highest rank wins."""
    dim = names.groupBy(F.col("event_id").alias("_id")).agg(F.max_by("description", "rank").alias("_text"))
    joined = events.join(dim, F.col("event_id") == F.col("_id"), "left")
    return joined.withColumn("description", F.coalesce("_text", F.lit(""))).drop("_id", "_text")


def decode_name(
    df: DataFrame,
    column: str,
    pattern: str | dict[int, str],
    codes: DataFrame,
    groups: Sequence[str] = ("code", "site", "number"),
    version: int = 1,
    prefix: str = "",
) -> DataFrame:
    """Split a name by the caller's pattern and translate its ``code`` group.

    The name is upper-cased and the pattern may match anywhere in it. Adds one column per
    group, ``code_description`` and ``decode_error``; all parts are NULL when the pattern does
    not match or the code is unknown. ``pattern`` may be a dict of versions. Of several
    descriptions of a code the first by text counts.
    """
    regex = pattern[version] if isinstance(pattern, dict) else pattern
    name = F.upper(F.col(column))
    parts = {f"_{g}": F.regexp_extract(name, regex, i + 1) for i, g in enumerate(groups)}
    dim = codes.groupBy(F.upper("code").alias("_known")).agg(F.min("description").alias("_text"))
    joined = df.withColumns(parts).join(dim, F.col("_code") == F.col("_known"), "left")
    matched = F.rlike(name, F.lit(regex))
    error = (
        F.when(F.col(column).isNull(), F.lit(None))
        .when(~matched, F.lit("name does not match"))
        .when(F.col("_known").isNull(), F.lit("unknown code"))
    )
    ok = matched & F.col("_known").isNotNull()
    out = {f"{prefix}{g}": F.when(ok, F.col(f"_{g}")) for g in groups}
    out[f"{prefix}code_description"] = F.when(ok, F.col("_text"))
    out[f"{prefix}decode_error"] = error
    return joined.withColumns(out).drop(*parts, "_known", "_text")


def _text_entry(value: Column) -> Column:
    return F.struct(value.alias("value"), F.lit(TEXT_TYPE).alias("type"))


def enrich_chain(
    events: DataFrame,
    pattern: str | dict[int, str],
    codes: DataFrame,
    groups: Sequence[str] = ("code", "site", "number"),
    version: int = 1,
) -> DataFrame:
    """Decode the first name-bearing field present in ``data`` and add its parts to ``data``.

    A name that does not decode adds nothing. Only events without any of these fields get
    their logon type translated.
    """
    present = [F.map_contains_key("data", F.lit(field)) for field, _ in NAME_SOURCES]
    source = F.coalesce(*[F.when(p, F.lit(f)) for p, (f, _) in zip(present, NAME_SOURCES)])
    target = F.coalesce(*[F.when(p, F.lit(t)) for p, (_, t) in zip(present, NAME_SOURCES)])
    named = events.withColumns(
        {"_source": source, "_target": target, "_name": F.try_element_at("data", source)["value"]}
    )
    decoded = decode_name(named, "_name", pattern, codes, groups, version, prefix="_d_")
    parts = [*groups, "code_description"]
    added = F.map_from_arrays(
        F.array(*[F.concat("_target", F.lit(f"_{p.upper()}")) for p in parts]),
        F.array(*[_text_entry(F.col(f"_d_{p}")) for p in parts]),
    )
    done = F.col("_source").isNotNull() & F.col("_d_decode_error").isNull()
    keep = F.map_filter("data", lambda k, _: ~F.array_contains(F.map_keys(added), k))
    translated = F.transform_values(
        "data",
        lambda k, v: F.when(k == LOGON_FIELD, v.withField("value", logon_type(v["value"]))).otherwise(v),
    )
    data = (
        F.when(done, F.map_concat(keep, added))
        .when(F.col("_source").isNull(), translated)
        .otherwise(F.col("data"))
    )
    return decoded.withColumn("data", data).drop(
        "_source", "_target", "_name", *[f"_d_{p}" for p in parts], "_d_decode_error"
    )


def logon_type(code: Column) -> Column:
    return F.coalesce(_lookup(LOGON_TYPES, code), code)


def impersonation_levels(data: Column | str) -> Column:
    """Translate the codes of all fields whose name ends in IMPERSONATIONLEVEL."""
    return F.transform_values(
        data,
        lambda k, v: F.when(
            k.endswith(LEVEL_SUFFIX),
            v.withField("value", F.coalesce(_lookup(IMPERSONATION_LEVELS, v["value"]), v["value"])),
        ).otherwise(v),
    )


def normalise_ips(data: Column | str) -> Column:
    return F.transform_values(
        data,
        lambda k, v: F.when(v["type"] == TIME_TYPE, v).otherwise(v.withField("value", normalise_ip(v["value"]))),
    )


def typed_times(data: Column | str) -> Column:
    """The time-typed fields as a map of TIMESTAMP; text that does not parse stays NULL."""
    times = F.map_filter(data, lambda _, v: v["type"] == TIME_TYPE)
    return F.transform_values(times, lambda _, v: system_time(v["value"]))


def drop_empty(events: DataFrame) -> DataFrame:
    return events.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in OMITTED_WHEN_EMPTY})


def computer_parts(
    events: DataFrame,
    pattern: str | dict[int, str],
    codes: DataFrame,
    groups: Sequence[str] = ("code", "site", "number"),
    version: int = 1,
) -> DataFrame:
    """Decode ``computer``; a failure makes the row a reject through ``error``."""
    out = decode_name(events, "computer", pattern, codes, groups, version, prefix="computer_")
    error = F.concat(F.lit("computer: "), F.col("computer_decode_error"))
    return out.withColumn("error", F.coalesce("error", error) if "error" in out.columns else error)


def tag_origin(
    logs: DataFrame,
    reference: str,
    pattern: str | dict[int, str],
    codes: DataFrame,
    path: str = "path",
    groups: Sequence[str] = ("code", "site", "number"),
    version: int = 1,
) -> DataFrame:
    """Add ``reference`` and ``sensor``, the parts of the log file's name joined by dots.

    A name that does not decode leaves ``sensor`` NULL and says why in ``decode_error``.
    """
    out = decode_name(logs, path, pattern, codes, groups, version)
    sensor = F.when(F.col("decode_error").isNull(), F.concat_ws(".", *groups))
    tagged = out.withColumns({"reference": F.lit(reference), "sensor": sensor})
    return tagged.drop(*groups, "code_description")


def event_row_key(uid: Column) -> Column:
    return F.concat_ws(
        "|", F.col("event_id").cast("string"), "computer", F.col("record_id").cast("string"), uid
    )


def typed_events(
    events: DataFrame,
    event_names: DataFrame,
    pattern: str | dict[int, str],
    codes: DataFrame,
    **naming,
) -> DataFrame:
    """The whole chain from decoded fields to stored events; rejects keep their ``error``."""
    out = residual_fields(typed_fields(events))
    out = describe_events(out, event_names)
    out = enrich_chain(out, pattern, codes, **naming)
    out = computer_parts(out, pattern, codes, **naming)
    out = out.withColumn("data", normalise_ips("data"))
    return drop_empty(out).drop("fields")


# Labels of the text report, in print order; None is an empty line.
REPORT_LINES = (
    ("Event Record # : ", "record_id"),
    ("Timestamp      : ", "ts"),
    ("Computer       : ", "computer"),
    ("    Version    : ", "version"),
    ("    Level      : ", "level"),
    ("    Task       : ", "task"),
    ("    Channel    : ", "channel"),
    ("Provider GUID  : ", "provider_guid"),
    ("Provider Name  : ", "provider_name"),
    ("", None),
    ("Event ID       : ", "event_id"),
    ("    description: ", "description"),
    ("    Qualifiers : ", "qualifiers"),
    ("    Op Code    : ", "opcode"),
    ("    Keywords   : ", "keywords"),
    ("    Process ID : ", "process_id"),
    ("    Thread ID  : ", "thread_id"),
    ("", None),
    ("Correlation    :", None),
    ("    Activity ID: ", "activity_id"),
    ("    Related  ID: ", "related_activity_id"),
    ("", None),
    ("Security       :", None),
    ("    User ID    : ", "user_id"),
    ("", None),
    ("Event Data     :", None),
    ("", None),
)


def event_report() -> Column:
    """Text rendering of an event. Open fields follow in name order, for maps have none."""

    def line(label: str, column: str | None) -> Column:
        if column is None:
            return F.lit(label)
        value = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") if column == "ts" else F.col(column)
        return F.concat(F.lit(label), F.coalesce(value.cast("string"), F.lit("")))

    entries = F.array_sort(F.map_entries(impersonation_levels("data")))
    fields = F.transform(
        entries, lambda e: F.concat(e["key"], F.lit(" : "), e["value"]["value"], F.lit(" -- "), e["value"]["type"])
    )
    head = F.array(*[line(*spec) for spec in REPORT_LINES])
    return F.concat(F.array_join(F.concat(head, fields), "\n"), F.lit("\n"))
