"""Encodings, cells, storage, events, metrics and domains on small hand-made rows."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from flowloom.functions import columns as fc
from flowloom.functions import encode
from flowloom.operators import cells, domains, events, metrics, packets, quality
from test_sessions import START, frame, packet


def one(spark, *expressions):
    return spark.range(1).select(*expressions).first()


# --- encodings and columns --------------------------------------------------------------


def test_float32_equals_struct(spark):
    rng = random.Random(5)
    values = [0.0, -0.0, 1.0, -1.0, 0.1, 1e-38, 1e-45, 1e-40, 3.4e38, 2.0**24 + 1, 1 / 3, float("inf"), float("-inf")]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-44, 38) for _ in range(2000)]
    values += [2.0**e for e in range(-149, 128)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", encode.float32("v").alias("b")).collect()
    wrong = [r.v for r in rows if bytes(r.b) != struct.pack(">f", r.v) and r.v != 0]
    assert wrong == []


@pytest.mark.parametrize("value", [0, 1, -1, 2**31 - 1, -(2**31)])
def test_integers_equal_struct(spark, value):
    row = one(spark, encode.int32(F.lit(value)), encode.int64(F.lit(value)))
    assert (bytes(row[0]), bytes(row[1])) == (struct.pack(">i", value), struct.pack(">q", value))


def test_instant(spark):
    row = one(spark, encode.instant(F.lit(START + 123_456_789)))
    assert bytes(row[0]) == struct.pack(">qi", (START + 123_456_789) // 10**6, 123_456_789)


def test_names_flags_and_ips(spark):
    row = one(
        spark,
        fc.normalise_name(F.lit("HTTP  over\tTLS")),
        fc.flag_string({n: F.lit(n in ("ack", "fin")) for n, _ in fc.FLAG_LETTERS}),
        fc.normalise_ip(F.lit("::1")),
        fc.normalise_ip(F.lit("from ::ffff:10.1.2.3 port")),
        fc.normalise_ip(F.lit("fe80::1")),
        fc.sorted_pair(F.lit(9), F.lit(10)),
    )
    assert list(row) == ["http_over_tls", " A   F", "127.0.0.1", "10.1.2.3", "fe80::1", "910"]


def test_uid_is_repeatable(spark):
    assert one(spark, fc.stable_uid(F.lit("f"), F.lit(3)))[0] == one(spark, fc.stable_uid(F.lit("f"), F.lit(3)))[0]


# --- cells and storage ------------------------------------------------------------------


def test_packet_cells(spark):
    rows = frame(spark, [packet(7, START + 5, flags="SA", size=12)]).withColumn("source_file", F.lit("f|1"))
    rows = rows.withColumns({"psh": F.lit(False), "urg": F.lit(False), "data": F.lit(b"raw")})
    found = {(r.family, r.qualifier): bytes(r.value) for r in cells.packet_cells(rows).collect()}
    assert found["PLD", "PACKET"] == b"raw"
    assert found["PM", "FLAGS"] == b" A  S "
    assert found["PM", "BYTES"] == struct.pack(">f", 12)
    assert found["PM", "ID_ORIG_P"] == struct.pack(">i", 1000)
    assert found["PM", "TS"] == struct.pack(">qi", START // 10**6, 5)
    assert ("PM", "ID_ICMP_TYPE") not in found


def test_later_write_wins(spark):
    df = spark.createDataFrame([("k", "f", "q", 1, "old", 1), ("k", "f", "q", 1, "new", 2), ("k", "f", "q", 2, "x", 1)],
                               "row_key string, family string, qualifier string, cell_ts long, value string, n int")
    rows = cells.upsert_latest(df, "n").orderBy("cell_ts").collect()
    assert [(r.cell_ts, r.value) for r in rows] == [(1, "new"), (2, "x")]


def test_written_records_are_partitioned(spark, tmp_path):
    df = frame(spark, [packet(0, START), packet(1, START + 86_400 * 10**9)])
    cells.write_records(df, str(tmp_path / "p"))
    assert sorted(p.name for p in (tmp_path / "p" / "reference=r").iterdir()) == ["date=2024-01-01", "date=2024-01-02"]
    pruned = spark.read.parquet(str(tmp_path / "p")).filter("date = date'2024-01-02'")
    assert [r.frame_no for r in pruned.collect()] == [1]


# --- events -----------------------------------------------------------------------------

CODES = [("BOX", "a machine"), ("USR", "a person")]
PATTERNS = {1: r"(BOX|USR|OLD)-([0-9]+)([A-Z]+)", 2: r"(USR)_([0-9])([A-Z]+)"}


def event(spark, **fields):
    kinds = {"EVENTDATA_WHEN": "SystemtimeTypeNode"}
    data = {k: (v, kinds.get(k, "WStringTypeNode")) for k, v in fields.items()}
    return spark.createDataFrame([(1, data)], "n int, fields map<string, struct<value: string, type: string>>")


def codes(spark):
    return spark.createDataFrame(CODES, "code string, description string")


def test_absent_fields_have_defaults(spark):
    row = events.typed_fields(event(spark)).first()
    assert (row.event_id, row.provider_name, row.record_id, row.ts, row.error) == (0, "", 0, None, None)


@pytest.mark.parametrize("name", ["SYSTEM_EVENTID", "SYSTEM_TASK", "SYSTEM_EVENTRECORDID", "SYSTEM_TIMECREATED_SYSTEMTIME"])
def test_unusable_fields_reject(spark, name):
    assert events.typed_fields(event(spark, **{name: "x1"})).first().error == f"not convertible: {name}"


def enriched(spark, **fields):
    rows = events.residual_fields(event(spark, **fields))
    return {k: v["value"] for k, v in events.enrich_chain(rows, PATTERNS, codes(spark)).first().data.items()}


def test_enrichment_prefers_the_target_user(spark):
    data = enriched(spark, EVENTDATA_DATA_TARGETUSERNAME="x usr-12ab", EVENTDATA_DATA_SUBJECTUSERNAME="box-1z", EVENTDATA_DATA_LOGONTYPE="3")
    added = {k: v for k, v in data.items() if "USERNAME_" in k}
    assert added == {
        "EVENTDATA_DATA_TARGETUSERNAME_CODE": "USR", "EVENTDATA_DATA_TARGETUSERNAME_SITE": "12",
        "EVENTDATA_DATA_TARGETUSERNAME_NUMBER": "AB", "EVENTDATA_DATA_TARGETUSERNAME_CODE_DESCRIPTION": "a person",
    }
    assert data["EVENTDATA_DATA_LOGONTYPE"] == "3"


def test_workstation_parts_go_under_the_target_user(spark):
    data = enriched(spark, EVENTDATA_DATA_WORKSTATION="box-7q")
    assert data["EVENTDATA_DATA_TARGETUSERNAME_CODE"] == "BOX"


def test_undecodable_name_adds_nothing_and_keeps_the_logon_type(spark):
    for name in ("nobody", "old-1a"):
        data = enriched(spark, EVENTDATA_DATA_TARGETUSERNAME=name, EVENTDATA_DATA_LOGONTYPE="3")
        assert data == {"EVENTDATA_DATA_TARGETUSERNAME": name, "EVENTDATA_DATA_LOGONTYPE": "3"}


@pytest.mark.parametrize("code,text", [("2", "Interactive"), ("11", "CachedInteractive"), ("6", "6")])
def test_logon_type_without_names(spark, code, text):
    assert enriched(spark, EVENTDATA_DATA_LOGONTYPE=code) == {"EVENTDATA_DATA_LOGONTYPE": text}


def test_pattern_versions(spark):
    df = spark.createDataFrame([("usr_5x",), (None,)], "name string")
    rows = events.decode_name(df, "name", PATTERNS, codes(spark), version=2).orderBy(F.col("name").desc_nulls_last()).collect()
    assert (rows[0].code, rows[0].site, rows[0].decode_error) == ("USR", "5", None)
    assert (rows[1].code, rows[1].decode_error) == (None, None)


def test_levels_times_and_ips(spark):
    rows = events.residual_fields(
        event(spark, EVENTDATA_X_IMPERSONATIONLEVEL="%%1833", EVENTDATA_WHEN="2024-01-01 00:00:00.5", EVENTDATA_IP="::ffff:1.2.3.4")
    )
    row = rows.select(
        events.impersonation_levels("data").alias("a"), events.normalise_ips("data").alias("b"), events.typed_times("data").alias("c")
    ).first()
    assert row.a["EVENTDATA_X_IMPERSONATIONLEVEL"]["value"] == "Impersonation"
    assert row.b["EVENTDATA_IP"]["value"] == "1.2.3.4"
    assert list(row.c) == ["EVENTDATA_WHEN"] and row.c["EVENTDATA_WHEN"].microsecond == 500_000


def test_computer_failure_rejects_but_keeps_the_first_reason(spark):
    typed = events.typed_fields(event(spark, SYSTEM_COMPUTER="nobody", SYSTEM_TASK="x"))
    assert events.computer_parts(typed, PATTERNS, codes(spark)).first().error == "not convertible: SYSTEM_TASK"
    typed = events.typed_fields(event(spark, SYSTEM_COMPUTER="nobody"))
    assert events.computer_parts(typed, PATTERNS, codes(spark)).first().error == "computer: name does not match"


def test_last_description_wins(spark):
    names = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "event_id int, description string, rank int")
    rows = events.describe_events(events.typed_fields(event(spark, SYSTEM_EVENTID="1")), names).collect()
    assert [r.description for r in rows] == ["new"]


def test_stored_event_cells(spark):
    names = spark.createDataFrame([(7, "seven", 1)], "event_id int, description string, rank int")
    rows = events.typed_events(
        event(spark, SYSTEM_EVENTID="7", SYSTEM_COMPUTER="box-1a", SYSTEM_TIMECREATED_SYSTEMTIME="2024-01-01 00:00:00.25",
              SYSTEM_CHANNEL="", EVENTDATA_WHEN="2024-01-01 00:00:01", EVENTDATA_IP="::1"),
        names, PATTERNS, codes(spark),
    )
    found = {r.qualifier: bytes(r.value) for r in cells.event_cells(rows, F.lit("k")).collect()}
    assert found["SYSTEM_EVENTID_DESCRIPTION"] == b"seven"
    assert found["EVENTDATA_IP"] == b"127.0.0.1"
    assert found["EVENTDATA_WHEN"] == struct.pack(">qi", START // 10**6 + 1000, 0)
    assert found["SYSTEM_SYSTEMTIME"] == struct.pack(">qi", START // 10**6 + 250, 250_000_000)
    assert "SYSTEM_CHANNEL" not in found and found["SYSTEM_COMPUTER"] == b"box-1a"


def test_counts_and_rejects(spark):
    df = spark.range(10).select(F.lit("f").alias("source_file"), F.col("id").alias("ordinal"), F.when(F.col("id") < 3, "bad").alias("error"))
    assert tuple(quality.ingest_counts(df).first()) == ("f", 10, 7, 3)
    rejects = quality.bad_records(df, "stage", F.lit(b"x"))
    assert rejects.columns == ["source_file", "member", "ordinal", "stage", "reason", "raw"] and rejects.count() == 3


# --- metrics, services, domains ---------------------------------------------------------


def test_other_field_types_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(TypeError):
        metrics.merge_fields(df, ["k"], ["v"], "k")


def test_points_per_protocol(spark):
    df = frame(spark, [packet(0, START + 999_999_999)]).withColumn("service", F.lit("http"))
    rows = metrics.packet_metrics(df).orderBy("measurement").collect()
    assert [(r.measurement, r.tag_value, r.ts_ns, r.packets, r.bytes) for r in rows] == [
        ("ip_version", "ipv4", START, 1.0, 10.0), ("protocol", "tcp", START, 1.0, 10.0), ("service", "http", START, 1.0, 10.0),
    ]


def test_service_of_the_lower_port(spark):
    ports = spark.createDataFrame([(80, "World Wide"), (80, "World Wide"), (5000, "Own")], "port int, service string")
    df = frame(spark, [packet(0, START), packet(1, START, ("a", 80), ("b", 90)), packet(2, START, ("a", 5000), ("b", 5000))])
    rows = packets.service_name(df, ports).orderBy("frame_no").collect()
    assert [r.service for r in rows] == ["world_wide", "world_wide", "own"]


def test_domains(spark):
    rules = [("com", "exact"), ("uk", "exact"), ("co.uk", "exact"), ("ck", "wildcard"), ("www.ck", "exception"), ("a.b.c.d", "exact")]
    rules.append(("p.q.r.s.t.u.v", "exact"))
    hosts = {
        "x.example.com": ("com", "example.com"), "com": ("com", None), "a.b.co.uk": ("co.uk", "b.co.uk"), "q.uk": ("uk", "q.uk"),
        "z.y.x.ck": ("x.ck", "y.x.ck"), "x.ck": ("x.ck", None), "www.ck": ("ck", "www.ck"), "t.www.ck": ("ck", "www.ck"),
        "unknown.zone": ("zone", "unknown.zone"), "e.a.b.c.d": ("a.b.c.d", "e.a.b.c.d"), "ck": ("ck", None),
        "n.o.p.q.r.s.t.u.v": ("p.q.r.s.t.u.v", "o.p.q.r.s.t.u.v"), None: (None, None),
    }
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = domains.registrable_domain(df, "host", spark.createDataFrame(rules, "suffix string, rule string"))
    assert {r.host: (r.suffix, r.domain) for r in found.collect()} == hosts


@pytest.mark.parametrize("text", ["ac", "com.ac", "", "xn--p1ai"])
def test_suffix_hash(spark, text):
    want = 0
    for c in text:
        want = (want * 31 + ord(c)) & 0xFFFFFFFF
    want = want - (1 << 32) if want >= 1 << 31 else want
    assert one(spark, domains.suffix_id(F.lit(text)))[0] == want
