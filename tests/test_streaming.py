"""Streams give what the batch gives, however the input is divided into micro-batches."""

import gzip
import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from flowloom.operators import flows
from flowloom.operators.cells import packet_cells, packet_table, write_stream
from flowloom.operators.events import tag_origin, typed_fields
from flowloom.operators.metrics import event_metrics, rollup_metrics
from flowloom.operators.quality import ingest_counts
from flowloom.operators.sessions import IDLE_S
from flowloom.plans.captures import log_file
from flowloom.plans.stream_queries import QUERIES
from flowloom.sources.files import _kind
from flowloom.streaming.counts import read_counts, write_counts
from flowloom.streaming.flows import stream_flows
from flowloom.streaming.ingest import parse_sources, read_digests, stream_captures, stream_directory, stream_event_logs, write_digests
from flowloom.streaming.metrics import stream_metrics, stream_metrics_idle
from flowloom.streaming.routing import read_routed, replace_parts, write_batch, write_routed, written
from flowloom.streaming.sessions import stream_counters, stream_sessions
from test_sessions import COLUMNS, START, frame, packet, random_packets, spark_rows
from test_sources import CAPTURE, EVENT, NAMES, capture, ether, ipv4, tcp, udp, zipped

MINUTE = 60 * 10**9


def arrivals(spark, df, folder, order, batches):
    """The rows as one file per micro-batch, in the given order; returns a stream over them."""
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // batches)
    for i in range(batches):
        part = rows[i * size : (i + 1) * size]
        spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.02)  # file times give the order
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drain(stream, folder):
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(f"{folder}/out")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def with_late_flow(packets):
    """A last packet far in the future lets the watermark close everything before it."""
    return packets + [packet(10**6, max(p["ts_ns"] for p in packets) + 3600 * 10**9, ("z", 1), ("y", 2))]


@pytest.mark.parametrize("batches", [1, 5])
@pytest.mark.parametrize("timeout_ms", [None, 2000])
def test_sessions_equal_batch(spark, tmp_path, batches, timeout_ms):
    df = frame(spark, with_late_flow(random_packets(21, 400)), 1)
    want = [r for r in spark_rows(flows.summarise_tcp(df, timeout_ms)) if r[0] != "y"]
    stream = arrivals(spark, df, tmp_path / "in", ["ts_ns", "frame_no"], batches)
    got = spark_rows(drain(stream_sessions(stream, timeout_ms), tmp_path).select(COLUMNS))
    assert got == want


def test_late_packets_are_counted_and_time_never_falls(spark, tmp_path):
    at = lambda i, seconds: packet(i, START + seconds * 10**9)
    df = frame(spark, with_late_flow([at(1, 10), at(2, 12), at(3, 9), at(4, 13)]), 1)
    stream = arrivals(spark, df, tmp_path / "in", ["frame_no"], 5)  # one packet each, the third too late
    rows = drain(stream_sessions(stream, delay="1 minute"), tmp_path).filter("id_orig_h <> 'z' and id_orig_h <> 'y'").collect()
    assert [(r.ts_ns - START, r.ts_end_ns - START, r.orig_pkts + r.resp_pkts, r.late_pkts) for r in rows] == [
        (10 * 10**9, 13 * 10**9, 3, 1)
    ]


@pytest.mark.parametrize("name", ["d9_stream_sessions", "d9_stream_counters", "e6_stream_metrics"])
def test_streams_read_folder_tables(spark, tmp_path, name):
    from flowloom.plans.registry import collect

    single = "/root/testdata/sf0.001"
    spark.read.parquet(f"{single}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    query = collect()[0][name]
    want, got = (sorted(map(str, query(spark, d).collect())) for d in (single, str(tmp_path)))
    assert got == want and want


def test_counters_equal_batch(spark, tmp_path):
    df = frame(spark, with_late_flow(random_packets(22, 400)), 1)
    # Native session windows count microseconds.
    df = df.withColumn("ts_ns", F.expr("ts_ns div 1000 * 1000"))
    want = flows.tcp_sessions(_runs(df)).filter("host_lo <> 'y'")
    names = ["host_lo", "port_lo", "host_hi", "port_hi", "session_ts", "last_ts", "lo_pkts", "hi_pkts", "lo_bytes", "hi_bytes"]
    got = drain(stream_counters(arrivals(spark, df, tmp_path / "in", ["ts_ns", "frame_no"], 3)), tmp_path)
    rows = [sorted(tuple(r) for r in x.select(names).collect()) for x in (got, want)]
    assert rows[0] == rows[1]


def _runs(df):
    from flowloom.operators.sessions import KEY, with_runs

    return flows.idle_epochs(flows._run_summaries(with_runs(flows.tcp_pieces(df), KEY, IDLE_S), [*KEY, "slice", "run"]))


def test_silent_sessions_close_by_wall_clock(spark, tmp_path):
    df = frame(spark, [packet(0, START), packet(1, START + 10)], 1)
    stream = arrivals(spark, df, tmp_path / "in", ["ts_ns"], 1)
    sessions = stream_sessions(stream, idle_s=1, clock="wall")
    query = (
        sessions.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="500 milliseconds").start(f"{tmp_path}/out")
    )
    until = time.time() + 60
    rows = []
    while not rows and time.time() < until:
        time.sleep(1)
        rows = spark.read.schema(sessions.schema).parquet(f"{tmp_path}/out").collect() if (tmp_path / "out").exists() else []
    query.stop()
    assert [(r.orig_pkts, r.conn_state) for r in rows] == [(2, "OTH")]


_FLOW = ["protocol", "id_orig_h", "id_resp_h", "id_orig_p", "id_resp_p", "ts_ns", "ts_end_ns", "first_frame", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes"]


def untimed_packets(seed, n=500):
    """Random packets as UDP, ICMP or plain IP by their endpoints, a third of them in one UDP flow, with silent times."""
    made = random_packets(seed, n)
    for p in made:
        kind = ("udp", "udp", "icmp", "gre")[(ord(p["id_orig_h"]) + ord(p["id_resp_h"])) % 4] if {p["id_orig_h"], p["id_resp_h"]} != {"a", "b"} else "udp"
        p |= {"protocol": kind, "icmp_type_number": 8 if kind == "icmp" else None, "icmp_type": ("echo reply" if p["syn"] else "echo") if kind == "icmp" else None}
        if kind != "udp":
            p |= {"id_orig_p": None, "id_resp_p": None}
    return made


def folded_flows(packets, timeout_ms, idle_ns=5 * 10**9):
    """Flows packet by packet: a silence cuts, and so does the second in which the span is exceeded."""
    by_key, out = {}, []
    for p in sorted(packets, key=lambda p: (p["ts_ns"], p["frame_no"])):
        ends = sorted([(p["id_orig_h"], p["id_orig_p"] or 0), (p["id_resp_h"], p["id_resp_p"] or 0)])
        by_key.setdefault((p["protocol"], *ends), []).append(p)
    for group in by_key.values():
        flow, over = [], None
        for p in group:
            second = p["ts_ns"] // 10**9
            if flow and (p["ts_ns"] - flow[-1]["ts_ns"] >= idle_ns or (over is not None and second > over)):
                out.append(flow)
                flow, over = [], None
            flow.append(p)
            if timeout_ms is not None and over is None and (p["ts_ns"] - flow[0]["ts_ns"]) // 10**6 > timeout_ms:
                over = second
        out.append(flow)
    rows = []
    for flow in out:
        f = flow[0]
        swap = f["id_orig_p"] < f["id_resp_p"] if f["protocol"] == "udp" else f["icmp_type"] == "echo reply"
        a, b = ("resp", "orig") if swap else ("orig", "resp")
        sent = [p for p in flow if (p["id_orig_h"], p["id_orig_p"]) == (f[f"id_{a}_h"], f[f"id_{a}_p"])]
        back = [p for p in flow if not any(p is q for q in sent)]
        ports = [f[f"id_{a}_p"], f[f"id_{b}_p"]]
        sums = [len(sent), len(back), sum(p["bytes"] for p in sent), sum(p["bytes"] for p in back)]
        rows.append((f["protocol"], f[f"id_{a}_h"], f[f"id_{b}_h"], *ports, f["ts_ns"], flow[-1]["ts_ns"], f["frame_no"], *sums))
    return sorted(map(str, rows))


@pytest.mark.parametrize("batches", [1, 4])
@pytest.mark.parametrize("timeout_ms", [None, 2500])
def test_flows_of_other_protocols_equal_the_fold(spark, tmp_path, batches, timeout_ms):
    packets = [p for p in untimed_packets(31) if p["id_orig_h"] != p["id_resp_h"]]
    packets = [p | {"ts_ns": p["ts_ns"] // 1000 * 1000} for p in packets]  # native session windows count microseconds
    late = packet(10**6, max(p["ts_ns"] for p in packets) + 3600 * 10**9, ("z", 9), ("y", 9))
    late |= {"protocol": "udp", "icmp_type_number": None, "icmp_type": None}
    rows = [tuple(p.values()) for p in [*packets, late]]
    kinds = frame(spark, [packet(1, START)]).schema.simpleString()[7:-1].replace(":", " ")
    df = spark.createDataFrame(rows, f"{kinds}, icmp_type_number int, icmp_type string")
    stream = arrivals(spark, df, tmp_path / "in", ["ts_ns", "frame_no"], batches)
    got = drain(stream_flows(stream, timeout_ms), tmp_path).filter("id_orig_h not in ('y', 'z')")
    assert sorted(str(tuple(r)) for r in got.select(_FLOW).collect()) == folded_flows(packets, timeout_ms)


def points(spark, n=400):
    df = spark.range(n).select(
        (F.lit(START) + F.col("id") * 7 * 10**9).alias("ts_ns"), F.lit("r").alias("reference"), F.lit("s").alias("sensor"),
        (F.col("id") % 3).cast("int").alias("event_id"),
    )
    return df


def test_metrics_equal_batch(spark, tmp_path):
    df = points(spark)
    want = rollup_metrics(event_metrics(df), ["count"], order="ts_ns")
    # Points carry bucket starts, so the watermark follows the newest bucket.
    end = (START + 399 * 7 * 10**9) // MINUTE * MINUTE - 70 * 10**9
    want = want.filter(F.col("ts_ns") + MINUTE <= end)
    stream = event_metrics(arrivals(spark, df, tmp_path / "in", "ts_ns", 4))
    got = drain(stream_metrics(stream, ["count"]), tmp_path)
    rows = [sorted((r.ts_ns, r.tag_value, r["count"]) for r in x.collect()) for x in (got, want)]
    assert rows[0] == rows[1] and rows[0]


def test_idle_points_are_flushed_by_wall_clock(spark, tmp_path):
    stream = event_metrics(arrivals(spark, points(spark, 30), tmp_path / "in", "ts_ns", 1), unit="days")
    flushed = stream_metrics_idle(stream, ["count"], idle_ms=1000)
    query = (
        flushed.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="500 milliseconds").start(f"{tmp_path}/out")
    )
    until, rows = time.time() + 60, []
    while len(rows) < 3 and time.time() < until:
        time.sleep(1)
        rows = spark.read.schema(flushed.schema).parquet(f"{tmp_path}/out").collect() if (tmp_path / "out").exists() else []
    query.stop()
    assert sorted((r.tag_value, r["count"]) for r in rows) == [("0", 10.0), ("1", 10.0), ("2", 10.0)]


def test_routed_batches_are_written_once(spark, tmp_path):
    """Several tables from one stream; a replayed batch changes nothing, one that is not in the log is not read."""
    df = frame(spark, random_packets(31, 300), 1).withColumns({"psh": F.lit(False), "urg": F.lit(False)}).withColumn("reference", F.when(F.col("frame_no") % 3 == 0, "a:b").otherwise("2024"))
    folder = str(tmp_path / "tables")
    cells = packet_cells(arrivals(spark, df, tmp_path / "in", ["ts_ns", "frame_no"], 4), table=packet_table())
    write_routed(cells, folder, f"{tmp_path}/cp", "live").awaitTermination()
    want = sorted(map(tuple, packet_cells(df, table=packet_table()).collect()))
    stored = lambda: sorted(map(tuple, read_routed(spark, folder).select("table", "row_key", "family", "qualifier", "value", "cell_ts").collect()))
    assert stored() == want
    assert {(r.table, r.batches) for r in written(spark, folder).collect()} == {("a:b-packets", 4), ("2024-packets", 4)}
    # The same files once more from a new checkpoint, as if the first one's last commit had been lost.
    again = packet_cells(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), table=packet_table())
    write_routed(again, folder, f"{tmp_path}/cp2", "live").awaitTermination()
    assert stored() == want
    batch = packet_cells(df.limit(5), table=packet_table())
    with pytest.raises(Exception, match="no table"):
        write_batch(batch.withColumn("table", F.lit(None).cast("string")), folder, "bad")
    # Data without a log entry, of a try that failed half-way.
    extra = batch.select("table", F.lit("2024-01-01").cast("date").alias("date"), F.lit("half").alias("batch"), "row_key", "family", "qualifier", "value", "cell_ts")
    replace_parts(extra, f"{folder}/data", ["table", "date", "batch"])
    assert stored() == want
    assert read_routed(spark, folder, "a:b-packets").count() == sum(r[0] == "a:b-packets" for r in want)
    write_batch(batch.limit(0), folder, "empty")
    assert stored() == want


def test_stream_counts_equal_batch_and_replays_count_once(spark, tmp_path):
    df = spark.range(90).select(
        F.concat(F.lit("f"), (F.col("id") % 4).cast("string")).alias("source_file"), F.when(F.col("id") % 7 == 0, "broken").alias("error"), "id"
    )
    stream = arrivals(spark, df, tmp_path / "in", ["id"], 5)
    for checkpoint in ("cp", "cp2"):  # the second run replays every batch
        write_counts(stream, f"{tmp_path}/counts", f"{tmp_path}/{checkpoint}", "x").awaitTermination()
    assert sorted(map(tuple, read_counts(spark, f"{tmp_path}/counts").collect())) == sorted(map(tuple, ingest_counts(df).collect()))


def test_watched_directory_to_stored_packets(spark, tmp_path):
    """Captures arriving in two polls, plain and packed, end as partitioned packet files."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "ab-01-000001.pcap").write_bytes(CAPTURE)

    def poll():
        packets = stream_captures(spark, f"{inbox}|lab", NAMES).filter("error is null")
        write_stream(packets.drop("ts"), f"{tmp_path}/packets", f"{tmp_path}/cp").awaitTermination()

    poll()
    later = capture([(86_400 * 3, 0, ether(ipv4(6, tcp(2)))), (86_400 * 3, 1, ether(ipv4(17, udp())))])
    (inbox / "cd-02-000002.zip").write_bytes(zipped([("x.pcap", later)]))
    poll()
    rows = spark.read.parquet(f"{tmp_path}/packets").orderBy("ts_ns").collect()
    assert [(r.sensor, r.reference, r.protocol, str(r.date)) for r in rows] == [
        ("ab-01", "lab", "tcp", "1970-01-01"), ("cd-02", "lab", "tcp", "1970-01-04"), ("cd-02", "lab", "udp", "1970-01-04"),
    ]


def test_directory_stream_takes_each_file_once(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for i in range(5):
        (inbox / f"{i}.pcap").write_bytes(CAPTURE)
    (inbox / "note.txt").write_bytes(b"no")
    stream = stream_directory(spark, str(inbox), glob="*.pcap", max_files=2).select("path", "length")
    assert drain(stream, tmp_path).count() == 5
    assert drain(stream, tmp_path).count() == 5


def _odd_files() -> dict[str, bytes]:
    """Contents with marks, line ends of all kinds, bytes that are no text, and signatures."""
    mark, mixed = b"\xef\xbb\xbf", bytes(range(256)) * 40
    return {
        "plain a.x": mixed, "ends.x": mixed + b"\n", "two ends.x": mixed + b"\r\n\n\n", "marked.x": mark + mixed, "marked ends.x": mark + mixed + b"\n",
        "ends only.x": b"\n" * 900, "mark only.x": mark, "double mark.x": mark + mark + b"\n", "returns.x": b"\r\r\n\r" * 300, "no ends.x": b"\0" * 5000,
        "log%20[1].x": bytes.fromhex("456c6646696c6500") + mixed, "tar.x": b"a" * 200 + b"\n" * 57 + b"ustar" + mixed, "packed.x.gz": gzip.compress(mixed), "empty.x": b"",
    }


@pytest.mark.parametrize("largest", [2**31 - 1, 4])
def test_digests_of_files_by_row_and_by_range(spark, tmp_path, monkeypatch, largest):
    """Files larger than a row may hold are read by small ranges; a packed name is not unpacked."""
    inbox = tmp_path / "in" / "day=1"
    inbox.mkdir(parents=True)
    contents = _odd_files()
    for name, content in contents.items():
        (inbox / name).write_bytes(content)
    monkeypatch.setattr("flowloom.sources.files.WHOLE_BYTES", largest)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    try:
        write_digests(stream_directory(spark, str(tmp_path / "in"), max_files=5), f"{tmp_path}/d", f"{tmp_path}/cp", "in").awaitTermination()
        rows = read_digests(spark, f"{tmp_path}/d").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {os.path.basename(r.path): (r.length, r.file_type, r.digest) for r in rows}
    assert len(rows) == len(got)
    assert got == {n: (len(c), _kind(c[:512]), hashlib.sha256(c).hexdigest()) for n, c in contents.items() if c}
    assert [got[n][1] for n in ("log%20[1].x", "tar.x", "packed.x.gz")] == ["evtx", "tar", "gzip"]


def test_table_file_larger_than_a_row_is_digested(spark, tmp_path):
    """The reader of whole files ends at a size, the query does not."""
    spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("s")).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    (file,) = (tmp_path / "t.parquet").glob("*.parquet")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 1 << 20)
    try:
        rows = QUERIES["a8_stream_directory"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    content = file.read_bytes()
    assert len(content) > 1 << 20
    assert [tuple(r) for r in rows] == [(file.name, len(content), "unsupported", hashlib.sha256(content).hexdigest())]


def test_source_config():
    assert parse_sources("/a|x, /b|y") == [("/a", "x"), ("/b", "y")]
    for wrong in ("/a", "/a|", "/a|b|c"):
        with pytest.raises(ValueError):
            parse_sources(wrong)



def test_event_logs_stream_to_typed_events(spark, tmp_path):
    """Logs in containers, a cut one and a broken container, in two micro-batches."""
    inbox = tmp_path / "logs"
    inbox.mkdir()
    (inbox / "xy-07-000001.zip").write_bytes(zipped([("a.evtx", log_file([(i, EVENT) for i in range(30)])), ("notes", b"n")]))
    (inbox / "xy-08-000002.evtx").write_bytes(log_file([(i, EVENT) for i in range(5)])[: 4096 + 3000])
    (inbox / "xy-09-000003.gz").write_bytes(b"\x1f\x8b\x08 broken")
    records = drain(stream_event_logs(spark, f"{inbox}|lab", NAMES, max_files=1), tmp_path)
    good = typed_fields(records.filter("error is null").drop("error")).filter("error is null")
    assert good.filter("sensor = 'xy-07'").count() == 30
    assert {(r.reference, r.event_id) for r in good.select("reference", "event_id").distinct().collect()} == {("lab", 4624)}
    errors = [(r.sensor, r.error) for r in records.filter("error is not null").collect()]
    assert ("xy-08", "truncated chunk") in errors and any(s == "xy-09" for s, _ in errors)


def test_origin_of_a_log(spark):
    logs = spark.createDataFrame([("/in/AB.north.7.evtx",), ("/in/zz.north.7.evtx",), ("odd",)], "path string")
    codes = spark.createDataFrame([("ab", "desk"), ("ab", "another")], "code string, description string")
    rows = tag_origin(logs, "lab", r"([A-Z]{2})\.([A-Z]+)\.([0-9]+)\.EVTX", codes).orderBy("path").collect()
    assert [(r.reference, r.sensor, r.decode_error) for r in rows] == [
        ("lab", "AB.NORTH.7", None), ("lab", None, "unknown code"), ("lab", None, "name does not match"),
    ]
