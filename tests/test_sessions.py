"""Sessions against a packet-by-packet fold: splits, orientation, states, work division."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowloom.operators import flows, max_span
from flowloom.operators.max_span import split_sessions
from flowloom.operators.packets import packet_row_key, with_optional_columns
from flowloom.operators.sessions import KEY, cut_pieces, fill_key, flow_key, order_packets
from reference_fold import sessions, summary_rows

SCHEMA = (
    "frame_no long, ts_ns long, reference string, sensor string, ip_version string, protocol string, "
    "id_orig_h string, id_resp_h string, id_orig_p int, id_resp_p int, syn boolean, ack boolean, "
    "fin boolean, rst boolean, seq_num long, ack_num long, bytes long"
)
START = 1_704_067_200_000_000_000
COLUMNS = [
    "id_orig_h", "id_orig_p", "id_resp_h", "id_resp_p", "ts_ns", "ts_end_ns", "conn_state",
    "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes",
]


def packet(n, ts_ns, src=("a", 1000), dst=("b", 80), flags="A", seq=1, ackn=1, size=10):
    return {
        "frame_no": n, "ts_ns": ts_ns, "reference": "r", "sensor": "s", "ip_version": "ipv4", "protocol": "tcp",
        "id_orig_h": src[0], "id_resp_h": dst[0], "id_orig_p": src[1], "id_resp_p": dst[1],
        "syn": "S" in flags, "ack": "A" in flags, "fin": "F" in flags, "rst": "R" in flags,
        "seq_num": seq, "ack_num": ackn, "bytes": size,
    }


def random_packets(seed, n=1500):
    """A third of all packets in one flow, equal ports, equal times, all flag mixes."""
    rng = random.Random(seed)
    ends = [("a", 5000), ("b", 5000), ("c", 80), ("d", 443), ("a", 6000), ("e", 5000)]
    out, now = [], START
    for i in range(n):
        now += rng.choice([0, 0, 1_000_000, 300_000_000, 700_000_000, 1_999_999_999, 4_000_000_000])
        a, b = ("a", 5000), ("b", 5000)
        if rng.random() > 0.34:
            a, b = rng.sample(ends, 2)
        if rng.random() < 0.5:
            a, b = b, a
        flags = "".join(f for f, p in (("S", 0.06), ("A", 0.7), ("F", 0.08), ("R", 0.08)) if rng.random() < p)
        out.append(packet(i, now, a, b, flags, rng.choice([0, 1, 2, 3]), rng.choice([0, 1, 1, 2]), rng.randrange(100)))
    rng.shuffle(out)
    return out


def frame(spark, packets, parts=3):
    rows = [tuple(p.values()) for p in packets]
    order = list(packets[0])
    return spark.createDataFrame(rows, order_schema(order)).repartition(parts)


def order_schema(names):
    kinds = dict(part.strip().split(" ") for part in SCHEMA.split(", "))
    return ", ".join(f"{n} {kinds[n]}" for n in names)


def spark_rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("slice_ns,max_rows", [(60_000_000_000, None), (1_000_000_000, None), (20_000_000_000, 7)])
def test_idle_sessions_equal_the_fold(spark, seed, slice_ns, max_rows):
    packets = random_packets(seed)
    want = summary_rows(sessions(packets))
    got = flows.summarise_tcp(frame(spark, packets, 1 + seed), slice_ns=slice_ns, max_rows=max_rows)
    assert spark_rows(got) == want


@pytest.mark.parametrize("fan", [64, 2])
@pytest.mark.parametrize("slice_ns,max_rows", [(5_000_000_000, 40), (1_000_000_000, None)])
def test_max_span_equals_the_fold(spark, monkeypatch, fan, slice_ns, max_rows):
    """Slices longer and shorter than the span, tables composed in one round and in many."""
    monkeypatch.setattr(max_span, "FAN", fan)
    packets = random_packets(11)
    want = sessions(packets, max_span_ms=2500)
    pieces = flows.tcp_pieces(frame(spark, packets), slice_ns, max_rows)
    rows = split_sessions(pieces, max_span_ms=2500)
    got = rows.groupBy("host_lo", "port_lo", "host_hi", "port_hi", "session_ts").count().collect()
    counted = {((((r[0], r[1]), (r[2], r[3]))), r[4]): r[5] for r in got}
    assert counted == {k: sum(s["pkts"].values()) for k, s in want.items()}


def test_max_span_flows_equal_the_fold(spark):
    packets = random_packets(12)
    got = flows.summarise_tcp(frame(spark, packets), timeout_ms=1500, slice_ns=5_000_000_000)
    assert spark_rows(got) == summary_rows(sessions(packets, max_span_ms=1500))


@pytest.mark.parametrize("gap,count", [(3_999_999_999, 1), (4_000_000_000, 2)])
def test_idle_boundary(spark, gap, count):
    assert flows.summarise_tcp(frame(spark, [packet(0, START), packet(1, START + gap)])).count() == count


@pytest.mark.parametrize("span_ms,count", [(1000, 1), (1001, 2)])
def test_span_boundary(spark, span_ms, count):
    packets = [packet(0, START), packet(1, START + span_ms * 1_000_000)]
    assert flows.summarise_tcp(frame(spark, packets), timeout_ms=1000).count() == count


C, S = ("c", 4000), ("s", 80)


@pytest.mark.parametrize(
    "script,state",
    [
        ([(C, "S")], "S0"),
        ([(S, "SA")], "S1"),
        ([(C, "A")], "OTH"),
        ([(C, "F")], "OTH"),
        ([(C, "R")], "OTH"),
        ([(C, "S"), (S, "SA")], "S1"),
        ([(C, "S"), (S, "SA"), (C, "FA")], "SF"),
        ([(C, "S"), (S, "SA"), (S, "FA")], "SF"),
        ([(C, "S"), (C, "F")], "SH"),
        ([(C, "S"), (S, "F")], "SF"),
        ([(C, "S"), (S, "R")], "REJ"),
        ([(C, "S"), (C, "R")], "RSTOS0"),
        ([(C, "S"), (S, "SA"), (C, "R")], "RSTO"),
        ([(C, "S"), (S, "SA"), (S, "R")], "RSTR"),
        ([(C, "A"), (S, "R")], "RSTRH"),
        ([(C, "A"), (C, "R")], "OTH"),
        ([(C, "A"), (C, "F")], "SHR"),
        ([(C, "A"), (S, "FR")], "RSTRH"),
        ([(C, "S"), (C, "F"), (S, "R")], "SH"),
        ([(C, "S"), (C, "F"), (C, "S")], "S0"),
    ],
)
def test_state_table(spark, script, state):
    packets = [packet(i, START + i, who, S if who == C else C, flags) for i, (who, flags) in enumerate(script)]
    rows = flows.summarise_tcp(frame(spark, packets)).collect()
    assert [r.conn_state for r in rows] == [state]


def test_a_million_runs_of_one_session(spark):
    """A packet per slice: no array holds more than an epoch's runs, or the epochs of the session."""
    n, slice_ns = 1_000_000, 1_000_000
    rows = spark.range(n).withColumnRenamed("id", "frame_no").withColumns(
        {
            "ts_ns": F.col("frame_no") * slice_ns + START,
            **{c: F.lit(v) for c, v in {"reference": "r", "sensor": "s", "ip_version": "ipv4", "protocol": "tcp"}.items()},
            "id_orig_h": F.when(F.col("frame_no") % 3 == 1, "b").otherwise("a"),
            "id_resp_h": F.when(F.col("frame_no") % 3 == 1, "a").otherwise("b"),
            "id_orig_p": F.lit(7),
            "id_resp_p": F.lit(7),
            "syn": F.col("frame_no").isin(0, 600_001),
            "ack": F.col("frame_no") != 0,
            "fin": F.col("frame_no").isin(500_000, 900_000),
            "rst": F.col("frame_no") == 800_002,
            "seq_num": F.lit(1).cast("long"),
            "ack_num": F.lit(1).cast("long"),
            "bytes": F.lit(10).cast("long"),
        }
    )
    got = flows.summarise_tcp(rows, slice_ns=slice_ns, max_rows=None).collect()
    # The first SYN orients; the second one, answered, reopens what the FIN had closed; then the responder resets.
    assert [(r.id_orig_h, r.conn_state, r.orig_pkts, r.resp_pkts, r.ts_ns, r.ts_end_ns) for r in got] == [
        ("a", "RSTR", 666_667, 333_333, START, START + (n - 1) * slice_ns)
    ]


@pytest.mark.parametrize("seed", range(2))
def test_epochs_change_nothing(spark, seed, monkeypatch):
    monkeypatch.setattr(flows, "EPOCH_SLICES", 2)
    packets = random_packets(20 + seed)
    got = flows.summarise_tcp(frame(spark, packets), slice_ns=1_000_000_000, max_rows=5)
    assert spark_rows(got) == summary_rows(sessions(packets))
    spans = flows.summarise_tcp(frame(spark, packets), timeout_ms=9_000, slice_ns=1_000_000_000)
    assert spark_rows(spans) == summary_rows(sessions(packets, max_span_ms=9_000))


def test_late_orientation_by_numbers(spark):
    a, b = ("a", 7), ("b", 7)
    packets = [packet(0, START, a, b, "A"), packet(1, START + 1, a, b, "", ackn=0), packet(2, START + 2, b, a, "R")]
    row = flows.summarise_tcp(frame(spark, packets)).collect()[0]
    assert (row.id_orig_h, row.conn_state) == ("b", "OTH")


def test_ports_follow_hosts_or_first_packet(spark):
    packets = [packet(0, START, S, C, "SA")]
    oriented = flows.summarise_tcp(frame(spark, packets)).collect()[0]
    assert (oriented.id_orig_h, oriented.id_orig_p, oriented.id_resp_p) == ("c", 4000, 80)
    first = flows.summarise_tcp(frame(spark, packets), ports="first_packet").collect()[0]
    assert (first.id_orig_h, first.id_orig_p, first.id_resp_p) == ("c", 80, 4000)


def test_host_talking_to_itself_is_counted(spark):
    packets = [packet(0, START, ("a", 9), ("a", 10), size=3), packet(1, START + 1, ("a", 10), ("a", 9), size=4)]
    row = flows.summarise_tcp(frame(spark, packets)).collect()[0]
    assert (row.orig_bytes, row.resp_bytes, row.orig_pkts + row.resp_pkts) == (4, 3, 2)


def test_direction_does_not_change_the_key(spark):
    there = flow_key(frame(spark, [packet(0, START, C, S)])).select(*KEY).collect()
    back = flow_key(frame(spark, [packet(0, START, S, C)])).select(*KEY).collect()
    assert there == back


def test_ports_do_not_collide(spark):
    packets = [packet(0, START, ("a", 1), ("b", 23)), packet(1, START, ("a", 12), ("b", 3))]
    assert flows.summarise_tcp(frame(spark, packets)).count() == 2


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_composed_tables_give_the_greedy_starts(width):
    """Starts found through the pieces' tables equal the greedy ones, however many neighbours are composed at once."""
    rng = random.Random(8)
    jump, session, got, want = 50, ["flow", "session_ts"], [], []
    for flow in ("f", "g"):
        times = sorted(rng.sample(range(3000), 400))
        due = times[0]
        for t in times:
            if t >= due:
                want.append((flow, t))
                due = t + jump
        parts = [p for p in ([t for t in times if t // 100 == n] for n in range(30)) if p]
        pieces = [pa.table({"flow": [flow] * len(p), "slice": [p[0] // 100] * len(p), "session_ts": [times[0]] * len(p), "pos": [i] * len(p), "ts_ns": p}) for i, p in enumerate(parts)]
        tables = [max_span._reach(jump, session)(p) for p in pieces]
        groups = [pa.concat_tables(tables[i : i + width]) for i in range(0, len(tables), width)]
        upper = pa.concat_tables([max_span._compose(session)(g) for g in groups])
        upper = upper.set_column(upper.column_names.index("pos"), "pos", pa.array(range(len(upper))))
        entries = max_span._hand_down(session)(upper.append_column("due", pa.array([times[0]] * len(upper))))
        for group, due in zip(groups, entries["due"].to_pylist(), strict=True):
            dues = max_span._hand_down(session)(group.append_column("due", pa.array([due] * len(group))))
            for pos, entry in zip(dues["pos"].to_pylist(), dues["due"].to_pylist(), strict=True):
                rows = pieces[pos].append_column("due", pa.array([entry] * len(pieces[pos])))
                got += [(flow, t) for t in max_span._list_starts(jump, ["flow", "slice"])(rows)["start_ts"].to_pylist()]
    assert sorted(got) == sorted(want)


def test_positions_do_not_depend_on_pieces(spark):
    keyed = fill_key(flow_key(frame(spark, random_packets(3))))
    placed = [
        {r.frame_no: r.position for r in order_packets(cut_pieces(keyed, KEY, width, rows)).collect()}
        for width, rows in ((60_000_000_000, None), (3_000_000_000, 5))
    ]
    assert placed[0] == placed[1]


def test_single_packet_flow_has_no_statistics(spark):
    packets = [packet(0, START), packet(1, START, ("x", 1), ("y", 2)), packet(2, START + 5, ("x", 1), ("y", 2), seq=9, size=30)]
    rows = flows.flow_stats(frame(spark, packets)).orderBy("host_lo").collect()
    assert rows[0].bytes_mean is None
    assert (rows[1].bytes_min, rows[1].bytes_median, rows[1].bytes_max, rows[1].bytes_std_dev) == (10, 20, 30, 10)


def test_busy_flow_is_cut_into_bounded_pieces(spark):
    packets = [packet(i, START + i * 1_000_000) for i in range(3000)]
    pieces = flows.tcp_pieces(frame(spark, packets), max_rows=100)
    largest = pieces.groupBy(*KEY, "slice").count().agg(F.max("count")).first()[0]
    assert largest <= 100


def test_copies_are_dropped_per_direction(spark):
    packets = [
        packet(0, START, seq=5), packet(1, START + 10, seq=5), packet(2, START + 20, S, ("a", 1000), seq=5),
        packet(3, START + 20, ("a", 1000), S, seq=6),
    ]
    for p in packets:
        p["id_resp_h"], p["id_orig_h"] = p["id_resp_h"].replace("b", "s"), p["id_orig_h"]
    rows = split_sessions(flows.tcp_pieces(frame(spark, packets)))
    kept = flows.drop_duplicates_per_direction(rows).select("frame_no").collect()
    assert sorted(r.frame_no for r in kept) == [0, 2, 3]


def test_rotated_files_fold_in_one_order(spark):
    """Frames of equal time and number in two files and two members give one result, however the rows are spread."""
    flags = ["S", "SA", "A", "FA", "R", "A"]
    packets = [packet(i % 3, START + (i // 4) * 10**8, flags=flags[i % 6], size=i) for i in range(24)]
    df = frame(spark, packets, 1).withColumn("n", F.monotonically_increasing_id())
    df = df.withColumns({"source_file": F.concat(F.lit("f"), F.col("n") % 2), "member": F.when(F.col("n") % 5 > 0, (F.col("n") % 5).cast("string"))})
    results = {
        str(sorted(map(str, flows.summarise_tcp(df.orderBy(F.rand(seed)).repartition(1 + seed)).collect()))) for seed in range(3)
    }
    assert len(results) == 1


def test_keys_tell_members_and_endpoints_apart(spark):
    df = frame(spark, [packet(0, START), packet(0, START)], 1).withColumn("n", F.monotonically_increasing_id())
    df = df.withColumns({"source_file": F.lit("a.tar|5"), "member": F.concat(F.lit("m"), F.col("n"))})
    assert with_optional_columns(df).select(packet_row_key()).distinct().count() == 2
    ends = [(None, "x", 1, None), ("x", None, None, 1), ("x", "y", None, 1), ("x", "y", 1, None)]
    same = spark.createDataFrame([("r", "s", "tcp", *e, 0, 5) for e in ends],
        "reference string, sensor string, protocol string, id_orig_h string, id_resp_h string, id_orig_p int, id_resp_p int, first_frame long, ts_ns long")
    assert same.select(flows.flow_uid()).distinct().count() == 4
