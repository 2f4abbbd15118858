"""Bidirectional flow summaries with connection states.

TCP: rows are shuffled once, by piece (see ``sessions``). Each run of a piece is reduced to
one row holding sums and the few packets that can change the outcome. The runs of a session
within an epoch of slices become a function from what the session brings in to what it is
after them, and these functions are applied in order. Every other protocol is one flow per key and needs only
associative aggregates, so it runs with map-side partial aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.columns import epoch_millis, epoch_seconds, nano_of_second, stable_uid
from flowloom.functions.lineage import shared_table
from flowloom.operators.max_span import split_sessions
from flowloom.operators.packets import protocol_numbers, record_type, with_optional_columns
from flowloom.operators.sessions import (
    IDLE_S,
    KEY,
    MAX_PIECE_ROWS,
    SLICE_NS,
    arrival,
    cut_pieces,
    fill_key,
    flow_key,
    stitch_runs,
    with_runs,
)

# The connection state codes, with descriptions in our own words.
CONN_STATES = {
    "S0": "attempt seen, never answered",
    "S1": "established, still open",
    "SF": "established and closed normally",
    "REJ": "attempt refused by the responder",
    "S2": "established, originator closed its side only",
    "S3": "established, responder closed its side only",
    "RSTO": "established, reset by the originator",
    "RSTR": "established, reset by the responder",
    "RSTOS0": "attempt reset by the originator before any answer",
    "RSTRH": "reset by the responder, opening not seen",
    "SH": "attempt closed by the originator before any answer",
    "SHR": "closed, opening not seen",
    "OTH": "traffic seen in the middle of a connection only",
    "NOTSET": "no state assigned",
}


def seed_orientation(p: Column | None = None) -> Column:
    """TRUE when the packet shows that the lower endpoint is the originator, NULL if unclear."""
    c = (lambda n: p[n]) if p is not None else F.col
    from_lo, sport, dport = c("from_lo"), c("id_orig_p"), c("id_resp_p")
    return (
        F.when(c("syn") & c("ack"), ~from_lo)
        .when(c("syn"), from_lo)
        .when(sport > dport, from_lo)
        .when(sport < dport, ~from_lo)
    )


def later_orientation(p: Column | None = None) -> Column:
    """As :func:`seed_orientation`; packets after the first may also tell by ack = 0 or seq = 0."""
    c = (lambda n: p[n]) if p is not None else F.col
    return F.coalesce(
        seed_orientation(p),
        F.when(c("ack_num") == 0, ~c("from_lo")).when(c("seq_num") == 0, c("from_lo")),
    )


def next_state(state: Column, by_orig: Column, fin: Column, rst: Column) -> Column:
    """State after a packet that carries no SYN; the first matching row of the table wins."""
    s0, s1, oth = state == "S0", state == "S1", state == "OTH"
    return (
        F.when(s0 & by_orig & fin, "SH")
        .when((s0 | s1) & fin, "SF")
        .when(s0 & rst & ~by_orig, "REJ")
        .when(s1 & rst & by_orig, "RSTO")
        .when(s1 & rst & ~by_orig, "RSTR")
        .when(s0 & rst & by_orig, "RSTOS0")
        .when(oth & rst & ~by_orig, "RSTRH")
        .when(oth & fin, "SHR")
        .otherwise(state)
    )


def _syn_state(syn: Column, ack: Column) -> Column:
    return F.when(syn & ack, "S1").when(syn, "S0")


_FIRST = ["ts_ns", "frame_no", "from_lo", "id_orig_h", "id_resp_h", "id_orig_p", "id_resp_p"]
_FIRST += ["syn", "ack", "fin", "rst", "seq_num", "ack_num", "service", "source_file", "ip_version"]


def _run_summaries(rows: DataFrame, run_key: list[str]) -> DataFrame:
    """One row per run. ``rest`` is everything after the run's first packet.

    For the state only four packets of ``rest`` can matter, whatever the state before it:
    the first FIN/RST after the last SYN (``last``), and, when no SYN came at all, the first
    closing packet if the responder is the lower (``end_lo``) or the higher endpoint
    (``end_hi``), or the one shown by the first orienting packet (``end_late``).
    """
    order = Window.partitionBy(*run_key).orderBy("ts_ns", *arrival(rows))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("rn", F.row_number().over(order))
    rest = F.col("rn") > 1
    rows = rows.withColumns(
        {
            "hit": F.when(rest, later_orientation()),
            "opening": F.when(rest, _syn_state(F.col("syn"), F.col("ack"))),
            "closing": rest & ~F.col("syn") & (F.col("fin") | F.col("rst")),
        }
    ).withColumns(
        {
            "known": F.first("hit", ignorenulls=True).over(running),
            "open_state": F.last("opening", ignorenulls=True).over(running),
            "openings": F.count("opening").over(running),
        }
    )
    from_lo, fin, rst, closing = (F.col(n) for n in ("from_lo", "fin", "rst", "closing"))
    packet = F.struct("rn", "from_lo", "fin", "rst")
    latest = F.struct("openings", "closing", (-F.col("rn")).alias("neg_rn"))
    side = F.struct("open_state", "closing", "from_lo", "fin", "rst")
    lo_bytes, hi_bytes = F.when(from_lo, F.col("bytes")), F.when(~from_lo, F.col("bytes"))
    return rows.groupBy(*run_key).agg(
        F.min_by(F.struct(*_FIRST), "rn").alias("head"),
        F.min("ts_ns").alias("first_ts"),
        F.max("ts_ns").alias("last_ts"),
        F.count(lo_bytes).alias("lo_pkts"),
        F.coalesce(F.sum(lo_bytes), F.lit(0)).alias("lo_bytes"),
        F.count(hi_bytes).alias("hi_pkts"),
        F.coalesce(F.sum(hi_bytes), F.lit(0)).alias("hi_bytes"),
        F.min(F.when(F.col("hit").isNotNull(), F.struct("rn", "hit"))).alias("first_hit"),
        F.max_by(side, F.when(rest, latest)).alias("last"),
        F.min(F.when(closing & (fin | from_lo), packet)).alias("end_lo"),
        F.min(F.when(closing & (fin | ~from_lo), packet)).alias("end_hi"),
        F.min(F.when(closing & F.col("known").isNotNull() & (fin | (from_lo != F.col("known"))), packet)).alias("end_late"),
    )


def _after(state: Column, packet: Column, orig_lo: Column) -> Column:
    """State after an optional closing packet."""
    stepped = next_state(state, packet["from_lo"] == orig_lo, packet["fin"], packet["rst"])
    return F.when(packet.isNull(), state).otherwise(stepped)


def _let(value: Column, body) -> Column:
    """Name an intermediate result, so that an expression using it often stays small."""
    return F.transform(F.array(value), body)[0]


#: Slices whose runs are reduced to one row per session before rows of a flow meet.
EPOCH_SLICES = 256
# What a session may bring into a run: no packet yet, or an orientation, known or guessed, and a state. States that no
# FIN or RST changes are all alike there; what comes out as kept is the state that went in.
_KEPT = "*"
_OPEN_STATES = ["S0", "S1", "OTH"]
_SIDES = [(lo, known) for known in (False, True) for lo in (False, True)]


def _session(orig_lo: bool | None, known: bool, state: str | None) -> Column:
    return F.struct(
        F.lit(orig_lo).cast("boolean").alias("orig_lo"), F.lit(known).alias("known"), F.lit(state).cast("string").alias("state")
    )


def _unopened() -> Column:
    return _session(None, False, None)


def _carried() -> list[Column]:
    return [_session(lo, known, state) for lo, known in _SIDES for state in (*_OPEN_STATES, _KEPT)]


def _place(session: Column) -> Column:
    """The place of a session among ``_carried``."""
    side = session["known"].cast("int") * 2 + session["orig_lo"].cast("int")
    state = F.when(session["state"] == "S0", 0).when(session["state"] == "S1", 1).when(session["state"] == "OTH", 2).otherwise(3)
    return side * (len(_OPEN_STATES) + 1) + state


def _merge_run(acc: Column, run: Column) -> Column:
    """The session after one more run; its state is NULL before its first one."""
    head, late, last, opens = run["head"], run["first_hit"], run["last"], acc["state"].isNull()

    def after_head(seen: Column) -> Column:
        # The run's first packet seeds the session or is one more ordinary packet.
        hit = F.when(opens, run["seed_hit"]).otherwise(run["head_hit"])
        orig_lo = F.coalesce(F.when(seen["known"], seen["guess"]), hit, seen["guess"])
        return F.struct(orig_lo.alias("orig_lo"), (seen["known"] | hit.isNotNull()).alias("known"))

    def after_rest(side: Column) -> Column:
        final_lo = F.when(side["known"], side["orig_lo"]).otherwise(F.coalesce(late["hit"], side["orig_lo"]))
        early = F.when(side["orig_lo"], run["end_hi"]).otherwise(run["end_lo"])
        in_time = side["known"] | late.isNull() | (early["rn"] < late["rn"])
        carried = next_state(acc["state"], head["from_lo"] == side["orig_lo"], head["fin"], head["rst"])
        state = F.coalesce(run["head_opening"], F.when(opens, F.lit("OTH")).otherwise(carried))
        return F.struct(
            side["orig_lo"],
            side["known"],
            final_lo.alias("final_lo"),
            F.when(in_time, early).alias("early"),
            state.alias("state"),
        )

    def final_state(s: Column) -> Column:
        # Which packet closes, seen by whom: after the last SYN, after an open state, midstream.
        reopened = last["open_state"].isNotNull()
        midstream = (s["state"] == "OTH") & ~reopened
        by_early = midstream & (s["early"].isNotNull() | s["known"])
        from_state = F.coalesce(last["open_state"], s["state"])
        packet = (
            F.when(by_early, s["early"])
            .when(midstream, run["end_late"])
            .when(last["closing"], run["last_end"])
        )
        orig_lo = F.when(reopened | (midstream & ~by_early), s["final_lo"]).otherwise(s["orig_lo"])
        closed = _let(
            F.struct(from_state.alias("state"), packet.alias("packet"), orig_lo.alias("orig_lo")),
            lambda c: _after(c["state"], c["packet"], c["orig_lo"]),
        )
        return F.struct(
            s["final_lo"].alias("orig_lo"), (s["known"] | late.isNotNull()).alias("known"), closed.alias("state")
        )

    before = F.struct((~opens & acc["known"]).alias("known"), F.when(opens, head["from_lo"]).otherwise(acc["orig_lo"]).alias("guess"))
    return _let(_let(_let(before, after_head), after_rest), final_state)


def _apply(acc: Column, step: Column) -> Column:
    """The session after an epoch, whose ``fold`` says what becomes of an unopened session and of each carried one."""
    found = F.when(step["opens"], step["fold"][0]).otherwise(F.get(step["fold"], 1 + _place(acc)))
    return _let(found, lambda out: F.struct(out["orig_lo"], out["known"], F.when(out["state"] == _KEPT, acc["state"]).otherwise(out["state"]).alias("state")))


_SUMS = ("lo_pkts", "lo_bytes", "hi_pkts", "hi_bytes")


def _epoch(slice_ns: int) -> Column:
    """Epochs follow one another as slices do; their length decides about arrays only."""
    return F.expr(f"slice div {EPOCH_SLICES * slice_ns // 1_000_000}")


def _fold_epochs(runs: DataFrame, part: str, may_continue: Column) -> DataFrame:
    """One row per flow key, epoch and ``part``, the runs of one session within an epoch.

    Where the session may have begun earlier, its runs become a function: ``fold`` has the outcome for every session
    that may come in. Such functions are applied one after the other, so no array grows with a session's runs: there
    are at most the runs of an epoch in one, and the epochs of a session in the next.
    """
    head, last = F.col("head"), F.col("last")
    runs = runs.withColumns(
        {
            "seed_hit": seed_orientation(head),
            "head_hit": later_orientation(head),
            "head_opening": _syn_state(head["syn"], head["ack"]),
            "last_end": F.struct(F.lit(0).alias("rn"), last["from_lo"], last["fin"], last["rst"]),
        }
    )
    run = F.struct("first_ts", "head", "seed_hit", "head_hit", "head_opening", "first_hit", "last", "last_end", "end_lo", "end_hi", "end_late")
    merged = runs.groupBy(*KEY, "epoch", part).agg(
        F.array_sort(F.collect_list(run)).alias("runs"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.bool_or(may_continue).alias("may_continue"),
        *[F.sum(c).alias(c) for c in _SUMS],
    )
    start = F.when(F.col("may_continue"), F.array(_unopened(), *_carried())).otherwise(F.array(_unopened()))
    fold = F.aggregate("runs", start, lambda accs, run: F.transform(accs, lambda acc: _merge_run(acc, run)))
    return merged.select(*KEY, "epoch", part, "first_ts", "last_ts", *_SUMS, F.col("runs")[0]["head"].alias("head"), fold.alias("fold"))


def idle_epochs(runs: DataFrame, idle_s: float = IDLE_S, slice_ns: int = SLICE_NS) -> DataFrame:
    """Epoch rows of idle-separated runs, with the ``session_ts`` that each belongs to and whether it ``opens`` it."""
    idle_ns = F.lit(int(idle_s * 1_000_000_000))
    runs = runs.withColumn("epoch", _epoch(slice_ns))
    order = Window.partitionBy(*KEY, "epoch").orderBy("slice", "run")
    gap = F.col("first_ts") - F.lag("last_ts").over(order)
    opens = F.coalesce(gap >= idle_ns, F.lit(False)).cast("int")
    runs = runs.withColumn("opens", opens).withColumn("part", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # A session from earlier slices has a packet here within the idle time after the border.
    near = F.col("first_ts") - F.col("slice") * 1_000_000 < idle_ns
    parts = _fold_epochs(runs, "part", (F.col("part") == 0) & near)
    return stitch_runs(parts.withColumnsRenamed({"epoch": "slice", "part": "run"}), KEY, idle_s)


def tcp_sessions(parts: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Merge epoch rows, each with its ``session_ts`` and whether it ``opens`` it, into one row per session."""
    merged = parts.groupBy(*key, "session_ts").agg(
        F.array_sort(F.collect_list(F.struct("first_ts", "opens", "fold"))).alias("steps"),
        F.min_by("head", "first_ts").alias("head"),
        F.max("last_ts").alias("last_ts"),
        *[F.sum(c).alias(c) for c in _SUMS],
    )
    return merged.select(*key, "session_ts", "last_ts", *_SUMS, "head", F.aggregate("steps", _unopened(), _apply).alias("fold"))


def _either(flag: Column, if_lo: str, if_hi: str) -> Column:
    return F.when(flag, F.col(if_lo)).otherwise(F.col(if_hi))


def _flow_columns(merged: DataFrame, ports: str) -> DataFrame:
    """Turn per-endpoint columns into originator and responder columns."""
    lo = F.col("orig_lo")
    first_ports = ports == "first_packet"
    return merged.select(
        "reference",
        "sensor",
        "protocol",
        F.col("session_ts").alias("ts_ns"),
        F.col("last_ts").alias("ts_end_ns"),
        duration_s("session_ts", "last_ts").alias("duration_s"),
        _either(lo, "host_lo", "host_hi").alias("id_orig_h"),
        _either(lo, "host_hi", "host_lo").alias("id_resp_h"),
        (F.col("head.id_orig_p") if first_ports else _either(lo, "port_lo", "port_hi")).alias("id_orig_p"),
        (F.col("head.id_resp_p") if first_ports else _either(lo, "port_hi", "port_lo")).alias("id_resp_p"),
        _either(lo, "lo_bytes", "hi_bytes").alias("orig_bytes"),
        _either(lo, "hi_bytes", "lo_bytes").alias("resp_bytes"),
        _either(lo, "lo_pkts", "hi_pkts").alias("orig_pkts"),
        _either(lo, "hi_pkts", "lo_pkts").alias("resp_pkts"),
        F.col("head.service").alias("service"),
        F.col("head.source_file").alias("source_file"),
        F.col("head.ip_version").alias("ip_version"),
        F.col("head.frame_no").alias("first_frame"),
        *[c for c in ("conn_state", "icmp_type", "icmp_code", "icmp_type_number", "icmp_code_number", "late_pkts") if c in merged.columns],
    )


def duration_s(first_ns: str, last_ns: str) -> Column:
    return (F.col(last_ns) - F.col(first_ns)) / F.lit(1e9)


def records_of(packets: DataFrame, kind: str) -> DataFrame:
    """The packets of one record type, with all optional columns."""
    return with_optional_columns(packets).filter(record_type() == kind)


def tcp_pieces(
    packets: DataFrame, slice_ns: int = SLICE_NS, max_rows: int | None = MAX_PIECE_ROWS, stored: bool = True
) -> DataFrame:
    """TCP packets with a non-NULL flow key and their piece, the input of the session operators.

    The pieces are ``stored`` as a table, as those operators read them more than once.
    """
    pieces = cut_pieces(fill_key(flow_key(records_of(packets, "tcp"))), KEY, slice_ns, max_rows)
    return shared_table(pieces) if stored else pieces


def summarise_tcp(
    packets: DataFrame,
    timeout_ms: int | None = None,
    idle_s: float = IDLE_S,
    slice_ns: int = SLICE_NS,
    max_rows: int | None = MAX_PIECE_ROWS,
    ports: str = "oriented",
    pieces: DataFrame | None = None,
) -> DataFrame:
    """TCP session table: one row per flow key and session.

    ``ports='first_packet'`` keeps the first packet's ports even when the hosts are swapped. ``pieces`` is the output
    of :func:`tcp_pieces` where it is there already.
    """
    if pieces is None:  # without a maximum span the pieces are read once
        pieces = tcp_pieces(packets, slice_ns, max_rows, stored=timeout_ms is not None)
    if timeout_ms is None:
        cut = with_runs(pieces, KEY, idle_s)
        parts = idle_epochs(_run_summaries(cut, [*KEY, "slice", "run"]), idle_s, slice_ns)
    else:
        cut = split_sessions(pieces, KEY, idle_s, timeout_ms)
        runs = _run_summaries(cut, [*KEY, "slice", "session_ts"]).withColumn("epoch", _epoch(slice_ns))
        opens = F.col("first_ts") == F.col("session_ts")
        parts = _fold_epochs(runs, "session_ts", F.col("first_ts") != F.col("session_ts")).withColumn("opens", opens)
    sessions = tcp_sessions(parts)
    merged = sessions.withColumns(
        {"orig_lo": F.col("fold.orig_lo"), "conn_state": F.col("fold.state")}
    )
    return _flow_columns(merged, ports)


_ICMP = ["icmp_type", "icmp_code", "icmp_type_number", "icmp_code_number"]


#: The record types whose flows have no sessions.
UNTIMED_KINDS = ["udp", "icmp", "ip"]
#: What their first packet tells.
HEAD = ["from_lo", "frame_no", "id_orig_p", "id_resp_p", "service", "source_file", "ip_version", *_ICMP]


def untimed_rows(packets: DataFrame, kinds: list[str]) -> DataFrame:
    """The packets of these record types, named by ``kind``, with their flow key."""
    return flow_key(with_optional_columns(packets).withColumn("kind", record_type()).filter(F.col("kind").isin(kinds)))


def untimed_columns(rows: DataFrame, tie: str) -> list[Column]:
    """Aggregates of a flow: ``head``, its first packet, its span, and the sums of both endpoints."""
    # The earliest time, and the last arrival at that time or the first one.
    later = tie == "later_first"
    order = F.struct((-F.col("ts_ns") if later else F.col("ts_ns")).alias("t"), *arrival(rows))
    chosen = F.max_by if later else F.min_by
    from_lo = F.col("from_lo")
    return [
        chosen(F.struct(*HEAD), order).alias("head"),
        F.min("ts_ns").alias("session_ts"),
        F.max("ts_ns").alias("last_ts"),
        F.count_if(from_lo).alias("lo_pkts"),
        F.count_if(~from_lo).alias("hi_pkts"),
        F.coalesce(F.sum(F.when(from_lo, F.col("bytes"))), F.lit(0)).alias("lo_bytes"),
        F.coalesce(F.sum(F.when(~from_lo, F.col("bytes"))), F.lit(0)).alias("hi_bytes"),
    ]


def orient_untimed(merged: DataFrame) -> DataFrame:
    """Adds ``orig_lo``, by the first packet and the rule of the record type ``kind``, and the ICMP columns."""
    kind = F.col("kind")
    reply = F.coalesce(F.endswith(F.col("head.icmp_type"), F.lit("reply")), F.lit(False))
    swap = F.when(kind == "udp", F.col("head.id_orig_p") < F.col("head.id_resp_p")).when(kind == "icmp", reply).otherwise(F.lit(False))
    icmp = {c: F.when(kind == "icmp", F.col(f"head.{c}")) for c in _ICMP}
    return merged.withColumns({"orig_lo": F.col("head.from_lo") != swap, **icmp})


def summarise_untimed(packets: DataFrame, protocol: str | None = None, tie: str = "arrival") -> DataFrame:
    """UDP, ICMP and other IP flows: one flow per key, oriented by the earliest packet.

    ``protocol`` is the record type: ``udp``, ``icmp`` or ``ip``, or None for all of them in one pass.
    ``tie='later_first'`` puts the later arrival first among packets of equal time.
    """
    rows = untimed_rows(packets, UNTIMED_KINDS if protocol is None else [protocol])
    merged = orient_untimed(rows.groupBy(*KEY, "kind").agg(*untimed_columns(rows, tie)))
    if protocol not in (None, "icmp"):
        merged = merged.drop(*_ICMP)
    return _flow_columns(merged.drop("kind"), "oriented")


def summarise(
    packets: DataFrame, timeout_ms: int | None = None, idle_s: float = IDLE_S, pieces: DataFrame | None = None, **kw
) -> DataFrame:
    """All protocols in one flow table, each by its own rule: TCP sessions, and one pass for all others."""
    parts = [summarise_tcp(packets, timeout_ms, idle_s, pieces=pieces, **kw), summarise_untimed(packets)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def flow_uid() -> Column:
    """Identifier of a flow: its endpoints, and the time and frame that it begins with."""
    return stable_uid(
        "reference", "sensor", "protocol", "id_orig_h", "id_resp_h", "id_orig_p", "id_resp_p", "first_frame", "ts_ns"
    )


def flow_row_key(uid: Column | None = None) -> Column:
    """``|``-joined flow key; ports, ICMP numbers or neither, by protocol."""
    return F.concat_ws(
        "|",
        "reference",
        "sensor",
        "id_orig_h",
        "id_resp_h",
        protocol_numbers(),
        "protocol",
        epoch_seconds("ts_ns").cast("string"),
        nano_of_second("ts_ns").cast("string"),
        flow_uid() if uid is None else uid,
    )


def flow_ready(timeout_ms: int, idle_for_ms: Column | None = None) -> Column:
    """Whether a flow is due: longer than ``timeout_ms``, or silent for over five seconds.

    TCP sessions never become due by span, their length is limited when they are split.
    """
    span_ms = F.floor((F.col("ts_end_ns") - F.col("ts_ns")) / F.lit(1_000_000))
    by_span = (F.col("protocol") != "tcp") & (span_ms > timeout_ms)
    return by_span if idle_for_ms is None else by_span | (idle_for_ms > 5000)


def describe_states(flows: DataFrame) -> DataFrame:
    """Add the description of ``conn_state``. The table is a fixed literal of 14 entries."""
    pairs = [F.lit(x) for item in CONN_STATES.items() for x in item]
    return flows.withColumn("conn_state_text", F.create_map(*pairs)[F.col("conn_state")])


def feature_stats(value: Column | str) -> list[Column]:
    """Min, mean, exact median, max and population deviation; NULL for single-row groups.

    The exact median keeps one counter per distinct value, and payload lengths have at most
    65,536 of them.
    """
    v = F.col(value) if isinstance(value, str) else value
    several = F.count(v) > 1
    return [
        F.when(several, F.min(v)).cast("double").alias("bytes_min"),
        F.when(several, F.avg(v)).cast("double").alias("bytes_mean"),
        F.when(several, F.median(v)).cast("double").alias("bytes_median"),
        F.when(several, F.max(v)).cast("double").alias("bytes_max"),
        F.when(several, F.stddev_pop(v)).cast("double").alias("bytes_std_dev"),
    ]


def drop_duplicates_per_direction(rows: DataFrame, key: list[str] = KEY, match: str = "fields") -> DataFrame:
    """Keep the first-seen packet per session, sender and (millisecond, seq, ack).

    Takes the output of the session split. Such copies share a piece, so nothing is
    shuffled. ``match='sum'`` compares the sum of the three numbers, which can also merge
    packets that differ; those are pre-aggregated before their shuffle.
    """
    ms, seq, ackn = epoch_millis("ts_ns"), F.coalesce("seq_num", F.lit(0)), F.coalesce("ack_num", F.lit(0))
    if match == "fields":
        copies = Window.partitionBy(*key, "slice", "session_ts", "from_lo", ms, seq, ackn).orderBy(*arrival(rows))
        return rows.withColumn("copy_no", F.row_number().over(copies)).filter("copy_no = 1").drop("copy_no")
    group = [*key, "session_ts", "from_lo"]
    others = [c for c in rows.columns if c not in group]
    first = F.min_by(F.struct(*others), F.struct(*arrival(rows))).alias("kept")
    kept = rows.withColumn("dup_sum", ms + seq + ackn).groupBy(*group, "dup_sum").agg(first)
    return kept.select(*group, "kept.*")


def flow_stats(
    packets: DataFrame, timeout_ms: int | None = None, idle_s: float = IDLE_S, pieces: DataFrame | None = None
) -> DataFrame:
    """Byte statistics per flow: over TCP sessions without copies, over other flows as they are."""
    pieces = tcp_pieces(packets) if pieces is None else pieces
    tcp = drop_duplicates_per_direction(split_sessions(pieces, KEY, idle_s, timeout_ms))
    other = flow_key(with_optional_columns(packets).filter(record_type() != "tcp"))
    return (
        tcp.groupBy(*KEY, "session_ts")
        .agg(*feature_stats("bytes"))
        .unionByName(other.groupBy(*KEY).agg(F.min("ts_ns").alias("session_ts"), *feature_stats("bytes")))
    )


def flow_packets(
    packets: DataFrame, timeout_ms: int | None = None, idle_s: float = IDLE_S, pieces: DataFrame | None = None
) -> DataFrame:
    """The packets of every flow as rows, with the flow's key and ``session_ts``; no array grows with a flow.

    TCP sessions list each copy once; other flows list what they have.
    """
    pieces = tcp_pieces(packets) if pieces is None else pieces
    tcp = drop_duplicates_per_direction(split_sessions(pieces, KEY, idle_s, timeout_ms)).drop("slice")
    other = flow_key(with_optional_columns(packets).filter(record_type() != "tcp"))
    names = {c: f"_{c}" for c in KEY}
    starts = other.groupBy(*KEY).agg(F.min("ts_ns").alias("session_ts")).withColumnsRenamed(names)
    listed = other.join(starts, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]).drop(*names.values())
    return tcp.unionByName(listed, allowMissingColumns=True)


def with_flow_key(listed: DataFrame, flows: DataFrame) -> DataFrame:
    """The packets of :func:`flow_packets` with ``flow_row_key``, the key of their row in the flow table."""
    names = {c: f"_{c}" for c in (*KEY, "ts_ns")}
    keys = flow_key(flows).select(*[F.col(c).alias(n) for c, n in names.items()], flow_row_key().alias("flow_row_key"))
    same = [F.col(c).eqNullSafe(F.col(names[c])) for c in KEY] + [F.col("session_ts") == F.col("_ts_ns")]
    return listed.join(keys, same).drop(*names.values())


def add_stats(flows: DataFrame, stats: DataFrame) -> DataFrame:
    """Join :func:`flow_stats` to the flow table made from the same packets."""
    names = {c: f"_{c}" for c in (*KEY, "session_ts")}
    keyed = flow_key(flows)
    same = [F.col(c).eqNullSafe(F.col(names[c])) for c in KEY] + [F.col("ts_ns") == F.col("_session_ts")]
    joined = keyed.join(stats.withColumnsRenamed(names), same, "left")
    return joined.drop(*names.values(), "host_lo", "port_lo", "host_hi", "port_hi", "from_lo")
