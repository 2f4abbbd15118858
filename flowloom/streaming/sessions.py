"""Continuous TCP sessions.

``stream_counters`` needs only built-in session windows. ``stream_sessions`` keeps one small
open session per flow in the state store, and leaves a session when a packet cuts it (idle
gap or maximum span) or when it has been silent long enough. Packets are folded in arrival
order, by time within a micro-batch; a packet older than its session's last never cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowloom.functions.columns import timestamp_of
from flowloom.operators.flows import _flow_columns, records_of
from flowloom.operators.sessions import IDLE_S, KEY, arrival, flow_key

# State after a FIN or RST without SYN, by (state, flag, sent by originator).
# Where a packet carries both flags the table is asked in this order.
TRANSITIONS = {
    ("S0", "fin", True): "SH",
    ("S0", "fin", False): "SF",
    ("S1", "fin", True): "SF",
    ("S1", "fin", False): "SF",
    ("S0", "rst", False): "REJ",
    ("S1", "rst", True): "RSTO",
    ("S1", "rst", False): "RSTR",
    ("S0", "rst", True): "RSTOS0",
    ("OTH", "rst", False): "RSTRH",
    ("OTH", "fin", True): "SHR",
    ("OTH", "fin", False): "SHR",
}
_COUNTERS = ("lo_pkts", "lo_bytes", "hi_pkts", "hi_bytes")
_SESSION_FIELDS = (
    "session_ts long, last_ts long, frame_no long, id_orig_p int, id_resp_p int, service string, "
    "source_file string, ip_version string, orig_lo boolean, known boolean, state string, "
    "lo_pkts long, lo_bytes long, hi_pkts long, hi_bytes long, late_pkts long"
)
_NAMES = [f.split(" ")[0] for f in _SESSION_FIELDS.split(", ")]
_HEAD = ["frame_no", "id_orig_p", "id_resp_p", "service", "source_file", "ip_version"]
_PACKET = ["ts_ns", "from_lo", "syn", "ack", "fin", "rst", "seq_num", "ack_num", "bytes", "member", *_HEAD]


def _orientation(p, first: bool) -> bool | None:
    if p.syn:
        return p.from_lo != p.ack
    if p.id_orig_p != p.id_resp_p:
        return p.from_lo == (p.id_orig_p > p.id_resp_p)
    if not first and p.ack_num == 0:
        return not p.from_lo
    if not first and p.seq_num == 0:
        return p.from_lo
    return None


def _fold(session: dict | None, part: pd.DataFrame) -> dict:
    """Add packets of one session, in order; only flagged or orienting ones are visited."""
    first = session is None
    if first:
        head = part.iloc[0]
        session = {"session_ts": int(head.ts_ns), "known": False, "orig_lo": bool(head.from_lo), "state": "OTH"}
        session |= {name: None if pd.isna(head[name]) else head[name] for name in _HEAD}
        session |= dict.fromkeys((*_COUNTERS, "late_pkts"), 0)
    lo = part["from_lo"].to_numpy(bool)
    size = part["bytes"].to_numpy()
    session["lo_pkts"] += int(lo.sum())
    session["hi_pkts"] += int((~lo).sum())
    session["lo_bytes"] += int(size[lo].sum())
    session["hi_bytes"] += int(size[~lo].sum())
    session["last_ts"] = int(part["ts_ns"].iloc[-1])
    matters = part["syn"] | part["fin"] | part["rst"]
    if not session["known"]:
        matters |= (part["id_orig_p"] != part["id_resp_p"]) | (part["ack_num"] == 0) | (part["seq_num"] == 0)
    if first:
        matters.iloc[0] = True
    for p in part[matters].itertuples(index=False):
        if not session["known"]:
            seen = _orientation(p, first)
            if seen is not None:
                session["known"], session["orig_lo"] = True, bool(seen)
        if p.syn:
            session["state"] = "S1" if p.ack else "S0"
        elif not first:
            by_orig = p.from_lo == session["orig_lo"]
            fired = (s for (was, flag, sender), s in TRANSITIONS.items() if was == session["state"] and sender == by_orig and getattr(p, flag))
            session["state"] = next(fired, session["state"])
        first = False
    return session


def _split(session: dict | None, rows: pd.DataFrame, idle_ns: int, jump: int | None) -> Iterator[tuple[dict, bool]]:
    """(session, closed) pairs for the time-ordered packets of one flow."""
    times = rows["ts_ns"].to_numpy()
    at, end = 0, len(rows)
    gaps = np.flatnonzero(np.diff(times) >= idle_ns) + 1
    while at < end:
        if session is not None:
            late = jump is not None and times[at] - session["session_ts"] >= jump
            if late or times[at] - session["last_ts"] >= idle_ns:
                yield session, True
                session = None
        start = times[at] if session is None else session["session_ts"]
        stop = gaps[np.searchsorted(gaps, at, "right")] if len(gaps) and gaps[-1] > at else end
        if jump is not None:
            stop = min(stop, max(at + 1, int(np.searchsorted(times, start + jump))))
        session = _fold(session, rows.iloc[at:stop])
        at = stop
    if session is not None:
        yield session, False


def stream_sessions(
    packets: DataFrame,
    timeout_ms: int | None = None,
    idle_s: float = IDLE_S,
    clock: str = "event",
    delay: str = "0 seconds",
    ports: str = "oriented",
) -> DataFrame:
    """TCP sessions of a packet stream, each emitted once when it closes.

    ``clock='event'`` closes silent sessions when the watermark passes the idle gap,
    ``'wall'`` when no packet arrived for that long in real time. A packet older than the last one of its open session
    is not folded in but counted, as ``late_pkts``.
    """
    idle_ns = int(idle_s * 1_000_000_000)
    idle_ms = -(-idle_ns // 1_000_000)
    jump = None if timeout_ms is None else (timeout_ms + 1) * 1_000_000
    output = [*KEY, *_NAMES]

    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        session = dict(zip(_NAMES, state.get)) if state.exists else None
        closed = []
        if state.hasTimedOut:
            closed, session = [session], None
        else:
            rows = pd.concat(list(batches))
            rows = rows.sort_values(["ts_ns", *arrival(rows)], ignore_index=True, na_position="first")
            if session is not None:  # what is older than the last packet came too late to be placed: counted only
                late = rows["ts_ns"] < session["last_ts"]
                session["late_pkts"] += int(late.sum())
                rows = rows[~late].reset_index(drop=True)
            for session, done in _split(session, rows, idle_ns, jump):
                if done:
                    closed.append(session)
        if session is None:
            state.remove()
        else:
            state.update(tuple(session[n] for n in _NAMES))
            if clock == "wall":
                state.setTimeoutDuration(idle_ms)
            else:
                due = session["last_ts"] // 1_000_000 + idle_ms
                state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if closed:
            yield pd.DataFrame([[*key, *(s[n] for n in _NAMES)] for s in closed], columns=output)

    keyed = flow_key(records_of(packets, "tcp"))
    timed = keyed.withColumn("ts", timestamp_of("ts_ns"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout
    if clock == "event":
        timed, timeout = timed.withWatermark("ts", delay), GroupStateTimeout.EventTimeTimeout
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.select(*KEY).schema)
    sessions = (
        timed.select(*KEY, "ts", *_PACKET)
        .groupBy(*KEY)
        .applyInPandasWithState(run, f"{key_schema}, {_SESSION_FIELDS}", _SESSION_FIELDS, "append", timeout)
    )
    merged = sessions.withColumn("head", F.struct(*_HEAD)).withColumnRenamed("state", "conn_state")
    return _flow_columns(merged, ports)


def stream_counters(packets: DataFrame, idle_s: float = IDLE_S, delay: str = "0 seconds") -> DataFrame:
    """Packets and bytes per session and endpoint with native session windows.

    Session windows merge at a distance equal to their gap, so the gap is one microsecond
    short of the idle time. Partial aggregation keeps busy flows out of single tasks' way.
    """
    gap = f"{int(idle_s * 1_000_000) - 1} microseconds"
    timed = flow_key(records_of(packets, "tcp")).withColumn("ts", timestamp_of("ts_ns"))
    from_lo = F.col("from_lo")
    counted = (
        timed.withWatermark("ts", delay)
        .groupBy(*KEY, F.session_window("ts", gap))
        .agg(
            F.min("ts_ns").alias("session_ts"),
            F.max("ts_ns").alias("last_ts"),
            F.sum(F.when(from_lo, 1).otherwise(0)).alias("lo_pkts"),
            F.sum(F.when(from_lo, F.col("bytes")).otherwise(0)).alias("lo_bytes"),
            F.sum(F.when(from_lo, 0).otherwise(1)).alias("hi_pkts"),
            F.sum(F.when(from_lo, 0).otherwise(F.col("bytes"))).alias("hi_bytes"),
        )
    )
    return counted.drop("session_window")
