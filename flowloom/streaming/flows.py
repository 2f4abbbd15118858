"""Continuous flows of UDP, ICMP and plain IP.

Without a span limit they are native session windows with the aggregates of the batch, partially aggregated, so that a
busy flow is no one's group. With a limit one small open flow per key is kept in the state store; the packets of a
micro-batch are reduced to one row per second as they come in, and never held together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowloom.functions.columns import timestamp_of
from flowloom.operators.flows import HEAD, UNTIMED_KINDS, _flow_columns, orient_untimed, untimed_columns, untimed_rows
from flowloom.operators.sessions import KEY, arrival

#: Seconds of silence that end a flow.
SILENT_S = 5
_SUMS = ["lo_pkts", "hi_pkts", "lo_bytes", "hi_bytes"]
_NS_PER_MS, _NS_PER_S = 1_000_000, 1_000_000_000
_OPEN = "session_ts long, last_ts long, lo_pkts long, hi_pkts long, lo_bytes long, hi_bytes long"


def _by_second(batch: pd.DataFrame, order: list[str]) -> Iterator[tuple[int, tuple, dict]]:
    """(second, order of the first packet, summed row) of a batch of one flow's packets."""
    batch = batch.sort_values(order, na_position="first")
    lo, size = batch["from_lo"].astype(bool), batch["bytes"].fillna(0)
    made = pd.DataFrame({"lo_pkts": lo, "hi_pkts": ~lo, "lo_bytes": size.where(lo, 0), "hi_bytes": size.where(~lo, 0)}).astype("int64")
    second = batch["ts_ns"] // _NS_PER_S
    sums, ends = made.groupby(second).sum(), batch["ts_ns"].groupby(second).last()
    first = batch.loc[~second.duplicated()]
    for at, head in zip(second[first.index], first.to_dict("records")):
        head = {c: None if pd.isna(v) else v for c, v in head.items()}
        place = tuple((head[c] is not None, head[c]) for c in order)
        sum_row = {c: int(sums.at[at, c]) for c in _SUMS}
        yield at, place, {c: head[c] for c in HEAD} | sum_row | {"session_ts": int(head["ts_ns"]), "last_ts": int(ends[at])}


def _merged(a: dict, b: dict) -> dict:
    """Row ``a`` with what comes later of the same flow."""
    return a | {"last_ts": max(a["last_ts"], b["last_ts"])} | {c: a[c] + b[c] for c in _SUMS}


def _next_flows(flow: dict | None, seconds: list[dict], idle_ns: int, span_ns: int) -> Iterator[tuple[dict, bool]]:
    """(flow, whether it ended) after one key's seconds, in order; the last one stays open."""
    for s in seconds:
        if flow is not None:
            over = flow["last_ts"] - flow["session_ts"] >= span_ns and s["session_ts"] // _NS_PER_S > flow["last_ts"] // _NS_PER_S
            if over or s["session_ts"] - flow["last_ts"] >= idle_ns:
                yield flow, True
                flow = None
        flow = s if flow is None else _merged(flow, s)
    yield flow, False


def _limited(timed: DataFrame, idle_ns: int, span_ns: int) -> DataFrame:
    order = ["ts_ns", *arrival(timed)]
    key = [*KEY, "kind"]
    types = {f.name: f.dataType.simpleString() for f in timed.schema}
    schema = ", ".join([_OPEN, *(f"{c} {types[c]}" for c in HEAD)])
    names = [part.split(" ")[0] for part in schema.split(", ")]
    whole = [c for c in HEAD if types[c] in ("int", "bigint")]
    needed = list(dict.fromkeys([*order, "bytes", *HEAD]))
    idle_ms = -(-idle_ns // _NS_PER_MS)

    def run(values, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        flow = dict(zip(names, state.get)) if state.exists else None
        ended = []
        if state.hasTimedOut:
            ended, flow = [flow], None
        else:
            seconds: dict[int, tuple] = {}
            for batch in batches:
                for at, place, row in _by_second(batch[needed], order):
                    was = seconds.get(at)
                    if was is None:
                        seconds[at] = place, row
                    else:
                        early, late = sorted([was, (place, row)], key=lambda x: x[0])
                        seconds[at] = early[0], _merged(early[1], late[1])
            rows = [seconds[at][1] for at in sorted(seconds)]
            rows = [r | {c: None if r[c] is None else int(r[c]) for c in whole} for r in rows]
            for flow, done in _next_flows(flow, rows, idle_ns, span_ns):
                if done:
                    ended.append(flow)
        if flow is None:
            state.remove()
        else:
            state.update(tuple(flow[c] for c in names))
            state.setTimeoutTimestamp(max(flow["last_ts"] // _NS_PER_MS + idle_ms, state.getCurrentWatermarkMs() + 1))
        if ended:
            yield pd.DataFrame([[*values, *(f[c] for c in names)] for f in ended], columns=[*key, *names], dtype=object)

    key_schema = ", ".join(f"{c} {types[c]}" for c in key)
    flows = timed.select(*key, "ts", *needed).groupBy(*key).applyInPandasWithState(
        run, f"{key_schema}, {schema}", schema, "append", GroupStateTimeout.EventTimeTimeout
    )
    return flows.select(*key, "session_ts", "last_ts", *_SUMS, F.struct(*HEAD).alias("head"))


def stream_flows(packets: DataFrame, timeout_ms: int | None = None, idle_s: float = SILENT_S, delay: str = "0 seconds") -> DataFrame:
    """UDP, ICMP and plain IP flows of a packet stream, each emitted once when it ends, in the layout of ``summarise_untimed``.

    A flow ends before a packet that comes ``idle_s`` or more (a second at least) after its last one, or when the
    watermark has passed that time. With ``timeout_ms`` it also ends with the second in which it becomes longer than
    that. Packets of a closed time begin a flow of their own or are dropped by the watermark; with a limit, a packet
    older than the last one of its open flow is added to it. Ports and ICMP numbers that are absent stay NULL.
    """
    idle_ns = int(idle_s * _NS_PER_S)
    if idle_ns < _NS_PER_S:
        raise ValueError("idle_s must be a second or more")
    timed = untimed_rows(packets, UNTIMED_KINDS).withColumn("ts", timestamp_of("ts_ns")).withWatermark("ts", delay)
    if timeout_ms is None:  # session windows merge at a distance equal to their gap
        window = F.session_window("ts", f"{idle_ns // 1000 - 1} microseconds")
        merged = timed.groupBy(*KEY, "kind", window).agg(*untimed_columns(timed, "arrival")).drop("session_window")
    else:
        merged = _limited(timed, idle_ns, (timeout_ms + 1) * _NS_PER_MS)
    return _flow_columns(orient_untimed(merged), "oriented")
