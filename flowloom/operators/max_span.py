"""Sessions limited in length: a packet too long after the session's first one opens the next.

The rule is greedy, so each start depends on the one before it. Idle-separated sessions
shorter than the limit need nothing. In longer ones every piece becomes a function, computed
in parallel: from when the next start is due on entering the piece to when it is due after
it, a short table of steps. Such tables are composed for up to 64 neighbours at a time, and
those again, until a session is one table; then the due times are handed down the same tree,
64 at a time, and the pieces list their starts in parallel. No task sees more of a session
than a piece's times or 64 tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.lineage import cut_lineage, shared_table
from flowloom.operators.sessions import IDLE_S, KEY, arrival, split_idle

# Neighbouring tables that are composed at a time.
FAN = 64


def _last_start(times: np.ndarray, jump: int) -> np.ndarray:
    """For each time taken as a start, the last start reached inside ``times``, by pointer doubling."""
    here = np.arange(len(times))
    hop = np.searchsorted(times, times + jump)
    hop = np.where(hop < len(times), hop, here)
    while True:
        twice = hop[hop]
        if np.array_equal(twice, hop):
            return times[hop]
        hop = twice


def _steps(upto: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A table without steps that change nothing: a start due up to ``upto[i]`` makes the one after it due at ``out[i]``."""
    last = np.append(np.flatnonzero(np.diff(out)), len(out) - 1)
    return upto[last], out[last]


def _due_after(due: np.ndarray, upto: np.ndarray, out: np.ndarray) -> np.ndarray:
    """When the next start is due behind a table; one that is due later than all its times stays due."""
    at = np.searchsorted(upto, due)
    return np.where(at < len(upto), out[np.minimum(at, len(out) - 1)], due)


def _tables(rows: pa.Table):
    """(position in ``rows``, upto, out) in the order of the pieces."""
    for i in np.argsort(rows["pos"].to_numpy()):
        yield int(i), np.array(rows["upto"][i].as_py(), "i8"), np.array(rows["out"][i].as_py(), "i8")


def _one(rows: pa.Table, names: list[str], pos: int, upto: np.ndarray, out: np.ndarray) -> pa.Table:
    first = rows.select(names).slice(0, 1)
    lists = [pa.array([v], pa.list_(pa.int64())) for v in (upto, out)]
    return first.append_column("pos", pa.array([pos])).append_column("upto", lists[0]).append_column("out", lists[1])


def _reach(jump: int, session: list[str]):
    """A piece's table."""

    def run(rows: pa.Table) -> pa.Table:
        times = np.sort(rows["ts_ns"].to_numpy())
        # The start before lies before times[0], so the next is due before times[0] + jump.
        opens = times[0] == rows["session_ts"][0].as_py()
        n = 1 if opens else min(len(times), int(np.searchsorted(times, times[0] + jump)) + 1)
        upto, out = _steps(times[:n], _last_start(times, jump)[:n] + jump)
        return _one(rows, session, rows["pos"][0].as_py(), upto, out)

    return run


def _compose(session: list[str]):
    """One table for neighbouring ones."""

    def run(rows: pa.Table) -> pa.Table:
        upto = out = None
        for _, more, leads in _tables(rows):
            if upto is None:
                upto, out = more, leads
            else:
                later = more > upto[-1]
                upto, out = _steps(np.append(upto, more[later]), np.append(_due_after(out, more, leads), leads[later]))
        return _one(rows, session, rows["pos"][0].as_py() // FAN, upto, out)

    return run


def _hand_down(session: list[str]):
    """When a start is due on entering each of neighbouring tables; ``due`` is known for the first."""

    def run(rows: pa.Table) -> pa.Table:
        due, dues = np.array([rows["due"][0].as_py()]), np.zeros(len(rows), "i8")
        for i, upto, out in _tables(rows):
            dues[i] = due[0]
            due = _due_after(due, upto, out)
        return rows.select([*session, "pos"]).append_column("due", pa.array(dues))

    return run


def _list_starts(jump: int, piece: list[str]):
    def run(rows: pa.Table) -> pa.Table:
        times = np.sort(rows["ts_ns"].to_numpy())
        at, starts = np.searchsorted(times, rows["due"][0].as_py()), []
        while at < len(times):
            starts.append(times[at])
            at = np.searchsorted(times, times[at] + jump)
        out = rows.select(piece).take(pa.array(np.zeros(len(starts), "i8")))
        return out.append_column("start_ts", pa.array(starts, pa.int64()))

    return run


def _schema(df: DataFrame, names: list[str], **more: T.DataType) -> T.StructType:
    return T.StructType([*(df.schema[n] for n in names), *(T.StructField(n, t) for n, t in more.items())])


def _starts(tagged: DataFrame, key: list[str], jump: int, most: int) -> DataFrame:
    """All starts of the long sessions whose packet times are in ``tagged``, with the piece's place ``pos`` in its session.

    ``most`` is the largest number of pieces of a session.
    """
    session, piece = [*key, "session_ts"], [*key, "slice", "session_ts"]
    long = T.LongType()
    table = _schema(tagged, session, pos=long, upto=T.ArrayType(long), out=T.ArrayType(long))
    chunk = F.expr(f"pos div {FAN}")
    levels = [tagged.groupBy(*piece).applyInArrow(_reach(jump, session), table)]
    while most > FAN:
        levels[-1] = shared_table(levels[-1])  # read on the way up and on the way down
        levels.append(levels[-1].groupBy(*session, chunk).applyInArrow(_compose(session), table))
        most = -(-most // FAN)
    due = None
    for level in reversed(levels):
        rows = level.withColumn("chunk", chunk)
        rows = rows.withColumn("due", F.col("session_ts")) if due is None else rows.join(due.withColumnRenamed("pos", "chunk"), [*session, "chunk"])
        due = rows.groupBy(*session, "chunk").applyInArrow(_hand_down(session), _schema(tagged, session, pos=long, due=long))
    entered = tagged.join(due, [*session, "pos"])
    return entered.groupBy(*piece).applyInArrow(_list_starts(jump, piece), _schema(tagged, piece, start_ts=long))


def split_sessions(
    pieces: DataFrame,
    key: list[str] = KEY,
    idle_s: float = IDLE_S,
    max_span_ms: int | None = None,
) -> DataFrame:
    """Add ``session_ts`` after the idle rule and, if given, the maximum span rule.

    Takes the output of ``sessions.cut_pieces``.
    """
    rows = split_idle(pieces, key, idle_s)
    if max_span_ms is None:
        return rows
    # More than max_span_ms whole milliseconds after the start.
    jump = (max_span_ms + 1) * 1_000_000
    session, piece = [*key, "session_ts"], [*key, "slice", "session_ts"]
    points = split_idle(pieces.select(*key, "slice", "ts_ns", *arrival(pieces)), key, idle_s)
    points = points.select(*piece, "ts_ns").distinct()
    of_session = Window.partitionBy(*session)
    span = F.max("last_ts").over(of_session) - F.col("session_ts")
    long_parts = (
        points.groupBy(*piece)
        .agg(F.max("ts_ns").alias("last_ts"))
        .withColumns({"span": span, "pos": F.row_number().over(of_session.orderBy("slice")).cast("bigint") - 1})
        .filter(F.col("span") >= jump)
    )
    tagged = cut_lineage(points.join(long_parts.select(*piece, "pos"), piece))
    most = tagged.agg(F.max("pos")).first()[0]
    starts = _starts(tagged, key, jump, 0 if most is None else most + 1)
    # A piece inherits the last start of the pieces before it.
    before = Window.partitionBy(*session).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    last_starts = starts.groupBy(*piece).agg(F.max("start_ts").alias("last_start"))
    inherited = (
        tagged.groupBy(*piece)
        .agg(F.min("ts_ns").alias("first_ts"))
        .join(last_starts, piece, "left")
        .withColumn("start_ts", F.last("last_start", ignorenulls=True).over(before))
        .filter("start_ts is not null")
        .select(*piece, "start_ts", F.col("first_ts").alias("ts_ns"))
    )
    # Markers sort before the packets of their time, and inherited ones before own starts.
    own = starts.select(*piece, "start_ts", F.col("start_ts").alias("ts_ns"))
    markers = own.unionByName(inherited).select(
        *key, "slice", "ts_ns", F.struct("session_ts", "start_ts").alias("marker")
    )
    order = Window.partitionBy(*key, "slice").orderBy("ts_ns", *arrival(rows), "marker")
    latest = F.last("marker", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    marked = rows.unionByName(markers, allowMissingColumns=True).withColumn("latest", latest)
    current = F.when(F.col("latest.session_ts") == F.col("session_ts"), F.col("latest.start_ts"))
    return (
        marked.filter("marker is null")
        .withColumn("session_ts", F.coalesce(current, F.col("session_ts")))
        .drop("marker", "latest")
    )
