"""Sessions of bidirectional flows.

Ordering is the hard part: one busy flow may hold a large share of all packets, so no step
sorts a whole flow in one task. Packets are cut into *pieces* - a flow key within one time
slice, with overfull slices cut finer - and every window runs inside a piece. What crosses a
border is carried by one small row per run of a piece. A flow has at most span/gap + span/slice of them, and per
MAX_PIECE_ROWS packets of a busy slice 60 more, or one per millisecond of a second that is itself overfull. The
cutting changes only how the work is split, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.columns import endpoint_key_columns, int_div

KEY = ["reference", "sensor", "protocol", "host_lo", "port_lo", "host_hi", "port_hi"]
IDLE_S = 4
SLICE_NS = 60 * 1_000_000_000
# Busiest piece that is sorted as one: about a gigabyte of packet rows.
MAX_PIECE_ROWS = 10_000_000
_NS_PER_MS = 1_000_000
_PARTS = 60  # of a busy slice


def arrival(df: DataFrame) -> list[str]:
    """The columns that put packets of equal time into one order, whatever files they come from.

    Frame numbers begin anew in every file, so the file and its member come first where they are known.
    """
    return [c for c in ("source_file", "member", "frame_no") if c in df.columns]


def flow_key(packets: DataFrame) -> DataFrame:
    """Add the direction-free key columns and ``from_lo`` (sender is the lower endpoint)."""
    return packets.withColumns(endpoint_key_columns())


def fill_key(packets: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Replace NULL in the key, so that joins lose no rows and Spark tests nothing in the scan."""
    unset = {c: F.lit(0) if c.startswith("port") else F.lit("") for c in key}
    return packets.withColumns({c: F.coalesce(F.col(c), unset[c]) for c in key})


def _same(key: list[str], *more: str) -> list[Column]:
    """Join condition with a table whose columns have ``_`` before their names."""
    return [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*key, *more)]


def cut_pieces(
    packets: DataFrame,
    key: list[str] = KEY,
    slice_ns: int = SLICE_NS,
    max_rows: int | None = MAX_PIECE_ROWS,
) -> DataFrame:
    """Add ``slice``, the millisecond that the packet's time slice begins with; slices are finer where a flow is busy.

    A slice with over ``max_rows`` packets of a flow is cut into 60 parts, and a part that is still too full by the
    millisecond. One partially aggregated count by part says both; it reads the key and the time only. Its rows in busy
    slices, at most 60 * packets / max_rows, are joined to the packets, with a broadcast where Spark finds them small.
    ``max_rows=None`` skips the counting.
    """
    if slice_ns % _NS_PER_MS:
        raise ValueError("slice_ns must be whole milliseconds")
    base, slice_ms = int_div("ts_ns", slice_ns), slice_ns // _NS_PER_MS
    if max_rows is None:
        return packets.withColumn("slice", base * slice_ms)
    ms = int_div(F.pmod("ts_ns", F.lit(slice_ns).cast("bigint")), _NS_PER_MS)
    part_ms = max(1, slice_ms // _PARTS)
    timed = {"base": base, "part": int_div(ms, part_ms)}
    counts = packets.select(*key, "ts_ns").withColumns(timed).groupBy(*key, "base", "part").agg(F.count("*").alias("n"))
    held = F.sum("n").over(Window.partitionBy(*key, "base"))
    busy = counts.withColumn("held", held).filter(F.col("held") > max_rows)
    names = {c: f"_{c}" for c in (*key, "base", "part")}
    busy = busy.select(*key, "base", "part", (F.col("n") > max_rows).alias("_full")).withColumnsRenamed(names)
    cut = packets.withColumns(timed).join(busy, _same(key, "base", "part"), "left")
    fine = F.when(F.col("_full"), ms).when(F.col("_full").isNotNull(), F.col("part") * part_ms).otherwise(F.lit(0))
    return cut.withColumn("slice", F.col("base") * slice_ms + fine).drop(*names.values(), "base", "part", "_full")


def _piece(pieces: DataFrame, key: list[str]):
    return Window.partitionBy(*key, "slice").orderBy("ts_ns", *arrival(pieces))


def with_runs(pieces: DataFrame, key: list[str] = KEY, idle_s: float = IDLE_S) -> DataFrame:
    """Number the idle-separated runs inside each piece; run 0 may continue an earlier piece."""
    piece = _piece(pieces, key)
    gap = F.col("ts_ns") - F.lag("ts_ns").over(piece)
    cut = F.coalesce(gap >= F.lit(int(idle_s * 1_000_000_000)), F.lit(False))
    cuts = pieces.withColumn("starts_run", cut)
    running = piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cuts.withColumn("run", F.sum(F.col("starts_run").cast("int")).over(running))


def stitch_runs(runs: DataFrame, key: list[str] = KEY, idle_s: float = IDLE_S) -> DataFrame:
    """Join runs across slice borders: adds ``opens`` and ``session_ts`` per run.

    Input has one row per run with ``first_ts`` and ``last_ts``.
    """
    order = Window.partitionBy(*key).orderBy("slice", "run")
    gap = F.col("first_ts") - F.lag("last_ts").over(order)
    opens = F.coalesce(gap >= F.lit(int(idle_s * 1_000_000_000)), F.lit(True))
    runs = runs.withColumn("opens", opens)
    start = F.last(F.when(F.col("opens"), F.col("first_ts")), ignorenulls=True)
    return runs.withColumn(
        "session_ts", start.over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )


def split_idle(pieces: DataFrame, key: list[str] = KEY, idle_s: float = IDLE_S) -> DataFrame:
    """Add ``session_ts``, the first packet time of the packet's idle-separated session.

    Takes the output of :func:`cut_pieces`. (key, session_ts) identifies a session: packets
    of equal time are never cut apart. The key columns must not be NULL.
    """
    runs = (
        with_runs(pieces.select(*key, "slice", "ts_ns", *arrival(pieces)), key, idle_s)
        .groupBy(*key, "slice", "run")
        .agg(F.min("ts_ns").alias("first_ts"), F.max("ts_ns").alias("last_ts"))
    )
    heads = (
        stitch_runs(runs, key, idle_s)
        .filter("run = 0")
        .select(*key, "slice", F.col("session_ts").alias("head_session_ts"))
    )
    running = _piece(pieces, key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own_start = F.last(F.when(F.col("starts_run"), F.col("ts_ns")), ignorenulls=True).over(running)
    rows = with_runs(pieces, key, idle_s).withColumn("own_start", own_start)
    # Both sides are already partitioned by the join columns: the packets are not moved again.
    joined = rows.join(heads, [*key, "slice"])
    return joined.withColumn("session_ts", F.coalesce("own_start", "head_session_ts")).drop(
        "own_start", "head_session_ts", "starts_run", "run"
    )


def order_packets(pieces: DataFrame, key: list[str] = KEY, tie: str = "arrival") -> DataFrame:
    """Add ``position``, the packet's place in its flow by time.

    Equal times keep arrival order, or put the later arrival first with ``tie='later_first'``.
    Positions are counted inside pieces and shifted by the packet counts of earlier pieces.
    The key columns must not be NULL.
    """
    before = Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.groupBy(*key, "slice").agg(F.count("*").alias("n"))
    shifts = shifts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    later = [F.col(c).desc() if tie == "later_first" else F.col(c).asc() for c in arrival(pieces)]
    place = F.row_number().over(Window.partitionBy(*key, "slice").orderBy("ts_ns", *later))
    rows = pieces.withColumn("place", place)
    joined = rows.join(shifts, [*key, "slice"])
    return joined.withColumn("position", F.col("place") + F.col("shift")).drop("place", "shift", "slice")
