"""What the physical plans must look like for large input."""

import re

import pytest

import __spark_entry__  # noqa: F401  (ships the package)
from flowloom.operators import flows
from flowloom.operators.max_span import split_sessions
from flowloom.operators.sessions import split_idle
from flowloom.plans import inputs
from flowloom.plans.inputs import table
from flowloom.plans.registry import collect

SF = "/root/testdata/sf0.001"
# These run actions of their own (streams, checkpoints), so their plans only read files back.
EAGER = {"d2_split_max_span", "d3_orient_tcp", "g5_write_records", "g5_write_packets", "a11_stream_counts", "g3_routed_stream", "g5_write_flows", "g5_write_events", "a8_stream_directory", "e6_stream_metrics",
         "d9_stream_sessions", "d9_stream_counters", "d9_stream_flows"}
QUERIES = collect()[0]
LAZY = sorted(set(QUERIES) - EAGER)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_single_partition(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition"):
        assert bad not in text
    # Only literal tables and the counted busy slices are ever broadcast unasked at scale.
    assert "PythonUDF" not in text or name.startswith("a")


def exchanges(text: str) -> list[str]:
    """Columns of the hash exchanges; the spreading of the small test input is none of them."""
    return re.findall(r"- Exchange hashpartitioning\(([^)]*)\)", text)


def test_packets_of_the_session_table_move_once(spark):
    text = plan(flows.summarise_tcp(inputs.packets(spark, SF)))
    moves = exchanges(text)
    # Default arguments: the packets once by piece, one row per run by epoch, one per session and epoch by flow; sessions
    # stay there. The counts of slice parts and of slices are the other two moves, the other scan reads key and time.
    assert len(moves) == 5 and sum("slice" in m for m in moves) == 1
    assert text.count("FileScan parquet") == 2


def test_flow_tables_store_pieces_once(spark, monkeypatch):
    """With a maximum span or statistics, everything after the cut reads the stored pieces, never the packets again."""
    rows = inputs.mixed_packets(spark, SF)
    folder = rows.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
    pieces = flows.tcp_pieces(rows)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    assert folder not in plan(split_sessions(pieces, max_span_ms=30_000))
    both = flows.add_stats(flows.summarise(rows, pieces=pieces), flows.flow_stats(rows, pieces=pieces))
    # Other protocols: once for their flows and once for their statistics.
    text = plan(both)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert text.count(folder) == 2


def test_session_split_joins_without_moving_packets_again(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the run heads were large
    try:
        text = plan(split_idle(flows.tcp_pieces(inputs.packets(spark, SF), max_rows=None, stored=False)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Packets once, their order columns once, and run heads by flow and back by piece.
    assert len(exchanges(text)) == 4 and "SortMergeJoin" in text


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["e2_event_metrics"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "value" not in schema and "event_type" not in schema


def test_filters_reach_the_scan(spark):
    text = plan(table(spark, SF, "lineitem").filter("l_quantity > 49").select("l_orderkey"))
    assert "GreaterThan(l_quantity,49.0)" in text
