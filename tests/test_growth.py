"""What one task or one batch holds, and what one row costs, do not grow with the tables."""

from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from flowloom.plans import captures, event_queries, inputs, sink_queries
from flowloom.sources import event_logs, files, pcap


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """A folder with 600 events of our own."""
    folder = tmp_path_factory.mktemp("tables")
    n = range(600)
    kinds = ("signup", "view", "click", "purchase", "error")
    columns = {
        "event_id": pa.array(n, pa.int64()),
        "ts": pa.array([datetime(2024, 1, 1) + timedelta(seconds=37 * i) for i in n], pa.timestamp("us")),
        "user_id": pa.array([i * 7 % 90 for i in n], pa.int64()),
        "event_type": pa.array([kinds[i % 5] for i in n]),
        "value": pa.array([i / 2 for i in n]),
        "props": pa.array([f'{{"k": {i * 11 % 100}}}' for i in n]),
    }
    pq.write_table(pa.table(columns), folder / "events.parquet")
    return str(folder)


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


@pytest.mark.parametrize("query", [event_queries.QUERIES["a10_bad_records"], sink_queries.QUERIES["g1_event_cells"]])
def test_filters_build_the_field_map_once(spark, tables, query):
    assert "\n".join(_plan(query(spark, tables))).count("map_from_entries") == 1


def test_row_key_is_hashed_once_a_record(spark, tables):
    plan = _plan(sink_queries.QUERIES["g1_event_cells"](spark, tables))
    inline = next(i for i, line in enumerate(plan) if "inline" in line)
    assert [i > inline for i, line in enumerate(plan) if "sha2(" in line] == [True]


def test_tasks_follow_the_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(inputs.tasks_for, "__defaults__", (50,))
    rows = inputs.event_fields(spark, tables).select("fields")
    assert rows.rdd.getNumPartitions() == 12


def test_files_of_a_task_are_few(spark, tables, monkeypatch):
    monkeypatch.setattr(captures, "EVENTS_PER_FILE", 10)
    monkeypatch.setattr(captures, "FILES_PER_TASK", 3)
    made = captures.capture_files(spark, tables)
    assert made.rdd.getNumPartitions() >= 20
    assert made.count() == 60


def test_batches_of_large_frames_are_small(monkeypatch):
    monkeypatch.setattr(pcap, "_BATCH_BYTES", 1000)
    frame = lambda i: (i, (i, 400, 400, 1, "micro", bytes(400), None))
    made = list(pcap.frame_batches("f", "", "r", "s", map(frame, range(10))))
    assert [b.num_rows for b in made] == [3, 3, 3, 1]
    assert [n for b in made for n in b.column("frame_no").to_pylist()] == list(range(10))


def test_leaves_are_sent_in_small_batches():
    assert files._BATCH_BYTES <= 4 << 20


def test_template_is_read_once_a_chunk(monkeypatch):
    fields = {"SYSTEM_EVENTID": "104", "SYSTEM_COMPUTER": "host", "EVENTDATA_DATA_LOGONTYPE": "3"}
    chunk = captures.log_file([(i, fields) for i in range(40)])[4096:]
    reads, read = [], event_logs._Xml._element
    monkeypatch.setattr(event_logs._Xml, "_element", lambda self, at, *rest: reads.append(at) or read(self, at, *rest))
    got = list(event_logs._records(chunk))
    assert [(n, error) for n, _, _, error in got] == [(i, None) for i in range(40)]
    assert {k: v for k, (v, _) in got[39][2].items()} == fields
    assert max(reads.count(at) for at in set(reads)) == 1


def test_chunks_are_dealt_over_the_tasks_asked_for(spark):
    content = captures.log_file([(i, {"SYSTEM_EVENTID": "104"}) for i in range(300)])
    logs = spark.createDataFrame([("a", "", bytearray(content))], "source_file string, member string, content binary")
    read = event_logs.read_evtx(logs, tasks=7)
    assert read.rdd.getNumPartitions() == 7
    assert sorted(r["record_id"] for r in read.select("record_id").collect()) == list(range(300))


def test_cells_of_stored_records_are_not_cached(spark, tables, monkeypatch):
    from pyspark.sql import DataFrame

    kept, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(1) or persist(self, *a))
    for name in ("g5_write_packets", "g5_write_events"):
        back = sink_queries.QUERIES[name](spark, tables)
        assert back.count() == back.select("row_key", "family", "qualifier", "cell_ts").distinct().count()
    assert not kept
