"""All registered queries with their oracle SQL, collected from the query modules."""

from __future__ import annotations

from importlib import import_module

MODULES = ["packet_queries", "flow_queries", "metric_queries", "event_queries", "sink_queries", "source_queries", "log_queries", "stream_queries"]


def collect() -> tuple[dict, dict]:
    queries, oracles = {}, {}
    for name in MODULES:
        module = import_module(f"flowloom.plans.{name}")
        queries.update(module.QUERIES)
        oracles.update(module.ORACLES)
    return queries, oracles
