"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words in every contract of this subpackage.
SPACES = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a folder of our own only where a local session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="flowloom-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def shared_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back.

    What follows starts from files that outlive any executor, and is computed once however often it is read.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: Column | str) -> Column:
    """A text, where a null one counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def per_process(key: str, build: Callable):
    """What ``build`` returns, built once in each Python process, so once for all tasks of a worker."""
    kept = sys.modules.setdefault("_flowloom_llm_kept", types.ModuleType("_flowloom_llm_kept")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def slices(sizes, most: int):
    """(start, end) ranges over ``sizes`` of about ``most`` in total each, at least one item long."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
