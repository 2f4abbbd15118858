"""Rejected records, capture tags and ingest counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_bad(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows); the stream of records goes on past a bad one."""
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())


def bad_records(
    df: DataFrame, stage: str, raw: Column, source_file: str = "source_file", ordinal: str = "ordinal", error: str = "error"
) -> DataFrame:
    """Rejected rows in the common layout (source_file, member, ordinal, stage, reason, raw)."""
    member = F.col("member") if "member" in df.columns else F.lit(None).cast("string")
    return df.filter(F.col(error).isNotNull()).select(
        F.col(source_file).alias("source_file"),
        member.alias("member"),
        F.col(ordinal).cast("bigint").alias("ordinal"),
        F.lit(stage).alias("stage"),
        F.col(error).alias("reason"),
        raw.cast("binary").alias("raw"),
    )


def ingest_counts(df: DataFrame, by: str = "source_file", error: str = "error") -> DataFrame:
    """Total, good and bad records per file; partial sums are formed before the shuffle."""
    return df.groupBy(by).agg(
        F.count("*").alias("total"),
        F.count_if(F.col(error).isNull()).alias("good"),
        F.count_if(F.col(error).isNotNull()).alias("bad"),
    )


def tag_source(
    files: DataFrame, reference: str, pattern: str, path: str = "path", length: str = "length"
) -> DataFrame:
    """Add ``reference``, ``sensor`` (the path's first match of the pattern's group, else the reference) and ``source_file``."""
    found = F.regexp_extract(F.col(path), pattern, 1)
    return files.withColumns(
        {
            "reference": F.lit(reference),
            "sensor": F.when(found != "", found).otherwise(F.lit(reference)),
            "source_file": F.concat_ws("|", F.col(path), F.col(length).cast("string")),
        }
    )
