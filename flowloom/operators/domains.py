"""Registrable domains by the caller's suffix rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def url_host(url: Column | str) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def registrable_domain(df: DataFrame, host: str, rules: DataFrame) -> DataFrame:
    """Add ``suffix`` and ``domain`` (suffix plus one label, NULL when there is none).

    ``rules(suffix, rule)`` holds exact, wildcard (any one label before the suffix) and
    exception rules of any depth. An exception wins over everything, else the longest rule does,
    and a host no rule fits has its last label as suffix. Every distinct host is looked up once,
    at all its depths in one join, so a frequent host costs no more than a rare one.
    """
    kinds = ("exact", "wildcard", "exception")
    dim = rules.groupBy("suffix").agg(*[F.bool_or(F.col("rule") == k).alias(k) for k in kinds])
    hosts = df.select(F.col(host).alias("_host")).filter("_host IS NOT NULL").distinct()
    labels = F.split("_host", r"\.")
    tails = hosts.select("_host", F.size(labels).alias("_size"), F.explode(F.sequence(F.lit(1), F.size(labels))).alias("_depth"))
    tail = F.array_join(F.slice(labels, F.col("_size") - F.col("_depth") + 1, F.col("_depth")), ".")
    met = tails.withColumn("suffix", tail).join(dim, "suffix")
    depth = F.col("_depth")
    longest = F.greatest(F.when(F.col("exact"), depth), F.when(F.col("wildcard") & (F.col("_size") > depth), depth + 1))
    ruled = met.groupBy("_host").agg(
        F.coalesce(F.max(F.when(F.col("exception"), depth - 1)), F.max(longest), F.lit(1)).alias("_n")
    )
    out = df.join(ruled, F.col(host) == F.col("_host"), "left").withColumn("_labels", F.split(F.col(host), r"\."))
    size, n = F.size("_labels"), F.coalesce("_n", F.lit(1))

    def last(count: Column) -> Column:
        return F.when(size >= count, F.array_join(F.slice("_labels", F.greatest(size - count + 1, F.lit(1)), count), "."))

    out = out.withColumns({"suffix": last(n), "domain": last(n + 1)})
    return out.select(*df.columns, "suffix", "domain")


def suffix_id(suffix: Column | str) -> Column:
    """32-bit polynomial text hash with factor 31, as a signed INT."""
    letters = F.split(F.col(suffix) if isinstance(suffix, str) else suffix, "")
    codes = F.transform(letters, lambda c: F.ascii(c).cast("bigint"))
    total = F.aggregate(codes, F.lit(0).cast("bigint"), lambda acc, c: F.pmod(acc * 31 + c, F.lit(1 << 32)))
    return F.when(total >= 1 << 31, total - (1 << 32)).otherwise(total).cast("int")
