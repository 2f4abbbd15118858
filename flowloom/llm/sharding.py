"""Shards by extendible hashing: a directory of hash prefixes in which only oversized buckets split on another bit.

Everything is DataFrame functions. Rows are summed per prefix some bits deeper than the directory starts, so that a
bucket's splits are sums over few counters; only rows of buckets that are still too large are summed again, deeper.
The directory has a row per counter, not per row of data, and stays a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.common import shared_table

#: Bits of a key hash: 15 hexadecimal digits of its digest.
HASH_BITS = 60
#: Levels that one pass over the rows can split.
STEP = 6


def key_hash(key: Column) -> Column:
    """60 uniform bits of a key, a null key being a key of its own."""
    return F.conv(F.substring(F.md5(F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))), 1, 15), 16, 10).cast("long")


def prefix(value: Column, depth) -> Column:
    """The first ``depth`` of ``HASH_BITS`` bits."""
    depth = depth if isinstance(depth, Column) else F.lit(depth)
    return F.call_function("shiftright", value, (F.lit(HASH_BITS) - depth).cast("int"))


def start_depth(total: int, limit: int) -> int:
    """Bits of the first directory: as many buckets as shards of the limit would hold the total."""
    return max(0, (max(0, -(-total // limit) - 1)).bit_length())


def directory(rows: DataFrame, limit: int, first: int, bits: int = HASH_BITS) -> DataFrame:
    """(depth, bucket, n_rows, bytes) of ``rows`` (hash, bytes): the leaves of the hash tree.

    A bucket splits while it holds more than ``limit`` bytes in several rows and has bits left. Rows are summed ``STEP`` bits at once.
    """
    leaves, rest, depth = None, rows, first
    while True:
        deepest = min(depth + STEP, bits)
        fine = shared_table(
            rest.groupBy(prefix(F.col("hash"), deepest).alias("fine")).agg(F.count("*").alias("n_rows"), F.sum("bytes").alias("bytes"))
        )
        at = fine.select("*", F.explode(F.sequence(F.lit(depth), F.lit(deepest))).alias("depth"))
        at = at.withColumn("bucket", F.call_function("shiftright", "fine", (F.lit(deepest) - F.col("depth")).cast("int")))
        bucket = Window.partitionBy("depth", "bucket")
        held = at.withColumn("held", F.sum("bytes").over(bucket)).withColumn("held_rows", F.sum("n_rows").over(bucket))
        stop = (F.col("held") <= limit) | (F.col("held_rows") == 1) | (F.col("depth") == bits)
        cut = held.filter(stop).groupBy("fine").agg(F.min("depth").alias("depth"), F.first("n_rows").alias("n_rows"), F.first("bytes").alias("bytes"))
        cut = cut.withColumn("bucket", F.call_function("shiftright", "fine", (F.lit(deepest) - F.col("depth")).cast("int")))
        found = cut.groupBy("depth", "bucket").agg(F.sum("n_rows").alias("n_rows"), F.sum("bytes").alias("bytes"))
        leaves = found if leaves is None else leaves.unionByName(found)
        large = shared_table(fine.join(cut, "fine", "left_anti").select("fine"))
        if large.isEmpty():
            break
        rest = shared_table(rest.withColumn("fine", prefix(F.col("hash"), deepest)).join(large, "fine", "left_semi").drop("fine"))
        depth = deepest + 1
    return leaves


def shard(df: DataFrame, keys: list[str], size: Column, limit: int) -> DataFrame:
    """``df`` with ``shard_depth``, ``shard_bucket``, ``shard_part`` and ``shard_bytes``, whose triples name the shards.

    No shard exceeds ``limit`` bytes unless one row does, however long its text is. Rows with one hash, such as repeated
    rows, can't be told apart by bits; where they exceed the limit together they are stored once, so that their order
    stays, and go on to ``shard_part``, numbered by running size, in tasks of salted slices. Null keys hash like any
    other value. Columns of ``df`` with these names are replaced, any other stays; an empty table stays empty.
    """
    df = df.drop("shard_depth", "shard_bucket", "shard_part", "shard_bytes")
    key = F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("v"), F.col(k).cast("string")), F.lit("n")) for k in keys])
    rows = df.select(F.struct(*df.columns).alias("row"), key_hash(key).alias("hash"), F.coalesce(size, F.lit(0)).cast("long").alias("bytes"))
    narrow = shared_table(rows.select("hash", "bytes"))
    total = narrow.agg(F.sum("bytes")).first()[0] or 0
    first = start_depth(total, limit)
    leaves = shared_table(directory(narrow, limit, first))
    entries, held = pointers(leaves, first), F.col("leaf")
    bits = min(first + STEP, HASH_BITS)
    placed = rows.withColumn("fine", prefix(F.col("hash"), bits)).join(entries, "fine")
    placed = placed.withColumn("leaf", F.filter("leaves", lambda x: prefix(F.col("hash"), x["depth"]) == x["bucket"])[0]).drop("fine", "leaves")

    def named(rows: DataFrame, part: Column) -> DataFrame:
        return rows.select(
            "row.*", held["depth"].alias("shard_depth"), held["bucket"].alias("shard_bucket"), part.alias("shard_part"), F.col("bytes").alias("shard_bytes")
        )

    zero = F.lit(0).cast("long")
    if leaves.filter((F.col("bytes") > limit) & (F.col("n_rows") > 1)).isEmpty():
        return named(placed, zero)
    large = _parts(shared_table(placed.filter(held["bytes"] > limit)), limit)
    return named(placed.filter(held["bytes"] <= limit), zero).unionByName(named(large, F.col("part")))


def pointers(leaves: DataFrame, first: int) -> DataFrame:
    """(fine, leaves): for each prefix of the first pass, the leaves below or above it.

    There is one, but where a hot hash was split further: then one for each bit on its way down at most.
    """
    bits = min(first + STEP, HASH_BITS)
    span = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.lit(bits) - F.col("depth"), F.lit(0)))
    low = F.when(F.col("depth") <= bits, F.col("bucket") * span).otherwise(F.call_function("shiftright", "bucket", F.greatest(F.col("depth") - bits, F.lit(0))))
    each = leaves.withColumn("fine", F.explode(F.sequence(low, low + span - 1)))
    return each.groupBy("fine").agg(F.collect_list(F.struct("depth", "bucket", "bytes")).alias("leaves"))


def _parts(rows: DataFrame, limit: int) -> DataFrame:
    """Adds ``part`` to stored rows of leaves that have no bits left, by running size within salted slices of a leaf.

    A slice holds about 16 parts. A part spans the limit less the largest row, so it never exceeds the limit with rows
    that fit. A row's number in the stored table tells equal rows apart, whichever executor reads it.
    """
    slices = (F.col("leaf.bytes") / F.lit(16 * limit)).cast("long") + 1
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("place"), slices))
    by = Window.partitionBy("leaf.depth", "leaf.bucket", "salt")
    before = F.sum("bytes").over(by.orderBy("hash", "bytes", "place").rowsBetween(Window.unboundedPreceding, -1))
    unit = F.greatest(F.lit(1), F.lit(limit) - F.max("bytes").over(by))
    part = F.floor(F.coalesce(before, F.lit(0)) / unit).cast("long")
    return rows.withColumn("part", part * slices + F.col("salt"))


def shard_sizes(sharded: DataFrame) -> DataFrame:
    """One row per shard with its rows and bytes."""
    return sharded.groupBy("shard_depth", "shard_bucket", "shard_part").agg(F.count("*").alias("n_rows"), F.sum("shard_bytes").alias("bytes"))
