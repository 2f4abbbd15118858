"""Merkle manifest of a dataset: leaf digests, a subtree per group of documents, and a tree over the groups.

Where a leaf lies in its group is not found by sorting the leaves. The ids of a group form a compressed bitmap, one row
for each 64-bit word that holds a bit, merged by ``bit_or`` from what every partition has. A popcount directory of four
levels, each with at most 65,536 children under one parent, says how many rows come before a word; the rank of an id is
that plus the bits below its own. The tree is then reduced by blocks of 3**6 leaves: a task puts the digests of a block
into an array by slot and hashes it six levels up, so that every round leaves a 729th of the nodes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import shared_table

#: Children of a node.
FAN = 3
#: Levels that one block reduces, and its slots.
LEVELS = 6
SLOTS = FAN**LEVELS
#: Rows of one word beyond which rows that share an id are ordered in parts by the first digits of their digests.
ORDERED_TOGETHER = 10_000
#: Ids of a word, and the children of a directory entry, as powers of two.
WORD_BITS, NODE_BITS = 6, 16
#: The word of rows without an id, before any other.
NO_WORD = -(1 << 57) - 1

SIBLINGS = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def digest(*values: Column) -> Column:
    """Hex SHA-256 of the values in a row: ``-`` for a null one, else its UTF-8 byte count, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def fold(leaf: Column | str, proof: Column | str) -> Column:
    """The root that a leaf digest and the siblings of its proof lead to."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(proof, start, lambda node, by: F.sha2(F.concat(by["left"], node, by["right"]), 256))


def proof_digest(proof: Column | str) -> Column:
    """Hex SHA-256 of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda by: F.concat(by["left"], by["right"])), ""), 256)


def _hash(texts: list[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _levels(nodes: list[str], closed: bool) -> list[list[str]]:
    """A block's nodes level by level; a closed one, which is a whole tree, ends at its single top."""
    out = [nodes]
    for _ in range(LEVELS):
        if closed and len(out[-1]) == 1:
            break
        out.append([_hash(out[-1][i : i + FAN]) for i in range(0, len(out[-1]), FAN)])
    return out


def _slots(block: pa.Table) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(row, slot) of each node and the digests by slot; a row of several equal nodes fills as many slots."""
    copies = block["copies"].to_numpy()
    rows = np.repeat(np.arange(len(copies)), copies)
    slots = np.repeat(block["slot"].to_numpy() - np.cumsum(copies) + copies, copies) + np.arange(len(rows))
    nodes = np.empty(len(rows), object)
    nodes[slots] = block["digest"].to_numpy(zero_copy_only=False)[rows]
    return rows, slots, nodes.tolist()


def _raise(rows: DataFrame) -> DataFrame:
    """The nodes six levels above those of ``rows`` (grp, total, block, slot, copies, digest), in the same columns."""

    def top(block: pa.Table) -> pa.Table:
        total = block["total"][0].as_py()
        node = _levels(_slots(block)[2], total <= SLOTS)[-1][0]
        at = block["block"][0].as_py()
        above = 1 if total <= SLOTS else -(-total // SLOTS)
        return pa.table({"grp": [block["grp"][0].as_py()], "total": [above], "block": [at // SLOTS], "slot": [at % SLOTS], "copies": [1], "digest": [node]})

    kept = rows.select("grp", "total", "block", "slot", "copies", "digest")
    return kept.groupBy("grp", "block").applyInArrow(top, "grp string, total long, block long, slot long, copies long, digest string")


def _prove(rows: DataFrame, parents: DataFrame) -> DataFrame:
    """One row per node of ``rows``, with ``proof`` and ``top``: the siblings in its block, then those of the block's own
    node, which ``parents`` (grp, block, up, top) has."""
    kept = [f for f in rows.schema.fields if f.name not in ("total", "copies")]
    schema = T.StructType([*kept, T.StructField("proof", SIBLINGS), T.StructField("top", T.StringType())])

    def prove(block: pa.Table, parent: pa.Table) -> pa.Table:
        rows, slots, nodes = _slots(block)
        levels = _levels(nodes, block["total"][0].as_py() <= SLOTS)
        left, right, index = [], [], []
        at = slots
        for level in levels[:-1]:
            index.append(at + len(left))
            runs = [level[i : i + FAN] for i in range(0, len(level), FAN)]
            left += ["".join(run[:k]) for run in runs for k in range(len(run))]
            right += ["".join(run[k + 1 :]) for run in runs for k in range(len(run))]
            at = at // FAN
        for by in parent["up"][0].as_py():
            index.append(np.full(len(rows), len(left)))
            left.append(by["left"])
            right.append(by["right"])
        picked = pa.array(np.stack(index, axis=1).ravel() if index else np.zeros(0, "i8"), pa.int64())
        siblings = pa.StructArray.from_arrays([pa.array(left, pa.string()).take(picked), pa.array(right, pa.string()).take(picked)], ["left", "right"])
        proof = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * len(index), pa.int32()), siblings)
        out = block.select([f.name for f in kept]).combine_chunks().take(pa.array(rows))
        out = out.set_column(out.schema.get_field_index("slot"), "slot", pa.array(slots, pa.int64()))
        return out.append_column("proof", proof).append_column("top", pa.array([parent["top"][0].as_py()] * len(rows), pa.string()))

    return rows.groupBy("grp", "block").cogroup(parents.groupBy("grp", "block")).applyInArrow(prove, schema)


def _tree(rows: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of ``rows``, a table, up to the tops of all groups; ``most`` is the largest group's number of leaves."""
    rounds = [rows]
    while True:
        rows = shared_table(_raise(rows))
        if most <= SLOTS:
            return rounds, rows
        rounds.append(rows)
        most = -(-most // SLOTS)


def _descend(rounds: list[DataFrame], parents: DataFrame) -> DataFrame:
    """The first round's nodes with their whole proofs, from those of the tops."""
    for rows in rounds[:0:-1]:
        proven = _prove(rows, parents)
        parents = proven.select("grp", (F.col("block") * SLOTS + F.col("slot")).alias("block"), F.col("proof").alias("up"), "top")
    return _prove(rounds[0], parents)


def _directory(words: DataFrame) -> DataFrame:
    """``words`` (grp, word, bits, n) with the rows of the group before each word (``base``) and in all (``total``)."""
    tables = [words.withColumnRenamed("word", "k0")]
    for j in range(1, 4):
        tables.append(tables[-1].groupBy("grp", F.shiftright(f"k{j - 1}", NODE_BITS).alias(f"k{j}")).agg(F.sum("n").alias("n")))
    group = Window.partitionBy("grp")
    found = tables[3].select("grp", "k3", (F.sum("n").over(group.orderBy("k3")) - F.col("n")).alias("base"), F.sum("n").over(group).alias("total"))
    for j in (2, 1, 0):
        parent = F.shiftright(f"k{j}", NODE_BITS)
        own = tables[j].withColumn(f"k{j + 1}", parent)
        before = F.sum("n").over(Window.partitionBy("grp", f"k{j + 1}").orderBy(f"k{j}")) - F.col("n")
        found = own.withColumn("before", before).join(found, ["grp", f"k{j + 1}"]).withColumn("base", F.col("base") + F.col("before")).drop("before", f"k{j + 1}", *([] if j == 0 else ["n"]))
    return found.withColumnRenamed("k0", "word")


def _indexed(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` (grp, id, digest, row) as a table of (grp, total, block, slot, copies, id, digest, row), and the rows of
    the largest group. Rows that are equal in all columns become one row of several copies per block."""
    rows = rows.withColumn("word", F.coalesce(F.shiftright("id", WORD_BITS), F.lit(NO_WORD)))
    rows = rows.withColumn("pos", F.coalesce(F.col("id").bitwiseAND((1 << WORD_BITS) - 1), F.lit(0)).cast("int"))
    # Null ids have a word of their own, so the bit of position 0 is theirs alone there.
    words = shared_table(rows.groupBy("grp", "word").agg(F.bit_or(F.expr("shiftleft(1L, pos)")).alias("bits"), F.count("*").alias("n")))
    found = shared_table(_directory(words))
    single = F.col("n") == F.bit_count("bits")
    most, shared = found.agg(F.max("total"), F.max((~single).cast("int"))).first()
    rank = F.expr("bit_count(bits & ~shiftleft(-1L, pos))")
    kept = ["grp", "total", "first", "copies", "id", "digest", "row"]
    alone = rows.join(found.filter(single), ["grp", "word"])
    alone = alone.withColumn("first", F.col("base") + rank).withColumn("copies", F.lit(1).cast("long")).select(*kept)
    placed = alone.withColumn("block", F.expr(f"first div {SLOTS}"))
    if shared:  # some rows share an id: these words are ordered by id and digest
        digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.col("n") / ORDERED_TOGETHER))).cast("int")
        same = rows.join(found.filter(~single), ["grp", "word"]).withColumn("part", F.substring("digest", F.lit(1), digits))
        same = same.groupBy("grp", "total", "word", "base", "pos", "part", "id", "digest", "row").agg(F.count("*").alias("copies"))
        same = shared_table(same)
        part = ["grp", "word", "pos", "part"]
        before = F.sum("held").over(Window.partitionBy("grp", "word").orderBy("pos", "part")) - F.col("held")
        starts = same.groupBy(*part).agg(F.sum("copies").alias("held")).withColumn("start", before)
        within = F.sum("copies").over(Window.partitionBy(*part).orderBy("digest", F.xxhash64("row")).rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
        same = same.withColumn("within", within).join(starts, part)
        same = same.withColumn("first", F.col("base") + F.col("start") + F.col("within")).select(*kept)
        same = same.withColumn("block", F.explode(F.expr(f"sequence(first div {SLOTS}, (first + copies - 1) div {SLOTS})")))
        placed = placed.unionByName(same)
    begin = F.greatest("first", F.col("block") * SLOTS)
    end = F.least(F.col("first") + F.col("copies"), (F.col("block") + 1) * SLOTS)
    return shared_table(placed.select("grp", "total", "block", (begin - F.col("block") * SLOTS).alias("slot"), (end - begin).alias("copies"), "id", "digest", "row")), most or 0


def _numbered(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``number``, from 0 in the order of ``key``, whose values differ."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    dealt = shared_table(df.repartitionByRange(key).sortWithinPartitions(key).select("*", F.spark_partition_id().alias("part"), place.alias("place")))
    # One row per range of keys.
    starts = dealt.groupBy("part").agg(F.count("*").alias("n")).withColumn("start", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    return dealt.join(starts, "part").withColumn("number", F.col("place") + F.col("start")).drop("part", "place", "n", "start")


def manifest(df: DataFrame, id_column: str = "doc_id", group: str = "source", leaf: str = "leaf") -> DataFrame:
    """``df``, whose ``leaf`` are digests, with ``subroot``, ``root`` and ``proof`` of each row.

    Leaves ascend by id within their group, groups by the UTF-8 bytes of their name; a null id or group comes first.
    Rows of one id are ordered by their leaf, so equal ones are interchangeable, and every row is a leaf of its own.
    ``proof`` has the siblings (left, right) of each level from the leaf to the root, each the joined digests of up to
    two nodes. Ids are 64-bit integers and may be sparse or negative. Columns of ``df`` with the three added names are
    replaced; other names are free. Copies are told apart by all columns, which must not be maps. An empty table has no
    root and stays empty. A null leaf is an error.
    """
    df = df.drop("subroot", "root", "proof")
    carried = [c for c in df.columns if c not in (id_column, leaf)]
    key = F.coalesce(F.concat(F.lit("v"), F.col(group).cast("string")), F.lit("n"))
    told = F.coalesce(F.col(leaf), F.raise_error(F.lit("a leaf digest is null")).cast("string"))
    rows, most = _indexed(df.select(key.alias("grp"), F.col(id_column).cast("long").alias("id"), told.alias("digest"), F.struct(*carried).alias("row")))
    rounds, tops = _tree(rows, most)
    # The tree over the groups has the same shape, with the group names as rows.
    groups = _numbered(tops.select(F.col("grp").alias("name"), "digest"), "name")
    total = groups.count()
    block = F.expr(f"number div {SLOTS}")
    groups = shared_table(
        groups.select(F.lit("").alias("grp"), F.lit(total).cast("long").alias("total"), block.alias("block"), F.expr(f"number % {SLOTS}").alias("slot"), F.lit(1).cast("long").alias("copies"), "digest", "name")
    )
    group_rounds, group_top = _tree(groups, total)
    empty = F.array().cast(SIBLINGS)
    upper = _descend(group_rounds, group_top.select("grp", F.lit(0).cast("long").alias("block"), empty.alias("up"), F.col("digest").alias("top")))
    parents = upper.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("block"), F.col("proof").alias("up"), F.col("digest").alias("top"))
    root = next((r.digest for r in group_top.select("digest").collect()), None)  # one row
    proven = _descend(rounds, parents)
    columns = {id_column: F.col("id").cast(df.schema[id_column].dataType), leaf: F.col("digest")} | {c: F.col(f"row.`{c}`") for c in carried}
    return proven.select(*(columns[c].alias(c) for c in df.columns), F.col("top").alias("subroot"), F.lit(root).cast("string").alias("root"), "proof")
