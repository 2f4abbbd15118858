"""N-gram Jaccard join: documents whose sets of word shingles are alike, and the groups that such links form.

1.  Shingles are hashed from the bytes of the texts, and documents with one set become one (``sets``).
2.  Shingles meet by hash range, packed as arrays, to learn in how many sets each occurs, and return to their sets.
    Those that occur once come first in every set and can link nothing, so most sets are done here.
3.  The rest keep a rare-first prefix, long enough that two alike sets share a shingle of it.
4.  Star round: among sets of like size that share a prefix shingle, each is verified against the one with the fewest
    rare shingles. Exact round: wherever a prefix shingle still joins sets of different groups, the pairs that pass the
    length, positional and suffix filters are verified, each once. A pair already in one group needs no verification,
    which spares the square of a group's size, and no link between groups is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import shared_table, slices

#: Bytes of text that a task hashes at a time, and shingles that it packs at a time.
SLICE_BYTES = 1 << 20
PACKED = 2_000_000
#: Shingles of a hash range, about, and of a group of sets.
RANGE_SHINGLES = 2_000_000
#: Parts of the shingle space that the suffix filter counts by.
BANDS = 64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype="u8") + 1
_LOWER[0x41:0x5B] += 0x20
_FACTOR = 0x9E3779B97F4A7C15 | 3
_PLACES = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93], "u8")


def _mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Sets of shingle hashes of many texts at once; words are hashed by prefix sums of a polynomial of their bytes."""

    def __init__(self, width: int):
        if not 1 <= width <= len(_PLACES):
            raise ValueError(f"shingles have 1 to {len(_PLACES)} words")
        self.width = width
        inverse = pow(_FACTOR, -1, 1 << 64)
        self.factors = [np.ones(1, "u8"), np.ones(1, "u8")]
        self.bases = (np.uint64(_FACTOR), np.uint64(inverse))

    def powers(self, n: int) -> list[np.ndarray]:
        if len(self.factors[0]) < n:
            self.factors = [np.concatenate([np.ones(1, "u8"), np.cumprod(np.full(n, b), dtype="u8")]) for b in self.bases]
        return self.factors

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text number) of each word of the texts that ``offsets`` cut ``data`` into."""
        ink = ~_SPACE[data]
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        begin = np.flatnonzero(ink & (border[:-1] | ~np.concatenate([[False], ink[:-1]])))
        end = np.flatnonzero(ink & (border[1:] | ~np.concatenate([ink[1:], [False]]))) + 1
        up, down = self.powers(len(data) + 1)
        sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(_LOWER[data] * up[: len(data)], dtype="u8")])
        hashes = _mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype("u8"))
        return hashes, np.searchsorted(offsets, begin, "right") - 1

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shingles, ends): the sorted distinct shingle hashes of the texts, one after the other."""
        n = len(offsets) - 1
        hashes, owner = self.words(data, offsets)
        w = self.width
        many = len(hashes) - w + 1
        if many > 0:
            inside = np.flatnonzero(owner[:many] == owner[w - 1 :])
            mixed = np.full(len(inside), w, "u8")
            for k in range(w):
                mixed += hashes[inside + k] * _PLACES[k]
            shingles, own = _mix(mixed), owner[inside]
        else:
            shingles, own = np.zeros(0, "u8"), np.zeros(0, "i8")
        counts = np.bincount(owner, minlength=n)
        first = np.cumsum(counts) - counts
        short = np.flatnonzero((counts > 0) & (counts < w))
        mixed = counts[short].astype("u8")
        for k in range(w - 1):
            there = counts[short] > k
            mixed[there] += hashes[first[short[there]] + k] * _PLACES[k]
        shingles, own = np.concatenate([shingles, _mix(mixed)]), np.concatenate([own, short])
        if len(short):
            order = np.argsort(own, kind="stable")
            shingles, own = shingles[order], own[order]
        ends = np.cumsum(np.bincount(own, minlength=n))
        out, sizes, a = [], np.zeros(n, "i8"), 0
        for i, b in enumerate(ends.tolist()):
            if b > a:
                one = np.sort(shingles[a:b])
                one = one[np.concatenate([[True], one[1:] != one[:-1]])]
                out.append(one)
                sizes[i] = len(one)
            a = b
        return np.concatenate(out) if out else np.zeros(0, "u8"), np.cumsum(sizes)


def digests(shingles: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set, 0 for empty ones."""
    out = []
    for seed in (0x1234567, 0x89ABCDEF):
        sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(_mix(shingles, seed), dtype="u8")])
        out.append(np.diff(sums[np.concatenate([[0], ends])]))
    return out[0], out[1]


def _texts(batch: pa.RecordBatch, column: int):
    """(first row, rows, bytes, offsets) of slices of a text column."""
    texts = batch.column(column)
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, texts.offset * 4)
    data = np.frombuffer(texts.buffers()[2], "u1") if texts.buffers()[2] is not None else np.zeros(0, "u1")
    for a, b in slices(np.diff(offsets), SLICE_BYTES):
        yield a, b - a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def sets_of(df: DataFrame, id_column: str, text: str, width: int) -> DataFrame:
    """(id, n, sig, sig2) of every row: the size of its set and two digests of it."""

    def run(batches):
        hasher = Hasher(width)
        for batch in batches:
            for a, rows, data, offsets in _texts(batch, 1):
                shingles, ends = hasher.sets(data, offsets)
                one, two = digests(shingles, ends)
                n = np.diff(np.concatenate([[0], ends]))
                columns = [batch.column(0).slice(a, rows), pa.array(n), pa.array(one.view("i8")), pa.array(two.view("i8"))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "sig", "sig2"])

    kind = T.StructType([T.StructField("id", df.schema[id_column].dataType), *(T.StructField(c, T.LongType()) for c in ("n", "sig", "sig2"))])
    return df.select(id_column, text).mapInArrow(run, kind)


def _blob(array: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(array, kind).tobytes()


def _joined(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table[column].to_pylist()), kind)


def repeated_shingles(df: DataFrame, text: str, width: int, range_bits: int, group_bits: int) -> DataFrame:
    """(grp, sigs, shingles, dfs): which shingles of which sets occur in two sets or more, packed by group of sets.

    A task sends the shingles of each distinct set it meets once, by hash range; a range counts the sets of each.
    """

    def send(batches):
        hasher, seen = Hasher(width), set()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush():
            if not held:
                return
            shingles = np.concatenate([h[0] for h in held])
            sigs = np.concatenate([h[1] for h in held])
            owner = np.repeat(np.arange(len(sigs)), np.concatenate([h[2] for h in held]))
            held.clear()
            parts = (shingles >> np.uint64(64 - range_bits)).astype("u4")
            order = np.argsort(parts.astype("u2") if range_bits <= 16 else parts, kind="stable")
            parts, shingles, owner = parts[order], shingles[order], owner[order]
            new = np.concatenate([[True], (parts[1:] != parts[:-1]) | (owner[1:] != owner[:-1])])
            places = np.arange(len(parts))
            new |= (places - np.maximum.accumulate(np.where(new, places, 0))) % 0xFFFF == 0  # lengths have 16 bits
            runs = np.flatnonzero(new)
            lengths = np.diff(np.concatenate([runs, [len(parts)]]))
            cut = np.flatnonzero(np.concatenate([[True], parts[runs][1:] != parts[runs][:-1]]))
            upto = np.concatenate([cut, [len(runs)]])
            rows = []
            for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
                i, j = runs[a], runs[b] if b < len(runs) else len(parts)
                rows.append((int(parts[i]), _blob(sigs[owner[runs[a:b]]], "<u8"), _blob(lengths[a:b], "<u2"), _blob(shingles[i:j], "<u8")))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["part", "sigs", "counts", "shingles"])

        total = 0
        for batch in batches:
            for _, _, data, offsets in _texts(batch, 0):
                shingles, ends = hasher.sets(data, offsets)
                sigs, _ = digests(shingles, ends)
                begins = np.concatenate([[0], ends[:-1]])
                fresh = [i for i, s in enumerate(sigs.tolist()) if ends[i] > begins[i] and not (s in seen or seen.add(s))]
                if fresh:
                    sizes = (ends - begins)[fresh]
                    held.append((np.concatenate([shingles[begins[i] : ends[i]] for i in fresh]), sigs[fresh], sizes))
                    total += int(sizes.sum())
                if total >= PACKED:
                    yield from flush()
                    total = 0
        yield from flush()

    def count(table: pa.Table) -> pa.Table:
        shingles = _joined(table, "shingles", "<u8")
        sigs = np.repeat(_joined(table, "sigs", "<u8"), _joined(table, "counts", "<u2"))
        order = np.lexsort((sigs, shingles))
        shingles, sigs = shingles[order], sigs[order]
        once = np.concatenate([[True], (shingles[1:] != shingles[:-1]) | (sigs[1:] != sigs[:-1])])  # copies in other tasks
        shingles, sigs = shingles[once], sigs[once]
        starts = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
        sets = np.diff(np.concatenate([starts, [len(shingles)]]))
        held = np.repeat(sets, sets)
        keep = held > 1
        shingles, sigs, held = shingles[keep], sigs[keep], np.minimum(held[keep], 0xFFFF)  # an order is all it gives
        group = (sigs >> np.uint64(64 - group_bits)).astype("u4")
        order = np.argsort(group, kind="stable")
        group, shingles, sigs, held = group[order], shingles[order], sigs[order], held[order]
        cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, "i8"), [len(group)]])
        rows = [(int(group[a]), _blob(sigs[a:b], "<u8"), _blob(shingles[a:b], "<u8"), _blob(held[a:b], "<u2")) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        return pa.Table.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["grp", "sigs", "shingles", "dfs"])

    sent = df.select(text).mapInArrow(send, "part int, sigs binary, counts binary, shingles binary")
    return sent.groupBy("part").applyInArrow(count, "grp int, sigs binary, shingles binary, dfs binary")


CANDIDATES = "sig long, n long, singles long, shingles binary, bands array<int>, prefix array<long>"


def candidates(repeated: DataFrame, sets: DataFrame, group_bits: int, percent: int) -> DataFrame:
    """Sets whose rare-first prefix reaches shingles that other sets have, as ``CANDIDATES``.

    ``shingles`` are those that occur elsewhere, sorted; ``prefix`` its first ones by number of sets, then hash, after
    the ``singles`` that occur nowhere else.
    """
    grouped = sets.select(F.shiftrightunsigned("sig", 64 - group_bits).cast("int").alias("grp"), "sig", "n")

    def choose(blobs: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if blobs.num_rows and known.num_rows:
            sigs, shingles, held = _joined(blobs, "sigs", "<u8"), _joined(blobs, "shingles", "<u8"), _joined(blobs, "dfs", "<u2")
            order = np.lexsort((shingles, held, sigs))
            sigs, shingles = sigs[order], shingles[order]
            sizes = dict(zip(known["sig"].to_numpy().view("u8").tolist(), known["n"].to_pylist(), strict=True))
            starts = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]]))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(sigs)], strict=True):
                n = sizes[int(sigs[a])]
                singles = n - (b - a)
                reach = n - -(-percent * n // 100) + 1 - singles
                if reach > 0:
                    own = np.sort(shingles[a:b])
                    bands = np.bincount(own & np.uint64(BANDS - 1), minlength=BANDS)
                    prefix = shingles[a : min(b, a + reach)].view("i8")
                    out.append((sigs[a : a + 1].view("i8")[0], n, singles, own.tobytes(), bands, prefix))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["sig", "n", "singles", "shingles", "bands", "prefix"])

    return repeated.groupBy("grp").cogroup(grouped.groupBy("grp")).applyInArrow(choose, CANDIDATES)


def verify(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that are alike, each tested once by merging its sorted shingles."""
    sides = [found.select(F.col("sig").alias(s), F.col("n").alias(f"n_{s}"), F.col("shingles").alias(f"s_{s}")) for s in ("a", "b")]
    full = pairs.join(sides[1], "b").join(sides[0], "a")

    def run(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                n = batch["n_a"][i].as_py() + batch["n_b"][i].as_py()
                a, b = (np.frombuffer(batch[c][i].as_buffer(), "<u8") for c in ("s_a", "s_b"))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= percent * (n - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the smallest node that it reaches.

    Rounds of two steps, each a grouped minimum and a join: every node hands its larger neighbours, then its smaller
    ones, to the smallest it knows. The number of rounds grows with the logarithm of the longest chain.
    """
    edges = shared_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        lower = larger.join(least, "u")
        edges = shared_table(lower.select("u", F.col("m").alias("v")).union(lower.select(F.col("v").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def star_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """For each set one pair, with the set of fewest singles among those of like size that share a prefix shingle."""
    like = F.floor(F.log(F.col("n")) / math.log(100 / percent)) if percent < 100 else F.col("n")
    posts = posts.withColumn("like", like)
    hubs = posts.groupBy("shingle", "like").agg(F.min(F.struct("singles", "sig")).alias("hub"))
    met = posts.join(hubs, ["shingle", "like"]).filter("hub.sig <> sig")
    return met.groupBy("sig").agg(F.min("hub").alias("hub")).select(F.least("sig", "hub.sig").alias("a"), F.greatest("sig", "hub.sig").alias("b")).distinct()


def exact_pairs(posts: DataFrame, found: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The pairs of sets of different groups that share a prefix shingle and pass the filters, each once."""
    named = posts.select("sig", "shingle", "at").join(groups.select(F.col("node").alias("sig"), "root"), "sig", "left")
    named = named.withColumn("root", F.coalesce("root", "sig"))
    sizes = named.groupBy("shingle", "root").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("shingle").agg(F.max(F.struct("c", "root"))["root"].alias("main"), F.count("*").alias("groups")).filter("groups > 1").drop("groups")
    rows = shared_table(named.join(mixed, "shingle").join(found.select("sig", "n", "bands"), "sig"))
    b = rows.filter("root <> main").select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("sig", "n", "at", "root", "bands")])
    a = rows.select("shingle", "main", *[F.col(c).alias(f"{c}_a") for c in ("sig", "n", "at", "root", "bands")])
    need = F.expr(f"({percent} * (n_a + n_b) + {99 + percent}) div {100 + percent}")
    ends = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    most = F.aggregate(F.zip_with("bands_a", "bands_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    once = (F.col("root_a") == F.col("main")) | (F.col("sig_a") < F.col("sig_b"))
    sizes_fit = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    met = a.join(b, (a["shingle"] == b["shingle"]) & (F.col("root_a") != F.col("root_b")) & once & sizes_fit & (ends >= need) & (most >= need))
    return met.select(F.least("sig_a", "sig_b").alias("a"), F.greatest("sig_a", "sig_b").alias("b")).distinct()


def jaccard_groups(df: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``df``.

    Words are runs without white space, A to Z in lower case. A set holds the distinct ``width``-word shingles of the
    whole text, or a shorter text's words as one; null, empty and blank texts have none and are linked with nothing.
    Rows link when 100 * intersection >= percent * union. ``component_id`` is the smallest id reachable by links, so
    copies get one id; rows that repeat an id each come back; a null id counts where no other is in its group. Shingles
    and sets are told apart by 64 and 128-bit hashes.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent is 1 to 100")
    rows = shared_table(sets_of(df, id_column, text, width))
    sets = shared_table(rows.filter("n > 0").groupBy("sig", "sig2", "n").agg(F.min("id").alias("id")))
    total = sets.agg(F.sum("n")).first()[0] or 0
    range_bits = max(6, math.ceil(math.log2(max(1, total / RANGE_SHINGLES))))
    group_bits = max(6, range_bits - 1)
    repeated = repeated_shingles(df, text, width, range_bits, group_bits)
    found = shared_table(candidates(repeated, sets, group_bits, percent))
    posts = found.select("sig", "n", "singles", F.posexplode("prefix").alias("i", "shingle")).withColumn("at", F.col("singles") + F.col("i"))
    stars = shared_table(verify(star_pairs(posts, percent), found, percent))
    groups = shared_table(components(stars))
    more = verify(exact_pairs(posts, found, groups, percent), found, percent)
    # Groups and the links between them are a graph in which every group is a star.
    roots = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    named = sets.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    of_set = named.join(least, "root").select("sig", "sig2", "n", "component_id")
    joined = rows.join(of_set, ["sig", "sig2", "n"], "left")
    return joined.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
