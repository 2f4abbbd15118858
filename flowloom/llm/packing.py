"""Packing token sequences by patterns: few-document length patterns, fitted to the histogram of lengths.

Only the histogram, with one counter per length up to the sequence size, comes to the driver. There, patterns of up to
three lengths that fill a sequence exactly are enumerated, their repeat counts fitted by non-negative least squares and
rounded, and what is left is packed best fit first. The plan says which ranks of each length go where, so placing
the pieces is a join on (length, salt) with a table of rank offsets, whatever the number of pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import per_process, shared_table, slices

#: Bytes of text that a task tokenises at a time.
SLICE_BYTES = 1 << 20
#: Distinct words that a task remembers; then it starts anew.
REMEMBERED = 300_000
#: Steps of the least squares fit. Its time does not depend on the number of pieces.
FIT_STEPS = 250
#: Pieces that one salt of a length ranks within a task, about.
RANKED_TOGETHER = 100_000

#: Letters that the tokenizer's normalisation maps one to one, then marks: the end of either ends a token.
_PLAIN = regex.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]*)([.,!?;:|]*)")


class WordEncoder:
    """Ids of whole texts, by words between blanks and line ends, which no token crosses; remembers them.

    Plain words are encoded together as one text and told apart by the tokens that end a word; other ones by themselves.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.remembered = remembered

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        vocabulary = self.model.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: set[str]) -> None:
        if len(self.known) > self.remembered:
            self.known = {"": b""}
        plain, parts, other = [], [], []
        for word in words.difference(self.known):
            m = _PLAIN.fullmatch(word)
            if m:
                plain.append(word)
                parts.append((1 if m[1] else 0) + (1 if m[2] else 0))
            else:
                other.append(word)
        for a in range(0, len(plain), 5000):
            ids = np.array(self._ids([" ".join(plain[a : a + 5000])])[0], "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            upto = np.cumsum(parts[a : a + 5000])
            if len(stops) != upto[-1]:  # a token that ends no word where one should end: encode these alone
                other += plain[a : a + 5000]
                continue
            stops = np.concatenate([[0], stops])[np.concatenate([[0], upto])]
            data = ids.tobytes()
            for word, i, j in zip(plain[a : a + 5000], stops[:-1].tolist(), stops[1:].tolist(), strict=True):
                self.known[word] = data[4 * i : 4 * j]
        for a in range(0, len(other), 1000):
            for word, ids in zip(other[a : a + 1000], self._ids(other[a : a + 1000]), strict=True):
                self.known[word] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; new words of all texts are learnt together."""
        split = [_lower(text).replace("\n", " ").split(" ") for text in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def _lower(text: str) -> str:
    """Latin-1 texts in lower case, as the tokenizer makes them anyway, so that fewer words differ; others as they are."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


def _windows(text: str, most: int = 1 << 20) -> Iterator[str]:
    """A long text cut at blanks."""
    start = 0
    while len(text) - start > most:
        cut = text.find(" ", start + most)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def pieces(df: DataFrame, path: str, size: int = 2048, text: str = "text", keep: list[str] | None = None, end_id: int = 0, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: the ``keep`` columns of ``df``, then piece, start, length and ids.

    ``ids`` are the little-endian unsigned 32-bit ids of the whole text and a closing ``end_id``, in runs of ``size``.
    A task remembers the ids of ``remembered`` words, about 200 bytes each. A null or empty text is the closing id alone. Columns of ``df`` with these names must not be in ``keep``.
    """
    keep = [c for c in df.columns if c != text] if keep is None else keep
    added = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
    schema = T.StructType([*(df.schema[c] for c in keep), *added])
    closing = int(end_id).to_bytes(4, "little")

    def run(batches):
        encoder = per_process(f"words{remembered},{path}", lambda: WordEncoder(path, remembered))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            sizes = np.diff(np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, texts.offset * 4)) if len(texts) else []
            for a, b in slices(sizes, SLICE_BYTES):
                rows, number, begin, cut = [], [], [], []
                taken = texts[a:b].to_pylist()
                if b - a > 1:
                    coded = encoder.encode([t or "" for t in taken])
                else:  # one text, perhaps a long one
                    coded = [b"".join(encoder.encode([w])[0] for w in _windows(taken[0] or ""))]
                for i, ids in enumerate(coded):
                    ids += closing
                    for k, at in enumerate(range(0, len(ids), 4 * size)):
                        rows.append(i)
                        number.append(k)
                        begin.append(at // 4)
                        cut.append(ids[at : at + 4 * size])
                part = batch.slice(a, b - a).take(pa.array(rows))
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                columns += [pa.array(number, pa.int32()), pa.array(begin, pa.int64()), pa.array([len(x) // 4 for x in cut], pa.int64()), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(*keep, text).mapInArrow(run, schema)


def few_document_patterns(size: int, lengths: np.ndarray) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, of one to three of ``lengths`` that add up to ``size``."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    out = []
    for a in lengths[::-1]:
        b = np.arange((size - a + 1) // 2, min(a, size - a) + 1)
        c = size - a - b
        ok = ((b == 0) | there[b]) & ((c == 0) | there[np.maximum(c, 0)]) & (b >= c)
        out.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), "i8")


def fit(patterns: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns with least squares sum over lengths of l * (used - held)^2.

    Projected gradient with momentum; the matrix has up to three entries a column, so products are bin counts.
    """
    size = len(histogram) - 1
    weight = np.sqrt(np.arange(size + 1, dtype="f8"))
    weight[0] = 0

    def used(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(patterns[:, k], x, size + 1) for k in range(3))

    degree = used(np.ones(len(patterns)))
    target = weight * histogram
    # Each pattern's step suits the most shared of its lengths: an error is divided among the patterns that hold it.
    step = 1.0 / np.maximum(1e-12, 3 * ((weight**2 * np.maximum(degree, 1))[patterns] * (patterns > 0)).max(axis=1))
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(steps):
        error = weight * (weight * used(y) - target)
        new = np.maximum(0.0, y - step * error[patterns].sum(axis=1))
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / nt * (new - x)
        x, t = new, nt
    return x


def whole_counts(x: np.ndarray) -> np.ndarray:
    """Whole repeat counts with the running sums of ``x``: many small counts of like patterns add up to some of one."""
    return np.diff(np.floor(np.concatenate([[0.0], np.cumsum(x)]) + 0.5)).astype("i8")


def residual_patterns(left: np.ndarray) -> list[tuple[list[int], int]]:
    """(lengths, repeats) that use up ``left``: longest first, each gap filled by the longest that fits.

    A pattern repeats as often as its scarcest length allows, so each one uses up a length or more.
    """
    left, size, out = left.copy(), len(left) - 1, []
    while left.any():
        gap, pattern, free = size, [], left.copy()
        while gap > 0:
            fits = np.flatnonzero(free[: gap + 1])
            if not len(fits):
                break
            pattern.append(int(fits[-1]))
            free[fits[-1]] -= 1
            gap -= int(fits[-1])
        lengths, times = np.unique(pattern, return_counts=True)
        repeats = int((left[lengths] // times).min())
        left[lengths] -= repeats * times
        out.append((pattern, repeats))
    return out


def plan(histogram: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, ranks, copies, first sequence, offset): where the pieces of a length go.

    Rank r of a length, counted from the slot's first rank, lies in sequence first + r // copies, at
    offset + (r % copies) * length. ``histogram[l]`` is the number of pieces of length l.
    """
    size = len(histogram) - 1
    left = histogram.astype("i8").copy()
    left[0] = 0
    chosen: list[tuple[list[int], int]] = []
    patterns = few_document_patterns(size, np.flatnonzero(left))
    if len(patterns):
        counts = whole_counts(fit(patterns, left))
        for k in np.argsort(-counts, kind="stable"):
            if counts[k] < 1:
                break
            lengths, times = np.unique(patterns[k][patterns[k] > 0], return_counts=True)
            repeats = int(min(counts[k], (left[lengths] // times).min()))
            if repeats:
                left[lengths] -= repeats * times
                chosen.append(([int(v) for v in patterns[k] if v], repeats))
    chosen += residual_patterns(left)
    ranks, sequence, slots = np.zeros(size + 1, "i8"), 0, []
    for pattern, repeats in chosen:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            copies = pattern.count(length)
            slots.append((length, int(ranks[length]), repeats * copies, copies, sequence, offset))
            ranks[length] += repeats * copies
            offset += copies * length
        sequence += repeats
    return slots


def pack(cut: DataFrame, size: int = 2048, length: str = "length", keys: list[str] | None = None) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``: where each piece of 1 to ``size`` tokens lies.

    ``cut`` is read twice, for the histogram and for placing, so it should be a table. ``keys`` order pieces of one
    length and spread them over tasks; rows equal in them are interchangeable. Columns of ``cut`` with the two names
    are replaced. An empty table stays empty; a length outside 1 to ``size`` is an error.
    """
    cut = cut.drop("sequence_id", "offset")
    keys = [c for c in cut.columns if c != length] if keys is None else keys
    total, low, high = cut.agg(F.count("*"), F.min(length), F.max(length)).first()
    if total and (low is None or low < 1 or high > size):
        raise ValueError(f"lengths must be 1 to {size}")
    salts = max(1, total // RANKED_TOGETHER)
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(salts)))
    held = shared_table(salted.groupBy(F.col(length).alias("_length"), "_salt").agg(F.count("*").alias("n")))
    histogram = np.zeros(size + 1, "i8")
    for row in held.groupBy("_length").agg(F.sum("n").alias("n")).collect():  # a counter per length
        histogram[row["_length"]] = row["n"]
    names = ["_length", "_first", "_ranks", "_copies", "_sequence", "_offset"]
    rows = np.array(plan(histogram), "i8").reshape(-1, 6)  # at most three for each pattern of lengths
    slots = cut.sparkSession.createDataFrame(pa.table({n: rows[:, k] for k, n in enumerate(names)}))
    # Which ranks a salt of a length has, and so which slots it meets.
    by = Window.partitionBy("_length").orderBy("_salt")
    ranges = held.withColumn("_before", F.sum("n").over(by) - F.col("n"))
    meets = (F.col("_before") < F.col("_first") + F.col("_ranks")) & (F.col("_first") < F.col("_before") + F.col("n"))
    met = ranges.join(slots, "_length").filter(meets).groupBy("_length", "_salt", "_before").agg(F.sort_array(F.collect_list(F.struct(*names[1:]))).alias("_slots"))
    order = Window.partitionBy(F.col(length), F.col("_salt")).orderBy(*keys)
    ranked = salted.withColumn("_rank", F.row_number().over(order) - 1)
    placed = ranked.withColumn("_length", F.col(length).cast("long")).join(met, ["_length", "_salt"])
    placed = placed.withColumn("_rank", F.col("_rank") + F.col("_before"))
    slot = F.element_at(F.filter("_slots", lambda s: s["_first"] <= F.col("_rank")), -1)
    placed = placed.withColumn("_slot", slot).withColumn("_in", F.col("_rank") - F.col("_slot._first"))
    return placed.select(
        *cut.columns,
        (F.col("_slot._sequence") + F.floor(F.col("_in") / F.col("_slot._copies"))).cast("long").alias("sequence_id"),
        (F.col("_slot._offset") + (F.col("_in") % F.col("_slot._copies")) * F.col("_length")).cast("long").alias("offset"),
    )
