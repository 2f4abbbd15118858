"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

How many toxic and how many clean training texts hold an n-gram is counted over all labelled rows, where they lie; the
log of the ratio of the two smoothed shares is the n-gram's scale. N-grams whose ratio lies within ``SIGNIFICANT``
standard errors of none tell nothing and are left out. A logistic regression over the scaled indicators is then fitted
on the driver, on a bounded sample: ``FIT_TEXTS`` distinct texts of either label, those of smallest hash, weighted back
to the labels' shares; an absolute penalty leaves few n-grams with a weight. The model is broadcast, at most
``MOST_GRAMS`` hashes and weights, and scores whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import shared_table, slices

#: Lengths of n-grams in characters of the lower-cased text, blanks included.
LENGTHS = (2, 3, 4, 5)
SIGNIFICANT = 4.0
#: Size bound of the model: the n-grams of largest ratio by standard error are kept.
MOST_GRAMS = 30_000
#: Distinct texts of each label that the regression is fitted on, at most.
FIT_TEXTS = 2_500
FIT_STEPS = 150
#: Penalties of the regression: squared, and absolute, which leaves few n-grams in the model.
PENALTY, SPARSE = 1e-4, 1e-3
SMOOTHING = 1.0
SLICE_BYTES = 1 << 20
#: Entries that a step of the fit handles at a time.
BLOCK = 1 << 20
#: N-grams that a task counts before it hands them on.
COUNTED_TOGETHER = 2_000_000

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SIEVE_BITS = 22


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, text number) of every n-gram of the texts, blank-padded, one pair of arrays per length."""
    padded = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in padded])
    h = np.zeros(len(codes), "u8")
    for n in range(1, max(LENGTHS) + 1):
        m = max(0, len(codes) - n + 1)
        h = h[:m] * _BASE + codes[n - 1 : n - 1 + m] + np.uint64(1)
        if n in LENGTHS:
            inside = owner[:m] == owner[n - 1 : n - 1 + m]
            yield h[inside], owner[:m][inside]


def _windows(text: str, most: int = SLICE_BYTES) -> Iterator[str]:
    """A long text in parts that share enough characters to lose no n-gram."""
    step = most - max(LENGTHS) + 1
    yield from (text[a : a + most] for a in range(0, max(1, len(text) - max(LENGTHS) + 1), step))


def _text_slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, texts) over the rows of a batch; a null text counts as empty."""
    texts = batch.column(batch.schema.get_field_index(text))
    sizes = np.diff(np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, texts.offset * 4)) if len(texts) else []
    for a, b in slices(sizes, SLICE_BYTES):
        yield a, b, [t or "" for t in texts[a:b].to_pylist()]


def held_by(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the distinct n-grams of each text."""
    if len(texts) == 1 and len(texts[0]) > SLICE_BYTES:
        found = np.zeros(0, "u8")
        for part in _windows(texts[0]):
            found = np.unique(np.concatenate([found, *(h for h, _ in _grams([part]))]))
        return found, np.zeros(len(found), "i8")
    pairs = list(_grams(texts))
    h, owner = (np.concatenate(x) for x in zip(*pairs, strict=True))
    order = np.argsort(owner, kind="stable")
    h, ends = h[order], np.cumsum(np.bincount(owner, minlength=len(texts)))
    sets = [np.unique(part) for part in np.split(h, ends[:-1])]
    return np.concatenate(sets), np.repeat(np.arange(len(texts)), [len(s) for s in sets])


@dataclass
class Model:
    """Sorted n-gram hashes, the weight of each (its log-count ratio included), and the offset."""

    grams: np.ndarray
    weights: np.ndarray
    offset: float


class Finder:
    """Which of the model's n-grams texts hold: a sieve of bits first, then the exact hashes."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self._slot(grams)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h * _MIX >> np.uint64(64 - _SIEVE_BITS)).astype("i8")

    def _among(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        places, owners = [], []
        for h, owner in _grams(texts) if len(self.grams) else ():
            maybe = np.flatnonzero(self.sieve[self._slot(h)])
            h, owner = h[maybe], owner[maybe]
            place = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
            same = self.grams[place] == h
            places.append(place[same])
            owners.append(owner[same])
        if not places:
            return np.zeros(0, "i8"), np.zeros(0, "i8")
        both = np.unique(np.concatenate(owners) * len(self.grams) + np.concatenate(places))
        return both % len(self.grams), both // len(self.grams)

    def find(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(place in the model, text number), each pair once, by text."""
        if len(texts) == 1 and len(texts[0]) > SLICE_BYTES:
            found = np.unique(np.concatenate([self._among([part])[0] for part in _windows(texts[0])]))
            return found, np.zeros(len(found), "i8")
        return self._among(texts)


def fit_scaled(entries: np.ndarray, sizes: np.ndarray, scale: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = FIT_STEPS) -> tuple[np.ndarray, float]:
    """Weights per column and the offset of a logistic regression over indicators times ``scale``.

    ``entries`` are the columns that the rows hold, row after row, ``sizes`` of them each. Accelerated gradient steps
    over blocks of rows; no matrix is made.
    """
    width, m = len(scale), len(sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    blocks = list(slices(sizes, BLOCK))

    def forward(w: np.ndarray, offset: float) -> np.ndarray:
        scaled, out = w * scale, np.full(m, offset)
        for a, b in blocks:
            held = np.flatnonzero(sizes[a:b])
            if len(held):
                out[a + held] += np.add.reduceat(scaled[entries[ends[a] : ends[b]]], ends[a + held] - ends[a])
        return out

    def backward(g: np.ndarray) -> tuple[np.ndarray, float]:
        out = np.zeros(width)
        for a, b in blocks:
            out += np.bincount(entries[ends[a] : ends[b]], np.repeat(g[a:b], sizes[a:b]), width)
        return out * scale, g.sum()

    v, u, largest = np.ones(width), 1.0, 1.0
    for _ in range(20):
        v, u = backward(weight * forward(v, u) / m)
        largest = max(np.sqrt(v @ v + u * u), 1e-12)
        v, u = v / largest, u / largest
    step = 1 / (0.25 * 1.1 * largest + PENALTY)
    w, z, c, d, t = np.zeros(width), np.zeros(width), 0.0, 0.0, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(forward(z, d), -35, 35)))
        down, flat = backward(weight * (p - y) / m)
        new, new_c = z - step * (down + PENALTY * z), d - step * flat
        new = np.sign(new) * np.maximum(np.abs(new) - step * SPARSE, 0.0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, d = new + (t - 1) / nt * (new - w), new_c + (t - 1) / nt * (new_c - c)
        w, c, t = new, new_c, nt
    return w * scale, float(c)


def count_grams(df: DataFrame, text: str, label: str) -> DataFrame:
    """(gram, toxic, clean): in how many texts of label 1 and of label 0 each n-gram is."""

    def run(batches):
        held: list[np.ndarray] = []

        def merged() -> np.ndarray:
            rows = np.concatenate(held, axis=1)
            grams, place = np.unique(rows[0], return_inverse=True)
            return np.stack([grams, *(np.bincount(place, rows[k], len(grams)).astype("u8") for k in (1, 2))])

        def out(rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(r.view("i8")) for r in np.ascontiguousarray(rows)], ["gram", "toxic", "clean"])

        size = 0
        for batch in batches:
            marks = batch.column(batch.schema.get_field_index(label)).to_numpy(zero_copy_only=False)
            for a, b, texts in _text_slices(batch, text):
                grams, owner = held_by(texts)
                toxic = (marks[a:b] == 1)[owner]
                held.append(np.stack([grams, toxic.astype("u8"), (~toxic).astype("u8")]))
                size += len(grams)
                if size > COUNTED_TOGETHER:
                    held = [merged()]
                    size = held[0].shape[1]
                    if size > COUNTED_TOGETHER // 2:
                        yield out(held[0])
                        held, size = [], 0
        if held:
            yield out(merged())

    return df.select(text, label).mapInArrow(run, "gram long, toxic long, clean long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(df: DataFrame, label: str, text: str = "text") -> Model:
    """The model of the rows of ``df`` whose ``label`` is 1 or 0; others teach nothing.

    A null text counts as empty. Each row counts in the ratios, so copies do too; the regression takes distinct texts.
    Equal hashes, scores and ratios are settled by value. Without rows of both labels the scores are the one label's
    share, 0 without any.
    """
    rows = df.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1)")
    rows = shared_table(rows.withColumn("hash", F.xxhash64("text")))
    held = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two at most
    if len(held) < 2:
        return Model(np.zeros(0, "u8"), np.zeros(0), 35.0 if held.get(1) else -35.0)
    shares = [(F.col(c) + SMOOTHING, float(held[k] + 2 * SMOOTHING)) for c, k in (("toxic", 1), ("clean", 0))]
    ratio = F.log(shares[0][0] / shares[0][1]) - F.log(shares[1][0] / shares[1][1])
    error = F.sqrt(F.greatest(F.lit(1e-12), sum(F.lit(1.0) / n - 1.0 / total for n, total in shares)))
    counted = count_grams(rows, "text", "label").select("gram", ratio.alias("ratio"), F.abs(ratio / error).alias("sure")).filter(F.col("sure") > SIGNIFICANT)
    picked = counted.orderBy(F.desc("sure"), "gram").limit(MOST_GRAMS).select("gram", "ratio").toArrow()
    grams = picked["gram"].to_numpy().view("u8")
    order = np.argsort(grams)
    grams, scale = grams[order], picked["ratio"].to_numpy()[order]
    finder_of = df.sparkSession.sparkContext.broadcast(grams)
    sample = None
    for k in (0, 1):
        hashes = rows.filter(F.col("label") == k).select("hash").distinct().orderBy("hash").limit(FIT_TEXTS)
        last = hashes.agg(F.max("hash")).first()[0]
        part = rows.filter((F.col("label") == k) & (F.col("hash") <= last)).dropDuplicates(["hash"])
        sample = part if sample is None else sample.unionByName(part)

    def features(batches):
        finder = Finder(finder_of.value)
        for batch in batches:
            for a, b, texts in _text_slices(batch, "text"):
                place, owner = finder.find(texts)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype("i4")
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(place.astype("i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), lists], ["label", "hash", "held"])

    found = sample.select("label", "hash", "text").mapInArrow(features, "label int, hash long, held array<int>").orderBy("label", "hash").toArrow()
    y = found["label"].to_numpy().astype("f8")
    lists = found["held"].combine_chunks() if found.num_rows else None
    # Back to the labels' shares, then the rarer label counts by the root of the imbalance more.
    per = np.array([held[k] / max(1, (y == k).sum()) for k in (0, 1)]) * np.sqrt([1 / held[0], 1 / held[1]])
    weight = per[y.astype(int)]
    weights, offset = fit_scaled(lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype("i8"), scale, y, weight / weight.mean())
    used = weights != 0
    return Model(grams[used], weights[used], offset)


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) with ``score``, 0 to 1, of the whole text, and ``predicted``: 1 from 0.5 on.

    Null and empty texts have the score of a text without known n-grams; equal texts score alike. Texts of any length
    are read whole, in windows. Columns of ``df`` with the two names are replaced; an empty table stays empty.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in ("score", "predicted")]
    rows = df.select(F.struct(F.lit(0).alias("none"), *keep).alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = df.sparkSession.sparkContext.broadcast((model.grams, model.weights, model.offset))

    def run(batches):
        grams, weights, offset = shared.value
        finder = Finder(grams)
        for batch in batches:
            for a, b, texts in _text_slices(batch, "text"):
                place, owner = finder.find(texts)
                logit = offset + np.bincount(owner, weights[place], len(texts)) if len(place) else np.full(len(texts), offset)
                p = 1 / (1 + np.exp(-np.clip(logit, -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(p), pa.array((p >= 0.5).astype("i4"))], ["row", "score", "predicted"])

    return rows.mapInArrow(run, schema).select(*(F.col(f"row.`{c}`").alias(c) for c in keep), "score", "predicted")
