"""Quality by co-training: one classifier reads the text, one the page's metadata, and each teaches the other.

Both are fitted on the driver on bounded samples, ``LABELLED`` rows with a label and ``UNLABELLED`` without, of which
only feature rows come there. In each round a classifier scores the unlabelled rows and hands its most confident ones,
with the labels it believes in, to the other. A part of the labelled rows is kept aside to calibrate both and to weigh
them; the fitted model is a few thousand numbers, and every document is scored with it where it lies.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import slices

#: Rows of each sample at most, about.
LABELLED = 12_000
UNLABELLED = 12_000
ROUNDS = 4
#: Share of the unlabelled rows that a classifier hands over per round, from either end of its scores.
HANDED = 0.03
#: Hashed buckets of word shapes and of metadata values.
SHAPES, VALUES = 64, 256
SLICE_BYTES = 4 << 20

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SHAPE = str.maketrans({**dict.fromkeys("abcdefghijklmnopqrstuvwxyz", "a"), **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A"), **dict.fromkeys("0123456789", "0")})
_RUNS = re.compile(r"(.)\1+")


def text_features(text: str | None) -> np.ndarray:
    """Shares and lengths of a whole text, and the hashed shapes of its words; zeros but the first for no words."""
    text = text or ""
    words = _WORD.findall(text)
    out = np.zeros(14 + SHAPES, "f4")
    out[0] = 1
    if not words:
        return out
    counts, n, chars = Counter(words), len(words), len(text)
    lines = [line for line in text.split("\n") if line.strip()]
    neighbours = sum(map(str.__eq__, words, words[1:]))
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    out[1:14] = [
        np.log1p(n) / 5,
        sum(map(len, words)) / n / 10,
        len(counts) / n,
        max(counts.values()) / n,
        neighbours / n,
        sum(c for c in windows.values() if c > 1) / n,
        letters / chars,
        upper / max(1, letters),
        sum(text.count(c) for c in "#*$%&|<>{}[]~^=") / n,
        sum(text.count(c) for c in "!?") / n,
        sum(text.count(c) for c in "0123456789") / chars,
        1 - len(set(lines)) / len(lines),
        np.log1p(chars / len(lines)) / 10,
    ]
    shapes = Counter()
    for word, c in counts.items():
        shapes[_RUNS.sub(r"\1", word.translate(_SHAPE))] += c
    for shape, c in shapes.items():
        out[14 + zlib.crc32(shape.encode()) % SHAPES] += c / n
    return out


def metadata_features(values: list) -> np.ndarray:
    """One-hot hashed values of the metadata columns, a null being a value of its own; numbers by magnitude."""
    out = np.zeros(1 + VALUES, "f4")
    out[0] = 1
    for k, value in enumerate(values):
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            value = f"size{int(np.log2(abs(value) + 1))}" if np.isfinite(value) else "size"
        out[1 + zlib.crc32(f"{k}={value!r}".encode()) % VALUES] = 1
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = penalty * weight.sum() * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge @ w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def balance(y: np.ndarray) -> np.ndarray:
    """Weights that give both labels the same total."""
    good = max(1e-9, y.mean())
    return np.where(y > 0, 0.5 / good, 0.5 / max(1e-9, 1 - good))


@dataclass
class Model:
    """Weights of both views, calibration (slope, offset) of each and of the two combined."""

    views: list[np.ndarray]
    calibration: list[np.ndarray]
    combined: np.ndarray

    def scores(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Columns p_text, p_meta and score."""
        logits = [np.clip(x @ w, -30, 30) for x, w in zip((text, meta), self.views, strict=True)]
        own = [np.clip(c[0] + c[1] * z, -30, 30) for c, z in zip(self.calibration, logits, strict=True)]
        both = np.clip(self.combined[0] + self.combined[1] * own[0] + self.combined[2] * own[1], -30, 30)
        return 1 / (1 + np.exp(-np.stack([*own, both], axis=1)))


def co_train(views: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray], rounds: int = ROUNDS, handed: float = HANDED) -> Model:
    """``views`` and ``pool`` are (text, metadata) features of labelled and of unlabelled rows, ``y`` the labels."""
    if len(set(y.tolist())) < 2:  # nothing to tell apart: every score is the one label's
        level = 30.0 if len(y) and y[0] > 0 else -30.0 if len(y) else 0.0
        flat = [np.zeros(v.shape[1]) for v in views]
        return Model(flat, [np.zeros(2), np.zeros(2)], np.array([level, 0, 0]))
    aside = np.arange(len(y)) % 4 == 3
    if len(set(y[aside].tolist())) < 2:
        aside = np.ones(len(y), bool)
        learn = aside
    else:
        learn = ~aside
    # Rows that each view learns from: the labelled ones and those that the other view has handed over.
    rows = [[v[learn]] for v in views]
    labels = [[y[learn]], [y[learn]]]
    free = np.ones(len(pool[0]), bool)
    fitted: list[np.ndarray] = []
    for turn in range(rounds + 1):
        fitted = []
        for k in range(2):
            target = np.concatenate(labels[k])
            fitted.append(fit_logistic(np.concatenate(rows[k]).astype("f8"), target, balance(target)))
        if turn == rounds:
            break
        taken = np.zeros(len(free), bool)
        for k in range(2):
            score = pool[k] @ fitted[k]
            open_rows = np.flatnonzero(free)
            n = int(handed * len(free))
            order = open_rows[np.argsort(score[open_rows], kind="stable")]
            low, high = order[:n], order[len(order) - n :]
            sure_low, sure_high = low[score[low] < -1.5], high[score[high] > 1.5]
            for picked, label in ((sure_low, 0.0), (sure_high, 1.0)):
                rows[1 - k].append(pool[1 - k][picked])
                labels[1 - k].append(np.full(len(picked), label))
                taken[picked] = True
        free &= ~taken
        if not taken.any():
            break
    held = y[aside]
    logits = [np.clip(v[aside] @ w, -30, 30) for v, w in zip(views, fitted, strict=True)]
    weight = np.ones(len(held))
    calibration = [fit_logistic(np.stack([np.ones(len(z)), z], axis=1), held, weight, 1e-4) for z in logits]
    own = [np.clip(c[0] + c[1] * z, -30, 30) for c, z in zip(calibration, logits, strict=True)]
    combined = fit_logistic(np.stack([np.ones(len(held)), *own], axis=1), held, weight, 1e-4)
    return Model(fitted, calibration, combined)


def features(df: DataFrame, text: str, metadata: list[str], keep: list[str]) -> DataFrame:
    """The ``keep`` columns with float arrays ``f_text`` and ``f_meta``."""
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, T.ArrayType(T.FloatType())) for c in ("f_text", "f_meta"))])

    def run(batches):
        for batch in batches:
            for part, text_rows, meta_rows in feature_slices(batch, text, metadata):
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                columns += [pa.array(list(text_rows), pa.list_(pa.float32())), pa.array(list(meta_rows), pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(*dict.fromkeys([*keep, text, *metadata])).mapInArrow(run, schema)


def feature_slices(batch: pa.RecordBatch, text: str, metadata: list[str]):
    texts = batch.column(batch.schema.get_field_index(text))
    sizes = np.diff(np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, texts.offset * 4)) if len(texts) else []
    for a, b in slices(sizes, SLICE_BYTES):
        part = batch.slice(a, b - a)
        found = [text_features(t) for t in texts[a:b].to_pylist()]
        values = [part.column(part.schema.get_field_index(c)).to_pylist() for c in metadata]
        yield part, np.stack(found), np.stack([metadata_features(list(v)) for v in zip(*values, strict=True)] if metadata else [metadata_features([])] * (b - a))


def _sample(df: DataFrame, rows: int, by: str) -> DataFrame:
    """About ``rows`` rows, picked by a hash of a column."""
    part = 1 << 30
    return df.filter(F.pmod(F.xxhash64(by, F.lit("sample")), F.lit(part)) < int(part * min(1.0, rows / max(1, df.count()))))


def train(df: DataFrame, label: str, text: str = "text", metadata: list[str] | None = None, by: str = "doc_id") -> Model:
    """The model of ``df``, whose ``label`` is 1 or 0, or null for unlabelled rows."""
    metadata = metadata or []
    samples = []
    for rows, most in ((df.filter(F.col(label).isNotNull()), LABELLED), (df.filter(F.col(label).isNull()), UNLABELLED)):
        found = features(_sample(rows, most, by), text, metadata, [by, label]).orderBy(F.xxhash64(by), by).toArrow()
        widths = {"f_text": 14 + SHAPES, "f_meta": 1 + VALUES}
        arrays = [np.array(found[c].to_pylist(), "f4").reshape(found.num_rows, n) for c, n in widths.items()]
        samples.append((arrays, np.array(found[label].to_pylist(), "f8")))
    return co_train(samples[0][0], samples[0][1], samples[1][0])


def classify(df: DataFrame, model: Model, text: str = "text", metadata: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) with calibrated ``p_text`` and ``p_meta``, ``score`` and ``good``.

    Null and empty texts and null metadata have features of their own. A model of no labelled row scores 0.5, one of a
    single label that label. ``good`` is a score of 0.5 or more. Columns of ``df`` with the added names are replaced.
    """
    metadata = metadata or []
    added = ["p_text", "p_meta", "score"]
    keep = [c for c in (df.columns if keep is None else keep) if c not in [*added, "good"]]
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, T.DoubleType()) for c in added), T.StructField("good", T.BooleanType())])
    shared = df.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches):
        fitted = Model(*shared.value)
        for batch in batches:
            for part, text_rows, meta_rows in feature_slices(batch, text, metadata):
                scores = fitted.scores(text_rows, meta_rows)
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                columns += [pa.array(scores[:, k], pa.float64()) for k in range(3)] + [pa.array(scores[:, 2] >= 0.5)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(*dict.fromkeys([*keep, text, *metadata])).mapInArrow(run, schema)
