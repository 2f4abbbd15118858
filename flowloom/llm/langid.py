"""Language identification, word first: known words score by their frequency in each language, unseen ones by the
longest character n-grams that are known.

The model is bounded by parameters: it is fitted on about ``TRAIN_ROWS`` labelled rows, picked by a hash of the text,
and keeps the most frequent ``MOST_WORDS`` words and ``MOST_GRAMS`` n-grams. So it can be broadcast at any corpus size.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import shared_table, slices

TRAIN_ROWS = 40_000
MOST_WORDS = 50_000
MOST_GRAMS = 50_000
#: Character n-grams of padded words, longest first.
LENGTHS = (4, 3, 2, 1)
#: Words beyond this many add no further confidence to a score; they still count for the language.
CONFIDENT_WORDS = 12
UNDETERMINED = "und"
SLICE_BYTES = 4 << 20
#: Entries that a task counts, or words that it remembers, before it starts anew.
REMEMBERED = 300_000

_RUN = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    out = []
    for word in _RUN.findall(text.lower()):
        if word.isalpha():
            out.append(word)
        else:  # numerals that are no digits
            out += _LETTERS.findall(word)
    return out


def grams_of(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    word_scores: np.ndarray
    gram_scores: np.ndarray


def train(df: DataFrame, text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """The model of the labelled rows of ``df``; rows whose text or language is null teach nothing."""
    known = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    held = known.count()
    part = 1 << 30
    picked = known.filter(F.pmod(F.xxhash64("text"), F.lit(part)) < int(part * min(1.0, rows / max(1, held))))
    schema = "lang string, kind int, item string, n long"

    def count(batches):
        counts: Counter = Counter()

        def flush():
            out: Counter = Counter()
            for (name, word), n in counts.items():
                out[(name, 0, word)] += n
                for length in LENGTHS:
                    for gram in grams_of(word, length):
                        out[(name, length, gram)] += n
            counts.clear()
            if out:
                keys = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int32()), pa.array(keys[2], pa.string()), pa.array(out.values(), pa.int64())],
                    ["lang", "kind", "item", "n"],
                )

        for batch in batches:
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(words_of(t)).items():
                    counts[(name, word)] += n
                if len(counts) > REMEMBERED // 3:
                    yield from flush()
        yield from flush()

    counted = picked.mapInArrow(count, schema).groupBy("kind", "item", "lang").agg(F.sum("n").alias("n"))
    # Read twice, for words and for n-grams.
    counted = shared_table(counted.groupBy("kind", "item").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by")))

    def most(kind: str, limit: int) -> pa.Table:
        return counted.filter(kind).orderBy(F.desc("total"), "kind", "item").limit(limit).drop("total").toArrow().combine_chunks()

    found = [most("kind = 0", MOST_WORDS), most("kind > 0", MOST_GRAMS)]
    by = [pa.chunked_array(items["by"]).combine_chunks() if items.num_rows else None for items in found]
    langs = sorted({name for lists in by if lists is not None for name in lists.flatten().field("lang").unique().to_pylist()})
    scores = []
    for items, lists in zip(found, by, strict=True):
        table = np.zeros((items.num_rows, len(langs)))
        kinds = np.array(items["kind"].to_pylist(), "i4")
        if lists is not None:
            entries = lists.flatten()
            row = np.repeat(np.arange(items.num_rows), lists.value_lengths().to_numpy())
            table[row, np.searchsorted(langs, entries.field("lang").to_pylist())] = entries.field("n").to_numpy()
        for kind in set(kinds.tolist()):  # frequencies among the items of one length
            own = kinds == kind
            table[own] = np.log((table[own] + 0.5) / (table[own].sum(axis=0) + 0.5 * own.sum()))
        scores.append(table.astype("f4"))
    return Model(langs, *({item: i for i, item in enumerate(items["item"].to_pylist())} for items in found), *scores)


class Scorer:
    """Scores of words under a model; those of unseen words are worked out once and remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        m = self.model
        self.index = dict(m.words)
        self.rows = np.zeros((len(m.words) + REMEMBERED, len(m.langs)), "f4")
        self.rows[: len(m.words)] = m.word_scores

    def backoff(self, word: str) -> np.ndarray:
        """Mean score of the longest n-grams of the word that are known; zero for all languages if none is."""
        for length in LENGTHS:
            known = [g for gram in grams_of(word, length) if (g := self.model.grams.get(gram)) is not None]
            if known:
                return self.model.gram_scores[known].mean(axis=0)
        return np.zeros(len(self.model.langs), "f4")

    def predict(self, text: str | None) -> tuple[str, float]:
        words = Counter(words_of(text or ""))
        if not words or not self.model.langs:
            return UNDETERMINED, 0.0
        total, n = np.zeros(len(self.model.langs)), sum(words.values())
        items = list(words)
        for a in range(0, len(items), REMEMBERED // 2):
            group = items[a : a + REMEMBERED // 2]
            if len(self.index) + len(group) > len(self.rows):
                self.forget()
            for word in group:
                if word not in self.index:
                    self.rows[len(self.index)] = self.backoff(word)
                    self.index[word] = len(self.index)
            total += np.array([words[w] for w in group], "f8") @ self.rows[[self.index[w] for w in group]]
        best = int(np.argmax(total))
        return self.model.langs[best], float(1 / np.exp((total - total[best]) * (min(n, CONFIDENT_WORDS) / n)).sum())


def identify(df: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` of the whole text.

    A null text and one without letters are ``und`` with score 0, as is every text under a model of no rows. Equal
    languages give the first by name. Columns of ``df`` with these two names are replaced.
    """
    df = df.drop("lang_pred", "score")
    kept = [c for c in df.columns if keep_text or c != text]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches):
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            sizes = np.diff(np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, texts.offset * 4)) if len(texts) else []
            for a, b in slices(sizes, SLICE_BYTES):
                found = [scorer.predict(t) for t in texts[a:b].to_pylist()]
                part = batch.slice(a, b - a)
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.mapInArrow(run, schema)
