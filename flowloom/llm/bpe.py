"""Byte-level BPE through sentencepiece models that are written directly from a vocabulary of ranked byte strings.

Each byte becomes one printable character, each ranked byte string a piece with score -rank, and the normaliser is the
identity; joining the best-scored neighbours first is then the same as joining the lowest rank first. Texts are split
into pre-tokens, each pre-token is encoded by itself, and ids are turned back by gathering the bytes of the pieces.
"""

from __future__ import annotations

import hashlib
import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowloom.llm.common import per_process, slices

#: Bytes of text, or of tokens, that a task holds as arrays at a time.
SLICE_BYTES = 4 << 20
#: Distinct pre-tokens that a task remembers; then it starts anew.
REMEMBERED = 400_000
#: Characters after which a long text is cut at the next place where pre-tokens end anyway.
LONG = 1 << 20


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in the order of their ranks, from lines of a base64 string and a rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    return [ranks[i] for i in range(len(ranks))]


def byte_characters() -> str:
    """A printable character for every byte: the byte's own where it is visible, else one from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    other = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in own)}
    return "".join(other.get(b, chr(b)) for b in range(256))


def _field(number: int, kind: int, payload: bytes) -> bytes:
    return _varint(number << 3 | kind) + (_varint(len(payload)) if kind == 2 else b"") + payload


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def serialise(tokens: list[bytes]) -> bytes:
    """The sentencepiece model, ids equal to ranks; the id after the last rank is the unknown piece, which never occurs."""
    table = byte_characters()

    def piece(text: str, score: float, kind: int) -> bytes:
        inner = _field(1, 2, text.encode()) + _field(2, 5, struct.pack("<f", score)) + _field(3, 0, _varint(kind))
        return _field(1, 2, inner)

    pieces = [piece("".join(table[b] for b in token), -float(rank), 1) for rank, token in enumerate(tokens)]
    pieces.append(piece("⁇", 0.0, 2))
    minus = _varint((1 << 64) - 1)
    trainer = _field(3, 0, _varint(2)) + _field(4, 0, _varint(len(pieces))) + _field(40, 0, _varint(len(tokens)))
    trainer += b"".join(_field(n, 0, minus) for n in (41, 42, 43)) + _field(45, 2, "⁇".encode())
    normaliser = _field(1, 2, b"identity") + b"".join(_field(n, 0, b"\0") for n in (3, 4, 5))
    return b"".join(pieces) + _field(2, 2, trainer) + _field(3, 2, normaliser)


class Encoder:
    """Ids of whole texts; remembers the ids of pre-tokens, as bytes of 32-bit numbers."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.pattern = regex.compile(pattern)
        self.border = regex.compile(r"(?<=\S) (?=\S)")
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        self.whole = {token: rank for rank, token in enumerate(tokens)}
        self.letters = {b: c for b, c in enumerate(byte_characters())}
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        rest = []
        for word in words.difference(self.known):
            rank = self.whole.get(word.encode())
            if rank is None:
                rest.append(word)
            else:
                self.known[word] = rank.to_bytes(4, "little")
        mapped = [word.encode().decode("latin-1").translate(self.letters) for word in rest]
        for word, ids in zip(rest, self.model.encode(mapped) if mapped else [], strict=True):
            self.known[word] = np.array(ids, "<i4").tobytes()

    def parts(self, text: str) -> Iterator[str]:
        """A long text in parts that cut no pre-token: a single space between other characters always begins one."""
        start = 0
        while len(text) - start > LONG:
            cut = self.border.search(text, start + LONG // 2)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; new pre-tokens of all texts are learnt together, those of a long text part by part."""
        if len(texts) == 1 and len(texts[0]) > LONG:
            return [b"".join(self._encode([part])[0] for part in self.parts(texts[0]))]
        return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [self.pattern.findall(text) for text in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def _without(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def encode(df: DataFrame, tokens: list[bytes], pattern: str, text: str = "text", ids: str = "ids", keep_text: bool = True) -> DataFrame:
    """``df`` with the token ids of the whole text in array column ``ids``; a null or empty text has none.

    ``tokens`` are byte strings by rank and hold all single bytes; they are broadcast, their number being that of a
    vocabulary. Only matches of ``pattern`` are encoded. A column already named ``ids`` is replaced. Each row is
    handled alone, in slices of ``SLICE_BYTES``, so repeated rows and empty tables need nothing special.
    """
    df = _without(df, ids)
    kept = [c for c in df.columns if keep_text or c != text]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(ids, T.ArrayType(T.IntegerType()))])
    shared = df.sparkSession.sparkContext.broadcast((tokens, pattern))
    # Workers keep encoders between calls, by their whole content.
    content = hashlib.sha256(repr((pattern, tokens)).encode()).hexdigest()

    def run(batches):
        vocabulary, split = shared.value
        encoder = per_process(f"bpe{content}", lambda: Encoder(vocabulary, split))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            sizes = np.diff(np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, texts.offset * 4)) if len(texts) else []
            for a, b in slices(sizes, SLICE_BYTES):
                coded = encoder.encode([t or "" for t in texts[a:b].to_pylist()])
                offsets = np.zeros(b - a + 1, "<i4")
                np.cumsum([len(x) // 4 for x in coded], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(coded), "<i4"), pa.int32())
                part = batch.slice(a, b - a)
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets), values)], [*kept, ids])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, tokens: list[bytes], ids: str = "ids", out: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """``df`` with the bytes of ``ids`` in binary column ``out``; null or empty ids give no bytes.

    An id without a byte string is an error.
    """
    df = _without(df, out)
    kept = [c for c in df.columns if keep_ids or c != ids]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.BinaryType())])
    shared = df.sparkSession.sparkContext.broadcast(tokens)

    def run(batches):
        lengths = np.array([len(t) for t in shared.value], "<i8")
        source = np.frombuffer(b"".join(shared.value), "u1")
        begins = np.cumsum(lengths) - lengths
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).fill_null([])
            ends = np.frombuffer(lists.buffers()[1], "<i4", len(lists) + 1, lists.offset * 4) if len(lists) else np.zeros(1, "<i4")
            for a, b in slices(4 * np.diff(ends), SLICE_BYTES):
                part = np.asarray(lists.values[ends[a] : ends[b]].fill_null(-1), "<i8")
                if len(part) and (part.min() < 0 or part.max() >= len(lengths)):
                    raise ValueError("an id outside the vocabulary can't be decoded")
                size = lengths[part]
                upto = np.concatenate([[0], np.cumsum(size)])
                data = source[np.repeat(begins[part] - upto[:-1], size) + np.arange(upto[-1])]
                offsets = upto[ends[a : b + 1] - ends[a]].astype("<i4")
                column = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
                rows = batch.slice(a, b - a)
                columns = [rows.column(rows.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, column], [*kept, out])

    return df.mapInArrow(run, schema)
