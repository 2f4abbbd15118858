r"""Chat formatting: turns become one text per conversation with a mask of what to learn, and can be read back.

A turn is ``### role: text</turn>`` and a line end. In roles and texts a backslash becomes two, two number signs
``\#\#`` and the closing mark ``<\/turn>`` (and a colon ``\:`` in a role), so neither mark ever occurs inside, and
dropping the backslash before any character gives back what was written.

Turns of a conversation are brought together by one shuffle and sorted; a task then walks over its rows, so it holds a
slice of turns at a time and never a whole conversation of any length. A conversation longer than ``PART_BYTES`` comes
out in several parts, in order, within one partition.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, AFTER_ROLE, CLOSE = b"### ", b": ", b"</turn>\n"
LEARNT = "assistant"
#: Bytes of one part of a formatted conversation, unless a single turn is longer.
PART_BYTES = 4 << 20
#: Bytes that are scattered at a time: the index arrays take 16 times as much.
SCATTER_BYTES = 1 << 20

PARTS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("loss_starts", T.ArrayType(T.LongType())),
        T.StructField("loss_ends", T.ArrayType(T.LongType())),
    ]
)
READ = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


def escape(texts: pa.Array, role: bool = False) -> pa.Array:
    texts = pc.replace_substring(texts, "\\", "\\\\")
    texts = pc.replace_substring(texts, "##", "\\#\\#")
    texts = pc.replace_substring(texts, "</turn>", "<\\/turn>")
    return pc.replace_substring(texts, ":", "\\:") if role else texts


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def _bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array without nulls."""
    array = array.cast(pa.large_string())
    if not len(array):
        return np.zeros(1, "<i8"), np.zeros(0, "u1")
    offsets = np.frombuffer(array.buffers()[1], "<i8", len(array) + 1, array.offset * 8)
    data = array.buffers()[2]
    return offsets, np.frombuffer(data, "u1") if data is not None else np.zeros(0, "u1")


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, ends of turns, starts and ends of texts) of turns whose roles and texts are escaped and not null.

    Segment lengths give the offsets; bytes are scattered from the columns into one preallocated buffer.
    """
    segments = [
        (np.zeros(len(roles), "<i8"), np.full(len(roles), len(OPEN)), np.frombuffer(OPEN, "u1")),
        None,
        (np.zeros(len(roles), "<i8"), np.full(len(roles), len(AFTER_ROLE)), np.frombuffer(AFTER_ROLE, "u1")),
        None,
        (np.zeros(len(roles), "<i8"), np.full(len(roles), len(CLOSE)), np.frombuffer(CLOSE, "u1")),
    ]
    for place, array in ((1, roles), (3, texts)):
        offsets, data = _bytes_of(array)
        segments[place] = (offsets[:-1], np.diff(offsets), data)
    lengths = np.stack([s[1] for s in segments], axis=1) if len(roles) else np.zeros((0, 5), "<i8")
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    begins = ends - lengths
    buffer = np.empty(int(ends[-1, -1]) if len(ends) else 0, "u1")
    for k, (source, size, data) in enumerate(segments):
        upto = np.cumsum(size)
        a = 0
        while a < len(size):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + SCATTER_BYTES, "right")))
            if b == a + 1:  # one long segment needs no index
                buffer[begins[a, k] : ends[a, k]] = data[source[a] : source[a] + size[a]]
            else:
                n = size[a:b]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                buffer[np.repeat(begins[a:b, k], n) + step] = data[np.repeat(source[a:b], n) + step]
            a = b
    return buffer, ends[:, 4], begins[:, 3], ends[:, 3]


def format_conversations(df: DataFrame) -> DataFrame:
    """Parts (conv_id, part, formatted, n_turns, loss_starts, loss_ends) of rows (conv_id, turn, role, text).

    Turns come in the order of ``turn``, then role, then text, nulls first; repeated rows are turns of their own. A
    null role or text counts as empty; a null ``conv_id`` is a conversation. The loss spans are byte ranges of the
    part: the escaped texts of the assistant. An empty table gives no rows; further columns are ignored.
    """
    rows = df.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        waiting, state = [], {"conv": (), "part": 0}

        def emit(table: pa.Table):
            """The turns of ``table`` as parts; a conversation that began before goes on counting."""
            roles, texts = (escape(table[c].combine_chunks(), c == "role") for c in ("role", "text"))
            buffer, ends, starts, stops = assemble(roles, texts)
            learnt = pc.equal(table["role"], LEARNT).to_numpy()
            convs = table["conv_id"].to_pylist()
            cuts = [0, *(i for i in range(1, len(convs)) if convs[i] != convs[i - 1]), len(convs)]
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                state["part"] = state["part"] + 1 if state["conv"] == (convs[a],) else 0
                state["conv"] = (convs[a],)
                base = int(ends[a - 1]) if a else 0
                mask = np.flatnonzero(learnt[a:b]) + a
                text = buffer[base : ends[b - 1]].tobytes().decode()
                out.append((convs[a], state["part"], text, b - a, (starts[mask] - base).tolist(), (stops[mask] - base).tolist()))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], PARTS.names)

        def pieces(table: pa.Table, last: bool):
            """Whole conversations, and a long one cut; what may go on stays in ``waiting``."""
            sizes = pc.add(pc.binary_length(table["text"]), pc.binary_length(table["role"])).to_numpy()
            convs, start, total, border = table["conv_id"].to_pylist(), 0, 0, 0
            for i, size in enumerate(sizes):
                if i > start and convs[i] != convs[i - 1]:
                    border = i
                if i > start and total + size > PART_BYTES:
                    cut = border if border > start else i
                    yield emit(table.slice(start, cut - start))
                    start, total = cut, int(sizes[cut:i].sum())
                total += int(size)
            if last and start < len(sizes):
                yield emit(table.slice(start))
            waiting[:] = [] if last else [table.slice(start)]

        for batch in batches:
            waiting.append(pa.Table.from_batches([batch]))
            yield from pieces(pa.concat_tables(waiting), False)
        if waiting:
            yield from pieces(pa.concat_tables(waiting), True)

    return ordered.mapInArrow(run, PARTS)


_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*?)</turn>\n", re.DOTALL)


def turns_of(formatted: str):
    """(role, text) of each turn, unescaped; anything that is no turn is an error."""
    at = 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        yield unescape(m[1]), unescape(m[2])
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")


def read_back(parts: DataFrame) -> DataFrame:
    """One row per conversation with digests of its turns and masked text, read from ``format_conversations``' output.

    ``parts`` must come straight from it, as the parts of a conversation follow one another in one partition.
    """

    def run(batches):
        at, seen = (), None

        def done():
            n, turns, chars, loss, total = seen
            return pa.RecordBatch.from_pylist([dict(zip(READ.names, (at[0], n, turns.hexdigest(), chars, loss.hexdigest(), total), strict=True))], pa.schema(zip(READ.names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()], strict=True)))

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if at != (row["conv_id"],):
                    if seen:
                        yield done()
                    at, seen = (row["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in turns_of(row["formatted"]):
                    seen[0] += 1
                    seen[1].update(f"{role}\n{text}\n".encode())
                whole = row["formatted"].encode()
                for start, end in zip(row["loss_starts"], row["loss_ends"], strict=True):
                    text = unescape(whole[start:end].decode())
                    seen[2] += len(text)
                    seen[3].update(text.encode())
                seen[4] += len(row["formatted"])
        if seen:
            yield done()

    return parts.mapInArrow(run, READ)
