"""Encoding, formatting, packing and language identification against brute force, round trips and held-out accuracy."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
from flowloom.llm import bpe, chat, langid, packing

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " \n\t ", "I'm it's 12345 déjà 漢字 🙂\0 ⁇ x", "a" * 5000, " " * 3000, "ab " * 500_000, "a" * 2_000_000, "<|endoftext|> ΣΑΣ İ ﬁ É́"]


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def tokens():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def rank_encoding(tokens):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_op1_equals_the_rank_library(spark, docs, rank_encoding):
    got = {r.doc_id: r for r in entry.queries()["op1_byte_bpe"](spark, SF).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        ids = rank_encoding.encode_ordinary(text or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(text or ""))


def test_bpe_of_odd_texts(spark, tokens, rank_encoding):
    rows = [(t, "clash", b"clash") for t in [*ODD, *ODD]]
    df = spark.createDataFrame(rows, "text string, ids string, decoded binary")
    got = bpe.decode(bpe.encode(df, tokens, public_tokenizers.PATTERN), tokens).collect()
    assert len(got) == len(rows)
    for row in got:
        text = row.text or ""
        assert row.decoded == text.encode()
        if "a" * 100 not in text:  # the library is slow on long runs
            assert row.ids == rank_encoding.encode_ordinary(text)
    assert bpe.decode(bpe.encode(df.limit(0), tokens, public_tokenizers.PATTERN), tokens).count() == 0


def test_bpe_of_mixed_scripts(tokens, rank_encoding):
    random.seed(3)
    encoder = bpe.Encoder(tokens, public_tokenizers.PATTERN)
    pick = lambda: chr(random.choice([random.randrange(32, 0x250), random.randrange(0x3000, 0x9FFF), random.randrange(0x1F300, 0x1F700), 32, 10]))
    texts = ["".join(pick() for _ in range(3000)) for _ in range(5)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == rank_encoding.encode_ordinary(text)


def test_ranks_with_gaps_are_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % (2 * i) for i in range(3)))
    with pytest.raises(ValueError, match="gaps"):
        bpe.read_ranks(str(path))


def told(rows):
    """conv_id -> (n_turns, turns digest, loss chars, loss digest)."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    return out


def test_op2_reads_back_what_was_said(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = entry.queries()["op2_chat_format"](spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == told(rows) and len(got) == len(told(rows))


@pytest.mark.parametrize("part_bytes", [100, 5000, 4 << 20])
def test_chat_of_odd_turns(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(chat, "PART_BYTES", part_bytes)
    monkeypatch.setattr(chat, "SCATTER_BYTES", 64)
    random.seed(2)
    bits = ["#", "##", "###", "\\", "</turn>", "<\\/turn>", ":", ": ", "\n", "a", "é🙂", "### user: x</turn>\n", ""]
    text = lambda: random.choice([None, "".join(random.choices(bits, k=random.randrange(12)))])
    rows = [(random.choice([None, 1, 2]), random.choice([None, 0, 1]), random.choice(["assistant", "user", None, "a: b", "\\", "##:"]), text()) for _ in range(300)]
    rows += [(9, 0, "assistant", "long " * 20_000), (9, 0, "assistant", "long " * 20_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    parts = chat.format_conversations(df)
    assert {r.conv_id: tuple(r)[1:5] for r in chat.read_back(parts).collect()} == told(rows)
    for p in parts.collect():
        for start, end in zip(p.loss_starts, p.loss_ends, strict=True):
            inside = p.formatted.encode()[start:end]
            assert b"</turn>" not in inside and b"###" not in inside
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_op4_places_every_piece_once(spark, docs):
    model = Tokenizer.from_file(WORDS)
    model.encode_special_tokens = True
    want = []
    for i, text in docs.items():
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    got = entry.queries()["op4_pattern_packing"](spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    assert_gapless(got)
    least = -(-sum(r.length for r in got) // 2048)
    assert least <= len({r.sequence_id for r in got}) <= least + max(1, least // 50)


def assert_gapless(rows, size=2048):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size


def test_words_of_odd_texts():
    model = Tokenizer.from_file(WORDS)
    model.encode_special_tokens = True
    encoder = packing.WordEncoder(WORDS)
    random.seed(4)
    pick = lambda: chr(random.choice([random.randrange(32, 0x250), random.randrange(0x300, 0x400), random.randrange(0x3000, 0x9FFF), 32, 10, 9]))
    texts = [*(t for t in ODD if t and len(t) < 10_000), *("".join(pick() for _ in range(3000)) for _ in range(5))]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_pieces_of_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*ODD, *ODD])], "doc_id long, text string, length string")
    cut = packing.pieces(df, WORDS, keep=["doc_id"])
    rows = packing.pack(cut.select("doc_id", "piece", "length"), keys=["doc_id", "piece"]).collect()
    assert_gapless(rows)
    assert {r.doc_id for r in rows} == set(range(2 * len(ODD)))
    assert [r.length for r in rows if r.doc_id == 0] == [1]
    assert packing.pack(packing.pieces(df.limit(0), WORDS, keep=["doc_id"]).select("doc_id", "piece", "length")).count() == 0


def test_packing_lengths(spark):
    rows = [(1, 10, "a")] * 500 + [(None, 3, "a")] * 77 + [(2, 7, None)] * 77 + [(3, 5, "b")] * 40
    df = spark.createDataFrame(rows, "k int, length int, offset string")
    got = packing.pack(df, size=10).collect()
    assert len(got) == len(rows) and len({r.sequence_id for r in got}) == 500 + 77 + 20
    assert_gapless(got, 10)
    with pytest.raises(ValueError, match="lengths"):
        packing.pack(df, size=9)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(1)
    for n in (1, 50, 3000):
        lengths = np.minimum(2048, rng.lognormal(6, 1.1, n).astype(int) + 2)
        slots = packing.plan(np.bincount(lengths, minlength=2049))
        sequences = max(s[4] + -(-s[2] // s[3]) for s in slots)
        least = -(-lengths.sum() // 2048)
        assert sum(s[2] for s in slots) == n and least <= sequences <= least + 1 + least // 100


def test_op5_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = entry.queries()["op5_language_id"](spark, sf).collect()
    assert {r.doc_id for r in got} == set(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) >= 0.98 * len(held)


def test_languages_of_odd_texts(spark):
    model = langid.train(spark.createDataFrame([("the cat sat", "en"), (None, "de"), ("der hund", "de"), ("x", None)], "text string, lang string"))
    assert model.langs == ["de", "en"]
    texts = [None, "", "12 ² Ⅷ !", "the dog", "the cat " * 200_000, "漢字", "the cat", "hunde"]
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, score int")
    got = [tuple(r) for r in langid.identify(df, model).select("text", "lang_pred", "score").collect()]
    by = {t: (p, s) for t, p, s in got}
    assert by[None] == by[""] == by["12 ² Ⅷ !"] == ("und", 0.0)
    assert by["the dog"][0] in ("de", "en") and by["the cat"][0] == by["the cat " * 200_000][0] == "en"
    assert by["漢字"] == ("de", 0.5)  # nothing known: the first language, a tie
    assert by["hunde"][0] == "de"
    nothing = langid.train(df.limit(0).selectExpr("text", "text AS lang"))
    assert [r.lang_pred for r in langid.identify(df, nothing).collect()] == ["und"] * len(texts)
    assert langid.identify(df.limit(0), model).count() == 0


def test_language_needs_no_other_column(spark):
    rows = [("der hund läuft", "en", "src"), ("der hund läuft", "de", None)]
    model = langid.train(spark.createDataFrame([("the cat", "en"), ("der hund", "de")], "text string, lang string"))
    got = langid.identify(spark.createDataFrame(rows, "text string, lang string, source string"), model).collect()
    assert len({(r.lang_pred, r.score) for r in got}) == 1
