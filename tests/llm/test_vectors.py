"""Whitening, manifests and toxicity against plain Python, held-out labels and odd tables."""

import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm import bpe, merkle, topk, toxicity, whitening
from flowloom.llm import queries as registered
from flowloom.llm.common import documents

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


# Whitening


def spectra():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    x = rng.normal(size=(200, 24))
    x[:, 3] = x[:, 5]
    yield from (np.eye(7), np.zeros((5, 5)), np.ones((6, 6)), np.diag([5.0, 1, 1, 1]), np.array([[2.0]]), x.T @ x)
    for values in (10.0 ** -np.arange(40), [1.0] * 20 + [0.0] * 20, np.concatenate([np.linspace(1, 1 + 1e-9, 20), np.linspace(2, 3, 20)])):
        yield turn @ np.diag(values) @ turn.T


@pytest.mark.parametrize("k", range(9))
def test_components_to_double_precision(k):
    a = list(spectra())[k]
    values, vectors = whitening.components_of(a)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * scale * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * scale * len(a)


def test_polar_is_the_matrix_sign():
    x = np.random.default_rng(4).normal(size=(30, 30))
    a = x + x.T
    u = whitening.polar(a)
    values, vectors = np.linalg.eigh(a)
    assert np.abs(u - vectors * np.sign(values) @ vectors.T).max() < 1e-12


def whitened_by_numpy(vectors):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors])
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:32]
    return centred @ basis[:, order] / np.sqrt(values[order]), ((n * x - sums) ** 2).sum(axis=1), values[order] / values.sum()


def test_op11_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    want, deviation, explained = whitened_by_numpy([r.embedding for r in rows])
    got = registered.op11_embedding_whitening(spark, SF).orderBy("vec_id", "component").toPandas()
    assert len(got) == want.size and got["n"].unique().tolist() == [len(rows)] and got["identity_error"].max() < 1e-9
    found = got["whitened"].to_numpy().reshape(want.shape)
    assert np.abs(found * np.sign((found * want).sum(axis=0)) - want).max() < 1e-8
    assert (got["deviation"].to_numpy().reshape(want.shape) == deviation[:, None]).all()
    assert np.abs(got["explained"].to_numpy()[: want.shape[1]] / explained - 1).max() < 1e-10


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [[float(v) for v in rng.normal(size=4)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate([*good, good[0], good[0]])]
    rows += [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan")] * 4), (103, [float("inf"), 0.0, 0.0, 0.0]), (104, [1.0]), (105, [])]
    df = spark.createDataFrame([(*r, "clash", 1.5) for r in rows], "vec_id long, embedding array<double>, whitened string, x double")
    whole = df.withColumn("v", whitening.whole_entries("embedding"))
    model = whitening.fit(whole, "v")
    assert model.n == 62 and len(model.values) == 4 and model.identity_error < 1e-10
    got = {r.vec_id: r for r in whitening.whiten(whole, model, "v").collect()}
    assert len(got) == 68 and got[0].x == 1.5 and got[0].whitened == got[60].whitened == got[61].whitened
    assert all(got[i].whitened is None and got[i].deviation is None for i in range(100, 106))
    constant = whole.filter("vec_id = 0")
    flat = whitening.fit(constant, "v")
    assert [r.whitened for r in whitening.whiten(constant, flat, "v").collect()] == [[]]
    assert whitening.fit(whole.limit(0), "v").n == 0 and whitening.whiten(whole.limit(0), model, "v").count() == 0
    with pytest.raises(Exception, match="below"):
        spark.createDataFrame([([1e30],)], "e array<double>").select(whitening.whole_entries("e")).collect()


def test_deviations_beyond_64_bits(spark):
    big = spark.createDataFrame([([k * 10**13, 5],) for k in range(100)], "v array<bigint>")
    rows = whitening.whiten(big, whitening.fit(big, "v"), "v").collect()
    total = sum(k * 10**13 for k in range(100))
    assert sorted(int(r.deviation) for r in rows) == sorted((100 * k * 10**13 - total) ** 2 for k in range(100))


# Search and tokens, where numbers and vocabularies are unusual


def test_large_scores_are_exact_or_refused(spark):
    rng = np.random.default_rng(8)
    for size, fits in ((10**8, True), (10**9, True), (10**10, False)):
        rows = [(i, [int(v) for v in rng.integers(-size, size, 4)]) for i in range(1, 60)]
        df = spark.createDataFrame(rows, "vec_id long, v array<bigint>")
        if not fits:
            with pytest.raises(Exception, match="64 bits"):
                topk.top_k(df.filter("vec_id = 1"), df).collect()
            continue
        got = [(r.vec_id, r.score) for r in topk.top_k(df.filter("vec_id = 1"), df, 5).orderBy("rank").collect()]
        scores = [(i, sum(a * b for a, b in zip(rows[0][1], v, strict=True))) for i, v in rows[1:]]
        assert got == sorted(scores, key=lambda x: (-x[1], x[0]))[:5]


def test_two_vocabularies_in_one_worker(spark):
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"cd", b"zz"]
    other = [*tokens[:256], b"cd", b"ab", b"zz"]
    df = spark.createDataFrame([("abcd",)], "text string").coalesce(1)
    ids = [bpe.encode(df, t, r"\w+").select("ids").first()[0] for t in (tokens, other, tokens)]
    assert ids == [[256, 257], [257, 256], [256, 257]]


# Manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, k in zip(paths, own, strict=True):
            t = k // 3 * 3
            path.append((nodes[t:k], nodes[k + 1 : t + 3]))
        own = [k // 3 for k in own]
        nodes = [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def leaf_of(r, text):
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*(said(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def manifest_by_hand(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    subs, parts = [], []
    for source in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(by[source], key=lambda x: x[:3])
        top, paths = tree([x[2] for x in own])
        subs.append(top)
        parts.append((own, paths))
    root, ups = tree(subs)
    out = []
    for (own, paths), sub, up in zip(parts, subs, ups, strict=True):
        for (_, _, leaf, r), path in zip(own, paths, strict=True):
            node, path = leaf, path + up
            if zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 2 == 0 and r.text is not None:
                node = leaf_of(r, r.text.replace("\n", ""))
            for left, right in path:
                node = sha(*left, node, *right)
            out.append((r.doc_id, leaf, sub, root, sha(*(x for left, right in path for x in left + right)), node, node == root))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def test_op12_equals_the_trees_by_hand(spark):
    got = told(registered.op12_merkle_manifest(spark, SF))
    assert got == manifest_by_hand(documents(spark, SF).collect())
    assert {r[-1] for r in got} == {True, False}


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents():
    rows = [(i * 977, f"text\n{i}", "en", f"s{i % 3}", i) for i in range(300)]
    rows += [(5, "same id", "en", "hot", k) for k in range(40)] + [(5, "same row\n", "en", "hot", 1)] * 30
    rows += [(None, None, None, None, None), (None, "a\nb", None, None, 3), (0, "", "", "", 0), (-7, "x", "é", "ü", 1), (-(1 << 63), "low\n", "l", "s1", 1)]
    rows += [((1 << 63) - 1, "high", "h", "s1", 1), (1, "z" * 300_000, "en", "s2", 300_000), (None, "again", "en", "s1", 5), (None, "again", "en", "s1", 5)]
    return rows


@pytest.mark.parametrize("levels,together", [(6, 10_000), (1, 3), (2, 1)])
def test_manifest_of_odd_documents(spark, monkeypatch, levels, together):
    """Repeated ids, equal rows across blocks, null and extreme ids; blocks of 3 to 729 slots."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "SLOTS", 3**levels)
    monkeypatch.setattr(merkle, "ORDERED_TOGETHER", together)
    df = spark.createDataFrame([(*r, "clash", 7) for r in odd_documents()], DOC + ", proof string, word int").repartition(5)
    named = ["doc_id", "source", "lang", "n_chars"]
    leaves = df.withColumn("leaf", merkle.digest(*(F.col(c) for c in (*named, "text")))).drop("text")
    got = merkle.manifest(leaves)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "word", "leaf", "subroot", "root", "proof"]
    rows = told(got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("proof").alias("p"), merkle.fold("leaf", "proof").alias("f"), "source", "word"))
    want = [r[:5] for r in manifest_by_hand(df.collect())]
    assert sorted([r[:5] for r in rows], key=str) == sorted(want, key=str)
    assert all(r[5] == r[3] and r[7] == 7 for r in rows)


def test_manifest_of_no_and_one_document(spark):
    df = spark.createDataFrame([(1, "a", "00ff")], "doc_id long, source string, leaf string")
    assert [tuple(r) for r in merkle.manifest(df).collect()] == [(1, "a", "00ff", "00ff", "00ff", [])]
    assert merkle.manifest(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="null"):
        merkle.manifest(df.withColumn("leaf", F.lit(None).cast("string"))).collect()


# Toxicity


def test_op13_on_held_out_labels():
    """The whole query's accuracy on labels it has not seen; a text's own label is wrong or unspoken in some."""
    from pyspark.sql import SparkSession

    spark, folder = SparkSession.getActiveSession(), "/root/testdata/sf0.1"
    got = registered.op13_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet").filter("toxic is not null"), "doc_id")
    rows = got.filter("held_out").select("toxic", "score", "predicted").toPandas()
    toxic = rows["toxic"] == 1
    assert len(rows) > 500 and rows["predicted"].eq((rows["score"] >= 0.5).astype(int)).all()
    assert rows["predicted"][toxic].mean() > 0.85 and rows["predicted"][~toxic].mean() < 0.03


def brute_score(model, text):
    text = f" {(text or '').lower()} "
    weights, found = dict(zip(model.grams.tolist(), model.weights.tolist(), strict=True)), set()
    for n in toxicity.LENGTHS:
        for i in range(len(text) - n + 1):
            h = 0
            for c in text[i : i + n]:
                h = (h * int(toxicity._BASE) + ord(c) + 1) % (1 << 64)
            found.add(h)
    return 1 / (1 + np.exp(-np.clip(model.offset + sum(weights.get(h, 0.0) for h in found), -35, 35)))


def test_toxicity_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefgh"), size=rng.integers(2, 7))) for _ in range(80)]
    prose = [" ".join(rng.choice(words, size=30)) for _ in range(300)]
    rows = [(t + " Xyzzy" * (k % 3 == 0), int(k % 3 == 0)) for k, t in enumerate(prose)]
    train = spark.createDataFrame([*rows, (None, 0), ("", 0), ("unlabelled", None), *[rows[0]] * 50], "text string, toxic int")
    model = toxicity.train(train, "toxic")
    texts = [None, "", "xyzzy", "clean " + prose[1], "é🙂 XYZZY!", "a", *[t for t, _ in rows[:20]], ("abc " * 4000 + "xyzzy ") * 3]
    df = spark.createDataFrame([(i, t, "clash", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, predicted string, row double")
    monkeypatch.setattr(toxicity, "SLICE_BYTES", 1000)  # the long text is read in windows
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert len(got) == len(texts) and got[2].predicted == 1 and got[3].predicted == 0 and got[len(texts) - 1].predicted == 1
    for i, t in enumerate(texts):
        assert abs(got[i].score - brute_score(model, t)) < 1e-9 and got[i].row == 1.0
    assert toxicity.score(df.limit(0), model).count() == 0


def test_grams_are_counted_over_all_rows(spark):
    rows = [("ab", 1), ("ab", 1), ("abc", 0), (None, 0)]
    counted = toxicity.count_grams(spark.createDataFrame([(t or "", y) for t, y in rows], "text string, label int"), "text", "label")
    want = defaultdict(lambda: [0, 0])
    for t, y in rows:
        text = f" {t or ''} "
        for g in {text[i : i + n] for n in toxicity.LENGTHS for i in range(len(text) - n + 1)}:
            want[g][1 - y] += 1
    assert sorted((r.toxic, r.clean) for r in counted.collect()) == sorted(map(tuple, want.values()))


@pytest.mark.parametrize("rows,score", [([], 0.0), ([("a", 0), ("b", 0)], 0.0), ([("a", 1)], 1.0), ([("a", None)], 0.0)])
def test_toxicity_without_two_labels(spark, rows, score):
    model = toxicity.train(spark.createDataFrame(rows, "text string, toxic int"), "toxic")
    got = toxicity.score(spark.createDataFrame([("x",), (None,)], "text string"), model).collect()
    assert all(abs(r.score - score) < 1e-9 for r in got)
