"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import bpe, chat, jaccard, langid, merkle, oracles, packing, quality, rules, secrets, sharding, topk, toxicity, whitening
from flowloom.llm.common import documents, shared_table

QUERIES, ORACLES = {}, {}


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), tokens, public_tokenizers.PATTERN, keep_text=False)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    counted = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), "ids")
    return bpe.decode(counted, tokens, keep_ids=False).withColumn("decoded", F.sha2("decoded", 256)).withColumnRenamed("decoded", "decoded_sha256")


QUERIES["op1_byte_bpe"] = op1_byte_bpe


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(told.unionByName(more)))


QUERIES["op2_chat_format"] = op2_chat_format


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(documents(spark, sf_dir).select("doc_id", "text"), width=4, percent=85)


QUERIES["op3_jaccard_join"] = op3_jaccard_join
ORACLES["op3_jaccard_join"] = oracles.JACCARD


def op4_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), remembered=1_000_000)
    digests = shared_table(cut.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32"))
    return packing.pack(digests, keys=["doc_id", "piece"])


QUERIES["op4_pattern_packing"] = op4_pattern_packing


def is_held_out():
    """Whether the checksum of a document's id leaves 2 when divided by 4; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.filter(~is_held_out()).select("text", "lang"))
    rows = docs.select("doc_id", is_held_out().alias("held_out"), "text")
    return langid.identify(rows, model, keep_text=False)


QUERIES["op5_language_id"] = op5_language_id


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality IS NOT NULL")
    labels = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    docs, metadata = documents(spark, sf_dir), ["source", "lang", "n_chars"]
    model = quality.train(docs.join(labels, "doc_id", "left"), "quality", metadata=metadata)
    return quality.classify(docs, model, metadata=metadata, keep=["doc_id"])


QUERIES["op6_quality_classifier"] = op6_quality_classifier


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.quality_rules(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"), keep=["doc_id"]).select(*columns)


QUERIES["op7_quality_rules"] = op7_quality_rules
ORACLES["op7_quality_rules"] = oracles.QUALITY


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return topk.top_k(vectors.filter("vec_id % 100 = 0"), vectors)


QUERIES["op8_top_k"] = op8_top_k
ORACLES["op8_top_k"] = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))

    def count(name: str):
        kind = secrets.KINDS.index(name)
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{name}")

    return found.select(
        "doc_id",
        *(count(name) for name in secrets.KINDS[:3]),
        F.sha2(secrets.listing("secrets", secrets.KINDS[:3]), 256).alias("base_sha256"),
        secrets.listing("secrets").alias("spans"),
    )


QUERIES["op9_secret_scan"] = op9_secret_scan


#: Bytes of text that a shard of the query holds at most.
SHARD_BYTES = 16 << 20


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return sharding.shard(docs, ["doc_id"], F.col("n_bytes"), SHARD_BYTES).select("doc_id", "n_bytes", "shard_depth", "shard_bucket", "shard_part")


QUERIES["op10_sharding"] = op10_sharding
ORACLES["op10_sharding"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
         ('0x' || substr(md5(coalesce('kv' || doc_id::VARCHAR, 'kn')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT greatest(0, ceil(log2(greatest(1, ceil(sum(n_bytes) / {SHARD_BYTES}.0)))))::INT AS first FROM d),
t AS (SELECT d.*, k.depth, d.h >> (60 - k.depth)::INT AS bucket, sum(n_bytes) OVER (PARTITION BY k.depth, d.h >> (60 - k.depth)::INT) AS held,
             count(*) OVER (PARTITION BY k.depth, d.h >> (60 - k.depth)::INT) AS held_rows
      FROM d, (SELECT unnest(range(0, 31)) AS depth) k, s WHERE k.depth >= s.first)
SELECT doc_id, n_bytes, min(depth)::INT AS shard_depth, min_by(bucket, depth) AS shard_bucket, 0::BIGINT AS shard_part
FROM t WHERE held <= {SHARD_BYTES} OR held_rows = 1 GROUP BY doc_id, n_bytes
"""


def _manifest_leaf(text: str):
    return merkle.digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text") if text == "text" else F.expr(text))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    changed = even & F.col("text").contains("\n")
    tampered = F.when(changed, _manifest_leaf("replace(text, '\\n', '')"))  # null: as it was
    leaves = documents(spark, sf_dir).select("doc_id", "source", _manifest_leaf("text").alias("leaf"), tampered.alias("tampered"))
    proven = merkle.manifest(leaves)
    folded = merkle.fold(F.coalesce("tampered", "leaf"), "proof")
    told = proven.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest("proof").alias("proof_sha256"), folded.alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES["op12_merkle_manifest"] = op12_merkle_manifest
ORACLES["op12_merkle_manifest"] = oracles.MANIFEST


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", whitening.whole_entries("embedding").alias("x"))
    vectors = vectors.filter("x IS NOT NULL")
    model = whitening.fit(vectors, "x")
    explained = F.lit((model.values / model.trace if model.trace else model.values).tolist()).cast("array<double>")
    rows = whitening.whiten(vectors, model, "x").select("vec_id", F.col("deviation").cast("long").alias("deviation"), F.posexplode("whitened").alias("k", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


QUERIES["op11_embedding_whitening"] = op11_embedding_whitening


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("toxic IS NOT NULL")
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs.filter(~apart).select("doc_id", "text").join(labels.hint("merge"), "doc_id"), "toxic")
    return toxicity.score(docs.select("doc_id", apart.alias("held_out"), "text"), model, keep=["doc_id", "held_out"])


QUERIES["op13_toxicity"] = op13_toxicity
