"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept; ``run`` writes what a
stage returns as Parquet into the shared folder and reads it again for the next. All stages but the last return the
columns of ``documents``; the last returns where each piece of each document lies. Nulls, empty and blank texts,
repeated rows and empty tables pass through every stage as its operator defines; further columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import jaccard, langid, packing, rules, secrets
from flowloom.llm.common import documents, shared_table, whole

#: A document whose language is this uncertain goes.
LEAST_CONFIDENCE = 0.4


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the fences of their language and source.

    A verdict depends on these and on the text alone, so the rejected ones are named by the text's digest and the texts
    themselves are not written a second time.
    """
    digest = F.md5(whole("text"))
    judged = rules.quality_rules(docs.select(digest.alias("_digest"), "text", "lang", "source"), keep=["_digest", "lang", "source"])
    names = {"_digest": "_d", "lang": "_l", "source": "_s"}
    rejected = judged.filter(~F.col("kept")).select(*[F.col(c).alias(n) for c, n in names.items()]).distinct()
    same = (digest == rejected["_d"]) & docs["lang"].eqNullSafe(rejected["_l"]) & docs["source"].eqNullSafe(rejected["_s"])
    return docs.join(rejected, same, "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; the model is fitted on the labelled ones among them."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    found = langid.identify(rows, langid.train(docs), keep_text=False)
    return found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_CONFIDENCE)).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of alike texts: of the smallest id, and where its texts differ, of the smallest digest.

    A row is known by its id and its text's digest, so other texts under the same id are decided on their own. A row
    without an id stays only where its group has no id. Blank texts are in no group: of these, rows that repeat an id
    and a text are one, and those without an id all stay.
    """
    digest = F.coalesce(F.md5("text"), F.lit(""))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), digest.alias("digest"))
    groups = shared_table(jaccard.jaccard_groups(docs.select(row.alias("_row"), "text"), width=5, percent=80, id_column="_row"))

    def names(rows: DataFrame) -> DataFrame:
        return shared_table(rows.select(F.col("_row.id").alias("_id"), F.col("_row.digest").alias("_digest")))

    def same(rows: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(rows["_id"]) & (digest == rows["_digest"])

    losers = names(groups.filter("component_id <> _row").select("_row").distinct())
    kept = docs.join(losers, same(losers), "left_anti")
    winners = groups.filter("component_id = _row AND (n_shingles > 0 OR NOT _row.unnamed)")
    repeated = names(winners.groupBy("_row").count().filter("count > 1"))
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, same(repeated), "left_semi").withColumn("_digest", digest).dropDuplicates(["doc_id", "_digest"]).select(*docs.columns)
    return kept.join(repeated, same(repeated), "left_anti").unionByName(once)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by its kind; ``n_chars`` follows the text."""
    done = secrets.redact(docs.withColumn("_before", F.col("text")))
    columns = [F.when(F.col("_before") != F.col("text"), F.length("text")).otherwise(F.col("n_chars")).cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return done.select(*columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset, as in the packing query."""
    cut = packing.pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    digests = shared_table(cut.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32"))
    return packing.pack(digests, keys=["doc_id", "piece"])


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Language identification, the similarity join, entropy windows and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir))
    return docs
