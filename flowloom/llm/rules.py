"""Quality rules with thresholds that follow the corpus: one quantile sketch per language, source and measure.

Everything is DataFrame functions. A sketch is a table of counters: a value falls into the bucket of its leading
``BITS`` binary digits, so a quantile is off by 2 % of its value at most, sketches merge by adding counters, and no
order of merging changes a result. Map-side sums keep a hot source from becoming a hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.common import SPACES, shared_table, whole

SYMBOLS = "#*$%&|<>"
#: Leading binary digits that a bucket of a sketch keeps.
BITS = 7
#: A group with fewer documents uses the sketch of its language, then that of the corpus.
LEAST_ROWS = 200
#: Fences lie this many times the distance of the quartiles outside them.
REACH = 4
#: Per mille measures and the slack that a fence leaves at least, so that groups without spread reject nothing clean.
MEASURES = {"mean_word": 1500, "symbols": 150, "dup_lines": 500, "repeats": 450, "shouts": 250}

ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_shouts", "n_repeat_words", *MEASURES, "base_failed", "kept"]


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_text`` and ``_words``, the words of the whole text."""
    plain = F.translate(F.col("_text"), SPACES, " " * len(SPACES))
    return df.withColumn("_text", whole(text)).withColumn("_words", F.filter(F.split(plain, " "), lambda w: w != ""))


def _shared_windows(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words within 3-word windows that occur twice or more in the same text."""
    window = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    df = df.withColumn("_windows", F.when(F.size("_words") > 3, F.slice(window, 1, F.size("_words") - 2)))
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("_placed", F.when(some, F.array_sort(placed)))
    twice = F.filter("_placed", lambda x, k: (x["h"] == F.get("_placed", k - 1)["h"]) | (x["h"] == F.get("_placed", k + 1)["h"]))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts of the whole text and the per mille measures made of them.

    A null, empty or blank text has zero in every count and measure. Lines are split at ``\\n`` and compared whole.
    """
    df = _shared_windows(with_words(df.drop(*(c for c in ADDED if c != text)), text))
    blank = F.translate("_text", SPACES, "")
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.translate(x, SPACES, "") != ""))
    df = df.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.length(blank).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.length("_text") - F.length(F.translate("_text", "!?", ""))).cast("long").alias("n_shouts"),
    ).drop("_text", "_words", "_windows", "_placed", "_lines")

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.expr(f"(1000 * {a}) div {b}")).otherwise(F.lit(0)).cast("long")

    return df.select(
        "*",
        ratio("word_chars", "n_words").alias("mean_word"),
        ratio("n_symbols", "n_words").alias("symbols"),
        ratio("n_dup_lines", "n_lines").alias("dup_lines"),
        ratio("n_repeat_words", "n_words").alias("repeats"),
        ratio("n_shouts", "n_words").alias("shouts"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )


def bucket(value: Column) -> Column:
    """The smallest number with the leading ``BITS`` binary digits of a non-negative number."""
    cut = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def sketches(measured: DataFrame, keys: list[str]) -> DataFrame:
    """Counters (keys, measure, bucket, n) over the rows that pass the base rules."""
    pairs = ", ".join(f"'{m}', {m}" for m in MEASURES)
    long = measured.filter(~F.col("base_failed")).selectExpr(*keys, f"stack({len(MEASURES)}, {pairs}) AS (measure, value)")
    return long.groupBy(*keys, "measure", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("n"))


def merge(counters: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups, by adding counters."""
    return counters.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(counters: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group with its size and lower and upper fence of each measure, as ``rows`` and ``<measure>_lo/hi``."""
    by = Window.partitionBy(*keys, "measure")
    run = counters.withColumn("upto", F.sum("n").over(by.orderBy("bucket"))).withColumn("rows", F.sum("n").over(by))
    quartiles = run.groupBy(*keys, "measure").agg(
        F.max("rows").alias("rows"),
        F.min(F.when(4 * F.col("upto") >= F.col("rows"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("rows"), F.col("bucket"))).alias("q3"),
    )
    slack = F.create_map(*[F.lit(x) for kv in MEASURES.items() for x in kv])
    reach = F.greatest(REACH * (F.col("q3") - F.col("q1")), slack[F.col("measure")])
    bounds = quartiles.select(*keys, "measure", "rows", (F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))
    columns = [F.max("rows").alias("rows")]
    for m in MEASURES:
        columns += [F.max(F.when(F.col("measure") == m, F.col(x))).alias(f"{m}_{x}") for x in ("lo", "hi")]
    return bounds.groupBy(*keys).agg(*columns)


def judge(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Adds ``kept`` to measured rows: false where a base rule fails or a measure lies outside its group's fences.

    Null languages and sources are groups like any other. Every row comes back once; an empty table stays empty.
    """
    named = measured.withColumn("_l", F.col(lang)).withColumn("_s", F.col(source))
    fine = shared_table(sketches(named, ["_l", "_s"]))
    levels = [(["_l", "_s"], fine), (["_l"], merge(fine, ["_l"])), ([], merge(fine, []))]
    for k, (keys, counters) in enumerate(levels):
        names = ["rows", *(f"{m}_{x}" for m in MEASURES for x in ("lo", "hi"))]
        table = fences(counters, keys).select(*[F.col(c).alias(f"{c}{k}") for c in keys], *[F.col(c).alias(f"{c}{k}") for c in names])
        if keys:
            on = [named[c].eqNullSafe(table[f"{c}{k}"]) for c in keys]
            named = named.join(table, on, "left").drop(*[f"{c}{k}" for c in keys])
        else:  # one row for the whole corpus
            row = table.first()
            named = named.withColumns({c: F.lit(row[c]).cast("long") for c in table.columns})
    ok = F.lit(True)
    for m in MEASURES:
        for x in ("lo", "hi"):
            bound = F.when(F.col("rows0") >= LEAST_ROWS, F.col(f"{m}_{x}0")).when(F.col("rows1") >= LEAST_ROWS, F.col(f"{m}_{x}1")).otherwise(F.col(f"{m}_{x}2"))
            ok = ok & ((F.col(m) >= bound) if x == "lo" else (F.col(m) <= bound))
    return named.select(*measured.columns, (~F.col("base_failed") & F.coalesce(ok, F.lit(True))).alias("kept"))


def quality_rules(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """All rows and the ``keep`` columns (all by default) of ``df`` with counts, measures, ``base_failed`` and ``kept``.

    Counts and measures are made once, written with the kept columns, and read twice: for the sketches and for the
    filter. Columns of ``df`` named like an added one give way to it.
    """
    measured = measure(df, text)
    if keep is not None:
        measured = measured.select(*dict.fromkeys([*keep, lang, source]), *(c for c in ADDED if c != "kept"))
    judged = judge(shared_table(measured), lang, source)
    return judged if keep is None else judged.select(*keep, *ADDED)
