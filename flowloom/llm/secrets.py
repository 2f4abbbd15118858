"""Secret scans: fixed patterns, and windows of high character entropy inside long candidate strings.

Everything is DataFrame functions. Positions come from splitting a text at the matches of a pattern: the pieces
between them and the matches alternate, so running sums of their lengths are the code point positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import whole

ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: The shortest match counts only; a shorter run of the same characters is no match, so the lengths are in the patterns.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ["assign", "access", "hex", "entropy"]
#: Characters in an entropy window.
WINDOW = 20
#: Bits per character that a window of a class must exceed. The classes are tried in this order.
CLASSES = [("[0-9]+", 2.8), ("[0-9a-f]+", 3.25), ("[0-9A-F]+", 3.25), ("[A-Za-z]+", 3.75), ("[A-Za-z0-9+/_=-]+", 3.75)]
#: Words of one class inside a run, which have their own threshold whatever stands beside them.
PURE = r"(?<![A-Za-z0-9])(?=[A-Za-z0-9]{20})(?:[0-9]++|[0-9a-f]++|[0-9A-F]++|[A-Za-z]++)(?![A-Za-z0-9])"
#: A part between delimiters that names itself a placeholder. A longer part can spell such a word by chance.
PLACEHOLDER = r"(?=[A-Za-z0-9+_]{1,80}(?![A-Za-z0-9+_]))[A-Za-z0-9+_]*?(?:(?i:example|placeholder|changeme|xxxx|dummy|sample))[A-Za-z0-9+_]*"
#: Candidates that are no secrets: placeholders, UUIDs, paths and names whose parts never mix letters and digits, and
#: plain numbers, which count up or down or are a time to the second with fractions.
ALLOW = [
    PLACEHOLDER,
    r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}",
    r"(?![A-Za-z]+$|[0-9]+$)(?!.*(?:[A-Za-z][0-9]|[0-9][A-Za-z])).*",
    r"[0-9]{0,9}(?:(?:0123456789)+|(?:1234567890)+|(?:9876543210)+|(?:0987654321)+)[0-9]{0,9}",
    r"(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])(?:[01][0-9]|2[0-3])[0-5][0-9][0-5][0-9][0-9]{6,9}",
]


def matches(text: str, pattern: str, kind: str, value_group: int = 0, least_value: int = 0) -> tuple[dict[str, Column], Column]:
    """Helper columns, to be added first, and the array of structs (start, end, kind, value) made of them."""
    found, held = f"_{kind}_found", f"_{kind}_pieces"
    some = F.col(text).rlike(pattern)
    helpers = {
        found: F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))),
        held: F.when(some, F.split(text, pattern, -1)),
        f"_{kind}_values": F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))),
    }
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,kind:int,value:string>>").alias("spans"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["piece"])
        end = begin + F.length(x["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"), x["value"].alias("value"))
        keep = F.length(x["value"]) >= least_value
        return F.struct(end.alias("at"), F.when(keep, F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))

    # One piece more than matches: the last has none and ends the walk.
    joined = F.slice(F.arrays_zip(F.col(held).alias("piece"), F.col(found).alias("match"), F.col(f"_{kind}_values").alias("value")), F.lit(1), F.size(found))
    spans = F.when(F.size(found) > 0, F.aggregate(joined, start, step, lambda a: a["spans"]))
    return helpers, F.coalesce(spans, start["spans"])


def _threshold(value: Column) -> Column:
    bits = F.lit(None).cast("double")
    for pattern, least in reversed(CLASSES):
        bits = F.when(value.rlike(f"^{pattern}$"), F.lit(least)).otherwise(bits)
    return bits


def window_spans(value: Column, window: int = WINDOW, threshold: Column | None = None) -> Column:
    """Ranges (start, end) of ``value`` covered by windows whose entropy exceeds the threshold, overlapping ones joined.

    ``counts`` holds how often each character is in the window and ``mass`` the sum of c * log2(c); a step takes the
    character that leaves and the one that enters and mends both. The entropy is log2(window) - mass / window.
    """
    limit = _threshold(value) if threshold is None else threshold
    empty = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"),
        F.lit(0.0).alias("mass"),
        (limit + 1e-9).alias("limit"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
    )

    def weight(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))

    def step(a: Column, x: Column) -> Column:
        into, out, at = x["m"]["into"], x["m"]["out"], x["at"]
        n_in, n_out = F.get(a["counts"], into), F.get(a["counts"], out)
        counts = F.transform(a["counts"], lambda n, c: n + F.when(c == into, 1).otherwise(0) - F.when(c == out, 1).otherwise(0))
        change = weight(n_in + 1) - weight(n_in) + F.when(out < 0, 0.0).otherwise(weight(n_out - 1) - weight(n_out))
        mass = a["mass"] + F.when(into == out, 0.0).otherwise(change)
        hot = (at >= window - 1) & (F.log2(F.lit(float(window))) - mass / window > a["limit"])
        first, end, last = at - (window - 1), at + 1, F.try_element_at(a["spans"], F.lit(-1))
        longer = F.concat(F.slice(a["spans"], F.lit(1), F.size(a["spans"]) - 1), F.array(F.struct(last["start"].alias("start"), end.alias("end"))))
        another = F.concat(a["spans"], F.array(F.struct(first.alias("start"), end.alias("end"))))
        spans = F.when(~hot, a["spans"]).when(last["end"] >= first, longer).otherwise(another)
        return F.struct(counts.alias("counts"), mass.alias("mass"), a["limit"].alias("limit"), spans.alias("spans"))

    # Candidates are ASCII, so their characters are numbers under 128; -1 says that none leaves yet.
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c))
    moves = F.zip_with(
        codes,
        F.slice(F.concat(F.array_repeat(F.lit(-1), window), codes), F.lit(1), F.length(value)),
        lambda c, o: F.struct(c.alias("into"), o.alias("out")),
    )
    return F.aggregate(F.transform(moves, lambda m, i: F.struct(m.alias("m"), i.alias("at"))), empty, step, lambda a: a["spans"])


def outside(c: Column, cuts: Column, least: int = WINDOW) -> Column:
    """What lies of the span ``c`` outside the spans ``cuts``: the pieces of ``least`` characters or more."""
    none = F.filter(F.array(c), lambda x: F.lit(False))

    def piece(start: Column, end: Column) -> Column:
        value = F.substr(c["value"], (start - c["start"] + 1).cast("int"), (end - start).cast("int"))
        made = F.struct(start.alias("start"), end.alias("end"), c["kind"].alias("kind"), value.alias("value"))
        return F.when(end - start >= least, F.array(made)).otherwise(none)

    def step(a: Column, x: Column) -> Column:
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.concat(a["pieces"], piece(a["at"], x["start"])).alias("pieces"))

    met = F.array_sort(F.filter(cuts, lambda x: (x["start"] < c["end"]) & (c["start"] < x["end"])))
    begin = F.struct(c["start"].alias("at"), none.alias("pieces"))
    cut = F.aggregate(met, begin, step, lambda a: F.concat(a["pieces"], piece(a["at"], c["end"])))
    return F.when(F.size(met) > 0, cut).otherwise(F.array(c))


def scan(df: DataFrame, text: str = "text", allow: list[str] | None = None, placeholder: str = PLACEHOLDER) -> DataFrame:
    """Adds ``secrets``, an array of (start, end, kind, value) by start, then kind as in ``KINDS``.

    Positions are code points of the whole text, the end exclusive. ``kind`` is a number into ``KINDS``. Spans of fixed
    patterns and parts that match ``placeholder`` are cut out of a candidate; each piece left that is long enough is a
    candidate of its own, unless all of it matches one of ``allow``. So no entropy span overlaps one of a fixed
    pattern. Words that match ``PURE`` are candidates beside the run they lie in. A null or empty text has none. Columns of ``df`` stay, except one named ``secrets``.
    """
    allow = ALLOW if allow is None else allow
    kept = [c for c in df.columns if c != "secrets"]
    df = df.select(*kept, whole(text).alias("_text"))
    spans = {}
    for kind, pattern, group, least in (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32), ("entropy", CANDIDATE, 0, 20)):
        helpers, spans[kind] = matches("_text", pattern, kind, group, least)
        df = df.withColumns(helpers)
    df = df.select(*kept, "_text", F.concat(spans["assign"], spans["access"], spans["hex"]).alias("_base"), spans["entropy"].alias("_runs"))

    # Only texts with a candidate are searched for placeholders.
    df = df.withColumn("_long", F.when(F.size("_runs") > 0, F.col("_text")))
    helpers, named = matches("_long", rf"(?<![A-Za-z0-9+_]){placeholder}", "entropy")
    df = df.withColumns(helpers).withColumn("_cuts", F.when(F.size("_runs") > 0, F.concat("_base", named)))
    helpers, words = matches("_long", PURE, "entropy")
    df = df.withColumns(helpers).withColumn("_runs", F.when(F.size("_runs") > 0, F.array_distinct(F.concat("_runs", words))).otherwise(F.col("_runs")))
    pieces = F.flatten(F.transform("_runs", lambda c: outside(c, F.col("_cuts"))))
    df = df.select(*kept, "_text", "_base", F.when(F.size("_cuts") > 0, F.array_distinct(pieces)).otherwise(F.col("_runs")).alias("_candidates"))

    def fresh(c: Column) -> Column:
        listed = F.lit(False)
        for pattern in allow:
            listed = listed | c["value"].rlike(f"^(?:{pattern})$")
        return ~listed

    df = df.withColumn("_candidates", F.filter("_candidates", fresh))

    def inside(c: Column) -> Column:
        return F.transform(window_spans(c["value"]), lambda s: F.struct((c["start"] + s["start"]).alias("start"), (c["start"] + s["end"]).alias("end")))

    # A word and its run may both report; overlapping spans are one.
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def join(a: Column, x: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        longer = F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when(last["end"] >= x["start"], longer).otherwise(F.concat(a, F.array(x)))

    joined = F.aggregate(F.array_sort(F.flatten(F.transform("_candidates", inside))), none, join)
    entropy = F.transform(
        joined,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(KINDS.index("entropy")).alias("kind"),
            F.substr("_text", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).alias("value"),
        ),
    )
    df = df.withColumn("_entropy", F.when(F.size("_candidates") > 0, entropy).otherwise(F.filter("_candidates", lambda c: F.lit(False))))
    ordered = F.array_sort(F.transform(F.concat("_base", "_entropy"), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"))))
    return df.select(*kept, ordered.alias("secrets"))


def listing(secrets: Column | str, kinds: list[str] = KINDS) -> Column:
    """Spans of these kinds as text: kind:start:end, comma-joined, in order."""
    numbers = [KINDS.index(k) for k in kinds]
    names = F.array(*[F.lit(k) for k in KINDS])
    picked = F.filter(secrets, lambda s: s["kind"].isin(numbers))
    return F.array_join(F.transform(picked, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every secret of ``text`` replaced by ``[kind]``; nested and overlapping spans become one mark."""
    scanned = scan(df.withColumn("_plain", whole(text)), "_plain")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def step(a: Column, s: Column) -> Column:
        more = F.concat(a["out"], F.substr("_plain", (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.get(names, s["kind"]))
        return F.struct(F.when(s["start"] >= a["at"], more).otherwise(a["out"]).alias("out"), F.greatest(a["at"], s["end"]).alias("at"))

    done = F.aggregate("secrets", start, step, lambda a: F.concat(a["out"], F.substr("_plain", (a["at"] + 1).cast("int"), F.length("_plain"))))
    columns = [F.when(F.size("secrets") > 0, done).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in df.columns]
    return scanned.select(*columns)
