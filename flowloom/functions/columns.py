"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column letters of the printed TCP flags, in print order.
FLAG_LETTERS = (("urg", "U"), ("ack", "A"), ("psh", "P"), ("rst", "R"), ("syn", "S"), ("fin", "F"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_name(name: Column | str) -> Column:
    """Lower-case a display name and turn whitespace runs into ``_``."""
    return F.regexp_replace(F.lower(_col(name)), r"\s+", "_")


def flag_string(flags: dict[str, Column | str] | None = None) -> Column:
    """Six characters, one per TCP flag, blank where the flag is unset."""
    flags = flags or {}
    return F.concat(
        *[
            F.when(_col(flags.get(name, name)), F.lit(letter)).otherwise(F.lit(" "))
            for name, letter in FLAG_LETTERS
        ]
    )


def sorted_pair(a: Column | str, b: Column | str) -> Column:
    """Both values concatenated without a delimiter, smaller first."""
    a, b = _col(a), _col(b)
    return F.concat(F.least(a, b).cast("string"), F.greatest(a, b).cast("string"))


def ip_key() -> Column:
    return F.concat(
        F.lit("|"), F.col("reference"), F.lit("|"), F.col("sensor"), sorted_pair("id_orig_h", "id_resp_h")
    )


def ip_port_key() -> Column:
    """``ip_key`` plus the sorted ports for records that have ports."""
    with_ports = F.concat(ip_key(), sorted_pair("id_orig_p", "id_resp_p"))
    return F.coalesce(with_ports, ip_key())


def endpoint_key_columns() -> dict[str, Column]:
    """Direction-free flow key as separate columns.

    Each host keeps its own port, so ``(1, 23)`` and ``(12, 3)`` cannot collide as they do
    in the concatenated text key.
    """
    src = F.struct(F.col("id_orig_h").alias("h"), F.col("id_orig_p").alias("p"))
    dst = F.struct(F.col("id_resp_h").alias("h"), F.col("id_resp_p").alias("p"))
    lo, hi = F.least(src, dst), F.greatest(src, dst)
    return {
        "host_lo": lo["h"],
        "port_lo": lo["p"],
        "host_hi": hi["h"],
        "port_hi": hi["p"],
        "from_lo": src == lo,
    }


def int_div(value: Column | str, by: int) -> Column:
    """Whole-number division on BIGINT, without a detour through DOUBLE."""
    return F.call_function("div", _col(value), F.lit(by).cast("bigint"))


def epoch_seconds(ts_ns: Column | str) -> Column:
    return int_div(ts_ns, 1_000_000_000)


def epoch_millis(ts_ns: Column | str) -> Column:
    return int_div(ts_ns, 1_000_000)


def nano_of_second(ts_ns: Column | str) -> Column:
    return F.pmod(_col(ts_ns), F.lit(1_000_000_000).cast("bigint")).cast("int")


def timestamp_of(ts_ns: Column | str) -> Column:
    """Microsecond TIMESTAMP of a nanosecond instant."""
    return F.timestamp_micros(int_div(ts_ns, 1_000))


def stable_uid(*parts: Column | str) -> Column:
    """Repeatable identifier: the same record gets the same uid on every run and retry.

    A NULL has a text of its own, so parts never move into each other's place.
    """
    return F.sha2(F.concat_ws("|", *[F.coalesce(_col(p).cast("string"), F.lit("\\N")) for p in parts]), 256)


def normalise_ip(value: Column | str) -> Column:
    """Loopback ``::1`` and v4-mapped v6 text become the plain v4 address."""
    v = _col(value)
    mapped = F.regexp_extract(v, r"::ffff:(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})", 1)
    return F.when(v == "::1", F.lit("127.0.0.1")).when(mapped != "", mapped).otherwise(v)


def system_time(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.f]`` in UTC as a TIMESTAMP, NULL when it does not parse."""
    return F.try_to_timestamp(F.concat(F.replace(_col(text), F.lit(" "), F.lit("T")), F.lit("Z")))
