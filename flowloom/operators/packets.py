"""Per-packet filters, projections and keys. No shuffle except for lookups too big to broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.columns import (
    epoch_millis,
    epoch_seconds,
    nano_of_second,
    normalise_name,
    stable_uid,
)


# Columns a packet table may lack, because its capture has no such protocol.
OPTIONAL_COLUMNS = {
    "id_orig_p": "int",
    "id_resp_p": "int",
    "seq_num": "bigint",
    "ack_num": "bigint",
    "icmp_type": "string",
    "icmp_code": "string",
    "icmp_type_number": "int",
    "icmp_code_number": "int",
    "service": "string",
    "source_file": "string",
    "member": "string",
    "ip_version": "string",
}


def with_optional_columns(packets: DataFrame) -> DataFrame:
    """The packets with every optional column, NULL where it was missing."""
    missing = {n: F.lit(None).cast(t) for n, t in OPTIONAL_COLUMNS.items() if n not in packets.columns}
    return packets.withColumns(missing) if missing else packets


def filter_ipv4(packets: DataFrame) -> DataFrame:
    return packets.filter(F.col("ip_version") == "ipv4")


def record_type() -> Column:
    """``tcp``, ``udp``, ``icmp`` or ``ip`` by first match; NULL when none applies.

    Fragments have a protocol but no transport header, so they are plain ``ip``. IPv6
    packets of any other protocol have no record type.
    """
    return (
        F.when((F.col("protocol") == "tcp") & F.col("id_orig_p").isNotNull(), "tcp")
        .when((F.col("protocol") == "udp") & F.col("id_orig_p").isNotNull(), "udp")
        .when(F.col("protocol").isin("icmp", "icmpv6") & F.col("icmp_type_number").isNotNull(), "icmp")
        .when(F.col("ip_version") == "ipv4", "ip")
    )


def dispatch_protocol(packets: DataFrame) -> DataFrame:
    typed = with_optional_columns(packets).withColumn("record_type", record_type())
    reason = F.when(F.col("record_type").isNull(), F.lit("unsupported protocol"))
    return typed.withColumn("reason", reason)


def payload_bytes(*layer_lengths: str) -> Column:
    """Payload length of the deepest known layer (given deepest first), 0 without a payload."""
    return F.coalesce(*[F.col(c) for c in layer_lengths], F.lit(0)).cast("bigint")


def service_name(packets: DataFrame, ports: DataFrame) -> DataFrame:
    """Add ``service``: the name of the lower port (the destination's on a tie).

    ``ports(port, service)`` is the caller's; Spark broadcasts it while it is below the
    session's broadcast limit and falls back to a skew-handled join beyond. Of several names of
    a port the first by text counts.
    """
    named = ports.groupBy(F.col("port").alias("_port")).agg(F.min(normalise_name("service")).alias("service"))
    src, dst = F.col("id_orig_p"), F.col("id_resp_p")
    joined = packets.withColumn("_service_port", F.when(src < dst, src).otherwise(dst))
    return joined.join(named, F.col("_service_port") == F.col("_port"), "left").drop("_port", "_service_port")


def icmp_names(packets: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``icmp_type`` and ``icmp_code`` from ``names(ip_version, type, code, type_name, code_name)``.

    Of several names of one type and code the first pair by text counts.
    """
    pair = F.struct(normalise_name("type_name").alias("icmp_type"), normalise_name("code_name").alias("icmp_code"))
    keys = [F.col(c).alias(a) for c, a in (("ip_version", "_v"), ("type", "_t"), ("code", "_c"))]
    dim = names.groupBy(*keys).agg(F.min(pair).alias("_pair")).select("_v", "_t", "_c", "_pair.*")
    on = (
        (F.col("ip_version") == F.col("_v"))
        & (F.col("icmp_type_number") == F.col("_t"))
        & (F.col("icmp_code_number") == F.col("_c"))
    )
    return packets.drop("icmp_type", "icmp_code").join(dim, on, "left").drop("_v", "_t", "_c")


def frame_uid() -> Column:
    """Identifier of a frame: its file, the container's member that it lies in, and its number there."""
    return stable_uid("source_file", "member", "frame_no")


def protocol_numbers() -> Column:
    """The ports or the ICMP numbers as ``a|b``; NULL where a record has neither."""
    return F.when(F.col("id_orig_p").isNotNull(), F.concat_ws("|", "id_orig_p", "id_resp_p")).when(
        F.col("icmp_type_number").isNotNull(), F.concat_ws("|", "icmp_type_number", "icmp_code_number")
    )


def packet_row_key() -> Column:
    """``|``-joined packet key; the ports or ICMP numbers only where the protocol has them."""
    return F.concat_ws(
        "|",
        "reference",
        "sensor",
        "id_orig_h",
        "id_resp_h",
        protocol_numbers(),
        "protocol",
        epoch_seconds("ts_ns").cast("string"),
        nano_of_second("ts_ns").cast("string"),
        F.col("bytes").cast("float").cast("string"),
        frame_uid(),
    )


def split_instant(ts_ns: str = "ts_ns") -> list[Column]:
    return [epoch_millis(ts_ns).alias("epoch_ms"), nano_of_second(ts_ns).alias("nanos")]


def instant_ns(ts_sec: str, ts_frac: str, precision: str) -> Column:
    """Nanoseconds since the epoch; the capture's precision says what the fraction counts."""
    unit = F.when(F.col(precision) == "nano", F.lit(1)).otherwise(F.lit(1000))
    return F.col(ts_sec).cast("bigint") * 1_000_000_000 + F.col(ts_frac).cast("bigint") * unit
