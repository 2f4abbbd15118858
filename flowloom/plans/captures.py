"""Capture and event-log files derived from the given tables, as rows with binary content.

They give the byte-level operators real input whose decoded form is known from the tables.
Every 256 events and their copies become one file, so no file grows with the data.
"""

from __future__ import annotations

import bz2
import gzip
import io
import struct
import tarfile
import zipfile
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.plans.inputs import DUCK_MIXED_PACKETS, event_fields, mixed_packets, table, tasks_for

EVENTS_PER_FILE = 256
#: Files that a task makes, on average.
FILES_PER_TASK = 32


def file_tasks(rows: DataFrame) -> int:
    """Tasks for the files of a stored table's rows, so that what one task holds does not grow with the table."""
    return tasks_for(rows, EVENTS_PER_FILE * FILES_PER_TASK)


def _hex(value, digits: int) -> Column:
    return F.lpad(F.hex(value.cast("bigint") if isinstance(value, Column) else F.lit(value).cast("bigint")), digits, "0")


def _swap(text: Column) -> Column:
    """Eight hex digits in the opposite byte order."""
    return F.concat(*[F.substring(text, i, 2) for i in (7, 5, 3, 1)])


def with_frame(rows: DataFrame, lower: Column) -> DataFrame:
    """Add ``frame``: the packet as hex text behind its link-layer header."""
    protocol, bytes_, v6 = F.col("protocol"), F.col("bytes"), F.col("ip_version") == "ipv6"
    flags = sum(
        (F.when(F.col(n), F.lit(bit)).otherwise(F.lit(0)) for n, bit in (("fin", 1), ("syn", 2), ("rst", 4), ("psh", 8), ("ack", 16), ("urg", 32))),
        F.lit(0),
    )
    ports = F.concat(_hex(F.col("id_orig_p"), 4), _hex(F.col("id_resp_p"), 4))
    tcp = F.concat(ports, _hex(F.col("seq_num"), 8), _hex(F.col("ack_num"), 8), F.lit("50"), _hex(flags, 2), F.lit("ffff00000000"))
    udp = F.concat(ports, _hex(bytes_ + 8, 4), F.lit("0000"))
    icmp6 = F.when(F.col("icmp_type") == "echo", F.lit("80")).otherwise(F.lit("81"))
    icmp = F.concat(F.when(v6, icmp6).otherwise(_hex(F.col("icmp_type_number"), 2)), F.lit("000000"))
    head = F.when(protocol == "tcp", tcp).when(protocol == "udp", udp).when(protocol == "icmp", icmp).otherwise(F.lit(""))
    number = (
        F.when(protocol == "tcp", F.lit("06")).when(protocol == "udp", F.lit("11"))
        .when(protocol == "gre", F.lit("2f")).when(v6, F.lit("3a")).otherwise(F.lit("01"))
    )
    # Steps in columns of their own are computed once each.
    rows = rows.withColumn("body", F.concat(head, F.repeat(F.lit("00"), bytes_.cast("int"))))
    body, size = F.col("body"), F.length("body") / 2
    octets = [F.concat(*[_hex(F.split(F.col(h), r"\.")[i].cast("int"), 2) for i in range(4)]) for h in ("id_orig_h", "id_resp_h")]
    v4_head = F.concat(F.lit("4500"), _hex(size + 20, 4), F.lit("0000000040"), number, F.lit("0000"), *octets)
    long = [F.concat(F.lit("fd00" + "0" * 20), F.lit("0000000"), F.split(F.col(h), r"\.")[3]) for h in ("id_orig_h", "id_resp_h")]
    v6_head = F.concat(F.lit("60000000"), _hex(size, 4), number, F.lit("40"), *long)
    return rows.withColumn("frame", F.concat(lower, F.when(v6, v6_head).otherwise(v4_head), body)).drop("body")


def capture_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capture per 256 events, varying byte order, precision, link type and damage."""
    rows = mixed_packets(spark, sf_dir).withColumn("file_no", F.expr(f"origin_id div {EVENTS_PER_FILE}"))
    # The frames are rendered where their file is put together, on all cores.
    rows = rows.repartition(file_tasks(rows), "file_no")
    big, nano = F.col("file_no") % 4 == 3, F.col("file_no") % 3 == 0
    link = F.when(F.col("file_no") % 29 == 7, 147).when(F.col("file_no") % 4 == 1, 12).when(F.col("file_no") % 4 == 2, 113).otherwise(1)
    kind = F.when(F.col("ip_version") == "ipv6", F.lit("86dd")).otherwise(F.lit("0800"))
    lower = F.when(link == 1, F.concat(F.lit("02" * 12), kind)).when(link == 113, F.concat(F.lit("00" * 14), kind)).otherwise(F.lit(""))
    rows = with_frame(rows, lower)
    frame, size = F.col("frame"), F.length("frame") / 2

    def word(value) -> Column:
        plain = _hex(value, 8)
        return F.when(big, plain).otherwise(_swap(plain))

    fraction = F.pmod("ts_us", F.lit(1_000_000)) * F.when(nano, 1000).otherwise(1)
    record = F.concat(word(F.expr("ts_us div 1000000")), word(fraction), word(size), word(size), frame)
    files = rows.groupBy("file_no").agg(F.array_sort(F.collect_list(F.struct("pkt_id", record.alias("record")))).alias("records"))
    magic = F.when(nano, F.lit("a1b23c4d")).otherwise(F.lit("a1b2c3d4"))
    magic = F.when(big, magic).otherwise(_swap(magic))
    header = F.concat(magic, F.when(big, F.lit("00020004")).otherwise(F.lit("02000400")), F.lit("0" * 16), word(F.lit(65535)), word(link))
    whole = F.concat(header, F.array_join(F.transform("records", lambda r: r["record"]), ""))
    files = files.withColumn("whole", F.unhex(whole))
    cut = F.substring("whole", F.lit(1), F.length("whole") - 5)
    files = files.withColumn("content", F.when(F.col("file_no") % 31 == 11, cut).otherwise(F.col("whole")))
    path = F.concat(F.lit("/captures/aa-0"), (F.col("file_no") % 3 + 1).cast("string"), F.lit("-"), F.lpad(F.col("file_no").cast("string"), 6, "0"), F.lit(".pcap"))
    return files.select("file_no", path.alias("path"), F.length("content").cast("bigint").alias("length"), "content")


# The same files seen from the tables: every packet with its file and place in it.
DUCK_CAPTURED = f"""(with m as (select *, origin_id // {EVENTS_PER_FILE} as file_no from ({DUCK_MIXED_PACKETS}) as p),
 placed as (select *, row_number() over (partition by file_no order by pkt_id) - 1 as place, count(*) over (partition by file_no) as in_file,
  case when file_no % 29 = 7 then 147 when file_no % 4 = 1 then 12 when file_no % 4 = 2 then 113 else 1 end as link_type,
  '/captures/aa-0' || (file_no % 3 + 1)::varchar || '-' || lpad(file_no::varchar, 6, '0') || '.pcap' as path from m)
 select *, link_type <> 147 and (file_no % 31 <> 11 or place < in_file - 1) as framed,
  link_type <> 147 and file_no % 31 = 11 and place = in_file - 1 as cut,
  bytes + case when ip_version = 'ipv6' then 40 else 20 end + case protocol when 'tcp' then 20 when 'udp' then 8 when 'icmp' then 4 else 0 end
   + case link_type when 1 then 14 when 113 then 16 else 0 end as frame_len from placed) as captured"""


def _wrap(kind: int, name: str, content: bytes) -> bytes:
    """Pack a capture in one of seven ways."""

    def tar(entries):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as archive:
            for entry, data in entries:
                info = tarfile.TarInfo(entry)
                info.size = len(data)
                archive.addfile(info, io.BytesIO(data))
        return out.getvalue()

    def zipped(entries):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            for entry, data in entries:
                archive.writestr(zipfile.ZipInfo(entry), data)
        return out.getvalue()

    notes = ("notes.txt", b"not a capture")
    return [
        lambda: content,
        lambda: gzip.compress(content, mtime=0),
        lambda: bz2.compress(content),
        lambda: tar([(name, content), notes]),
        lambda: zipped([("day.tgz", gzip.compress(tar([(name, content)]), mtime=0)), notes]),
        lambda: zipped([notes]),
        lambda: gzip.compress(content, mtime=0)[:-9],
    ][kind]()


def packed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captures, each packed in one of seven ways (the last two hold no capture)."""

    def run(batches):
        for batch in batches:
            for number, path, content in zip(*(batch.column(c) for c in ("file_no", "path", "content"))):
                packed = _wrap(number.as_py() % 7, path.as_py().rsplit("/", 1)[1], content.as_py())
                columns = [pa.array([path.as_py()], pa.string()), pa.array([len(packed)], pa.int64()), pa.array([packed], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "length", "content"])

    return capture_files(spark, sf_dir).mapInArrow(run, "path string, length long, content binary")


# Leaves of the packed files by packing: member, depth, chain and type.
DUCK_LEAVES = f"""(with f as (select distinct file_no, path, substr(path, 11) as name from {DUCK_CAPTURED})
 select path, file_no, '' as member, 0 as depth, '' as chain, 'pcap' as file_type, null::varchar as error from f where file_no % 7 = 0
 union all select path, file_no, '', 1, 'gzip', 'pcap', null from f where file_no % 7 = 1
 union all select path, file_no, '', 1, 'bzip2', 'pcap', null from f where file_no % 7 = 2
 union all select path, file_no, name, 1, 'tar', 'pcap', null from f where file_no % 7 = 3
 union all select path, file_no, 'notes.txt', 1, 'tar', 'unsupported', null from f where file_no % 7 = 3
 union all select path, file_no, 'day.tgz/' || name, 3, 'zip,gzip,tar', 'pcap', null from f where file_no % 7 = 4
 union all select path, file_no, 'notes.txt', 1, 'zip', 'unsupported', null from f where file_no % 7 in (4, 5)
 union all select path, file_no, '', 0, '', 'gzip', 'ValueError: truncated gzip stream' from f where file_no % 7 = 6) as leaves"""


# --- event logs -------------------------------------------------------------------------


class _LogWriter:
    """Writes events as log chunks: one template for the system part, event data spelled out."""

    # Element, attribute or None, and field name, in document order.
    SYSTEM = (
        ("Provider", "Name", "SYSTEM_PROVIDER_NAME"), ("Provider", "Guid", "SYSTEM_PROVIDER_GUID"),
        ("EventID", "Qualifiers", "SYSTEM_EVENTID_QUALIFIERS"), ("EventID", None, "SYSTEM_EVENTID"),
        ("Version", None, "SYSTEM_VERSION"), ("Level", None, "SYSTEM_LEVEL"), ("Task", None, "SYSTEM_TASK"),
        ("Opcode", None, "SYSTEM_OPCODE"), ("Keywords", None, "SYSTEM_KEYWORDS"),
        ("TimeCreated", "SystemTime", "SYSTEM_TIMECREATED_SYSTEMTIME"), ("EventRecordID", None, "SYSTEM_EVENTRECORDID"),
        ("Correlation", "ActivityID", "SYSTEM_CORRELATION_ACTIVITYID"),
        ("Correlation", "RelatedActivityID", "SYSTEM_CORRELATION_RELATEDACTIVITYID"),
        ("Execution", "ProcessID", "SYSTEM_EXECUTION_PROCESSID"), ("Execution", "ThreadID", "SYSTEM_EXECUTION_THREADID"),
        ("Channel", None, "SYSTEM_CHANNEL"), ("Computer", None, "SYSTEM_COMPUTER"), ("Security", "UserID", "SYSTEM_SECURITY_USERID"),
    )

    def __init__(self):
        self.out, self.template, self.names = bytearray(512), None, {}

    def name(self, text: str) -> None:
        """A name reference with the name itself right behind it."""
        if text not in self.names:
            self.names[text] = struct.pack("<IHH", 0, 0, len(text)) + text.encode("utf-16-le") + b"\0\0"
        self.out += struct.pack("<I", len(self.out) + 4) + self.names[text]

    def open(self, tag: str, attributes: bool = False) -> None:
        self.out += struct.pack("<BHI", 0x41 if attributes else 0x01, 0xFFFF, 0)
        self.name(tag)
        if attributes:
            self.out += struct.pack("<I", 0)

    def text(self, value: str) -> None:
        self.out += struct.pack("<BBH", 0x05, 0x01, len(value)) + value.encode("utf-16-le")

    def system_template(self) -> None:
        self.open("Event")
        self.out += b"\x02"
        self.open("System")
        self.out += b"\x02"
        tags = list(dict.fromkeys(tag for tag, _, _ in self.SYSTEM))
        for tag in tags:
            parts = [(i, attribute) for i, (t, attribute, _) in enumerate(self.SYSTEM) if t == tag]
            self.open(tag, attributes=any(a for _, a in parts))
            for i, attribute in parts:
                if attribute:
                    self.out += b"\x06"
                    self.name(attribute)
                    self.out += struct.pack("<BHB", 0x0E, i, 0x01)
            self.out += b"\x02"
            for i, attribute in parts:
                if not attribute:
                    self.out += struct.pack("<BHB", 0x0E, i, 0x01)
            self.out += b"\x04"
        self.out += b"\x04" + struct.pack("<BHB", 0x0D, len(self.SYSTEM), 0x21) + b"\x04\x00"

    @staticmethod
    def value(field: str, text: str | None) -> tuple[int, bytes]:
        """Type and bytes of a substitution; numbers, times and masks in their own types."""
        if text is None:
            return 0x00, b""
        if field in ("SYSTEM_EVENTID", "SYSTEM_TASK") and text.isdigit():
            return 0x06, struct.pack("<H", int(text))
        if field == "SYSTEM_EVENTRECORDID":
            return 0x0A, struct.pack("<Q", int(text))
        if field == "SYSTEM_KEYWORDS":
            return 0x15, struct.pack("<Q", int(text, 16))
        if field == "SYSTEM_TIMECREATED_SYSTEMTIME" and text[0].isdigit():
            since = datetime.fromisoformat(text) - datetime(1601, 1, 1)
            return 0x11, struct.pack("<Q", (since // timedelta(microseconds=1)) * 10)
        return 0x01, text.encode("utf-16-le")

    def record(self, number: int, fields: dict[str, str]) -> None:
        begin = len(self.out)
        self.out += struct.pack("<IIQQ", 0x2A2A, 0, number, 133_500_000_000_000_000) + b"\x0f\x01\x01\x00"
        definition = self.template or len(self.out) + 10
        self.out += struct.pack("<BBII", 0x0C, 1, 1, definition)
        if self.template is None:
            self.template = definition
            at = len(self.out)
            self.out += struct.pack("<I16sI", 0, bytes(16), 0) + b"\x0f\x01\x01\x00"
            self.system_template()
            struct.pack_into("<I", self.out, at + 20, len(self.out) - at - 24)
        values = [self.value(f, fields.get(f)) for _, _, f in self.SYSTEM]
        # The nested part holds positions, so it is written in place and its size set afterwards.
        self.out += struct.pack("<I", len(values) + 1)
        sizes = len(self.out)
        self.out += b"".join(struct.pack("<HBB", len(raw), kind, 0) for kind, raw in values) + struct.pack("<HBB", 0, 0x21, 0)
        self.out += b"".join(raw for _, raw in values)
        nested = len(self.out)
        self.out += b"\x0f\x01\x01\x00"
        self.open("EventData")
        self.out += b"\x02"
        for field, value in fields.items():
            if field.startswith("EVENTDATA_DATA_"):
                self.open("Data", attributes=True)
                self.out += b"\x06"
                self.name("Name")
                self.text(field.removeprefix("EVENTDATA_DATA_").title())
                self.out += b"\x02"
                self.text(value + "\n")
                self.out += b"\x04"
        self.out += b"\x04\x00"
        struct.pack_into("<H", self.out, sizes + 4 * len(values), len(self.out) - nested)
        self.out += b"\0" * (-(len(self.out) - begin + 4) % 8)
        size = len(self.out) - begin + 4
        self.out += struct.pack("<I", size)
        struct.pack_into("<I", self.out, begin + 4, size)

    def chunk(self) -> bytes:
        struct.pack_into("<8s", self.out, 0, b"ElfChnk\0")
        struct.pack_into("<II", self.out, 40, 128, 0)
        struct.pack_into("<I", self.out, 48, len(self.out))
        return bytes(self.out).ljust(65536, b"\0")


def log_file(events: list[tuple[int, dict[str, str]]]) -> bytes:
    """A whole log file; a chunk takes as many events as surely fit."""
    chunks, writer = [], _LogWriter()
    for number, fields in events:
        if len(writer.out) > 65536 - 8192:
            chunks.append(writer.chunk())
            writer = _LogWriter()
        writer.record(number, fields)
    chunks.append(writer.chunk())
    header = struct.pack("<8sQQQIHHHH", b"ElfFile\0", 0, len(chunks) - 1, len(events), 128, 1, 3, 4096, len(chunks))
    return header.ljust(4096, b"\0") + b"".join(chunks)


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log file per 256 events."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id")
        content = log_file([(int(n), dict(f)) for n, f in zip(pdf["row_id"], pdf["fields"])])
        return pd.DataFrame({"source_file": [f"/logs/{pdf['file_no'].iloc[0]:06}.evtx"], "member": [""], "content": [content]})

    rows = event_fields(spark, sf_dir).withColumn("file_no", F.expr(f"row_id div {EVENTS_PER_FILE}"))
    rows = rows.withColumn("fields", F.transform_values("fields", lambda _, v: v["value"]))
    rows = rows.repartition(file_tasks(table(spark, sf_dir, "events")), "file_no")
    return rows.groupBy("file_no").applyInPandas(run, "source_file string, member string, content binary")
