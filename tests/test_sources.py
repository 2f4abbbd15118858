"""Byte fixtures: captures, containers and event logs written here with struct."""

import bz2
import gzip
import io
import struct
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from flowloom.operators import quality
from flowloom.plans.captures import log_file
from flowloom.sources import capture_scan
from flowloom.sources.capture_scan import capture_splits, scan_captures
from flowloom.sources import event_logs
from flowloom.sources.event_logs import flatten_event, read_evtx
from flowloom.sources.files import classify_magic, expand_containers, file_inventory, read_files
from flowloom.sources.pcap import LINK_TYPES, decode_packets, read_pcap


def ipv4(proto, body, fragment=0, total=None, options=b""):
    head = 20 + len(options)
    fixed = struct.pack(
        ">BBHHHBBH4s4s", 0x40 | head // 4, 0, head + len(body) if total is None else total, 0, fragment, 64, proto, 0,
        bytes([10, 0, 0, 1]), bytes([192, 168, 1, 200]),
    )
    return fixed + options + body


def ipv6(proto, body):
    src, dst = bytes.fromhex("20010db8" + "0" * 23 + "1"), bytes.fromhex("fe80" + "0" * 24 + "00ff")
    return struct.pack(">IHBB", 6 << 28, len(body), proto, 64) + src + dst + body


def tcp(flags=0x10, payload=b"xyz", seq=4_000_000_000, ackn=7):
    return struct.pack(">HHIIBBHHH", 40000, 443, seq, ackn, 0x50, flags, 1, 0, 0) + payload


def udp(payload=b"ping", length=None):
    return struct.pack(">HHHH", 53, 5353, 8 + len(payload) if length is None else length, 0) + payload


def ether(body, kind=0x0800):
    return bytes(12) + struct.pack(">H", kind) + body


def capture(frames, order="<", nano=False, link=1, sigfigs=0):
    magic = 0xA1B23C4D if nano else 0xA1B2C3D4
    out = struct.pack(order + "IHHiIII", magic, 2, 4, 0, sigfigs, 65535, link)
    for sec, frac, data in frames:
        out += struct.pack(order + "IIII", sec, frac, len(data), len(data) + 4) + data
    return out


def framed(spark, content, **kw):
    schema = "source_file string, member string, reference string, sensor string, content binary"
    return read_pcap(spark.createDataFrame([("f", "", "r", "s", bytearray(content))], schema), **kw)


def decoded(spark, data, link=1):
    return decode_packets(framed(spark, capture([(1, 0, data)], link=link))).collect()[0]


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("nano", [False, True])
def test_framing(spark, order, nano):
    rows = framed(spark, capture([(4_000_000_000, 5, b"ab"), (1, 999_999, b"")], order, nano)).orderBy("frame_no").collect()
    unit = 1 if nano else 1000
    assert [(r.frame_no, r.ts_ns, r.incl_len, r.orig_len, bytes(r.data)) for r in rows] == [
        (0, 4_000_000_000 * 10**9 + 5 * unit, 2, 6, b"ab"), (1, 10**9 + 999_999 * unit, 0, 4, b""),
    ]
    assert {r.precision for r in rows} == {"nano" if nano else "micro"}


def test_precision_from_header_field(spark):
    content = capture([(0, 7, b"")], sigfigs=1)
    assert framed(spark, content).first().ts_ns == 7
    assert framed(spark, content, precision="magic").first().ts_ns == 7000


@pytest.mark.parametrize(
    "content,reasons",
    [
        (b"", ["not a capture"]),
        (b"nothing here", ["not a capture"]),
        (capture([])[:20], ["truncated capture header"]),
        (capture([]), []),
        (capture([(1, 1, b"abc")], link=147), ["unsupported link type 147"]),
        (capture([(1, 1, b"abc"), (1, 2, b"abc")])[:-1], [None, "truncated record"]),
        (capture([(1, 1, b"abc")]) + b"\0" * 9, [None, "truncated record"]),
    ],
)
def test_damaged_captures(spark, content, reasons):
    assert [r.error for r in framed(spark, content).orderBy("frame_no").collect()] == reasons


def test_link_types(spark):
    packet = ipv4(17, udp())
    snap = b"\xaa\xaa\x03\0\0\0\x08\0"
    wrapped = {
        0: struct.pack("<I", 2) + packet,
        1: ether(packet),
        6: bytes(14) + snap + packet,
        9: b"\x00\x21" + packet,
        10: bytes(13) + snap + packet,
        12: packet,
        14: packet,
        50: b"\xff\x03\x00\x21" + packet,
        105: b"\x08\x01" + bytes(22) + snap + packet,
        113: bytes(14) + b"\x08\x00" + packet,
        127: b"\0\0\x0c\0" + bytes(8) + b"\x88\x01" + bytes(24) + snap + packet,
        143: b"\x00\x00" + bytes(4) + ether(packet),
    }
    assert set(wrapped) == set(LINK_TYPES)
    for link, data in wrapped.items():
        row = decoded(spark, data, link)
        assert (link, row.error, row.protocol, row.id_orig_p, row.bytes) == (link, None, "udp", 53, 4)


@pytest.mark.parametrize("bit,name", [(1, "fin"), (2, "syn"), (4, "rst"), (8, "psh"), (16, "ack"), (32, "urg")])
def test_tcp_flags(spark, bit, name):
    row = decoded(spark, ether(ipv4(6, tcp(bit))))
    assert {n for n in ("fin", "syn", "rst", "psh", "ack", "urg") if row[n]} == {name}
    assert (row.id_orig_h, row.id_resp_h, row.seq_num, row.ack_num, row.bytes) == ("10.0.0.1", "192.168.1.200", 4_000_000_000, 7, 3)


def test_packet_shapes(spark):
    row = decoded(spark, ether(ipv4(6, tcp(), options=bytes(8)) + b"padding"))
    assert (row.protocol, row.id_resp_p, row.bytes) == ("tcp", 443, 3)  # options skipped, padding not counted
    row = decoded(spark, ether(ipv4(6, tcp(), total=0)))
    assert row.bytes == 3  # segmentation left to the card
    row = decoded(spark, ether(struct.pack(">H", 5) + b"\x08\x00" + ipv4(17, udp(b"x" * 9)), 0x8100))
    assert (row.protocol, row.bytes) == ("udp", 9)  # VLAN tag
    row = decoded(spark, ether(ipv4(17, udp(b"x" * 30, length=18))))
    assert row.bytes == 10  # the UDP length counts
    row = decoded(spark, ether(ipv4(1, bytes([8, 0, 0, 0]) + b"12345")))
    assert (row.protocol, row.icmp_type_number, row.icmp_code_number, row.bytes) == ("icmp", 8, 0, 5)
    row = decoded(spark, ether(ipv4(47, b"12345")))
    assert (row.protocol, row.id_orig_p, row.bytes) == ("gre", None, 5)
    row = decoded(spark, ether(ipv4(6, tcp(), fragment=0x2000)))
    assert (row.protocol, row.id_orig_p, row.bytes) == ("tcp", None, 23)  # a fragment has no transport layer
    row = decoded(spark, ether(ipv6(6, tcp()), 0x86DD))
    assert (row.ip_version, row.id_orig_h, row.id_resp_h, row.bytes) == ("ipv6", "2001:db8:0:0:0:0:0:1", "fe80:0:0:0:0:0:0:ff", 3)
    row = decoded(spark, ether(ipv6(0, bytes([17, 0]) + bytes(6) + udp()), 0x86DD))
    assert (row.protocol, row.id_orig_p, row.bytes) == ("udp", 53, 4)  # behind an extension header
    assert decoded(spark, ether(b"\0\x01" + bytes(26), 0x0806)).error == "no IP layer"
    assert decoded(spark, b"").error == "no IP layer"
    assert decoded(spark, ether(ipv4(6, tcp())[:12])).error == "no IP layer"


def test_payload_is_dropped_unless_kept(spark):
    frames = framed(spark, capture([(1, 0, ether(ipv4(6, tcp())))]))
    assert "data" not in decode_packets(frames).columns
    assert len(decode_packets(frames, keep_payload=True).first().data) == 14 + 20 + 20 + 3


# --- containers -------------------------------------------------------------------------


def tar(entries):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as archive:
        for name, data in entries:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


def zipped(entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, data in entries:
            archive.writestr(name, data)
    return out.getvalue()


NAMES = r"([a-z]+-\d+)-\d+"
CAPTURE = capture([(1, 0, ether(ipv4(6, tcp())))])


def leaves(spark, content, **kw):
    files = spark.createDataFrame([("p", len(content), bytearray(content))], "path string, length long, content binary")
    return [
        (r.member, r.depth, list(r.chain), r.file_type, r.error) for r in expand_containers(files, **kw).orderBy("member").collect()
    ]


def test_nested_containers(spark):
    inner = gzip.compress(tar([("a.pcap", CAPTURE), ("b.bz2", bz2.compress(CAPTURE))]))
    assert leaves(spark, zipped([("d.tgz", inner), ("readme", b"text")])) == [
        ("d.tgz/a.pcap", 3, ["zip", "gzip", "tar"], "pcap", None),
        ("d.tgz/b.bz2", 4, ["zip", "gzip", "tar", "bzip2"], "pcap", None),
        ("readme", 1, ["zip"], "unsupported", None),
    ]


def test_depth_and_size_limits_reject_with_a_reason(spark):
    deep = CAPTURE
    for _ in range(4):
        deep = gzip.compress(deep)
    assert leaves(spark, deep, max_depth=3) == [("", 3, ["gzip"] * 3, "gzip", "nested too deep")]
    bomb = gzip.compress(bytes(100_000))
    assert leaves(spark, bomb, max_bytes=1000)[0][-1] == "ValueError: unpacks to too many bytes"
    assert leaves(spark, zipped([("x", bytes(5000))]), max_bytes=1000)[0][-1] == "ValueError: unpacks to too many bytes"


def test_all_streams_and_depths_are_unpacked(spark):
    two = gzip.compress(CAPTURE[:30]) + gzip.compress(CAPTURE[30:]) + bytes(512)
    files = spark.createDataFrame(
        [("g", 1, bytearray(two)), ("b", 1, bytearray(bz2.compress(CAPTURE[:30]) + bz2.compress(CAPTURE[30:])))],
        "path string, length long, content binary",
    )
    assert {(r.path, bytes(r.content)) for r in expand_containers(files).collect()} == {("g", CAPTURE), ("b", CAPTURE)}
    assert leaves(spark, gzip.compress(CAPTURE) + b"junk")[0][-1] is not None
    deep = CAPTURE
    for _ in range(12):
        deep = gzip.compress(deep)
    assert leaves(spark, deep) == [("", 12, ["gzip"] * 12, "pcap", None)]


def test_members_before_the_damage_are_kept(spark):
    cut = tar([("a.pcap", CAPTURE), ("b.pcap", CAPTURE)])
    found = leaves(spark, cut[: len(CAPTURE) + 1400])
    assert ("a.pcap", 1, ["tar"], "pcap", None) in found


def test_damaged_container_is_reported(spark):
    assert leaves(spark, gzip.compress(CAPTURE)[:-10])[0][-1] == "ValueError: truncated gzip stream"
    assert "BadZipFile" in leaves(spark, zipped([("x", b"1")])[:30])[0][-1]


def test_read_files_classify_and_inventory(spark, tmp_path):
    (tmp_path / "x.pcap").write_bytes(CAPTURE)
    (tmp_path / "y.zip").write_bytes(zipped([("notes", b"n"), ("z.gz", gzip.compress(CAPTURE))]))
    (tmp_path / "n.zip").write_bytes(zipped([("notes", b"n")]))
    (tmp_path / "empty.pcap").write_bytes(b"")
    files = read_files(spark, str(tmp_path))
    kinds = {r.path.rsplit("/", 1)[1]: r.kind for r in files.select("path", classify_magic().alias("kind")).collect()}
    assert kinds == {"x.pcap": "pcap", "y.zip": "zip", "n.zip": "zip"}
    found = {r.path.rsplit("/", 1)[1] for r in file_inventory(files, ["pcap"]).collect()}
    assert found == {"x.pcap", "y.zip"}


def test_tag_source(spark):
    files = spark.createDataFrame([("/d/xy-07-123456.pcap", 5), ("/d/other", 6)], "path string, length long")
    rows = quality.tag_source(files, "ref", NAMES).collect()
    assert [(r.reference, r.sensor, r.source_file) for r in rows] == [
        ("ref", "xy-07", "/d/xy-07-123456.pcap|5"), ("ref", "ref", "/d/other|6"),
    ]


# --- event logs -------------------------------------------------------------------------


def log_rows(spark, content):
    logs = spark.createDataFrame([("l", "", bytearray(content))], "source_file string, member string, content binary")
    return read_evtx(logs).orderBy("chunk_no", "record_id").collect()


EVENT = {
    "SYSTEM_PROVIDER_NAME": "Kern", "SYSTEM_EVENTID": "4624", "SYSTEM_KEYWORDS": "0x8020000000000000",
    "SYSTEM_TIMECREATED_SYSTEMTIME": "2024-02-29 23:59:59.123456", "EVENTDATA_DATA_NAMED": "value",
}


def test_binary_log(spark):
    row = log_rows(spark, log_file([(9, EVENT)]))[0]
    fields = {k: (v["value"], v["type"]) for k, v in row.fields.items()}
    assert row.record_id == 9 and row.error is None
    assert fields == {
        "SYSTEM_PROVIDER_NAME": ("Kern", "WStringTypeNode"),
        "SYSTEM_EVENTID": ("4624", "UnsignedWordTypeNode"),
        "SYSTEM_KEYWORDS": ("0x8020000000000000", "Hex64TypeNode"),
        "SYSTEM_TIMECREATED_SYSTEMTIME": ("2024-02-29 23:59:59.1234560", "FiletimeTypeNode"),
        "EVENTDATA_DATA_NAMED": ("value", "WStringTypeNode"),
    }


def test_log_of_several_chunks_and_a_damaged_record(spark):
    content = bytearray(log_file([(i, EVENT) for i in range(200)]))
    rows = log_rows(spark, content)
    assert [r.record_id for r in rows] == list(range(200)) and rows[-1].chunk_no > 0
    at = content.index(struct.pack("<I", 0x2A2A), 4096 + 512 + 8)  # the second record
    content[at + 24] = 0x77
    bad = log_rows(spark, content)
    assert [r.record_id for r in bad if r.error] == [1]
    assert len(bad) == 200


def test_no_record_of_a_cut_or_damaged_log_is_silent(spark):
    whole = log_file([(i, EVENT) for i in range(400)])
    chunks = (len(whole) - 4096) // 65536
    assert chunks >= 2
    cut = log_rows(spark, whole[: 4096 + 65536 * (chunks - 1) + 9000])
    good = [r.record_id for r in cut if not r.error]
    assert good == list(range(len(good))) and any(r.chunk_no == chunks - 1 for r in cut if not r.error)
    assert "truncated chunk" in {r.error for r in cut}
    damaged = bytearray(whole)
    damaged[4096:4104] = b"ElfXXXX\0"
    rows = log_rows(spark, damaged)
    assert [r.error for r in rows if r.error] == ["damaged chunk header"]
    assert sorted(r.record_id for r in rows if not r.error) == list(range(400))
    assert log_rows(spark, whole + bytes(65536)) == log_rows(spark, whole)  # unused chunks say nothing


def test_records_go_on_behind_a_damaged_header(spark):
    content = bytearray(log_file([(i, EVENT) for i in range(20)]))
    at = content.index(struct.pack("<I", 0x2A2A), 4096 + 512 + 8)
    content[at : at + 8] = b"\x00" * 8
    rows = log_rows(spark, content)
    assert [r.record_id for r in rows if not r.error] == [0, *range(2, 20)]
    assert [r.error for r in rows if r.error] == ["damaged record header"]


def test_values_of_every_type():
    never = struct.pack("<Q", 0x7FFFFFFFFFFFFFFF)
    assert event_logs._typed(0x11, never) == ("0x7fffffffffffffff", "FiletimeTypeNode")
    assert event_logs._typed(0x81, "a\0b\0".encode("utf-16-le")) == ("a,b", "WStringArrayTypeNode")
    assert event_logs._typed(0x82, b"a\0b\0") == ("a,b", "StringArrayTypeNode")
    assert event_logs._typed(0x83, struct.pack("<bb", -1, 2)) == ("-1,2", "SignedByteArrayTypeNode")
    assert event_logs._typed(0x8A, struct.pack("<QQ", 1, 1 << 63)) == (f"1,{1 << 63}", "UnsignedQWordArrayTypeNode")
    sid = bytes([1, 1, 0, 0, 0, 0, 0, 5]) + struct.pack("<I", 18)
    assert event_logs._typed(0x93, sid * 2) == ("S-1-5-18,S-1-5-18", "SIDArrayTypeNode")
    assert event_logs._typed(0x20, b"\x01\x02") == ("0102", "HandleTypeNode")
    assert event_logs._typed(0x7E, b"\x01") == ("01", "Type0x7e")
    assert event_logs._typed(0x06, b"\x01") == ("01", "UnsignedWordTypeNode")  # too short for its type


def test_rendered_xml(spark):
    xml = (
        "<Event xmlns='http://schemas.microsoft.com/win/2004/08/events/event'><System><Provider Name='P'/>"
        "<EventID Qualifiers='3'>77</EventID><TimeCreated SystemTime='2024-01-01T00:00:01.5Z'/></System>"
        "<EventData><Data Name='UserName'>bob\r\n</Data><Data>plain</Data></EventData></Event>"
    )
    rows = flatten_event(spark.createDataFrame([(1, xml), (2, "<Event>"), (3, None)], "n int, x string"), "x").orderBy("n").collect()
    assert {k: v["value"] for k, v in rows[0].fields.items()} == {
        "SYSTEM_PROVIDER_NAME": "P", "SYSTEM_EVENTID_QUALIFIERS": "3", "SYSTEM_EVENTID": "77",
        "SYSTEM_TIMECREATED_SYSTEMTIME": "2024-01-01 00:00:01.5", "EVENTDATA_DATA_USERNAME": "bob", "EVENTDATA_DATA": "plain",
    }
    assert rows[1].error.startswith("not well-formed") and rows[2].error == "no event text"


def test_split_bad(spark):
    df = spark.range(10).withColumn("error", F.when(F.col("id") % 3 == 0, "third"))
    good, bad = quality.split_bad(df)
    assert (good.count(), bad.count()) == (6, 4)


# --- captures read by byte range --------------------------------------------------------


def test_any_number_of_tags_and_extension_headers(spark):
    inner = ether(ipv4(6, tcp()))
    tagged = inner[:12] + b"\x81\x00\x00\x01" * 9 + inner[12:]
    extended = b"\x00\x01" + bytes(6)  # hop-by-hop header of eight bytes, then another of its kind
    chain = b"".join((b"\x00" if i < 11 else b"\x11") + extended[1:2].replace(b"\x01", b"\x00") + bytes(6) for i in range(12))
    body = chain + udp(b"xyz")
    v6 = struct.pack(">IHBB", 6 << 28, len(body), 0, 64) + bytes(15) + b"\x01" + bytes(15) + b"\x02" + body
    frames = capture([(1, 0, tagged), (2, 0, inner[:12] + b"\x86\xdd" + v6)])
    rows = spark.createDataFrame([("p", len(frames), bytearray(frames))], "path string, length long, content binary")
    got = decode_packets(read_pcap(quality.tag_source(expand_containers(rows), "lab", NAMES))).orderBy("frame_no").collect()
    assert [r.protocol for r in got] == ["tcp", "udp"] and got[1].bytes == 3


@pytest.fixture
def captures(tmp_path):
    folder = tmp_path / "captures"
    folder.mkdir()
    frames = [(i, i * 7, ether(ipv4(17, udp(b"x" * (i % 50))))) for i in range(900)]
    (folder / "ab-01-000001.pcap").write_bytes(capture(frames))
    (folder / "ab-02-000002.pcap").write_bytes(capture(frames[:40], ">", nano=True)[:-3])
    (folder / "ab-02-000003.pcap").write_bytes(capture(frames[:3], link=147))
    (folder / "notes.txt").write_bytes(b"not a capture, but long enough")
    return folder


def frame_rows(df):
    names = ["sensor", "frame_no", "ts_ns", "incl_len", "orig_len", "link_type", "precision", "data", "error"]
    split = F.element_at(F.split("source_file", "/"), -1)
    return sorted((tuple(str(v) for v in r) for r in df.select(split, *names).collect()))


@pytest.mark.parametrize("split_bytes", [1 << 30, 2000, 1])
def test_ranges_give_what_whole_files_give(spark, captures, split_bytes):
    whole = quality.tag_source(expand_containers(read_files(spark, str(captures))), "lab", NAMES)
    ranged = scan_captures(spark, str(captures), "lab", NAMES, split_bytes=split_bytes)
    assert frame_rows(ranged) == frame_rows(read_pcap(whole))


def test_large_captures_are_split(spark, captures):
    files = spark.read.format("binaryFile").load(str(captures / "ab-01-000001.pcap"))
    splits = capture_splits(files, split_bytes=10_000).orderBy("start").collect()
    assert len(splits) > 5 and splits[0].start == 24
    assert [s.start for s in splits[1:]] == [s.stop for s in splits[:-1]]
    assert max(s.stop - s.start for s in splits) < 10_000 + 200


def test_record_longer_than_a_block(spark, tmp_path, monkeypatch):
    (tmp_path / "x.pcap").write_bytes(capture([(1, 0, b"a" * 5000), (2, 0, b"b")]))
    monkeypatch.setattr(capture_scan, "_BLOCK", 64)
    split = capture_scan._whole_file(str(tmp_path / "x.pcap"), (tmp_path / "x.pcap").stat().st_size, "header")
    names = capture_scan._names(capture_scan._SPLIT_SCHEMA)
    assert [len(f[5]) for _, f in capture_scan._split_frames(dict(zip(names, split)))] == [5000, 1]


def nested_capture(order="<", cut=0):
    """Records whose payloads are captures themselves, so that guesses inside them are wrong, and records of no bytes."""
    inner = capture([(i, i, b"q" * (i % 9)) for i in range(300)], order)
    frames = [(i, i, inner if i % 3 == 1 else b"\0" * (i % 4) * 700) for i in range(24)]
    return capture(frames, order)[: -cut or None]


@pytest.mark.parametrize("order, cut, split_bytes", [("<", 0, 1500), (">", 5, 200), ("<", 4000, 7919)])
def test_wrong_guesses_are_mended(spark, tmp_path, order, cut, split_bytes):
    path = tmp_path / "ab-01-000001.pcap"
    path.write_bytes(nested_capture(order, cut))
    (tmp_path / "junk.pcap").write_bytes(b"no capture " * 2000)
    length = path.stat().st_size
    low = range(24 + split_bytes, length, split_bytes)
    with capture_scan._open(str(path)) as handle:
        borders = [at for at, header, _ in capture_scan._walk(handle, order, 24, length) if header]
        guesses = [capture_scan._synchronise(handle, order, at, min(at + split_bytes, length), 1000) for at in low]
    assert any(g not in borders for g in guesses if g)  # the test is about wrong ones
    whole = quality.tag_source(expand_containers(read_files(spark, str(tmp_path))), "lab", NAMES)
    ranged = scan_captures(spark, str(tmp_path), "lab", NAMES, split_bytes=split_bytes)
    assert frame_rows(ranged) == frame_rows(read_pcap(whole))


def test_a_range_reads_itself_and_one_header(captures, monkeypatch):
    path, most = captures / "ab-01-000001.pcap", []

    class Watched:
        def __init__(self, inner):
            self.inner = inner

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.inner.close()

        def size(self):
            return self.inner.size()

        def read_at(self, n, at):
            most.append(at + n)
            return self.inner.read_at(n, at)

    opened = capture_scan._open
    monkeypatch.setattr(capture_scan, "_open", lambda p: Watched(opened(p)))
    monkeypatch.setattr(capture_scan, "_CHAIN", 1)
    (found,) = capture_scan._range(str(path), path.stat().st_size, 2, 20_000, 30_000, "header")
    assert found[4] is not None and max(most) <= 30_000 + 15


def test_pcap_format(spark, captures):
    spark.dataSource.register(capture_scan.PcapDataSource)
    got = spark.read.format("pcap").option("reference", "lab").load(str(captures))
    good = got.filter("error is null")
    assert good.count() == 939 and {r.reference for r in good.select("reference").distinct().collect()} == {"lab"}
    assert sorted(r.error for r in got.filter("error is not null").collect()) == [
        "not a capture", "truncated record", "unsupported link type 147",
    ]
    assert decode_packets(got).filter("protocol = 'udp'").count() == 939
