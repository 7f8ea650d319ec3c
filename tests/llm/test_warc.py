"""Web archives: records read back, the files' format by a plain reader, odd rows, damage."""

import glob
import hashlib
import random
import struct

import pytest
import zstandard
from pyspark.errors import PythonException

from strataflow.llm import warc

SHAPE = "page_id bigint, url string, html string"
BODY = "<html><body>" + "the same page again " * 20 + "</body></html>"
PAGES = [
    (5, "http://a/5", BODY), (3, "http://a/3", BODY), (9, "http://b/9?x=a%20b", BODY), (None, "http://c", BODY), (1, None, None), (2, "u\r\nX: y", ""),
    (4, "http://s/4", "short"), (6, "http://s/6", "short"), (7, "http://é/7", "ünï ☃ \r\n\r\n WARC/1.1 " * 9), (8, "v", "x" * 99), (10, "v", "x" * 99),
    (11, "v", "y" * 100), (12, "v", "y" * 100), (3, "http://a/3", BODY), (None, None, "no id, no twin " * 10), (None, None, "no id, a twin " * 10), (None, "w", "no id, a twin " * 10),
]


def expected(pages):
    rows = []
    for key, url, html in pages:
        raw = (html or "").encode()
        twins = [k for k, _, h in pages if (h or "").encode() == raw and k is not None]
        first = min(twins, default=None)
        again = len(raw) >= 100 and first is not None and (key is None or key > first)
        rows.append((key, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(rows, key=repr)


def read(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("small", [200_000, 0])
def test_read_back(spark, small):
    pages = spark.createDataFrame(PAGES, SHAPE).selectExpr("*", "1 as payload", "'x' as digest", "2 as n", "3 as first").repartition(3)
    folder = warc.write_archive(pages, small=small)
    back = warc.read_archive(spark, folder)
    assert read(back) == expected(PAGES)
    given = {(k, u and u.replace("\r\n", "%0D%0A"), h or "") for k, u, h in PAGES}
    for row in back.collect():
        assert row.record_type == "revisit" or (row.page_id, row.url, bytes(row.payload).decode()) in given
        assert (row.payload is None) == (row.record_type == "revisit")
    assert {r.url for r in back.collect() if r.page_id == 2} == {"u%0D%0AX: y"}


def test_files_by_a_plain_reader(spark):
    rng = random.Random(2)
    rows = [(n, f"http://host/{n}", f"<p>page {n}</p>" + " ".join(str(rng.randrange(300)) for _ in range(200))) for n in range(300)]
    folder = warc.write_archive(spark.createDataFrame(rows, SHAPE).repartition(2))
    files, found = glob.glob(f"{folder}/records/part-*"), {}
    assert len(files) == 2
    for name in files:
        raw = open(name, "rb").read()
        kind, size = struct.unpack("<II", raw[:8])
        assert kind == 0x184D2A5D
        dictionary = zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size])
        assert dictionary[:4] == struct.pack("<I", 0xEC30A437)
        coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        # One decoder over the whole file: all other frames in a row, those to pass over among them.
        whole = coder.stream_reader(raw[8 + size :], read_across_frames=True).read()
        for record in whole.split(b"WARC/1.1\r\n")[1:]:
            head, _, block = record.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n"))
            assert len(block) == int(fields[b"Content-Length"]) + 4 and block.endswith(b"\r\n\r\n")
            found[int(fields[b"WARC-Record-ID"][10:-1])] = block[:-4].split(b"\r\n\r\n", 1)[1].decode()
    assert found == {key: html for key, _, html in rows}
    assert sum(len(open(f, "rb").read()) for f in files) < sum(len(h) for *_, h in rows)


def test_splits_long_pages_and_keys(spark):
    rows = [(f"key {n}>\r\n%", "u", chr(97 + n % 26) * (1 + n * 700)) for n in range(120)] + [("long", "u", "long page \x00 " * 400_000)]
    folder = warc.write_archive(spark.createDataFrame(rows, "page_id string, url string, html string").coalesce(1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        back = warc.read_archive(spark, folder)
        assert back.rdd.getNumPartitions() > 3
        assert {r.page_id: bytes(r.payload).decode() for r in back.collect()} == {k: h for k, _, h in rows}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_mark_is_kept_out_of_frames():
    raw = random.Random(1).randbytes(300)
    plain = warc.compressed(raw, {}, None, b"no such mark")
    header = plain[:6]
    for mark in (plain[-4:], header):  # the checksum is alike at all levels
        with pytest.raises(ValueError):
            warc.compressed(raw, {}, None, mark)
    text = b"abc " * 500 + raw + b"abd " * 800
    frames = {zstandard.ZstdCompressor(level=k, write_checksum=True).compress(text) for k in range(3, 20)}
    assert len(frames) > 1
    level_3 = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(text)
    part = next(level_3[k : k + 8] for k in range(len(level_3) - 8) if not all(level_3[k : k + 8] in f for f in frames))
    assert part not in warc.compressed(text, {}, None, part)
    with pytest.raises(ValueError):
        warc.compressed(b"x", {}, None, b"")  # every frame holds the empty mark


def test_empty_and_few_pages(spark):
    assert warc.read_archive(spark, warc.write_archive(spark.createDataFrame([], SHAPE))).count() == 0
    rows = [(1, "u", None)]
    assert read(warc.read_archive(spark, warc.write_archive(spark.createDataFrame(rows, SHAPE)))) == expected(rows)


def test_damage_is_an_error(spark):
    good = warc.record("1", "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, warc.CAPTURED)
    assert warc.parsed(good)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parsed(good.replace(b"payload\r\n", b"paylaod\r\n"))
    folder = warc.write_archive(spark.createDataFrame(PAGES[:5], SHAPE).coalesce(1))
    [name] = glob.glob(f"{folder}/records/part-*")
    raw = bytearray(open(name, "rb").read())
    raw[-60] ^= 255
    open(name, "wb").write(raw)
    [check] = glob.glob(f"{folder}/records/.part-*.crc")
    open(check, "wb").close()
    with pytest.raises((PythonException, Exception)):
        warc.read_archive(spark, folder).collect()
