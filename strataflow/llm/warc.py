"""Web archives of individually compressed records that share a dictionary, written and read by Spark.

An archive file is a run of Zstandard frames: a skippable frame with the dictionary (itself
compressed), then one frame for each WARC record. Records are told apart by one more kind of
skippable frame, empty but for a mark. Decoders pass over it, and it is plain ASCII, so it serves
Spark's text source as line separator: files are written with Spark's commit protocol to any
store, and large ones are read in splits.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.shared import column, saved, scratch_path, small_batches

#: Fixed values of the formats: magic numbers of the dictionary's frame and of a frame to pass over, and of a dictionary.
DICTIONARY_FRAME, MARK_FRAME, DICTIONARY = 0x184D2A5D, 0x184D2A50, 0xEC30A437
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads of fewer bytes are stored each time.
LEAST = 100
LEVEL = 3
#: The dictionary is built from about so many bytes of distinct records, each of at most so many bytes.
DICTIONARY_BYTES, SAMPLE_BYTES, SAMPLE_RECORD = 64 << 10, 4 << 20, 64 << 10
#: A table of repeated payloads of at most so many rows is broadcast; beyond, pages are joined with it by shuffle.
SMALL = 200_000
#: When the pages give no date of their own.
CAPTURED = "2000-01-01T00:00:00Z"


def record(key: str | None, url: str | None, payload: bytes, digest: str, refers: str | None, captured: str) -> bytes:
    """One WARC record; a revisit (``refers`` given) holds the HTTP header, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = f"urn:page:{quote(key, safe='')}" if key is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {digest}')}"
    fields = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", captured)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{quote(refers, safe='')}>"), ("WARC-Profile", REVISIT_PROFILE)]
    block = http + payload if refers is None else http
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def _page(name: str | None) -> str | None:
    return unquote(name[10:-1]) if name and name.startswith("<urn:page:") else None


def parsed(raw: bytes) -> dict:
    """The fields of a record; a stored payload is held against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(_fields(http)["Content-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind, "refers": _page(fields.get("WARC-Refers-To")),
        "payload": payload if kind == "response" else None, "payload_bytes": size, "payload_digest": digest,
    }


def built_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; too few for the builder: the samples themselves, which decoders take as raw content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def dictionary_frame(dictionary: bytes) -> bytes:
    content = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(content)) + content


def read_dictionary(frame: bytes) -> bytes:
    """The dictionary of a leading skippable frame, which may hold it compressed or plain."""
    content = frame[8 : 8 + struct.unpack("<I", frame[4:8])[0]]
    return zstandard.ZstdDecompressor().decompress(content) if content[:4] == zstandard.FRAME_HEADER else content


def _loaded(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    whole = dictionary[:4] == struct.pack("<I", DICTIONARY)
    kind = zstandard.DICT_TYPE_FULLDICT if whole else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(dictionary, dict_type=kind) if dictionary else None


def mark_frame(dictionary: bytes) -> bytes:
    """The frame between records: its mark follows from the dictionary, so no page can be written to hold it."""
    mark = hashlib.sha256(b"mark" + dictionary).hexdigest()[:32].encode()
    return struct.pack("<II", MARK_FRAME, len(mark)) + mark


def compressed(raw: bytes, coders: dict[int, zstandard.ZstdCompressor], loaded, mark: bytes) -> bytes:
    """A frame of its own, without the mark in it: at a chance match, of another level."""
    for level in range(LEVEL, 20):
        if level not in coders:
            coders[level] = zstandard.ZstdCompressor(level=level, dict_data=loaded, write_checksum=True)
        frame = coders[level].compress(raw)
        if mark not in frame:
            return frame
    raise ValueError("a record's frame holds the mark at every level")


def _rows(pages: DataFrame, key: str, url: str, body: str) -> DataFrame:
    payload = F.coalesce(column(pages, body).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(column(pages, key).alias("page_id"), column(pages, url).cast("string").alias("url"), payload.alias("payload"))
    return rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("n"))


def _repeated(rows: DataFrame) -> tuple[DataFrame, int]:
    """``digest, first`` of payloads that occur more than once, and the bytes of all distinct payloads."""
    seen = Observation()
    groups = rows.where(F.col("n") >= LEAST).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"), F.max("n").alias("n"))
    groups = groups.observe(seen, F.sum("n").alias("n"))
    repeated = saved(groups.where("copies > 1").select(F.col("digest").alias("repeated"), "first"), "repeated")
    return repeated, seen.get["n"] or 0


def _sample(rows: DataFrame, total: int, captured: str) -> list[bytes]:
    """Whole records of distinct payloads, drawn by a hash of the payload so that their bytes are about ``SAMPLE_BYTES`` in all."""
    space = 1 << 32
    drawn = rows.where(F.col("n").between(LEAST, SAMPLE_RECORD) & (F.pmod(F.xxhash64("payload"), F.lit(space)) < int(space * min(1.0, SAMPLE_BYTES / max(total, 1)))))
    one = drawn.groupBy("digest").agg(F.min(F.struct(F.col("page_id").cast("string").alias("page"), "url", "payload")).alias("of")).select("digest", "of.*")
    found = sorted(one.collect(), key=lambda r: r.digest)
    return [record(r.page, r.url, bytes(r.payload), r.digest, None, captured) for r in found]


def write_archive(
    pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", captured: str = CAPTURED, small: int = SMALL,
) -> str:
    """Write a record for every row of ``pages``; returns the archive's folder (``read_archive`` reads it).

    Of the rows whose payloads are equal and have at least ``LEAST`` bytes, the one with the
    smallest key is stored as response, the others as revisits that refer to it. Rows that tie on
    that key are each a response; so are rows whose group has no key at all. A row without key
    otherwise revisits the group's smallest one. NULL payloads are empty. Line breaks in a URL are
    percent-encoded, a NULL URL has no field. Payloads of any length are one record; other columns are not read. An empty table
    gives an archive without files.

    Digests alone are shuffled to find equal payloads; pages are, only where more than ``small``
    payloads repeat. The dictionary comes from a sample of bounded size (``SAMPLE_BYTES``), and each task writes one
    file: the dictionary's frame, then a frame for each of its rows.
    """
    spark = pages.sparkSession
    small_batches(spark)
    folder = scratch_path(spark, "archive")
    rows = _rows(pages, key, url, body)
    repeated, total = _repeated(rows)
    dictionary = built_dictionary(_sample(rows, total, captured))
    mark = mark_frame(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)  # DICTIONARY_BYTES at most
    few = repeated.limit(small + 1).count() <= small
    joined = rows.join(F.broadcast(repeated) if few else repeated, F.col("digest") == F.col("repeated"), "left")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    given = joined.select(
        F.col("page_id").cast("string").alias("page"), "url", "payload", "digest", F.when(again, F.col("first")).cast("string").alias("refers"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, coders, begun = _loaded(shared.value), {}, not shared.value
        for batch in batches:
            frames = [] if begun or not batch.num_rows else [dictionary_frame(shared.value)]
            begun = begun or bool(frames)
            for page, uri, payload, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                frames.append(compressed(record(page, uri, payload, digest, refers, captured), coders, loaded, mark))
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    # Text of a cast keeps its bytes as they are, and so does the text source.
    frames = given.mapInArrow(write, "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("lineSep", mark.decode()).text(f"{folder}/records")
    about = spark.createDataFrame([(mark.decode(), pages.schema[key].dataType.simpleString())], "mark string, key string")
    about.coalesce(1).write.parquet(f"{folder}/about")
    return folder


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest`` of every record.

    The payload of a revisit is NULL; its length and digest are those of the payload it stands for.
    Files are split between records, so memory holds one batch of records. A damaged frame or payload is an error.
    """
    small_batches(spark)
    about = spark.read.parquet(f"{folder}/about").first()
    frames = spark.read.schema("value string").option("lineSep", about.mark).text(f"{folder}/records")
    frames = frames.select(F.col("value").cast("binary").alias("frame"))
    leading = F.substring("frame", 1, 4) == F.lit(bytearray(struct.pack("<I", DICTIONARY_FRAME)))
    first = frames.where(leading).limit(1).collect()  # the same in every file
    shared = spark.sparkContext.broadcast(read_dictionary(bytes(first[0].frame)) if first else b"")
    shape = pa.schema([
        ("page", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers", pa.string()), ("payload", pa.binary()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = _loaded(shared.value)
        coder = zstandard.ZstdDecompressor(dict_data=loaded) if loaded else zstandard.ZstdDecompressor()
        for batch in batches:
            held, size = [], 0
            for frame in batch.column(0):
                held.append(parsed(coder.decompress(frame.as_py())))
                size += held[-1]["payload_bytes"]
                if size > 16 << 20:  # frames may be far shorter than what they hold
                    yield pa.RecordBatch.from_pylist(held, schema=shape)
                    held, size = [], 0
            yield pa.RecordBatch.from_pylist(held, schema=shape)

    found = frames.where(~leading).mapInArrow(
        read, "page string, url string, record_type string, refers string, payload binary, payload_bytes bigint, payload_digest string"
    )

    def back(name: str) -> Column:
        return F.col(name).cast(about.key)

    return found.select(
        back("page").alias("page_id"), "url", "record_type", back("refers").alias("refers_to"), "payload", "payload_bytes", "payload_digest",
    )


def oracle() -> str:
    return f"""
    WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    sized AS (SELECT page_id, octet_length(encode(body)) AS n, sha256(body) AS digest FROM bodies),
    grouped AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM sized),
    judged AS (SELECT *, n >= {LEAST} AND page_id > first_id AS again FROM grouped)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
        CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to
    FROM judged
    """
