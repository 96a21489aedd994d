"""Web archives of pages, each compressed with a dictionary of its own records (operator 11).

``write_archives`` turns every page into a WARC record. Of the pages with equal payloads of at least SMALLEST bytes, the
one with the smallest id is a response and the others are revisits, which hold only headers and the id they refer to.
A task collects records up to ARCHIVE_BYTES, trains a Zstandard dictionary on records spread evenly over these (at most
SAMPLE_BYTES of them), and writes one archive: a skippable frame with the dictionary, a frame with the warcinfo
record, then one frame for each record, so that a record can be read without those before it. Spark's own text writer
writes the frames and commits them, so a lost executor leaves no half archive; its line separator is a skippable frame with a
mark, which every Zstandard reader passes over. ``read_archives`` walks the frames and checks each payload's digest.

Null payloads are empty; a null id is none and never the one referred to; rows that share the smallest id of a payload
are all responses; a null or empty address becomes the record's own name. An archive of too few records to train on has
no dictionary. A payload larger than ARCHIVE_BYTES makes an archive of its own. An empty table gives no archive and an
empty result. Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlift.llm.common import pieces
from chartlift.operators.joins import attach
from chartlift.runtime import scratch_path

SMALLEST = 100  # bytes of a payload that a revisit may stand for
ARCHIVE_BYTES = 32_000_000  # of records before compression
SAMPLE_BYTES = 2_000_000
DICTIONARY_BYTES = 32_768
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"
_NAME = "urn:x-page:"
_DICTIONARY, _SKIPPABLE, _FRAME = 0x184D2A5D, 0x184D2A50, 0xFD2FB528
_SEPARATOR = struct.pack("<II", _SKIPPABLE, 16).decode() + "record separator"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _record(kind: str, name: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, digest: str, size: int, payload: bytes | None, refers_to: int | None) -> bytes:
    """A response, or without a payload a revisit; the HTTP headers of both tell the size of the full payload."""
    name = _NAME + ("" if page_id is None else str(page_id))
    headers = [("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else name), ("WARC-Payload-Digest", f"sha256:{digest}")]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    if payload is None:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("WARC-Refers-To", f"<{_NAME}{refers_to}>"))
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _record("revisit" if payload is None else "response", name, headers, block + (payload or b""))


def dictionary_of(records: list[bytes], sample_bytes: int = SAMPLE_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of records spread evenly over all; None if they are too few or too much alike to train on."""
    step = max(1, sum(map(len, records)) // sample_bytes)
    samples = [r[:131_072] for r in records[::step]]  # the trainer looks at no more of one sample
    total = sum(map(len, samples))
    if len(samples) < 8 or total < 8 * 1024:
        return None
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 8), samples, k=512, d=8)
    except zstandard.ZstdError:
        return None


def archive_frames(records: list[bytes], title: str) -> Iterator[bytes]:
    """The frames of one archive: its dictionary, the warcinfo record, the records."""
    trained = dictionary_of(records)
    if trained is not None:
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
        yield struct.pack("<II", _DICTIONARY, len(packed)) + packed
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    info = [("WARC-Filename", title), ("Content-Type", "application/warc-fields")]
    yield press.compress(_record("warcinfo", f"urn:x-archive:{title}", info, b"format: WARC File Format 1.1\r\n"))
    for record in records:
        yield press.compress(record)


def _frame_end(content: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, by its block headers."""
    kind = content[at + 4]
    single = kind >> 5 & 1
    at += 5 + (1 - single) + (0, 1, 2, 4)[kind & 3] + (single, 2, 4, 8)[kind >> 6]
    last = 0
    while not last:
        head = int.from_bytes(content[at : at + 3], "little")
        last = head & 1
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
    return at + (4 if kind & 4 else 0)


def archive_records(content: bytes) -> Iterator[bytes]:
    """The records of an archive, warcinfo included."""
    view, at, press = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic == _FRAME:
            end = _frame_end(view, at)
            yield press.decompressobj().decompress(view[at:end])
        elif magic & 0xFFFFFFF0 == _SKIPPABLE:
            end = at + 8 + size
            if magic == _DICTIONARY and at == 0:
                trained = bytes(view[at + 8 : end])
                if trained[:4] == struct.pack("<I", _FRAME):
                    trained = zstandard.ZstdDecompressor().decompressobj().decompress(trained)
                press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained))
        else:
            raise ValueError(f"no Zstandard frame at byte {at}")
        at = end


def _page_of(name: str | None) -> int | None:
    number = (name or "").strip("<>").removeprefix(_NAME)
    return int(number) if number else None


def parse_record(record: bytes, with_payload: bool = True) -> dict | None:
    """The row of a response or revisit, None for other records; a payload that differs from its digest raises."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    said = int(next(line.split(b":")[1] for line in http.split(b"\r\n") if line.startswith(b"Content-Length:")))
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]), "payload_bytes": len(payload) if kind == "response" else said, "payload_digest": digest,
        "record_type": kind, "refers_to": _page_of(fields.get("WARC-Refers-To")), "url": fields["WARC-Target-URI"],
        "payload": payload if with_payload and kind == "response" else None,
    }


def classify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, digest, size, refers_to (null for responses) and the payload (null for revisits)."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload")
    )
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    firsts = rows.where(F.col("size") >= SMALLEST).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    marked = attach(rows, firsts.where("copies > 1 AND first IS NOT NULL").select("digest", "first"), ["digest"], "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    marked = marked.withColumn("refers_to", refers)
    return marked.select("page_id", "url", "digest", "size", "refers_to", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"))


def _pack(archive_bytes: int):
    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        size = 0

        def rows(records, number):
            title = f"{task:06d}-{number:05d}"
            group, weight, place = [], 0, 0
            for frame in archive_frames(records, f"{title}.warc.zst"):
                group.append(frame)
                weight += len(frame)
                if weight > 4_000_000:
                    yield batch(title, place, group)
                    place, group, weight = place + len(group), [], 0
            if group:
                yield batch(title, place, group)

        def batch(title, place, group):
            columns = [pa.array([title] * len(group)), pa.array(range(place, place + len(group)), pa.int64()), pa.array(group, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["archive", "place", "frame"])

        for some in pieces(batches, "payload"):
            for row in some.to_pylist():
                record = page_record(**row)
                if held and size + len(record) > archive_bytes:
                    yield from rows(held, number)
                    held, size, number = [], 0, number + 1
                held.append(record)
                size += len(record)
        if held:
            yield from rows(held, number)

    return run


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Write the archives of all pages below ``path``, one in each folder ``archive=...``."""
    marked = classify(pages, id_col, url_col, html_col)
    frames = marked.mapInArrow(_pack(archive_bytes), "archive string, place long, frame binary").sortWithinPartitions("archive", "place")
    text = frames.select(F.col("frame").cast("string").alias("value"), "archive")
    text.write.partitionBy("archive").option("lineSep", _SEPARATOR).text(path)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The response and revisit records of all archives below ``path``."""
    # Archives are ARCHIVE_BYTES before compression, or one record; Spark puts whole files up to its split size into a task.
    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile")
    files = files.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)

    def run(batches):
        names = [part.split()[0] for part in _READ.split(", ")]
        kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[part.split()[1]] for part in _READ.split(", ")]

        def batch(rows):
            columns = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for some in batches:
            for content in some.column("content"):
                rows, size = [], 0
                for record in archive_records(content.as_py()):
                    row = parse_record(record, with_payload)
                    if row:
                        rows.append(row)
                        size += len(row["payload"] or b"") + 200
                    if size > 4_000_000:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return files.select("content").mapInArrow(run, _READ)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the archives and read them back: a row for each page, without the payloads."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, with_payload=False).drop("payload")
