"""Archives: what is read back, dictionaries, odd rows, damage."""

import hashlib
import struct

import pytest

zstandard = pytest.importorskip("zstandard")

from chartlift.llm import warc  # noqa: E402

SCHEMA = "page_id long, url string, html string, digest string, size int"


def page(n):
    return f"<html><head><title>Page {n}</title></head><body><p>" + " ".join(f"word{(n * k) % 97}" for k in range(200)) + "</p></body></html>"


def brute(rows):
    """The rows that the contract asks for."""
    firsts = {}
    for number, html in rows:
        if len((html or "").encode()) >= 100 and number is not None:
            firsts[html] = min(number, firsts.get(html, number))
    out = []
    for number, html in rows:
        body = (html or "").encode()
        first = firsts.get(html) if len(body) >= 100 else None
        again = first is not None and number != first
        out.append((number, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def odd_rows():
    long = "ä\r\n\r\n%" * 30
    rows = [(n, page(n % 40)) for n in range(120)]
    rows += [(200, None), (201, ""), (202, ""), (203, long), (199, long), (None, long), (None, "x" * 100), (None, "x" * 100)]
    rows += [(300, "y" * 99), (301, "y" * 99), (302, "z" * 100), (303, "z" * 100), (304, "w" * 3_000_000), (305, "WARC/1.1\r\n" + page(3)), (7, page(7))]
    return rows


@pytest.mark.parametrize("archive_bytes", [2_000, 20_000, warc.ARCHIVE_BYTES])
def test_what_is_read_back(spark, tmp_path, archive_bytes):
    rows = odd_rows()
    urls = ["http://a.b/c?d=e f\r\nX: y", None, "", "http://ü.example/#t"]
    pages = spark.createDataFrame([(n, urls[i % 4], h, "clash", i) for i, (n, h) in enumerate(rows)], SCHEMA).repartition(3)
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path, archive_bytes=archive_bytes)
    found = warc.read_archives(spark, path).collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == brute(rows)
    payloads = {(n, h) for n, h in rows}
    for r in found:
        assert "\n" not in r.url and r.url
        if r.record_type == "response":
            assert (r.page_id, bytes(r.payload).decode() or None) in payloads or (r.page_id, bytes(r.payload).decode()) in payloads
        else:
            assert r.payload is None
    folders = [f for f in (tmp_path / "archives").iterdir() if f.is_dir()]
    assert len(folders) >= (30 if archive_bytes == 2_000 else 1)


def test_layout_of_an_archive(spark, tmp_path):
    """The dictionary leads, every record is a frame of its own, and other readers of Zstandard can follow."""
    path = str(tmp_path / "archives")
    rows = [(n, None, page(n)) for n in range(300)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    (file,) = (tmp_path / "archives").glob("archive=*/part-*")
    content = file.read_bytes()
    magic, size = struct.unpack_from("<II", content)
    assert magic == 0x184D2A5D
    trained = zstandard.ZstdDecompressor().decompress(content[8 : 8 + size])
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained))
    whole = b"".join(iter(lambda reader=press.stream_reader(content, read_across_frames=True): reader.read(1 << 20), b""))
    records = list(warc.archive_records(content))
    assert whole == b"".join(records) and len(records) == 301 and records[0].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    alone = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in records)
    assert len(content) < 0.8 * alone  # dictionary included
    assert not list((tmp_path / "archives").glob("**/*.crc.tmp"))


def test_damage_is_seen():
    body = page(1).encode()
    record = warc.page_record(1, None, hashlib.sha256(body).hexdigest(), len(body), body, None)
    assert warc.parse_record(record)["page_id"] == 1
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(record.replace(b"Page 1", b"Page 2"))
    with pytest.raises(ValueError, match="no Zstandard frame"):
        list(warc.archive_records(b"\x00" * 16))


def test_empty_table(spark, tmp_path):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA), str(tmp_path / "none")).count() == 0
