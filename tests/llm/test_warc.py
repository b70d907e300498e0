"""WARC bundles: exact round trips, the seek table, and which records revisit which."""

import base64
import hashlib
import io
from collections import defaultdict

import pyarrow as pa
import pytest
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from formlake.llm import warc
from formlake.llm.warc import archived, fetch, read_archive, read_seek_table, write_archive
from tests.llm.helpers import prose, rng


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("row", "digest", "frame", "refers_row", "payload"):
        df = df.withColumn(name, F.lit(7))
    return df


def cases():
    r = rng(17)
    rows = [(i, f"http://example.com/{i}?q=a#b", f"<html>{prose(r, r.randrange(0, 80))}</html>") for i in range(120)]
    rows += [(200 + i, "http://copy.example/x", "<p>copied page</p>") for i in range(60)]
    rows += [(300, None, None), (301, "http://e.example/", ""), (None, "http://n.example/", "no id"), (None, "http://n.example/", "no id"), (None, None, "<p>copied page</p>")]
    rows += [(400, "http://r.example/", "repeated row")] * 5
    rows += [(500, "http://ü.example/a b\r\nX: 1", "WARC/1.1\r\n\r\n日本語 🙂\r\n\r\n\x00"), (501, "http://long.example/", prose(r, 30000)), (502, "u", "\r\n\r\n")]
    return rows


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    """Sorted rows; of rows sharing the largest id and the payload one is the response."""
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = []
    for html, ids in groups.items():
        size, ids = len(html.encode()), sorted(ids, key=lambda i: (i is not None, i or 0))
        for k, page in enumerate(ids):
            response = k == len(ids) - 1 or size < min_bytes
            out.append((page, size, digest(html), "response" if response else "revisit", None if response else ids[-1]))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("min_bytes", [0, 15])
def test_types_and_digests(spark, min_bytes):
    rows = cases()
    assert result(archived(pages(spark, rows).repartition(4), min_bytes)) == expected(rows, min_bytes)


def test_revisits_without_a_broadcast_and_a_hot_payload(spark):
    rows = cases()
    spark.conf.set("formlake.broadcast.maxRows", "0")
    spark.conf.set("formlake.skew.rowsPerTask", "7")
    try:
        assert result(archived(pages(spark, rows))) == expected(rows)
    finally:
        spark.conf.unset("formlake.broadcast.maxRows")
        spark.conf.unset("formlake.skew.rowsPerTask")


def test_payloads_come_back_exactly(spark):
    rows = cases()
    uri, index = write_archive(pages(spark, rows), frame_bytes=2000, bundle_bytes=3000)
    assert index.select("bundle").distinct().count() > 3 and index.agg(F.max("frame")).first()[0] > 0
    found = read_archive(uri, index)
    payloads = {bytes(r["payload"]).decode() for r in found.filter("record_type = 'response'").collect()}
    assert payloads == {h or "" for _, _, h in rows}
    assert found.count() == len(rows) == index.count() == index.select("record_id").distinct().count()
    assert {r["url"] for r in found.filter("page_id < 200").collect()} == {u for i, u, _ in rows if i is not None and i < 200}


def test_bundles_are_plain_zstandard_with_a_seek_table(spark):
    uri, index = write_archive(pages(spark, cases()), frame_bytes=2000, bundle_bytes=30000)
    system, root = fs.FileSystem.from_uri(uri)
    by_bundle = defaultdict(list)
    for r in index.collect():
        by_bundle[r["bundle"]].append(r)
    for bundle, records in by_bundle.items():
        data = system.open_input_file(f"{root}/{bundle}").read()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        table = read_seek_table(pa.BufferReader(data))
        assert sum(plain for _, _, plain in table) == len(whole)
        assert int.from_bytes(data[-4:], "little") == 0x8F92EAB1 and int.from_bytes(data[-9:-5], "little") == len(table)
        starts = [sum(p for _, _, p in table[:k]) for k in range(len(table))]
        for r in records:
            record = whole[starts[r["frame"]] + r["at"] :][: r["length"]]
            assert record.startswith(b"WARC/1.1\r\n") and f"<{r['record_id']}>".encode() in record and record.endswith(b"\r\n\r\n")


def test_fetch_reads_single_records(spark):
    rows = cases()
    uri, index = write_archive(pages(spark, rows), frame_bytes=4000)
    some = index.orderBy("record_id").limit(9)
    got = fetch(uri, index, some)
    assert sorted(r["record_id"] for r in got.collect()) == sorted(r["record_id"] for r in some.collect())
    assert fetch(uri, index, spark.createDataFrame([("urn:x-page:9:123456",)], "record_id string")).collect() == []


def test_unlisted_bundles_do_not_count(spark):
    rows = cases()
    uri, index = write_archive(pages(spark, rows))
    stray = warc.BundleWriter(uri)  # a lost attempt's bundle
    stray.add("urn:x-page:1:1", warc.make_record("urn:x-page:1:1", None, b"lost", None))
    stray.close()
    assert result(read_archive(uri, index)) == expected(rows)


def test_damaged_payload_is_noticed():
    record = warc.make_record("urn:x-page:1:0", "u", b"payload", None)
    (headers, block), = warc.parse_records(record)
    assert warc.record_row(headers, block)[1:] == (1, "u", "response", None, b"payload", 7, digest("payload"))
    with pytest.raises(ValueError, match="digest"):
        warc.record_row(headers, block.replace(b"payload", b"damaged"))


def test_empty_table(spark):
    assert archived(pages(spark, [])).collect() == []
