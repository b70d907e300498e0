"""WARC archives as seekable Zstandard bundles.

Writing. The archive folder is one that ``pyarrow.fs`` opens; by default a fresh one in the shared folder. Records with equal payloads of at least ``min_bytes`` bytes are one group: the row with
the largest page id is its response, the others are revisits that name it. Records are laid
one after another; about ``FRAME_BYTES`` of them form a frame, compressed on its own, and about
``BUNDLE_BYTES`` of frames form a bundle. A bundle ends with a seek table in the public seekable
format: a skippable frame with the compressed and decompressed size of every frame and a footer, so any
Zstandard reader still reads the whole bundle, and a frame can be read without those before it.

The index maps every record identifier to (bundle, frame, offset inside the frame, length). Tasks
write their bundles to the archive folder under names of their own attempt and return the index rows;
the index, written by Spark, lists the bundles that count. A lost or repeated task leaves at most a
bundle nobody lists.

Reading. ``read_archive`` deals the listed frames out to tasks, which take the places of frames from the
bundles' seek tables and parse whole records; ``fetch`` reads only the frames that hold given
identifiers. Payload digests are taken from the bytes read and compared with the header.

Finding the groups needs digests only: a count and a maximum per digest (partial aggregates), joined back to
the rows by a lookup that is broadcast behind a checked bound, or shuffled with hot digests salted.

Record layout (WARC/1.1): a response block is an HTTP response with the html in UTF-8 as payload; a revisit
block is its HTTP header only, whose Content-Length is the full payload's. Record identifiers are
``urn:x-page:<page id>:<row number>``, so a revisit names its response's page.

Defined results: a null html is empty; of rows that share the largest page id and the payload one
is the response; a null page id is smaller than any other and written as ``null``; a null url leaves
out the target; characters in a url that a header line cannot hold (controls, spaces, beyond ASCII) are
percent-encoded; repeated rows are records each; an empty table gives an empty archive; extra columns
play no part.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.common import shared_folder, staged
from formlake.llm.textkit import small_batches
from formlake.operators.joins import lookup_join, lookup_scope

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
READ_FRAMES = 16  # frames one reading row covers
# fixed values of the seekable format
_SKIPPABLE_MAGIC = 0x184D2A5E
_SEEKABLE_MAGIC = 0x8F92EAB1
_FOOTER, _FOOTER_BYTES = "<IBI", 9  # frames, descriptor, magic
_ENTRY, _ENTRY_BYTES = "<II", 8  # compressed, decompressed size

INDEX_FIELDS = {"record_id": "string", "bundle": "string", "frame": "int", "at": "long", "length": "long"}
RECORD_FIELDS = {
    "record_id": "string", "page_id": "long", "url": "string", "record_type": "string", "refers_to": "long",
    "payload": "binary", "payload_bytes": "long", "payload_digest": "string",
}


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


def _rows(rows: list[tuple], fields: dict[str, str]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(columns, fields.values())], names=list(fields))


def payload_digest(payload: bytes) -> str:
    """Base32 SHA-1 as WARC headers write it, without its label."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(page_id: int | None, row: int) -> str:
    return f"urn:x-page:{'null' if page_id is None else page_id}:{row}"


def page_of(identifier: str) -> int | None:
    page = identifier.split(":")[2]
    return None if page == "null" else int(page)


def make_record(identifier: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record; ``refers_to`` makes it a revisit, whose payload is left out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode("ascii")
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{identifier}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE, errors='surrogatepass')}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "".join(chr(c) for c in range(0x21, 0x7F))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record in a frame's bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("ascii").split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no record at byte {at} of a frame: {version[:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers["Content-Length"])
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record {headers['WARC-Record-ID']} is longer or shorter than it says")
        at += 4


def record_row(headers: dict[str, str], block: bytes) -> tuple:
    """A record as a row of ``RECORD_FIELDS``; a revisit has no payload, but its size and digest."""
    identifier, kind = headers["WARC-Record-ID"][1:-1], headers["WARC-Type"]
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        n_bytes, refers_to = len(payload), None
        if payload_digest(payload) != stated:
            raise ValueError(f"record {identifier}: payload and digest differ")
    else:
        n_bytes = int(head.rsplit(b"Content-Length: ", 1)[1])
        payload, refers_to = None, page_of(headers["WARC-Refers-To"][1:-1])
    return identifier, page_of(identifier), headers.get("WARC-Target-URI"), kind, refers_to, payload, n_bytes, stated


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: (compressed, decompressed) size of every frame."""
    body = b"".join(struct.pack(_ENTRY, *s) for s in sizes) + struct.pack(_FOOTER, len(sizes), 0, _SEEKABLE_MAGIC)
    return struct.pack("<II", _SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """(offset, compressed, decompressed size) of every frame of an open bundle."""
    size = source.size()
    source.seek(size - _FOOTER_BYTES)
    frames, descriptor, magic = struct.unpack(_FOOTER, source.read(_FOOTER_BYTES))
    if magic != _SEEKABLE_MAGIC:
        raise ValueError("the bundle does not end with a seek table")
    entry = _ENTRY_BYTES + 4 * (descriptor >> 7)  # a set top bit adds a checksum to every entry
    source.seek(size - _FOOTER_BYTES - frames * entry)
    table, out, at = source.read(frames * entry), [], 0
    for k in range(frames):
        packed, plain = struct.unpack_from(_ENTRY, table, k * entry)
        out.append((at, packed, plain))
        at += packed
    return out


class BundleWriter:
    """Records of one task, in frames and bundles; ``index`` holds a row per record."""

    def __init__(self, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES):
        import zstandard
        from pyarrow import fs

        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.system.create_dir(self.root, recursive=True)
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.out, self.records, self.held = None, [], 0
        self.index: list[tuple[str, str, int, int, int]] = []

    def add(self, identifier: str, record: bytes) -> None:
        if self.held and self.held + len(record) > self.frame_bytes:
            self.end_frame()
        if self.out is None:
            self.name = f"{uuid.uuid4().hex}.warc.zst"
            self.out = self.system.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.sizes, self.written = [], 0
        self.index.append((identifier, self.name, len(self.sizes), self.held, len(record)))
        self.records.append(record)
        self.held += len(record)

    def end_frame(self) -> None:
        if not self.records:
            return
        frame = self.pack(b"".join(self.records))
        self.out.write(frame)
        self.sizes.append((len(frame), self.held))
        self.written += len(frame)
        self.records, self.held = [], 0
        if self.written >= self.bundle_bytes:
            self.close()

    def close(self) -> None:
        self.end_frame()
        if self.out is not None:
            self.out.write(seek_table(self.sizes))
            self.out.close()
            self.out = None

    def take_index(self) -> list[tuple]:
        """The index rows made since the last call."""
        rows, self.index = self.index, []
        return rows


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(row, refers_page, refers_row) of the rows of ``pages`` (row, page_id, payload) that repeat a payload.

    ``row`` is unique. Payloads are read for their digests and go no further.
    """
    narrow = pages.filter(F.length("payload") >= min_bytes).select("row", "page_id", F.unhex(F.sha1("payload")).alias("digest"))
    chosen = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "row")).alias("best")
    best = narrow.groupBy("digest").agg(chosen, F.count(F.lit(1)).alias("n")).filter("n > 1")
    best = best.select("digest", F.col("best.page_id").alias("refers_page"), F.col("best.row").alias("refers_row"))
    return lookup_join(narrow.select("row", "digest"), best, ["digest"], "inner").filter("row != refers_row").select("row", "refers_page", "refers_row")


def write_archive(pages: DataFrame, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write a record per row of ``pages`` (page_id, url, html); returns (folder, index)."""
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex[:12]}"
    uri = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    # a written row number: every later step, and every repeated task, sees the same one
    numbered = staged(own.withColumn("row", F.monotonically_increasing_id()), "warc-pages")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(uri, frame_bytes, bundle_bytes)
        for batch in small_batches(batches, "payload"):
            for r in batch.to_pylist():
                identifier, refers = record_id(r["page_id"], r["row"]), None
                if r["refers_row"] is not None:
                    refers = record_id(r["refers_page"], r["refers_row"])
                writer.add(identifier, make_record(identifier, r["url"], r["payload"], refers))
            yield _rows(writer.take_index(), INDEX_FIELDS)
        writer.close()  # a task that fails here fails as a whole, and its index rows go with it

    with lookup_scope():
        again = revisits(numbered, min_bytes)
        # rows are unique, so none is hot; a bounded list of revisits reaches the payloads without moving them
        rows = lookup_join(numbered, again, ["row"], key_counts=again.select("row", F.lit(1).alias("__n")))
        return uri, staged(rows.mapInArrow(run, ddl(INDEX_FIELDS)), "warc-index")


def _frames(uri: str, wanted: DataFrame, pick: bool) -> DataFrame:
    """Records of the frames named by ``wanted`` (bundle, frames[, ids]); only the ids listed, if ``pick``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(uri)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for job in batch.to_pylist():
                ids = set(job["ids"]) if pick else None
                with system.open_input_file(f"{root}/{job['bundle']}") as source:
                    table = read_seek_table(source)
                    for frame in job["frames"]:
                        at, packed, plain = table[frame]
                        source.seek(at)
                        data = unpack(source.read(packed), max_output_size=plain)
                        rows = [record_row(h, b) for h, b in parse_records(data) if ids is None or h["WARC-Record-ID"][1:-1] in ids]
                        yield _rows(rows, RECORD_FIELDS)

    return wanted.mapInArrow(run, ddl(RECORD_FIELDS))


def read_archive(uri: str, index: DataFrame) -> DataFrame:
    """All records of the bundles that ``index`` lists, in the columns of ``RECORD_FIELDS``.

    Frames are dealt out evenly, ``READ_FRAMES`` neighbours at a time, whatever the bundles' sizes.
    """
    sizes = index.groupBy("bundle").agg(F.max("frame").alias("last"))
    starts = sizes.select("bundle", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(READ_FRAMES))).alias("start"))
    jobs = starts.select("bundle", F.sequence(F.col("start"), F.least(F.col("start") + READ_FRAMES - 1, F.col("last"))).alias("frames"))
    # the job list is as long as the archive is in blocks; each row stands for some 16 MB of records
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _frames(uri, jobs.repartition(tasks, "bundle", "frames"), pick=False)


def fetch(uri: str, index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records with the identifiers of ``ids`` (record_id), read from their frames alone."""
    places = index.join(ids.select("record_id").distinct(), "record_id")
    jobs = places.groupBy("bundle", "frame").agg(F.collect_list("record_id").alias("ids"))
    return _frames(uri, jobs.select("bundle", F.array("frame").alias("frames"), "ids"), pick=True)


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as an archive and read it back: one row per record."""
    uri, index = write_archive(pages, min_bytes)
    return read_archive(uri, index)
