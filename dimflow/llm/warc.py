"""Web pages in seekable Zstandard bundles of WARC records, and back.

A bundle is a row of independent Zstandard frames, each with some whole records, and a seek table in a
skippable frame at the end: compressed and plain size of every frame. A record's place is its frame and the
offset inside the plain frame, so one record costs one ranged read and one frame. Pages with the payload of an
earlier page become revisit records, which name that page and repeat its digest and length.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm import files
from dimflow.llm.common import query, table
from dimflow.session import fresh_path, materialise

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 64 << 20
LEAST_REVISIT = 100
#: The seekable Zstandard format's numbers.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

_PLACES = "page_id long, file string, frame long, frame_bytes long, inside long, length long"
_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def deduplicated(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    """``page_id``, ``url``, ``payload`` (null for revisits), its size and SHA-256, and ``refers_to``.

    Of pages with equal payloads of at least ``LEAST_REVISIT`` bytes, those with the least id are responses and
    the others revisit it; so rows that repeat the least id are all responses. A null body is an empty payload. A
    page without an id revisits like others, and is a response where none of the equal pages has an id.
    """
    body = F.coalesce(F.col(f"`{body_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), body.alias("payload")
    )
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    large = rows.where(F.col("payload_bytes") >= LEAST_REVISIT)
    shared = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = materialise(shared.where("n > 1 AND first IS NOT NULL").select("payload_digest", "first"), "shared-payloads")
    later = ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    rows = rows.join(shared, "payload_digest", "left").withColumn("refers_to", F.when(later, F.col("first")))
    payload = F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload")
    return rows.select("page_id", "url", payload, "payload_bytes", "payload_digest", "refers_to")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    return None if name is None or name == "<urn:page:none>" else int(name[len("<urn:page:") : -1])


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; the payload of a revisit is left out."""
    revisit = refers_to is not None
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id))]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    body = b"" if revisit else payload
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Payload-Length", str(size)), ("Content-Length", str(len(body)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def parse(plain: bytes, at: int) -> tuple[tuple, int]:
    """The record at ``at`` as a row of ``_RECORDS``, checked against its digest, and where the next begins."""
    end = plain.index(b"\r\n\r\n", at)
    lines = plain[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size, kind = int(fields["Content-Length"]), fields["WARC-Type"]
    body = plain[end + 4 : end + 4 + size]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (hashlib.sha256(body).hexdigest() != digest or size != int(fields["Payload-Length"])):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    row = (
        _page(fields["WARC-Record-ID"]), url, int(fields["Payload-Length"]), digest, kind,
        _page(fields.get("WARC-Refers-To")), body if kind == "response" else None,
    )
    return row, end + 4 + size + 4


class Bundle:
    """Writes records into frames, and the seek table when closed."""

    def __init__(self, folder: str) -> None:
        self.name = files.fresh_name(folder, "pages", ".warc.zst")
        self.sink, self.packer = files.create(self.name), zstandard.ZstdCompressor(level=3)
        self.open, self.size, self.offset, self.table, self.places = [], 0, 0, [], []
        self.waiting: list[tuple[int | None, int, int]] = []

    def add(self, page_id: int | None, raw: bytes) -> None:
        self.waiting.append((page_id, self.size, len(raw)))
        self.open.append(raw)
        self.size += len(raw)
        if self.size >= FRAME_BYTES:
            self.cut()

    def cut(self) -> None:
        if not self.open:
            return
        packed = self.packer.compress(b"".join(self.open))
        self.sink.write(packed)
        self.places += [(p, self.name, self.offset, len(packed), inside, n) for p, inside, n in self.waiting]
        self.table.append((len(packed), self.size))
        self.offset += len(packed)
        self.open, self.size, self.waiting = [], 0, []

    def close(self) -> list[tuple]:
        self.cut()
        entries = b"".join(struct.pack("<II", *entry) for entry in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.sink.close()
        return self.places


def seek_table(file: str) -> list[tuple[int, int, int]]:
    """Offset, compressed and plain size of each frame, from the end of the bundle."""
    n, flags, magic = struct.unpack("<IBI", files.read(file, -9, 9))
    if magic != SEEKABLE or flags:
        raise ValueError(f"{file} is no bundle")
    sizes = np.frombuffer(files.read(file, -9 - 8 * n, 8 * n), "<u4").reshape(n, 2).astype(np.int64)
    ends = np.cumsum(sizes[:, 0])
    return [(int(e - c), int(c), int(p)) for e, (c, p) in zip(ends, sizes)]


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


_PLACES_ARROW = pa.schema([("page_id", pa.int64()), ("file", pa.string()), *[(c, pa.int64()) for c in ("frame", "frame_bytes", "inside", "length")]])
_RECORDS_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def write_bundles(pages: DataFrame, id_col: str, url_col: str, body_col: str, folder: str | None = None) -> DataFrame:
    """Write the archives; the result has the place of each record. A table without rows makes no bundle.

    Without ``folder`` the bundles go to a fresh one under the shared folder. Other columns are not read.
    """
    target = files.make_folder(folder or fresh_path(pages.sparkSession, "warc"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            for page_id, url, payload, size, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                bundle = bundle or Bundle(target)
                bundle.add(page_id, record(page_id, url, payload, size, digest, refers_to))
                if bundle.offset >= BUNDLE_BYTES:
                    yield _rows(bundle.close(), _PLACES_ARROW)
                    bundle = None
        if bundle is not None:
            yield _rows(bundle.close(), _PLACES_ARROW)

    return materialise(deduplicated(pages, id_col, url_col, body_col).mapInArrow(work, _PLACES), "record-places")


def read_bundles(places: DataFrame) -> DataFrame:
    """All records of the bundles that ``places`` names, found by the bundles' own seek tables."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                found = seek_table(file)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(found)), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())],
                    names=["file", "frame", "frame_bytes"],
                )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for file, frame, size in zip(*(c.to_pylist() for c in batch.columns)):
                plain, at, rows = unpack.decompress(files.read(file, frame, size)), 0, []
                while at < len(plain):
                    row, at = parse(plain, at)
                    rows.append(row)
                yield _rows(rows, _RECORDS_ARROW)

    found = places.select("file").distinct().mapInArrow(frames, "file string, frame long, frame_bytes long")
    # Frames are listed in a few bytes each: the number of tasks must not follow the list's size.
    tasks = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(tasks, "file", "frame").mapInArrow(records, _RECORDS)


def fetch(places: DataFrame) -> DataFrame:
    """The records at some rows of ``write_bundles``' result, each by one ranged read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for file, frame, size, inside in zip(*(batch.column(c).to_pylist() for c in ("file", "frame", "frame_bytes", "inside"))):
                yield _rows([parse(unpack.decompress(files.read(file, frame, size)), inside)[0]], _RECORDS_ARROW)

    return places.mapInArrow(work, _RECORDS)


@query
def op7_warc(spark, sf_dir):
    back = read_bundles(write_bundles(table(spark, sf_dir, "pages"), "page_id", "url", "html"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
