"""WARC records in seekable Zstandard bundles (operator 6)."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, small, stored, table
from tidewatch.session import work_folder

#: Fixed values of the seekable format and of the revisit profile.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: A frame ends with the record that reaches this size; a bundle with the frame.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 26
DATE = "1970-01-01T00:00:00Z"

INDEX = "page_id long, bundle string, frame int, position long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; with ``refers_to`` a revisit, which keeps the HTTP head but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at a place, and the place behind it."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no record begins here")
    headers = dict(line.split(": ", 1) for line in lines)
    begin = end + 4
    stop = begin + int(headers["Content-Length"])
    return headers, data[begin:stop], stop + 4


def interpret(headers: dict[str, str], block: bytes) -> tuple[int | None, int, str, str, int | None, bytes]:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload of a record.

    The payload of a response is measured and its digest taken again; a
    mismatch with the header raises. A revisit has both from its headers.
    """
    head, _, payload = block.partition(b"\r\n\r\n")
    kind = headers["WARC-Type"]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    refers = _page(headers["WARC-Refers-To"]) if kind == "revisit" else None
    return _page(headers["WARC-Record-ID"]), size, digest, kind, refers, payload


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle, from compressed and plain frame sizes."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


@lru_cache(maxsize=8)
def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class Bundle:
    """Random access to the frames of one bundle, by its seek table."""

    def __init__(self, folder: str, name: str):
        system, path = _file_system(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_MAGIC:
            raise ValueError(f"{name} has no seek table")
        table_bytes = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.frames, start = [], 0
        for packed, plain in struct.iter_unpack("<II", table_bytes):
            self.frames.append((start, packed, plain))
            start += packed

    def frame(self, number: int) -> bytes:
        start, packed, plain = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, start), max_output_size=plain)

    def record(self, frame: int, position: int, length: int) -> tuple[dict[str, str], bytes]:
        headers, block, _ = parse_record(self.frame(frame)[position : position + length])
        return headers, block

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def _write(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Write rows (page_id, url, payload, refers_to) as bundles; yields their index."""
    system, path = _file_system(folder)
    task = TaskContext.get()
    squeeze = zstandard.ZstdCompressor(level=3)
    bundles = 0
    out = None
    frames: list[tuple[int, int]] = []
    index: list[tuple] = []
    records: list[bytes] = []
    plain = written = 0
    name = ""

    def end_frame() -> None:
        nonlocal records, plain, written
        packed = squeeze.compress(b"".join(records))
        out.write(packed)
        frames.append((len(packed), plain))
        written += len(packed)
        records, plain = [], 0

    def end_bundle() -> pa.RecordBatch:
        nonlocal out, frames, index, written
        if records:
            end_frame()
        out.write(seek_table(frames))
        out.close()
        columns = list(zip(*index))
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["page_id", "bundle", "frame", "position", "length"]
        )
        out, frames, index, written = None, [], [], 0
        return batch

    for batch in batches:
        for page_id, url, html, refers_to in zip(*(batch.column(k) for k in range(4))):
            payload = (html.as_py() or "").encode()
            if out is None:
                # an attempt that fails leaves a file that no index names
                name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{bundles:04d}.warc.zst"
                bundles += 1
                out = system.open_output_stream(f"{path}/{name}", compression=None)
            page = page_id.as_py()
            record = build_record(page, url.as_py(), payload, base32_sha1(payload), refers_to.as_py())
            index.append((page, name, len(frames), plain, len(record)))
            records.append(record)
            plain += len(record)
            if plain >= FRAME_BYTES:
                end_frame()
                if written >= BUNDLE_BYTES:
                    yield end_bundle()
    if out is not None:
        yield end_bundle()


def _read(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name in batch.column(0).to_pylist():
            with Bundle(folder, name) as bundle:
                for number in range(len(bundle.frames)):
                    data, at, rows = bundle.frame(number), 0, []
                    while at < len(data):
                        headers, block, at = parse_record(data, at)
                        rows.append(interpret(headers, block)[:5])
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as bundles below ``folder``; returns the stored index.

    ``folder`` is a URI that all executors reach. The index maps page_id to
    bundle, frame, and the record's position and length in the plain frame; it
    is also the list of valid bundles, since failed attempts leave others.

    Of records with equal payloads of at least ``least_bytes`` the one with the
    largest page_id is the response and the others revisit it; smaller ones are
    all responses. A null html is an empty payload. A null page_id is never
    the largest; its record is a response if its payload has no other id.
    Repeated rows of the response are responses too. Digests are
    grouped with a map-side maximum, and only those met more than once are
    joined back: broadcast if few, else shuffled, where adaptive execution
    splits a large group of copies. An empty table writes nothing.
    """
    spark = pages.sparkSession
    system, path = _file_system(folder)
    system.create_dir(path, recursive=True)
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    keyed = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    copies = stored(
        keyed.where(F.octet_length("html") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .where("n > 1 and response is not null")
        .select("digest", "response"),
        "warc-copies",
    )
    refers = F.when(
        (F.octet_length("html") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")
    )
    records = keyed.join(small(copies), "digest", "left").select(
        "page_id", "url", "html", refers.alias("refers_to")
    )
    return stored(map_arrow(records, partial(_write, folder), INDEX), "warc-index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that the index names: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    bundles = index.select("bundle").distinct()
    return map_arrow(bundles, partial(_read, folder), RECORD)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = work_folder(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder}"
    return read_archives(write_archives(pages, folder), folder)


OP6_SQL = """
with hashed as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages
),
bits as (
  select page_id, strlen(payload) as payload_bytes, digest, max(page_id) over (partition by digest) as response,
         array_to_string(list_transform(range(1, 41), lambda i:
           substr('0000000100100011010001010110011110001001101010111100110111101111',
                  (strpos('0123456789abcdef', substr(digest, i, 1)) - 1) * 4 + 1, 4)), '') as b
  from hashed
)
select page_id, payload_bytes::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * substr(b, 5 * i + 1, 1)::int + 8 * substr(b, 5 * i + 2, 1)::int
                  + 4 * substr(b, 5 * i + 3, 1)::int + 2 * substr(b, 5 * i + 4, 1)::int
                  + substr(b, 5 * i + 5, 1)::int, 1)), '') as payload_digest,
       case when page_id = response then 'response' else 'revisit' end as record_type,
       case when page_id <> response then response end as refers_to
from bits
"""
