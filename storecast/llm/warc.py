"""Web archives in seekable Zstandard bundles.

A bundle holds WARC records in independent Zstandard frames, then a seek table in a skippable frame, so any frame can be
read alone. The index maps a record to bundle, frame and place inside the frame. Records with a payload that another
record of the table answers for are revisits without a payload.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storecast.llm.frames import mapped, scratch_path, stored

#: Uncompressed bytes after which a frame is closed, and compressed bytes after which a bundle is.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 28
#: The tables hold no time of capture; every record has this date, so that archives of equal rows are equal.
DATE = "2000-01-01T00:00:00Z"
#: Seek tables of bundles that a reading task remembers.
TABLES_HELD = 16
LEVEL = 3

# Fixed values of the public formats: seek table magic numbers and base-32 alphabet.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

INDEX = (
    "page_id bigint, bundle string, frame int, frame_start bigint, frame_size bigint, start bigint, length bigint"
)


# -- payloads and their digests ------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1: each five hex digits are four letters."""
    hexes = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexes, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.lower(F.concat(*groups)), "0123456789abcdefghijklmnopqrstuv", _BASE32)


def resolved(pages: DataFrame) -> DataFrame:
    """page_id, payload_digest, payload_bytes, refers_to of each different (page_id, payload).

    Of equal payloads the largest page_id answers, the others refer to it. The digests of popular payloads are combined
    before the shuffle, and the join back may be split, as there is one answer to a digest.
    """
    raw = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    prints = stored(
        pages.select(
            F.col("page_id").cast("bigint").alias("page_id"),
            base32_sha1(raw).alias("payload_digest"),
            F.octet_length(raw).cast("bigint").alias("payload_bytes"),
        ),
        "payloads",
    )
    answers = prints.groupBy("payload_digest").agg(F.max("page_id").alias("answer"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("answer")), F.col("answer")).alias("refers_to")
    return prints.distinct().join(answers, "payload_digest").select("page_id", "payload_digest", "payload_bytes", refers)


# -- records and bundles -------------------------------------------------------


class Record(NamedTuple):
    """One record as written; payload_bytes and digest are those of the full payload."""

    page_id: int | None
    url: str | None
    payload: bytes
    payload_bytes: int
    digest: str
    refers_to: int | None


def _urn(page_id: int | None, digest: str) -> str:
    """The id of a record: rows that share it are alike in page and payload."""
    return f"<urn:page:{'null' if page_id is None else page_id}:{digest}>"


def _page(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").partition(":")[0]
    return None if name == "null" else int(name)


def packed(r: Record) -> bytes:
    """A WARC/1.1 record: a response with its payload, or a revisit that names the response."""
    revisit = r.refers_to is not None
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % r.payload_bytes]
    block = b"\r\n".join([*http, b"", b"" if revisit else r.payload])
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(r.page_id, r.digest)}",
        f"WARC-Date: {DATE}",
        # What a header cannot hold is percent-encoded; the table keeps the URL as it was.
        f"WARC-Target-URI: {quote(r.url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{r.digest}",
    ]
    if revisit:
        head += [
            f"WARC-Refers-To: {_urn(r.refers_to, r.digest)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def unpacked(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record headers, HTTP headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: compressed and plain size of each frame, then a footer."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of the frames of an open bundle of `size` bytes, from its footer."""
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != _SEEKABLE or flags & 0x80:
        raise ValueError("no seek table of the expected kind")
    file.seek(size - 9 - 8 * count)
    table, start, out = file.read(8 * count), 0, []
    for i in range(count):
        packed_size, plain = struct.unpack_from("<II", table, 8 * i)
        out.append((start, packed_size, plain))
        start += packed_size
    return out


def filesystem(folder: str):
    """File system and path of a folder that all executors share, by its URI."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    scheme, _, rest = folder.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


class _Bundle:
    """One bundle being written: frames go out as they fill."""

    def __init__(self, folder: str):
        import zstandard

        self.fs, path = filesystem(folder)
        self.fs.create_dir(path, recursive=True)
        # A name of its own for each attempt: the index names the bundles of tasks that succeeded.
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = self.fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.press = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size, self.written, self.waiting = 0, 0, []

    def add(self, page_id: int | None, record: bytes) -> None:
        self.waiting.append((page_id, self.size, len(record)))
        self.held.append(record)
        self.size += len(record)

    def close_frame(self) -> list[tuple]:
        """Index rows of the records in the frame."""
        if not self.held:
            return []
        frame = self.press.compress(b"".join(self.held))
        self.out.write(frame)
        rows = [(p, self.name, len(self.frames), self.written, len(frame), a, n) for p, a, n in self.waiting]
        self.frames.append((len(frame), self.size))
        self.written += len(frame)
        self.held, self.size, self.waiting = [], 0, []
        return rows

    def close(self) -> list[tuple]:
        rows = self.close_frame()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return rows


def write(pages: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """Writes a record per row of `pages` (page_id, url, html) below `folder`, and returns the stored index.

    Null html counts as an empty payload. Of equal payloads that with the largest page_id is a response, the others are
    revisits; rows that repeat that page_id are each a response. Rows without a page_id have records too. Other columns
    are ignored. An empty table writes nothing and has an empty index. `folder` must be shared by all executors.

    Payloads travel once, to the join with what is known of them; each of its partitions writes bundles of its own.
    `tasks` deals the records out anew, to so many writers.
    """
    raw = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    own = pages.select(F.col("page_id").cast("bigint").alias("id"), "url", raw.alias("payload"))
    own = own.withColumn("digest", base32_sha1(F.col("payload")))
    known = resolved(pages)
    full = own.join(known, own.id.eqNullSafe(known.page_id) & (own.digest == known.payload_digest)).select(
        "page_id",
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        "refers_to",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
        names = [f.split()[0] for f in INDEX.split(", ")]

        def indexed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        bundle = None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for record in map(Record._make, zip(*columns)):
                bundle = bundle or _Bundle(folder)
                bundle.add(record.page_id, packed(record))
                if bundle.size >= FRAME_BYTES:
                    yield from indexed(bundle.close_frame())
                    if bundle.written >= BUNDLE_BYTES:
                        yield from indexed(bundle.close())
                        bundle = None
        if bundle:
            yield from indexed(bundle.close())

    full = full.repartition(tasks, "page_id", "payload_digest") if tasks else full
    return stored(mapped(full, run, INDEX), "warc-index")


_READ = (
    "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint"
)


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records that `index` names, read from the bundles below `folder`: each frame is read and opened once.

    payload is null for revisits. A response whose payload does not have the digest of its header raises.
    """
    # Index rows are few and what they stand for is large, so they are dealt out by number, not by size.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frames = index.repartition(tasks, "bundle", "frame").groupBy("bundle", "frame").agg(
        F.min("frame_start").alias("frame_start"),
        F.min("frame_size").alias("frame_size"),
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias("records"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64
        import hashlib

        import zstandard

        fs, path = filesystem(folder)
        names = [f.split()[0] for f in _READ.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        opener = zstandard.ZstdDecompressor()
        tables: dict[str, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{path}/{row['bundle']}") as file:
                    if row["bundle"] not in tables:
                        if len(tables) >= TABLES_HELD:
                            tables.clear()
                        tables[row["bundle"]] = read_seek_table(file, file.size())
                    start, size, plain = tables[row["bundle"]][row["frame"]]
                    if (start, size) != (row["frame_start"], row["frame_size"]):
                        raise ValueError(f"{row['bundle']}: index and seek table differ")
                    file.seek(start)
                    data = opener.decompress(file.read(size), max_output_size=plain)
                out = []
                for r in row["records"]:
                    head, http, payload = unpacked(data[r["start"] : r["start"] + r["length"]])
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = head["WARC-Type"] == "revisit"
                    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{head['WARC-Record-ID']}: payload and digest differ")
                    out.append(
                        (
                            _page(head["WARC-Record-ID"]),
                            head["WARC-Target-URI"],
                            None if revisit else payload,
                            int(http["Content-Length"]),
                            digest,
                            head["WARC-Type"],
                            _page(head["WARC-Refers-To"]) if revisit else None,
                        )
                    )
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return mapped(frames, run, _READ)


def lookup(index: DataFrame, folder: str, page_ids: DataFrame) -> DataFrame:
    """The records of some pages (page_id), reading only the frames that hold them."""
    return read(index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi"), folder)


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
