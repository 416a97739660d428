"""Archives: exact round trips through files, frames read alone, revisits."""

from __future__ import annotations

import base64
import hashlib
import os
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from storecast.llm import warc
from storecast.session import scratch_path

SCHEMA = "page_id bigint, url string, html string"


def pages(n=80):
    rng = random.Random(5)
    bodies = ["", "é<p>" * 50, "x\r\n\r\ny", "WARC/1.1\r\n", "z" * 400_000] + [f"<html>{i}" * rng.randint(1, 900) for i in range(30)]
    rows = [(i, f"http://h/{i}?q=é \r\n", rng.choice(bodies)) for i in range(n)]
    return rows + [(1000, None, None), (None, "u", "only here"), (None, "u", bodies[1])]


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "warc")


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_round_trip(spark, folder):
    rows = pages()
    index = warc.write(spark.createDataFrame(rows, SCHEMA), folder)
    got = warc.read(index, folder).collect()
    answers = {}
    for i, _, html in rows:
        answers.setdefault(html or "", []).append(i)
    answers = {k: max((i for i in v if i is not None), default=None) for k, v in answers.items()}
    want = []
    for i, _, html in rows:
        raw, answer = (html or "").encode(), answers[html or ""]
        kind = "response" if i == answer else "revisit"
        want.append((i, raw if kind == "response" else None, len(raw), sha(raw), kind, None if i == answer else answer))
    have = [(r.page_id, bytes(r.payload) if r.payload is not None else None, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_frames_stand_alone_and_the_index_points_into_them(spark, folder):
    index = warc.write(spark.createDataFrame(pages(), SCHEMA), folder, tasks=3).collect()
    assert max(r.frame for r in index) > 0
    for r in index:
        path = f"{folder}/{r.bundle}"
        with open(path, "rb") as f:
            start, size, plain = warc.read_seek_table(f, os.path.getsize(path))[r.frame]
            f.seek(start)
            data = zstandard.ZstdDecompressor().decompress(f.read(size))
        assert len(data) == plain
        head, http, _ = warc.unpacked(data[r.start : r.start + r.length])
        assert warc._page(head["WARC-Record-ID"]) == r.page_id
    # A reader that knows nothing of the table reads the bundle from end to end.
    with open(path, "rb") as f:
        whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == sum(r.bundle == index[-1].bundle for r in index)


def test_lookup_reads_chosen_records(spark, folder):
    index = warc.write(spark.createDataFrame(pages(), SCHEMA), folder)
    got = warc.lookup(index, folder, spark.createDataFrame([(3,), (1000,), (77777,)], "page_id bigint"))
    assert sorted(r.page_id for r in got.collect()) == [3, 1000]


def test_a_damaged_payload_raises(spark, folder):
    index = warc.write(spark.createDataFrame([(1, "u", "abc")], SCHEMA), folder, tasks=1)
    name = f"{folder}/{index.first().bundle}"
    record = warc.packed(warc.Record(1, "u", b"abd", 3, sha(b"abc"), None))
    frame = zstandard.ZstdCompressor().compress(record)
    with open(name, "wb") as f:
        f.write(frame + warc.seek_table([(len(frame), len(record))]))
    fixed = index.withColumns({"frame_size": F.lit(len(frame)).cast("bigint"), "length": F.lit(len(record)).cast("bigint")})
    with pytest.raises(Exception, match="differ"):
        warc.read(fixed, folder).collect()


def test_repeated_rows_clashing_columns_and_empty_tables(spark, folder):
    df = spark.createDataFrame([(1, "u", "a"), (1, "u", "a"), (0, "v", "a")], SCHEMA)
    index = warc.write(df.withColumns({"payload": F.lit("own"), "digest": F.lit(1), "id": F.lit(5)}), folder)
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read(index, folder).collect())
    assert got == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]
    none = warc.write(df.limit(0), scratch_path(spark, "warc"))
    assert none.count() == 0 and warc.read(none, folder).count() == 0


def test_digest_expression(spark):
    df = spark.createDataFrame([(b"",), (b"abc",), ("é".encode() * 999,)], "p binary")
    for r in df.select("p", warc.base32_sha1(F.col("p")).alias("d")).collect():
        assert r.d == sha(bytes(r.p))


def test_headers_have_a_date_and_ids_that_tell_payloads_of_a_page_apart(spark, folder):
    rows = [(1, "u", "a" * 90), (1, "u", "b" * 90), (2, "u", "a" * 90), (None, "u", "c"), (None, "u", "d")]
    index = warc.write(spark.createDataFrame(rows, SCHEMA), folder).collect()
    heads = []
    for r in index:
        path = f"{folder}/{r.bundle}"
        with open(path, "rb") as f:
            start, size, plain = warc.read_seek_table(f, os.path.getsize(path))[r.frame]
            f.seek(start)
            data = zstandard.ZstdDecompressor().decompress(f.read(size), max_output_size=plain)
        heads.append(warc.unpacked(data[r.start : r.start + r.length])[0])
    ids = [h["WARC-Record-ID"] for h in heads]
    assert len(set(ids)) == len(rows) and all(h["WARC-Date"] == warc.DATE for h in heads)
    assert all(h["WARC-Refers-To"] in ids for h in heads if h["WARC-Type"] == "revisit")
