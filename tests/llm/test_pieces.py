"""Tokens equal those of the model's own library."""

from __future__ import annotations

import random
import struct

import pytest
import sentencepiece
from pyspark.sql import functions as F

from storecast.llm import pieces
from tests.conftest import SMALL

ODD = [" a  b\n\n c ", "", "▁x", "  ", " ", "日本語🙂\x00\ttab", "<s> </s> <unk> <0x41>", "a" * 5000, "▁▁ ▁", "\xa0nbsp\u3000 x", "éé", "e\u0301", "\u200b"]


@pytest.fixture(scope="module")
def reference():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_parity_over_all_documents_and_odd_texts(spark, reference):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    both = docs.union(odd)
    got = pieces.round_trip(both, pieces.load(spark)).collect()
    texts = dict(both.collect())
    assert len(got) == len(texts)
    for r in got:
        want = reference.encode(texts[r.doc_id])
        assert list(r.tokens) == want and r.n_tokens == len(want)
        assert r.text == reference.decode(want) and r.lossless == (r.text == texts[r.doc_id])


def test_encode_then_decode_keeps_columns(spark, make_docs):
    model = pieces.load(spark)
    docs = make_docs([(1, "one two"), (1, "one two"), (None, None), (3, "")]).withColumns({"tokens": F.lit("own"), "extra": F.lit(4)})
    rows = pieces.encoded(docs, model)
    assert rows.columns == ["doc_id", "lang", "source", "n_chars", "extra", "tokens", "n_tokens"]
    back = pieces.decoded(rows, model)
    assert sorted((str(r.doc_id), r.text, r.extra) for r in back.collect()) == [("1", "one two", 4), ("1", "one two", 4), ("3", "", 4), ("None", "", 4)]
    again = pieces.retold(docs, model)
    assert again.columns == back.columns and again.dtypes == back.dtypes
    assert sorted(map(str, again.collect())) == sorted(map(str, back.collect()))
    assert pieces.retold(make_docs([]), model).count() == 0
    assert pieces.encoded(make_docs([]), model).count() == 0
    assert pieces.round_trip(make_docs([]), model).count() == 0


def library_and_table(model):
    """The tokenizer as its workers have it, and its decoder by table."""
    tokenizer = pieces.build(model)
    return tokenizer, pieces.Decoder(tokenizer)


def test_decoding_by_table_equals_the_library(monkeypatch):
    """Any ids: runs of byte tokens that are or are not text, at pieces' ends, spaces in front, no ids at all."""
    with open(pieces.MODEL, "rb") as f:
        model = pieces.Model.parse(f.read())
    tokenizer, decode = library_and_table(model)
    rng, n = random.Random(5), len(model.pieces)
    byte = [i for i, p in enumerate(model.pieces) if p[2] == pieces.BYTE]
    high = [byte[b] for b in "é🙂日".encode()]
    ids = [[], [byte[32], byte[32]], high, high[:3], high[1:], [*high[:1], 300, *high[1:2]], [0, 1, 2]]
    for k in range(300):
        pool = [range(n), byte, [*high, 400, *byte[8:40]]][k % 3]
        ids.append([rng.choice(pool) for _ in range(rng.randint(1, 30))])
    want = tokenizer.decode_batch(ids, skip_special_tokens=False)
    arrays = [pieces.np.array(x, pieces.np.int32) for x in ids]
    assert decode(arrays) == want and "\ufffd" in "".join(want)
    monkeypatch.setattr(pieces, "DECODED_AT_ONCE", 3)
    assert decode(arrays) == want and decode([]) == [] and decode(arrays[:1]) == [""]


@pytest.mark.parametrize("add_prefix", [True, False])
def test_decoding_by_table_of_models_without_byte_tokens(add_prefix):
    tokenizer, decode = library_and_table(pieces.Model.parse(unigram_model(False, add_prefix, False)))
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in ("a  b", " ab", "", "z zz", "abc cd")]
    assert decode([pieces.np.array(x, pieces.np.int32) for x in ids]) == tokenizer.decode_batch(ids, skip_special_tokens=False)


def test_round_trip_leaves_only_broken_texts_to_the_library(monkeypatch):
    with open(pieces.MODEL, "rb") as f:
        tokenizer, decode = library_and_table(pieces.Model.parse(f.read()))
    ids = [pieces.np.array(tokenizer.encode(t, add_special_tokens=False).ids, pieces.np.int32) for t in ODD]
    decode.tokenizer = None  # any call fails
    assert decode(ids)[2:4] == ["▁x".replace("▁", " "), "  "]


def varint(n):
    out = b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def part(number, value):
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    return varint(number << 3) + varint(value)


def unigram_model(byte_fallback, add_prefix, squeeze):
    """A small unigram model, written as protobuf."""
    letters = [(c, -4.0 - i / 7) for i, c in enumerate("abcdé")]
    units = [("▁", -3.0), ("▁a", -3.5), ("ab", -4.2), ("▁ab", -5.5), ("abc", -6.1), ("cd", -4.9), ("da", -7.7), ("▁▁", -5.0)]
    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    if byte_fallback:
        listed += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    listed += [(p, s, 1) for p, s in letters + units]
    out = b"".join(part(1, part(1, p.encode()) + b"\x15" + struct.pack("<f", s) + part(3, k)) for p, s, k in listed)
    out += part(2, part(3, 1) + part(35, int(byte_fallback)))
    return out + part(3, part(1, b"identity") + part(3, int(add_prefix)) + part(4, int(squeeze)) + part(5, 1))


@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("add_prefix", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_unigram_models_are_rebuilt_too(byte_fallback, add_prefix, squeeze):
    data = unigram_model(byte_fallback, add_prefix, squeeze)
    own = sentencepiece.SentencePieceProcessor()
    own.LoadFromSerializedProto(data)
    built = pieces.build(pieces.Model.parse(data))
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("aabbccdé  ") + rng.choice(["", "", "", "z"]) for _ in range(rng.randint(1, 12)))
        if squeeze and not text.strip():
            continue
        assert built.encode(text, add_special_tokens=False).ids == own.encode(text), text


def test_unsupported_models_are_refused():
    with pytest.raises(ValueError):
        pieces.build(pieces.Model(pieces=[("<unk>", 0.0, 2)], kind=3))
