from __future__ import annotations

import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from storecast.llm import bpe
from tests.conftest import SMALL

END = "<|endoftext|>"
ODD = [
    "",
    " ",
    "   \n\t  x",
    "it's they'll I'm 'S 'Ll",
    "naïve café Ωmega 東京 ١٢٣ ½ é",
    " a　b c\x85d\x1c\x1d e",
    "👩‍👩‍👧 family \U0001f1e9\U0001f1ea",
    f"{END}a{END}{END} b<|endoftext",
    "՘࢏\U000187f8 \U0003d000x",
    "\x00\x01\x7f",
    "a" * 3001,
    " " * 3001,
    "ab" * 1500,
    "0" * 999,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.MODEL)


@pytest.fixture(scope="module")
def own():
    with open(bpe.MODEL, encoding="utf-8") as f:
        return bpe.Encoder(bpe.Vocabulary.parse(f.read()))


def ids(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def same(own, library, texts):
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, w in zip(texts, want):
        got = ids(own, text)
        assert got == w.ids, text[:80]
        assert own.decode(np.array(got)) == library.decode(got, skip_special_tokens=False)


def test_odd_texts_equal_the_library(own, library):
    same(own, library, ODD)


def test_random_texts_equal_the_library(own, library):
    rng = random.Random(3)
    letters = "aábcdehlorstuxyz  ..,'\n01éß中́" + "".join(chr(c) for c in rng.sample(range(32, 0xD800), 40))
    same(own, library, ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(4000)])


def test_every_code_point_is_split_as_the_library_does(own, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b 1{c}2 .{c}. {c}" for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    want = library.encode_batch_fast(texts, add_special_tokens=False)
    assert all(ids(own, t) == w.ids for t, w in zip(texts, want))


def test_long_texts_are_cut_without_a_trace(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", 10)
    rng = random.Random(4)
    parts = ["word", " ", "  ", "\n", " x", "'s", " ", "\x1c", "12", " .", "é"]
    same(own, library, ["".join(rng.choices(parts, k=200)) for _ in range(200)])


def slow_merges(v, data):
    """One merge at a time, the earliest rule first, leftmost place first."""
    out = [v.tokens.index(bytes([b])) for b in data]
    while True:
        made = [(v.made_by[p], i) for i, p in enumerate(zip(out, out[1:])) if p in v.made_by]
        if not made:
            return out
        token, at = min(made)
        out[at : at + 2] = [token]


def small_model(merges, end=None):
    letters = {b: c for c, b in bpe.byte_letters().items()}
    tokens = [letters[b] for b in range(256)] + [a + b for a, b in merges]
    return json.dumps(
        {
            "added_tokens": [],
            "normalizer": None,
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False},
            "model": {"type": "BPE", "vocab": {t: (7 * i) % len(tokens) if len(tokens) % 7 else i for i, t in enumerate(tokens)}, "merges": merges},
        }
    )


@pytest.mark.parametrize("seed", range(12))
def test_small_vocabularies_with_any_merges(seed):
    """Random merges, some of whose tokens can never occur, against merging step by step."""
    rng = random.Random(seed)
    tokens, merges = list("abc"), []
    while len(merges) < 14:
        pair = (rng.choice(tokens), rng.choice(tokens))
        if pair[0] + pair[1] not in tokens and len(pair[0] + pair[1]) < 9:
            tokens.append(pair[0] + pair[1])
            merges.append(list(pair))
    own = bpe.Encoder(bpe.Vocabulary.parse(small_model(merges)))
    for _ in range(400):
        data = bytes(rng.choices(b"abc", k=rng.randint(1, 24)))
        assert own.merged(data) == slow_merges(own.vocabulary, data)
    back = own.encode("abcabc")
    assert own.decode(np.frombuffer(back, "<u4")) == "abcabc"


def test_other_models_are_refused():
    model = json.loads(small_model([["a", "b"]]))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"model": model["model"] | {"byte_fallback": True}}):
        with pytest.raises(ValueError):
            bpe.Vocabulary.parse(json.dumps(model | change))


def test_decoding_passes_over_unknown_ids_and_broken_bytes(own, library):
    rng = random.Random(5)
    for _ in range(300):
        some = rng.choices(range(50257), k=rng.randint(0, 12)) + rng.choices([50300, 99999999], k=rng.randint(0, 2))
        assert own.decode(np.array(some, np.int64)) == library.decode(some, skip_special_tokens=False)


def test_all_given_documents(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = bpe.round_trip(docs, bpe.load(spark)).collect()
    want = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(got) == len(want)
    for r in got:
        assert np.frombuffer(r.packed, "<u4").tolist() == library.encode(want[r.doc_id], add_special_tokens=False).ids
        assert r.text == want[r.doc_id] and r.n_tokens == len(r.packed) // 4


def test_frames_nulls_repeats_clashing_columns_and_empty_tables(spark, own):
    rows = [(1, None, 5), (1, "", None), (None, "x's y", 7), (2, "ab " * 50000, 8), (2, "ab " * 50000, 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, tokens int")
    model = bpe.load(spark)
    got = bpe.encoded(docs, model)
    assert got.dtypes == [("doc_id", "bigint"), ("tokens", "array<int>"), ("n_tokens", "bigint")]
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == sorted(
        (i or 0, len(ids(own, t or ""))) for i, t, _ in rows
    )
    back = bpe.decoded(got, model)
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t, _ in rows)
    lists = spark.createDataFrame([(None,), ([],), ([72, None, 73],), ([99999999, 72],)], "tokens array<int>")
    assert [r.text for r in bpe.decoded(lists, model).collect()] == ["", "", "ij", "i"]
    assert bpe.encoded(docs.limit(0), model).count() == 0
    assert bpe.round_trip(docs.limit(0), model).count() == 0
