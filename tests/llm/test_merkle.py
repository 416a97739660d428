"""Merkle fingerprints: equality, likeness, located edits, and the next document."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from storecast.llm import merkle

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, lines):
    return "\n".join(" ".join(rng.choices(WORDS, k=rng.randint(3, 30))) for _ in range(lines))


def test_equal_texts_and_only_those_have_equal_fingerprints():
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(0, 12)) for _ in range(60)] + ["", "\n", "\n\n", "a", "a\n", " a", "é" * 9000, "é" * 9001]
    prints = {t: merkle.tree(t).fingerprint for t in texts}
    assert len(set(prints.values())) == len(set(texts))
    assert all(merkle.tree(t).fingerprint == p for t, p in prints.items())
    assert all(merkle.likeness(p, p) == 1.0 for p in prints.values())


def test_pieces_cover_the_text_and_the_root_follows_from_the_levels():
    text = prose(random.Random(2), 40)
    t = merkle.tree(text)
    assert merkle._size(t.leaves) == len(text.encode())
    assert t.root == merkle._digest(b"r" + b"".join(t.sections)) and len(t.sections) > 1


def test_likeness_follows_the_shared_part():
    rng = random.Random(3)
    for _ in range(20):
        a, b = prose(rng, 40), prose(rng, 40)
        near = merkle.likeness(merkle.tree(a).fingerprint, merkle.tree(merkle.edited(a, b)).fingerprint)
        far = merkle.likeness(merkle.tree(a).fingerprint, merkle.tree(b).fingerprint)
        assert 0.65 < near < 0.9 and far < 0.1


def test_differences_locate_an_edit():
    rng = random.Random(4)
    a = prose(rng, 60)
    at = len(a) // 2
    b = a[:at] + "CHANGED" + a[at + 5 :]
    ranges = merkle.differences(merkle.tree(a).fingerprint, merkle.tree(b).fingerprint)
    assert ranges and all(at - 150 <= x and y <= at + 150 for x, y in ranges)
    assert merkle.differences(merkle.tree(a).fingerprint, merkle.tree(a).fingerprint) == []


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        k = len(text) // 4
        changed = text[: len(text) - k] + following[:k]
        own, new, nxt = (merkle.tree(t).fingerprint for t in (text, changed, following))
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, new, merkle.likeness(own, new), merkle.likeness(own, nxt)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 120])
def test_next_documents_match_brute_force(make_docs, n):
    rng = random.Random(n)
    rows = [(i * 7 - 50, prose(rng, rng.randint(0, 6))) for i in range(n)]
    rng.shuffle(rows)
    got = merkle.compared_with_next(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_nulls_repeats_and_clashing_columns(make_docs):
    rows = [(1, "b b"), (1, "a a"), (1, "a a"), (None, "x y z w"), (2, None), (3, "")] + [(9, "é" * 100_000)]
    df = make_docs(rows).withColumns({"id": F.lit("own"), "block": F.lit(1), "ahead": F.lit(2), "fingerprint": F.lit(3)})
    assert sorted((tuple(r) for r in merkle.compared_with_next(df).collect()), key=str) == brute(rows)
    assert merkle.fingerprints(df).count() == 7


def test_a_third_of_all_rows_without_an_id(spark, make_docs):
    rng = random.Random(12)
    rows = [(i, prose(rng, 2)) for i in range(60)] + [(None, prose(rng, 1)) for _ in range(40)] + [(5, "the same")] * 40
    got = merkle.compared_with_next(make_docs(rows).repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
