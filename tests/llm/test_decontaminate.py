"""Decontamination against brute force."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from storecast.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    grams = {}
    for item, text in items:
        w = split(text)
        k = min(len(w), window)
        for i in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + k]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in grams:
                    hit |= set(range(i, i + k))
                    found |= grams[tuple(w[i : i + k])]
        out.append((doc, len(w), len(hit), sorted(map(str, found))))
    return out


def tables(spark, make_docs, window=4):
    rng = random.Random(2)
    vocabulary = ["a", "B", "Été", "été", "x1", "9", "ß", "w", "of", "the"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 9)))) for i in range(25)] + [(3, "a, B; of-the"), (50, None), (51, "!!")]
    docs = [(i, rng.choice(["", ". "]) + ", ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(60)]
    docs += [(7, "a b of the"), (100, None), (101, ""), (102, "?!"), (None, "x1 9 w")]
    return docs, items, make_docs(docs), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("set_windows", [200_000, 3])
def test_matches_brute_force(spark, make_docs, set_windows):
    docs, items, d, b = tables(spark, make_docs)
    got = decontaminate.report(d, b, window=4, set_windows=set_windows).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == sorted(brute(docs, items, 4), key=str)


def test_spans_are_maximal_and_ordered(spark, make_docs):
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    got = decontaminate.report(make_docs([(1, "z a b c d e q c d e f a b c")]), b, window=3).first()
    assert [(s["at"], s["to"]) for s in got.spans] == [(1, 6), (7, 14)] and got.n_hit == 12


def test_removal_of_documents_and_of_spans(spark, make_docs):
    b = spark.createDataFrame([(1, "a b c"), (2, "été")], "item_id bigint, text string")
    docs = make_docs([(1, "-- A b, c! then z"), (2, "clean"), (3, None), (4, "Été été, x"), (5, "a b a b c")])
    assert sorted(r.doc_id for r in decontaminate.without_contaminated(docs, b, window=3).collect()) == [2, 3]
    got = {r.doc_id: r.text for r in decontaminate.without_spans(docs, b, window=3).collect()}
    assert got == {1: "-- then z", 2: "clean", 3: None, 4: "Été x", 5: "a b "}


@pytest.mark.parametrize("joined", ["broadcast", "shuffled"])
def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark, make_docs, request, joined):
    if joined == "shuffled":
        request.getfixturevalue("shuffled")
    b = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    clean = [(None, None), (None, ""), (None, "clean"), (7, None), (7, "other"), (7, "other"), (8, "fine")]
    docs = make_docs(clean + [(None, "a b c"), (7, "z A, b c"), (7, "z A, b c"), (9, "a b c")])
    kept = decontaminate.without_contaminated(docs, b, window=3)
    assert kept.dtypes == docs.dtypes
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_empty_tables_and_clashing_columns(spark, make_docs):
    docs = make_docs([(1, "a b c")]).withColumns({"items": F.lit(1), "w": F.lit("own"), "_row": F.lit(2), "size": F.lit(3)})
    empty = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "a b c", 5)], "item_id bigint, text string, h int")
    assert decontaminate.report(docs, empty).first().n_hit == 0
    assert decontaminate.report(docs, one, window=3).first().n_hit == 3
    assert decontaminate.report(make_docs([]), one).count() == 0
    assert decontaminate.without_contaminated(docs, empty).columns == docs.columns


def test_no_python_in_the_plan(spark, make_docs):
    b = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    plan = decontaminate.report(spark.range(3).selectExpr("id doc_id", "string(id) text"), b.limit(1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "BroadcastHashJoin" in text


def test_a_very_long_text(spark, make_docs):
    words = [f"w{i % 9999}" for i in range(120_000)]
    items = [(1, " ".join(words[500:530])), (2, "never seen at all")]
    docs = [(1, " ".join(words)), (2, " ".join(words[:400]))]
    got = decontaminate.report(make_docs(docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == sorted(brute(docs, items, 10))


def test_spans_of_repeated_and_missing_ids_are_cut_row_by_row(spark, make_docs):
    b = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    rows = [(1, "x a b c p"), (1, "j k a b c"), (1, "j k a b c"), (None, "q a b c"), (None, "clean"), (1, None)]
    docs = make_docs(rows).withColumn("spans", F.lit("own")).withColumn("_id", F.lit(5))
    got = decontaminate.without_spans(docs, b, window=3)
    assert got.dtypes == docs.dtypes
    want = [(1, "x p"), (1, "j k "), (1, "j k "), (None, "q "), (None, "clean"), (1, None)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
    assert {r.spans for r in got.collect()} == {"own"}
