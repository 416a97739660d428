"""The pipeline stage by stage against brute force, and its shape."""

from __future__ import annotations

import pytest
import sentencepiece

import corpus_pipeline
from storecast.llm import pieces, quality
from tests.conftest import SMALL
from tests.llm import test_decontaminate, test_simhash


def cut_repeats(rows, length=100):
    """Texts without what occurred before; a character goes only with all its bytes."""
    seen, out = set(), {}
    for doc, text in sorted(rows.items()):
        raw = text.encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        kept, at = [], 0
        for c in text:
            size = len(c.encode())
            if not all(gone[at : at + size]):
                kept.append(c)
            at += size
        out[doc] = "".join(kept)
    return out


@pytest.fixture(scope="module")
def stages(spark):
    """Documents after each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SMALL).cache())
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_of_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_filter", "near_dedup", "suffix_dedup", "decontamination", "tokenization"
    ]
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes
    assert [df.count() for df in stages] == sorted((df.count() for df in stages), reverse=True)


def test_quality(spark, stages):
    docs = stages[0]
    model = quality.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    want = {i: t for i, t in texts(docs).items() if model.scores(quality._vectors([t.encode()]))[0] >= 0.3}
    assert texts(stages[1]) == want and len(want) < docs.count()


def test_near_dedup(stages):
    before = texts(stages[1])
    kept = set(test_simhash.brute_groups(list(before.items())).values())
    assert texts(stages[2]) == {i: t for i, t in before.items() if i in kept} and len(kept) < len(before)


def test_suffix_dedup(stages):
    assert texts(stages[3]) == cut_repeats(texts(stages[2]))
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_decontamination(spark, stages):
    before = texts(stages[3])
    items = list(texts(spark.read.parquet(f"{SMALL}/benchmark.parquet").withColumnRenamed("item_id", "doc_id")).items())
    hit = {doc for doc, _, n, _ in test_decontaminate.brute(list(before.items()), items, 10) if n}
    assert texts(stages[4]) == {i: t for i, t in before.items() if i not in hit}


def test_tokenization_and_the_whole_run(spark, stages):
    reference = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    before = texts(stages[4])
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: (list(r.tokens), r.text) for r in got} == {i: (reference.encode(t), t) for i, t in before.items()}


def test_empty_documents(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
