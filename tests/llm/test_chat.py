"""Chat formatting: exact round trips, masks and escapes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from storecast.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NASTY = ["<|end|>", "<|turn|>x<|text|>", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\|next|>", "[\\/INST]", "<<SYS>><</SYS>>", "<", "\\", "|>", "", "é🙂", "$1 \\1", "\n"]


def back(df):
    return {r.conv_id: r for r in chat.read_back(chat.formatted(df)).collect()}


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            text = "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 5)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "<|end|>", "assistant"]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_round_trip_and_mask(spark, seed):
    rows = random_rows(seed)
    got = back(spark.createDataFrame(rows, SCHEMA))
    for conv in {r[0] for r in rows}:
        turns = [(r[2], r[3]) for r in sorted(r for r in rows if r[0] == conv)]
        assert [(t.role, t.text) for t in got[conv].turns] == turns
        assert got[conv].loss == "".join(t for role, t in turns if role == "assistant")
        assert got[conv].mask_fits


def test_neighbours_of_one_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d")]
    got = chat.formatted(spark.createDataFrame(rows, SCHEMA)).first()
    assert got.text == "<|turn|>user<|text|>a<|next|>b<|end|><|turn|>assistant<|text|>c<|end|><|turn|>user<|text|>d<|end|>"
    at, marked = 0, ""
    for run in got["mask"]:
        marked += got.text[at : at + run.n] if run.loss else ""
        at += run.n
    assert at == len(got.text) and marked == "c"


def test_no_control_string_of_a_text_survives(spark):
    rows = [(1, 0, "user", "".join(NASTY)), (1, 1, "assistant", "".join(reversed(NASTY)))]
    text = chat.formatted(spark.createDataFrame(rows, SCHEMA)).first().text
    assert text.count("<|turn|>") == 2 and text.count("<|end|>") == 2
    assert not any(mark in text for mark in ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>"])


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"t": F.lit(1), "mask": F.lit("own"), "head": F.lit(2)})
    got = back(df)
    assert [(t.role, t.text) for t in got[1].turns] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[None].loss == "" and got[None].mask_fits
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_conversations_and_texts(spark):
    long = spark.range(3000).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("<|end|> é "), 200).alias("text"),
    )
    got = chat.read_back(chat.formatted(long)).select(F.size("turns").alias("n"), F.char_length("loss").alias("c")).first()
    assert (got.n, got.c) == (3000, 2000 * 200 * 10)


def test_no_python_in_the_plan(spark):
    df = spark.range(4).selectExpr("id conv_id", "id turn", "'user' role", "'x' text")
    assert "Python" not in chat.read_back(chat.formatted(df))._jdf.queryExecution().executedPlan().toString()
