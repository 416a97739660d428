"""URL rules against a plain reading of the rules."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from storecast.llm import urlrules
from storecast.llm.urlrules import Automaton, Rule


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.verdict if best else default


URLS = [
    "http://example.net/en/x", "https://A.Example.NET/de", "http://net/", "http://net", "http://notnet.org/fr/", "x://y.org/fr/?a",
    "http://example.com/de/#x", "http://m.example.com/de", "http://example.com/a/example.net/en/", "nothing", "", None, "://", "a://b://c/",
    "http://ex.net?x=/en/", "http://é.net/", "http://.net/", "http://x..net//", "HTTP://EXAMPLE.ORG/FR/", "http://u@h.net:80/", "http://a\n.net/b\nc",
]


def check(spark, urls, rules):
    rows = list(enumerate(urls))
    got = urlrules.judged(spark.createDataFrame(rows, "page_id bigint, url string"), rules)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: plain(u, rules) for i, u in rows}


def test_odd_urls(spark):
    check(spark, URLS + ["http://" + "a." * 3000 + "net/" + "b/" * 3000], urlrules.RULES)


def test_many_rules_cross_word_borders(spark):
    rng = random.Random(4)
    hosts = [".".join(rng.choices(["a", "bb", "net", "x"], k=rng.randint(1, 4))) for _ in range(60)]
    rules = tuple({h + p: Rule(rng.choice(["allow", "block"]), h, p) for h in hosts for p in ["/", "/a/", "/é"]}.values())
    urls = ["http://" + ".".join(rng.choices(["a", "bb", "net", "x", "y"], k=rng.randint(1, 5))) + rng.choice(["", "/", "/a/b", "/é/", "/a"]) for _ in range(300)]
    check(spark, urls, rules)


def test_automaton_against_regular_expressions():
    rng = random.Random(9)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**"]) for _ in range(rng.randint(1, 12))) for _ in range(80)]
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    words = ["".join(rng.choice("ab/") for _ in range(rng.randint(0, 14))) for _ in range(200)]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    got = Automaton(globs).matches(data, np.concatenate(([0], np.cumsum([len(w) for w in words]))))
    for g, glob in enumerate(globs):
        want = re.compile(re.escape(glob).replace(r"\*\*", ".*").replace(r"\*", "[^/]*"))
        assert [bool(want.fullmatch(w)) for w in words] == got[:, g].tolist()


def test_repeats_clashes_empty_tables_and_bad_rules(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, "x")], "page_id bigint, url string")
    got = urlrules.judged(df.withColumns({"host": F.lit("own"), "rule": F.lit(1), "canonical": F.lit(2)}))
    assert sorted((str(r.page_id), r.verdict) for r in got.collect()) == [("1", "block"), ("1", "block"), ("None", "allow")]
    assert urlrules.judged(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        urlrules.judged(df, (Rule("block", "*.net", "/"),))
