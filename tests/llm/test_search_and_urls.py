"""Exact search against brute force; URL rules and vocabulary."""

import math
import random

import pytest

from tallyroll.llm import maxscore, url_filter

VECTORS = "vec_id long, embedding array<float>, score string, rank string"


def brute(rows, k=20, every=20):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in {i: min(v for j, v in ok if j == i) for i, _ in ok if i % every == 0}.items():
        scored = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block,shard,run", [(256, 4096, 16), (2, 7, 2)])
def test_equals_brute_force(spark, monkeypatch, block, shard, run):
    for name, value in (("BLOCK", block), ("SHARD", shard), ("RUN", run)):
        monkeypatch.setattr(maxscore, name, value)
    r = random.Random(2)
    unit = lambda: [r.gauss(0, 0.15) for _ in range(12)]
    import numpy as np

    rows = [(k, [float(np.float32(x)) for x in unit()]) for k in range(300)]
    rows += [(300, rows[7][1]), (301, rows[7][1]), (7, rows[7][1])]  # ties and a repeated row
    rows += [(320, None), (340, [None] * 12), (360, [float("nan")] * 12), (380, [float("inf")] * 12), (None, rows[3][1]), (400, []), (420, [0.5, -0.5])]
    found = maxscore.top_k(spark.createDataFrame([(*x, "c", "c") for x in rows], VECTORS).repartition(3))
    assert sorted(tuple(x) for x in found.collect()) == brute(rows)


def test_large_numbers_stay_exact(spark):
    r = random.Random(3)
    rows = [(k, [float(r.randrange(-2 ** 22, 2 ** 22)) for _ in range(5)]) for k in range(60)]
    assert sorted(tuple(x) for x in maxscore.top_k(spark.createDataFrame([(*x, "", "") for x in rows], VECTORS)).collect()) == brute(rows)


def test_fewer_rows_than_ranks_and_none(spark):
    rows = [(0, [1.0]), (1, [0.5])]
    assert [tuple(x) for x in maxscore.top_k(spark.createDataFrame([(*x, "", "") for x in rows], VECTORS)).collect()] == [(0, 1, 1, 64 * 32)]
    assert maxscore.top_k(spark.createDataFrame([], VECTORS)).collect() == []


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("https://WWW.Example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("http://example.com/fr/", "example.com", "/fr/", "com/", "allow"),
    ("http://a.net/es/", "a.net", "/es/", "net/es/", "block"),
    ("http://a.net/en/", "a.net", "/en/", None, "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("http://a.com?q=/x", "a.com", "", None, "allow"),
    ("http://notcom/x", "notcom", "/x", None, "allow"),
    ("no scheme casino", "", "", None, "block"),
    ("http://casino.org/", "casino.org", "/", None, "block"),
    ("http://casinos.org/", "casinos.org", "/", None, "allow"),
    ("http://my.org/free-BONUS", "my.org", "/free-BONUS", None, "block"),
    ("http://my.org/free/free", "my.org", "/free/free", None, "allow"),
    ("http://my.com/casino", "my.com", "/casino", "com/", "allow"),
    ("", "", "", None, "allow"), (None, "", "", None, "allow"),
])
def test_urls(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "clash"), (None, url, "clash"), (1, url, "clash")], "page_id long, url string, host string")
    rows = url_filter.judge_urls(pages).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [(host, path, rule, verdict)] * 3


def test_no_pages(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_long_vectors_and_tables_without_a_usable_one(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "BLOCK", 3)
    monkeypatch.setattr(maxscore, "SEARCH", 2)
    r = random.Random(5)
    rows = [(k, [r.randrange(-9, 9) / 64 for _ in range(3000)]) for k in range(0, 200, 5)]
    assert sorted(tuple(x) for x in maxscore.top_k(spark.createDataFrame([(*x, "", "") for x in rows], VECTORS)).collect()) == brute(rows)
    assert maxscore.top_k(spark.createDataFrame([(0, [float("nan")], "", ""), (20, None, "", "")], VECTORS)).collect() == []
