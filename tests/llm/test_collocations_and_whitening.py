"""Phrases and components against brute force."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tallyroll.llm import collocations, whitening

LANGS = ["en", "de", None]


def brute(rows, longest=4, least=3, top=2000):
    """rows: (lang, text)."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i:i + m])] += 1
    out = []
    frequent = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    for (lang, g), a in frequent.items():
        if any(la == lang and len(h) > len(g) and 100 * b >= 80 * a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1)) for (la, h), b in frequent.items()):
            continue
        score, k = min((2000000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g)))
        out.append((lang, " ".join(g), a, f[lang, g[:k]], f[lang, g[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    seen = Counter()
    ranked = []
    for r in out:
        seen[r[0]] += 1
        if seen[r[0]] <= top:
            ranked.append((r[0], seen[r[0]], *r[1:]))
    return ranked


def found(df):
    return [tuple(r) for r in df.orderBy("lang", "rank").collect()]


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "a", "river", "bank", "new", "york", "city", "hall", "éa", "ÉA", "Zürich", "x\x1cy", "\x00", "😀"]
    fixed = ["new york city hall", "a of the river", "bank of the river bank"]
    rows = []
    for _ in range(n):
        words = [r.choice(fixed) if r.random() < 0.3 else r.choice(vocabulary) for _ in range(r.randrange(25))]
        rows.append((r.choice(LANGS), "".join(w + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", ";"]) for w in words)))
    return rows


def documents(spark, rows):
    return spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").selectExpr("*", "'clash' AS id", "1 AS f", "2 AS c", "'z' AS word", "'q' AS phrase", "0 AS n")


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_phrases_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(collocations, "BLOCK", block)
    rows = [*texts(1, 220), ("en", None), ("en", ""), ("fr", "a b"), (None, "under und"), ("en", "the the the the the the the"), *[("en", "copy of one text that repeats")] * 9]
    assert found(collocations.collocations(documents(spark, rows), least=3)) == brute(rows)


def test_top_keeps_order_among_ties(spark):
    rows = texts(2, 150)
    assert found(collocations.collocations(documents(spark, rows), least=4, top=5)) == brute(rows, least=4, top=5)


def test_a_full_bitmap_prunes_nothing_and_changes_nothing(spark, monkeypatch):
    rows = texts(3, 120)
    monkeypatch.setattr(collocations, "in_bitmap", lambda groups, marks, bits: np.ones(len(groups), bool))
    assert found(collocations.collocations(documents(spark, rows), least=3)) == brute(rows)


def test_very_long_text_and_empty_tables(spark):
    rows = [("en", "one two three four five. " * 40_000)]
    got = found(collocations.collocations(documents(spark, rows)))
    assert got[0][:4] == ("en", 1, "one two three four", 40_000) and len(got) == 2
    assert found(collocations.collocations(documents(spark, rows).limit(0))) == []
    assert found(collocations.collocations(documents(spark, [("en", None)]))) == []


def test_polynomial_and_roots_are_exact(spark):
    r = np.random.default_rng(3)
    for d in (1, 2, 5, 9):
        b = r.integers(-40, 40, (d, max(1, d - (d == 9)))).astype(object)
        m = (b @ b.T).tolist()
        got = whitening.characteristic_polynomial(spark, m)
        # Faddeev-LeVerrier in fractions.
        a, c, k = np.array([[Fraction(x) for x in row] for row in m], object).reshape(d, d), [Fraction(1)], np.zeros((d, d), object)
        for step in range(1, d + 1):
            k = a @ (k + np.eye(d, dtype=int).astype(object) * c[-1]) if step > 1 else a
            c.append(-sum(k[i][i] for i in range(d)) / step)
        assert got == [int(x) for x in c[::-1]]
        trace = sum(m[i][i] for i in range(d))
        roots = [at / 2 ** bits for at, bits in whitening.largest_roots(got, trace, 4)]
        true = np.linalg.eigvalsh(np.array(m, float).reshape(d, d))[::-1]
        assert np.allclose(roots, true[:len(roots)], rtol=1e-9) and len(roots) == min(4, sum(true > 1e-6))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS x", "'clash' AS id", "3 AS n", "0 AS d", "4 AS component")


def brute_whiten(rows, k=4):
    keep = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in keep}), np.int64)
    n, s = len(fit), fit.sum(axis=0)
    e, v = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True).reshape(fit.shape[1], -1))
    order = np.argsort(e)[::-1][:k]
    out = {}
    for i, x in keep:
        c = n * np.array(x) - s
        for j, o in enumerate(order):
            out.setdefault((i, j + 1), []).append((n, int((c.astype(object) ** 2).sum()), abs(float(c @ v[:, o]) / n / np.sqrt(e[o])), e[o] / e.sum()))
    return out


def test_whitening_equals_floating_point(spark):
    r = np.random.default_rng(7)
    mix = r.normal(size=(6, 6))
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(r.normal(size=(300, 6)) @ mix)]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (0, rows[5][1]), (None, rows[3][1]), (402, None), (403, []), (404, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (405, [float("nan")] * 6), (406, [float("inf")] + [0.0] * 5), (407, [0.5, 0.25])]
    whole = [x for x in rows if x[0] != 407]
    got = {}
    for row in whitening.whiten(vectors(spark, rows)).collect():
        got.setdefault((row.vec_id, row.component), []).append(row)
        assert row.identity_error < 1e-9
    want = brute_whiten(whole)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in want.items()}
    for key, some in want.items():
        for a, b in zip(sorted(some), sorted(((x.n, x.deviation, abs(x.whitened), x.explained) for x in got[key])), strict=True):
            assert a[:2] == b[:2] and np.allclose(a[2:], b[2:], rtol=1e-7, atol=1e-9)
    # One sign for all rows: whitened columns have mean 0 over the fit list.
    once = {k: v[0].whitened for k, v in got.items() if k[0] is not None and 0 < k[0] < 300}
    for c in range(1, 5):
        assert abs(np.mean([w for k, w in once.items() if k[1] == c])) < 0.2


def test_equal_eigenvalues_give_orthogonal_components(spark):
    corner = [(k, [float(s * (j == i)) for j in range(3)]) for k, (i, s) in enumerate([(i, s) for i in range(3) for s in (1, -1)])]
    rows = whitening.whiten(vectors(spark, corner)).collect()
    assert len(rows) == 18 and all(abs(r.explained - 1 / 3) < 1e-12 and r.identity_error < 1e-12 for r in rows)


def test_few_or_equal_vectors_and_empty_tables(spark):
    assert whitening.whiten(vectors(spark, [(1, [0.5, 0.25])] * 3)).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None)])).collect() == []
    assert whitening.whiten(vectors(spark, [])).collect() == []
    two = whitening.whiten(vectors(spark, [(1, [0.5, 0.25]), (2, [0.0, 0.0])])).collect()
    assert [(r.component, round(abs(r.whitened), 9), r.n) for r in two] == [(1, 1.0, 2)] * 2


def test_huge_entries_stay_exact(spark):
    rows = [(k, [2.0 ** 40 * k, float(k * k)]) for k in range(5)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(vectors(spark, rows)).collect() if r.component == 1}
    x = [[2 ** 48 * k, 256 * k * k] for k in range(5)]
    s = [sum(c) for c in zip(*x, strict=True)]
    want = {k: sum((5 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for k, v in enumerate(x)}
    assert got == {k: v if v < 1 << 63 else None for k, v in want.items()}


def test_blocks_go_to_python_one_by_one(spark, monkeypatch):
    from tallyroll.llm import collocations as setm

    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, plain = spark.conf.get(name), setm.land
    monkeypatch.setattr(setm, "land", lambda df, to: seen.append((to, df.sparkSession.conf.get(name))) or plain(df, to))
    docs = spark.createDataFrame([("en", "a b c d " * 40)], "lang string, text string")
    assert setm.collocations(docs, least=30).count() > 0
    batches = dict(seen)
    assert {batches[n] for n in ("vocabulary", "frequent-2", "frequent-3", "frequent-4")} == {"1"}
    assert batches["frequent-1"] == before == spark.conf.get(name)
