"""The similarity join against brute force, with regions of all sizes."""

import random

import pytest

from tallyroll.llm import jaccard
from tallyroll.llm.components import components


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


def brute(rows, percent=75):
    """Component by row number, with pairs of all rows."""
    sets = [shingles(t) for _, t in rows]
    head = list(range(len(rows)))

    def root(k):
        while head[k] != k:
            k = head[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                head[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(sets[k]), least.get(root(k)), sum(s == sets[k] for s in sets) if sets[k] else 1) for k, (i, _) in enumerate(rows)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def near_copies(seed, groups, size, words=60, edits=4):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [r.choice(vocabulary) for _ in range(40)]
    texts = []
    for g in range(groups):
        base = [r.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(r.randrange(edits + 1)):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            texts.append(" ".join(own + (passage if r.random() < 0.3 else [])))
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("leaf", [32, 2])
def test_groups_of_near_copies(make, monkeypatch, leaf):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "SALT", 3)
    rows = near_copies(3, 12, 9)
    assert found(jaccard.jaccard_classes(make(rows))) == brute(rows)


def test_a_large_region_with_several_components(make, monkeypatch):
    """Texts that are one long common passage and a little of their own: every region is large, few members are linked."""
    monkeypatch.setattr(jaccard, "LEAF", 3)
    r = random.Random(9)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(k, f"{passage} " + " ".join(f"t{r.randrange(6)}_{j}" for j in range(r.randrange(2, 16)))) for k in range(90)]
    assert found(jaccard.jaccard_classes(make(rows))) == brute(rows)


def test_odd_rows(make):
    rows = [(5, "a b c"), (2, "A  b\tC"), (9, "a b c d"), (1, None), (4, ""), (7, " \n "), (None, "a b c"), (None, "only null ids here"), (5, "a b c"), (8, "é É x y z"), (6, "é É x y z\x0b"),
            (10, "word " * 5000), (11, "one two three four five six"), (12, "one two three four five six")]
    assert found(jaccard.jaccard_classes(make(rows, extra=True))) == brute(rows)


def test_threshold_is_met_exactly(make):
    # 6 of 8 shingles common: 75 of 100; 5 of 7: less.
    a = [f"w{k}" for k in range(11)]
    rows = [(1, " ".join(a)), (2, " ".join([*a[:10], "z"])), (3, " ".join(f"v{k}" for k in range(10))), (4, " ".join([*(f"v{k}" for k in range(9)), "q"]))]
    assert found(jaccard.jaccard_classes(make(rows))) == brute(rows)


def test_empty_table(make):
    assert jaccard.jaccard_classes(make([])).collect() == []


def test_components_of_chains_and_stars(spark):
    r = random.Random(4)
    names = [r.getrandbits(62) for _ in range(300)]
    edges = [(names[k], names[k + 1]) for k in range(120)] + [(names[200], names[k]) for k in range(201, 300)] + [(names[5], names[5])]
    labels = {row.node: row.label for row in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert len({labels[n] for n in names[:121]}) == 1 and len({labels[n] for n in names[200:]}) == 1
    assert len(set(labels.values())) == 2 and len(labels) == 221
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []
