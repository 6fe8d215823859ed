"""Ordinals, periods, as-of, stays and snapshots against brute force, with hot keys, ties and NULLs."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyroll.operators import carry, intervals, ordinals, snapshots

DAY0 = date(2025, 6, 1)


def day(n):
    return None if n is None else DAY0 + timedelta(days=n)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- ordinals
def order_rows(spark, n, seed=1):
    r = random.Random(seed)
    rows = [(k, None if r.random() < 0.1 else 7 if r.random() < 0.5 else r.randrange(50), r.randrange(-5, 9)) for k in range(n)]
    return rows, spark.createDataFrame(rows, "id long, v int, w int").repartition(5)


def test_ordinals_equal_a_global_sort(spark):
    rows, df = order_rows(spark, 3000)
    found = ordinals.with_ordinals(df, [F.col("v").desc_nulls_last(), F.col("id").asc()])
    want = {k: n for n, (k, _, _) in enumerate(sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[0])), 1)}
    assert {r.id: r.place for r in found.collect()} == want
    assert "SinglePartition" not in plan(found) and found.columns == ["id", "v", "w", "place"]


def test_running_totals(spark):
    rows, df = order_rows(spark, 2000, 2)
    total, want = 0, {}
    for k, _, w in sorted(rows):
        total += w
        want[k] = total
    found = ordinals.with_running_total(df, [F.col("id")], "w")
    assert {r.id: r.running_total for r in found.collect()} == want and "SinglePartition" not in plan(found)
    some = ordinals.with_running_total(df.selectExpr("id", "CAST(CASE WHEN v > 20 THEN v / 2 END AS DOUBLE) AS x"), [F.col("id")], "x")
    assert abs(max(r.running_total for r in some.collect()) - sum(v / 2 for _, v, _ in rows if v and v > 20)) < 1e-6


def test_a_hot_value_fills_many_ranges(spark):
    df = spark.range(0, 4000, 1, 8).select("id", F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = ordinals.cut_path(ordinals._sorted_evenly(df, [F.col("v")]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1500


def test_ordinals_of_nothing(spark):
    none = spark.createDataFrame([], "id long, v int")
    assert ordinals.with_ordinals(none, [F.col("v")]).collect() == []
    assert ordinals.with_running_total(none, [F.col("v")], "v").collect() == []


# ---------------------------------------------------------------- periods
def periods(r, n, keys):
    out = []
    for k in range(n):
        start = None if r.random() < 0.05 else r.randrange(300)
        end = None if r.random() < 0.2 else (start or 0) + r.choice([-2, 0, 1, 3, 4, 5, 15, 16, 17, 64, 100, 250])
        out.append((k, None if r.random() < 0.05 else "hot" if r.random() < 0.4 else r.choice(keys), day(start), day(end)))
    return out


def shared_days(a, b):
    if None in (a[1], b[1], a[2], b[2]) or a[1] != b[1] or (a[3] and a[3] < a[2]) or (b[3] and b[3] < b[2]):
        return []
    ends = [x for x in (a[3], b[3]) if x]
    if not ends:
        return [None]
    days = (min(ends) - max(a[2], b[2])).days + 1
    return [days] if days > 0 else []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlaps_equal_brute_force(spark, seed):
    r = random.Random(seed)
    a, b = periods(r, 150, "xyz"), periods(r, 150, "xyz")
    a.append(a[0])
    schema = "id long, key string, s date, e date"
    found = intervals.overlapping(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ("s", "e"), ("s", "e"), [("key", "key")])
    want = sorted(((x[0], y[0], d) for x in a for y in b for d in shared_days(x, y)), key=repr)
    assert values(found.select("left_id", "right_id", "overlap_days")) == want
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)


def test_overlaps_without_keys_and_without_rows(spark):
    schema = "id long, s date, e date"
    a = spark.createDataFrame([(1, day(0), day(5)), (2, day(6), None), (3, None, day(1))], schema)
    b = spark.createDataFrame([(7, day(5), day(6)), (8, day(300), day(900))], schema)
    assert values(intervals.overlapping(a, b, ("s", "e"), ("s", "e")).select("left_id", "right_id", "overlap_days")) == [(1, 7, 1), (2, 7, 1), (2, 8, 601)]
    assert intervals.overlapping(a, b.limit(0), ("s", "e"), ("s", "e")).collect() == []


# ---------------------------------------------------------------- as-of and stays
@pytest.mark.parametrize("block", [1, 32])
def test_as_of_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(carry.block_of, "__defaults__", (block,))
    r = random.Random(5)
    pick = lambda: None if r.random() < 0.1 else "hot" if r.random() < 0.4 else r.choice("abc")
    left = [(k, pick(), day(None if r.random() < 0.1 else r.randrange(200))) for k in range(300)]
    right = [(k, pick(), day(None if r.random() < 0.1 else r.randrange(200)), None if r.random() < 0.2 else f"s{k}") for k in range(200)]
    ldf, rdf = spark.createDataFrame(left, "id long, key string, t date"), spark.createDataFrame(right, "seq long, rk string, rt date, school string")
    for within in (None, 9):
        found = carry.as_of(ldf, rdf, "key", "t", "rk", "rt", {"seq": "seq", "school": "school"}, "seq", ["id"], within)
        want = []
        for k, key, t in left:
            known = [x for x in right if key is not None and t is not None and x[1] == key and x[2] is not None and x[2] <= t]
            best = max(known, key=lambda x: (x[2], -x[0]), default=None)
            if best and within is not None and (t - best[2]).days > within:
                best = None
            want.append((k, key, t, best[0] if best else None, best[3] if best else None))
        assert values(found) == sorted(want, key=repr)
    assert carry.as_of(ldf.limit(0), rdf, "key", "t", "rk", "rt", {"seq": "seq"}, "seq", ["id"]).collect() == []
    assert {r.seq for r in carry.as_of(ldf, rdf.limit(0), "key", "t", "rk", "rt", {"seq": "seq"}, "seq", ["id"]).collect()} == {None}


@pytest.mark.parametrize("block,gap", [(1, 0), (7, 3), (32, 14)])
def test_stays_equal_brute_force(spark, monkeypatch, block, gap):
    monkeypatch.setattr(carry.block_of, "__defaults__", (block,))
    rows = periods(random.Random(block), 250, "abcdefgh")
    found = carry.stays(spark.createDataFrame(rows, "id long, key string, s date, e date"), "key", "s", "e", gap)
    want = []
    for key in {x[1] for x in rows if x[1]}:
        open_ = None
        for s, e in sorted((x[2], date.max if x[3] is None else max(x[3], x[2])) for x in rows if x[1] == key and x[2]):
            if open_ and (open_[2] == date.max or (s - open_[2]).days <= gap):
                open_[2], open_[3] = max(open_[2], e), open_[3] + 1
            else:
                open_ = [key, s, e, 1]
                want.append(open_)
    assert values(found) == sorted(((k, s, None if e == date.max else e, n) for k, s, e, n in want), key=repr)


def test_a_hot_students_rows_do_not_meet_in_one_task(spark):
    """A third of all rows of one key: windows see its distinct days alone."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
                                      F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("s")).withColumn("e", F.date_add("s", 3))
    found = carry.stays(rows, "key", "s", "e", 5)
    hot = found.filter("key = 'hot'").collect()
    assert len(hot) == 1 and hot[0].periods == 10_000 and found.agg(F.sum("periods")).first()[0] == 30_000


# ---------------------------------------------------------------- snapshots
def test_snapshots_equal_multisets(spark):
    r = random.Random(11)
    make = lambda n: [(r.choice([None, 1, 2, 3, 4]), r.choice([None, "", "a", "null"]), r.choice([None, 0.5, -0.0, 0.0])) for _ in range(n)]
    old, new = make(120), make(150)
    schema = "k int, t string, x double"
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    one, two = (Counter(repr((k, t, x if x is None else x + 0.0)) for k, t, x in side) for side in (old, new))
    want = {t: two[t] - one[t] for t in one | two if two[t] != one[t]}
    assert {repr(tuple(x)[:3]): x.difference for x in snapshots.multiset_difference(a, b.select("x", "k", "t").select("k", "t", "x")).collect()} == want
    assert snapshots.multiset_difference(a, a).collect() == [] and snapshots.changes_by_key(a, a, ["k"]).collect() == []


def test_kinds_of_change(spark):
    schema = "k int, t string"
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "a"), (4, "a"), (None, "a"), (6, "a")], schema)
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (3, "a"), (4, "a"), (5, "z"), (None, "b")], schema)
    assert values(snapshots.changes_by_key(old, new, ["k"])) == sorted([(2, "changed", 1, 1), (3, "repeated", 0, 1), (4, "merged", 1, 0), (5, "inserted", 0, 1), (None, "changed", 1, 1), (6, "deleted", 1, 0)], key=repr)
    assert values(snapshots.change_counts(old.limit(0), new, ["k"])) == [("inserted", 6, 0, 7)]
