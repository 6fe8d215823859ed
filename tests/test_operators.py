"""Operators against brute force, with hot keys, NULL keys and repeated rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyroll.operators import keys, lookups, measures, quality, windows
from tallyroll.plans import unify


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_left_on_key_keeps_every_row_and_null_never_matches(spark):
    left = spark.createDataFrame([(i, None if i % 3 == 0 else ("hot" if i % 3 == 1 else f"k{i}")) for i in range(300)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), (None, 2), ("k2", 3)], "rk string, v int")
    out = keys.left_on_key(left, right, F.col("k"), "rk", ["id"])
    assert out.columns == ["id", "k", "v"] and out.count() == 300
    got = {r.id: r.v for r in out.collect()}
    assert got[0] is None and got[1] == 1 and got[2] == 3 and got[5] is None


def test_rows_without_key_are_spread(spark):
    df = spark.range(20000).withColumn("k", F.lit(None).cast("string"))
    spread = df.select(keys.spread_key(F.col("k"), F.col("id")).alias("s")).distinct().count()
    assert spread > 1000


def test_first_and_latest_per_key(spark):
    data = [("a", date(2026, 1, 1), 3, "x"), ("a", date(2026, 2, 1), 2, "y"), ("a", date(2026, 2, 1), 1, "z"), ("b", None, 4, "w"), (None, date(2026, 1, 1), 5, "q")]
    df = spark.createDataFrame(data, "k string, d date, ord int, v string")
    assert rows(keys.first_per_key(df, ["k"], [F.col("ord")]), "k", "v") == [("a", "z"), ("b", "w")]
    assert rows(keys.latest_per_key(df, ["k"], "d", "ord"), "k", "v") == [("a", "z"), ("b", "w")]
    assert rows(keys.latest_with_count(df, "k", "d", "ord"), "k", "v", "enrollment_count") == [("a", "z", 3), ("b", "w", 1)]


def test_first_per_key_does_not_ship_a_hot_key_whole(spark):
    df = spark.range(100000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    plan = keys.first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_flag_members(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    keyset = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    assert rows(keys.flag_members(df, F.col("k"), keyset, "hit", ["id"]), "id", "hit") == [(1, True), (2, False), (3, False)]


def transitions_by_hand(data):
    out, last = [], {}
    for seq, who, s, e in sorted(data, key=lambda r: (r[1], r[2], r[3] or date.min, r[0])):
        prior = last.get(who)
        if prior is not None and s != prior:
            out.append((seq, prior, (s - prior).days, "Overlap" if s < prior else "Gap"))
        last[who] = e
    return sorted(out, key=repr)


def test_enrollment_transitions_with_a_hot_student(spark):
    rng = random.Random(3)
    day = date(2025, 7, 1)
    data = []
    for seq in range(1500):
        start = day + timedelta(days=rng.randrange(40))
        end = None if rng.random() < 0.2 else start + timedelta(days=rng.randrange(-1, 15))
        data.append((seq, "placeholder" if seq % 3 == 0 else f"s{rng.randrange(200)}", start, end))
    df = spark.createDataFrame(data, "seq int, who string, s date, e date")
    out = windows.enrollment_transitions(df, "who", "s", "e", "seq")
    assert rows(out, "seq", "prior_enddate", "days_between", "transition_type") == transitions_by_hand(data)


def test_dense_rank_equals_the_plain_window(spark):
    rng = random.Random(5)
    data = [(rng.choice([1990, 1991, None]), None if rng.random() < 0.1 else rng.choice([0.0, 7.5, rng.randrange(-50, 100000) / 4])) for _ in range(3000)]
    df = spark.createDataFrame(data, "y int, v double")
    from pyspark.sql import Window as W

    plain = df.withColumn("r", F.dense_rank().over(W.partitionBy("y").orderBy(F.col("v").desc_nulls_last())))
    assert rows(windows.dense_rank_desc(df, ["y"], "v", "r"), "y", "v", "r") == rows(plain, "y", "v", "r")


def test_previous_two_with_repeated_periods(spark):
    """Several rows per county and year: whatever their order, each row sees the two rows before it in one order."""
    rng = random.Random(7)
    data = [("hot" if i % 3 else f"c{i % 5}", 1990 + rng.randrange(6), i, float(rng.randrange(1000))) for i in range(400)]
    df = spark.createDataFrame(data, "county string, year int, tie int, v double")
    out = windows.with_previous_two(df, ["county"], "year", ["tie"], "v").collect()
    salt = {r.tie: r.s for r in df.select("tie", F.pmod(F.xxhash64("tie"), F.lit(windows.BLOCKS_PER_PERIOD)).alias("s")).collect()}
    expected, seen = {}, {}
    for county, year, tie, v in sorted(data, key=lambda r: (r[0], r[1], salt[r[2]], r[2])):
        before = seen.setdefault(county, [])
        expected[tie] = (before[-1] if before else None, before[-2] if len(before) > 1 else None)
        before.append(v)
    assert {r.tie: (r.prev_1, r.prev_2) for r in out} == expected


def test_previous_two_within_one_block(spark, monkeypatch):
    monkeypatch.setattr(windows, "BLOCKS_PER_PERIOD", 1)
    data = [("a", 1990 + i // 4, i, float(i)) for i in range(20)]
    df = spark.createDataFrame(data, "county string, year int, tie int, v double")
    got = {r.tie: (r.prev_1, r.prev_2) for r in windows.with_previous_two(df, ["county"], "year", ["tie"], "v").collect()}
    assert got == {i: (float(i - 1) if i > 0 else None, float(i - 2) if i > 1 else None) for i in range(20)}


def test_patch_takes_the_lowest_level_and_keeps_all_rows(spark):
    table = spark.createDataFrame([(0, "x", "zero"), (1, "y", "one"), (1, "x", "wrong")], "level int, key string, v string")
    df = spark.createDataFrame([(1, "x", "y", True), (2, None, "y", True), (3, None, None, True), (4, "x", "y", False), (5, "q", "q", True)], "id int, a string, b string, need boolean")
    out = lookups.patch(df, "id", F.col("need"), [F.col("a"), F.col("b")], table, ["v"])
    assert rows(out, "id", "a", "v") == [(1, "x", "zero"), (2, None, "one"), (3, None, None), (4, "x", None), (5, "q", None)]


def test_level_table_unique_levels_need_exactly_one_row(spark):
    src = spark.createDataFrame([("k", "a", 1), ("k", "b", 2), ("m", "c", 3)], "k string, v string, ord int")
    agg = [F.min_by("v", "ord").alias("found")]
    table = lookups.level_table(src, [F.col("k")], agg, [F.col("v"), F.col("ord")], unique_levels=[0])
    assert rows(table, "key", "found") == [("m", "c")]
    assert rows(lookups.level_table(src, [F.col("k")], agg, [F.col("v"), F.col("ord")]), "key", "found") == [("k", "a"), ("m", "c")]


@pytest.fixture
def roster_and_export(spark):
    columns = "row_id int, `Charter_Source Ticket #` string, `NYSSIS ID` string, `Student ID` string, `Last Name` string, `First Name` string, DOB date, `School Name` string, `Enroll Date` date, SPED_Flag string"
    d = date(2010, 1, 1)
    roster = spark.createDataFrame([
        (1, "A", "n1", None, "Lee", "Ann", d, "S", date(2025, 9, 3), "Gen Ed"),
        (2, "A", None, "s2", "Ray", "Bob", None, None, date(2025, 9, 3), "Gen Ed"),
        (3, "A", "0", "0", "Fox", "Cy", d, "0", date(2025, 9, 3), "Gen Ed"),
        (4, "A", "n9", "s9", "Kim", "Di", d, "S", date(2025, 9, 3), "Gen Ed"),
        (5, "A", None, None, "X", "Y", None, None, None, None),
    ], columns)
    st = spark.createDataFrame([
        (1, "n1", "s1", "ANN", "LEE", d, "School 1"), (2, "n2", "s2", "BOB", "RAY", date(2011, 2, 2), "School 2"),
        (3, "n3", "s3", "CY", "FOX", d, "School 3"), (4, "n3b", "s3b", "CY", "FOX", d, "School 3b"),
    ], "o int, nyssis string, sid string, fname string, lname string, dob date, school string")
    return roster, unify.combine_exports({"one": st}, "o")


def test_patches_fill_only_gaps_and_are_idempotent(spark, roster_and_export):
    roster, st = roster_and_export
    once = unify.patch_all(roster, st, "row_id")
    names = ["row_id", "NYSSIS ID", "Student ID", "DOB", "School Name"]
    d = date(2010, 1, 1)
    assert rows(once, *[f"`{n}`" for n in names]) == sorted([
        (1, "n1", "s1", d, "S"), (2, "n2", "s2", date(2011, 2, 2), "School 2"), (3, "n3", "s3", d, "School 3"),
        (4, "n9", "s9", d, "S"), (5, None, None, None, None)], key=repr)
    assert rows(unify.patch_all(once, st, "row_id"), *[f"`{n}`" for n in names]) == rows(once, *[f"`{n}`" for n in names])


def test_dedupe_within_charter(spark):
    d1, d2 = date(2025, 9, 3), date(2026, 1, 5)
    data = [
        (1, "A", "n1", d1, "Gen Ed"), (2, "A", "n1", d1, "SPED - Not on Gen Roster"),  # the general row wins
        (3, "A", "n2", d1, "Gen Ed"), (4, "A", "n2", d2, "Gen Ed"),  # re-enrollment: both stay
        (5, "A", "n3", d1, "Gen Ed"), (6, "A", "n3", None, "SPED"),  # true duplicate: first stays
        (7, "B", "n3", d1, "Gen Ed"),  # other charter
        (8, "A", None, d1, "Gen Ed"), (9, "A", "0", d1, "Gen Ed"), (10, "A", None, d1, "Gen Ed"),  # no ID
        (11, "A", "n4", d1, "not on gen roster"), (12, "A", "n4", d1, "not on gen roster"),
    ]
    df = spark.createDataFrame(data, "row_id int, `Charter_Source Ticket #` string, `NYSSIS ID` string, `Enroll Date` date, SPED_Flag string")
    assert [r[0] for r in rows(unify.dedupe_within_charter(df, "row_id").withColumn("z", F.format_string("%02d", "row_id")), "z")] == [
        "01", "03", "04", "05", "07", "08", "09", "10", "11"]


def test_distinct_counts_and_reconcile(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", None, 2), ("b", None, None)], "g string, p string, q int")
    got = rows(quality.distinct_counts(df, ["g"], ["p", "q"]), "g", "row_count", "distinct_p", "distinct_q")
    assert got == [("a", 3, 1, 2), ("b", 1, 0, 0)]
    roster = spark.createDataFrame([("A", "1"), ("A", "1"), ("A", "2"), ("A", None), ("B", None)], "charter string, nyssis_id string").withColumn("student_id", F.lit("s"))
    keyset = spark.createDataFrame([("1",)], "key string")
    out = quality.reconcile(roster, keyset)
    assert [tuple(map(str, r)) for r in rows(out, *out.columns)] == [("A", "4", "2", "1", "1", "50.00"), ("B", "1", "0", "0", "0", "None")]


def test_measures_on_ties_gaps_and_zeros(spark):
    data = [("a", 2000, 10.0, 4.0, "COMPLETE"), ("b", 2000, 10.0, 1.0, "INCOMPLETE"), ("a", 2002, 30.0, 6.0, "COMPLETE"), ("b", 2003, 0.0, 0.0, "COMPLETE")]
    df = spark.createDataFrame(data, "county string, year int, total_index_crimes double, violent_crime_total double, data_quality_flag string").withColumn("property_crime_total", F.lit(0.0))
    assert rows(measures.top_county(df, ["year"]), "year", "top_county") == [(2000, None), (2002, "a"), (2003, "b")]
    assert rows(measures.yoy_change(df), "year", "yoy_change_pct") == [(2000, None), (2002, None), (2003, -1.0)]
    assert rows(measures.moving_average(df, "violent_crime_total"), "county", "year", "moving_avg_3yr") == [("a", 2000, 4.0), ("a", 2002, 5.0), ("b", 2000, 1.0), ("b", 2003, 0.0)]
    assert measures.totals(df.filter("1 = 0")).head().completeness_rate == 0.0
    assert rows(measures.totals(df, ["year"]), "year", "violent_crime_rate") == [(2000, 0.25), (2002, 0.2), (2003, 0.0)]


def test_variance_counts_pairs_of_a_key_hot_on_both_sides(spark):
    st = spark.createDataFrame([("hot", "S", date(2026, 1, 1 + i % 9)) for i in range(90)] + [(None, "S", date(2026, 1, 1))],
                               "st_nyssis_id string, schoolname string, st_studentenrollment_startdate date")
    roster = spark.createDataFrame([("hot", date(2026, 1, 1 + i % 11)) for i in range(110)], "nyssis_id string, st_entry_date date")
    out = quality.variance_stats(quality.date_variance(st, roster)).head()
    pairs = sorted(abs((i % 9) - (k % 11)) for i in range(90) for k in range(110))
    assert out.compared_rows == len(pairs) and out.over_5_day_rows == sum(p > 5 for p in pairs)
    assert out.median_abs_variance_days == (pairs[len(pairs) // 2 - 1] + pairs[len(pairs) // 2]) / 2
    assert abs(float(out.avg_abs_variance_days) - sum(pairs) / len(pairs)) < 1e-6
