"""Column functions, case by case."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyroll.functions import dates, fte, text
from tallyroll.functions.ladders import ladder


def apply(spark, fn, values, kind="string"):
    """fn over a one-column table; results in input order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in df.select(fn(F.col("v")).alias("out"), "i").orderBy("i").select("out").collect()]


CASES = {
    "normalize_value": (text.normalize_value, {
        " a  b ": "A B", "12345.0": "12345", "00123": "123", "30123": "1982-06-21", "0030123": "1982-06-21", "20000": "20000",
        "60000": "60000", "59999": "2064-04-07", "02/14/2026 08:30": "2026-02-14", "2026-02-14 00:00:00": "2026-02-14", "2/3/26": "2026-02-03",
        "2-14-2026": "2026-02-14", "N/A": None, "": None, " null ": None, "é#1": "1", "a b": "A B", "2/30/2026": "2/30/2026",
        "2026-02-14T00:00:00": "2026-02-14T00:00:00", "2/3/2026 25:00": "2/3/2026 25:00", "x.y": "XY", "2026.02.14": "20260214", None: None}),
    "id_safe": (lambda c: text.normalize_value(c, "id_safe"), {"30123": "30123", "00123": "00123", "12345.0": "12345", "2/3/26": "2026-02-03"}),
    "normalize_name": (text.normalize_name, {" o'Neil-Smith  jr. ": "ONEILSMITH JR", "Ann  Lee": "ANN LEE", "": ""}),
    "clean_id": (text.clean_id, {"123.0": "123", "123.00": "123", "10.05": "10.05", "NaN": None, " 7 ": "7", "NULL": None}),
    "strip_decimal_zero": (text.strip_decimal_zero, {"123.0": "123", "123.00": "123.00", " 5 ": "5"}),
    "clean_fte": (text.clean_fte, {"0.5": 0.5, "50%": 50.0, "x": None, " 1 ": 1.0, "": None}),
    "split_last": (text.split_last, {"Last, First M": "Last", "Single": "Single", "": None}),
    "split_first": (text.split_first, {"Last, First M": "First M", "Single": "", "A,B": "B"}),
    "title_case": (text.title_case, {"  NORTH county TOTAL ": "North County Total"}),
    "comparable_status": (text.comparable_status, {
        "Not in ST System": "Not Found-Needs Manual Review", " Good ": "Good", "": None, "NA": None, "Other": "Other"}),
    "null_tokens": (lambda c: text.null_tokens(c, ("0", "")), {"0": None, "": None, "1": "1"}),
    "resolve_id": (lambda c: text.resolve_id(c, F.lit("z")), {"": "z", None: "z", "a": "a"}),
}


@pytest.mark.parametrize("name", CASES)
def test_text(spark, name):
    fn, cases = CASES[name]
    assert apply(spark, fn, list(cases)) == list(cases.values())


D = date
DATE_CASES = {
    "normalize_dob": (dates.normalize_dob, {
        "45839": D(2025, 7, 1), "45839.0": D(2025, 7, 1), "20260214": D(2026, 2, 14), "14FEB2026": D(2026, 2, 14),
        "14-Feb-26": D(2026, 2, 14), "14-feb-1970": D(1970, 2, 14), "2026.02.14": D(2026, 2, 14), "31/12/2010": D(2010, 12, 31),
        "02/14/70": D(1970, 2, 14), "02/14/68": D(2068, 2, 14), "NULL": None, "2/30/2024": None, "20000": None, "60000": None, "12/2010": None}),
    "parse_billing": (dates.parse_billing, {
        "45839": D(2025, 7, 1), "39000": D(2006, 10, 10), "70000": None, "2026-02-14T00:00:00": D(2026, 2, 14), "0": None,
        "2/3/2026": D(2026, 2, 3), "2/3/26": D(2026, 2, 3), "02/14/2026 08:30:00": D(2026, 2, 14), "nan": None, "None": None, " ": None}),
    "parse_billing_mixed": (dates.parse_billing_mixed, {
        "45839": D(2025, 7, 1), "39000": D(2006, 10, 10), "70000": D(2091, 8, 25), "0": D(1899, 12, 30), "#N/A": None, "2/3/26": D(2026, 2, 3)}),
    "parse_roster": (dates.parse_roster, {
        "45839": D(2025, 7, 1), "39000": D(2006, 10, 10), "70000": D(2091, 8, 25), "0": None, "2-3-2026": D(2026, 2, 3),
        "31.12.2010": D(2010, 12, 31), "2026/2/3": D(2026, 2, 3), "null": None, "20000": None}),
    "parse_roster_recent": (dates.parse_roster_recent, {
        "45839": D(2025, 7, 1), "39000": None, "70000": D(2091, 8, 25), "80000": None, "2/3/2026": D(2026, 2, 3)}),
    "clamp": (lambda c: dates.clamp_to(c.cast("date"), D(2025, 9, 3)), {
        "2025-07-01": D(2025, 9, 3), "2025-10-01": D(2025, 10, 1), None: None}),
    "short_date": (lambda c: dates.short_date(c.cast("date")), {"2026-02-03": "2/3/26", "2025-12-31": "12/31/25"}),
}


@pytest.mark.parametrize("name", DATE_CASES)
def test_dates(spark, name):
    fn, cases = DATE_CASES[name]
    assert apply(spark, fn, list(cases)) == list(cases.values())


def weeks_by_hand(s, e):
    """The week rule, one week after the other."""
    from datetime import timedelta

    def month_end(d):
        return (d.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)

    def count(lo, hi, limit):
        wk, n, first = lo - timedelta(days=lo.weekday()), 0, True
        while wk <= hi:
            end = wk + timedelta(days=6)
            days = (min(hi, end) - max(lo, wk)).days + 1
            n += days >= 3 and not (first and limit and end > limit)
            wk, first = wk + timedelta(days=7), False
        return n

    cap = lambda n, d: min(n, 5 if d.month == 7 else 4)
    idx = lambda d: d.month - 6 if d.month >= 7 else d.month + 6
    days = (e - s).days + 1
    if days <= 3:
        return 1 if days == 3 else 0
    if idx(s) == idx(e):
        return cap(count(s, min(e, month_end(s)), month_end(s)), s)
    return cap(count(s, month_end(s), month_end(s)), s) + cap(count(e.replace(day=1), e, None), e) + max(0, idx(e) - idx(s) - 1) * 4


def test_fte_weeks_against_the_rule(spark):
    from datetime import timedelta

    first = D(2025, 6, 25)
    pairs = [(first + timedelta(days=a), first + timedelta(days=a + b)) for a in range(0, 380, 3) for b in (-4, 0, 1, 2, 3, 6, 9, 16, 27, 45, 90, 200, 290, 366)]
    df = spark.createDataFrame(pairs, "s date, e date")
    got = df.select("s", "e", fte.student_weeks(F.col("s"), F.col("e")).alias("w"), fte.fte(F.col("s"), F.col("e")).alias("f")).collect()
    assert len(got) == len(pairs)
    for r in got:
        expected = weeks_by_hand(r.s, r.e)
        assert r.w == expected, (r.s, r.e)
        assert r.f == round(min(expected / 40, 1), 3) and 0 <= r.f <= 1


@pytest.mark.parametrize("start,end,method,expected", [
    ("2025-09-03", "2026-06-30", "weeks", 1.0), ("2025-10-30", "2026-01-02", "weeks", 0.2), ("2025-09-03", None, "weeks", 1.0),
    (None, "2026-06-30", "weeks", None), ("2025-09-03", "2025-11-12", "continuous", 1.0), ("2025-09-03", "2025-09-17", "continuous", 0.2),
    ("2025-09-03", None, "sheet", 1.0), ("2026-01-05", "2026-02-02", "sheet", 0.1), ("2026-02-02", "2026-01-05", "sheet", 0.0),
    ("2026-02-02", "2026-01-05", "continuous", 0.0), ("2026-02-02", "2026-01-05", "weeks", 0.0)])
def test_fte_methods(spark, start, end, method, expected):
    df = spark.createDataFrame([(start, end)], "s string, e string").select(F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"))
    assert df.select(fte.fte(F.col("s"), F.col("e"), method=method)).head()[0] == expected


def test_unknown_choices_are_refused(spark):
    with pytest.raises(ValueError):
        fte.fte(F.lit(None).cast("date"), F.lit(None).cast("date"), method="monthly")
    with pytest.raises(ValueError):
        text.normalize_value(F.lit("x"), "other")
    with pytest.raises(ValueError):
        dates.parse(F.lit("x"), ["yyyy"])


def test_name_key_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([(" ann ", "Lee"), (None, "Lee"), ("ann", None)], "a string, b string")
    assert [r[0] for r in df.select(text.name_key(F.col("a"), F.col("b"))).collect()] == ["ANN|LEE", None, None]


def test_ladder_takes_the_first_true_branch(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    x = F.col("x")
    assert [r[0] for r in df.select(ladder([(x == 1, "one"), (x < 5, "small")], "other")).collect()] == ["one", "small", "other"]
