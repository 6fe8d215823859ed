"""Queries of the operators along time and order, with their SQL: ordinals, periods, as-of, stays, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.inputs import Inputs
from checks.oracles import query as sql
from tallyroll.operators import carry, intervals, ordinals, snapshots

START, END, STUDENT = "st_studentenrollment_startdate", "st_studentenrollment_enddate", "student_universalstudentid"


def ordinals_of_enrollments(i: Inputs) -> DataFrame:
    """Every enrollment's place by start date, newest first."""
    rows = i.st_enrollment().select("enrollment_seq", START)
    return ordinals.with_ordinals(rows, [F.col(START).desc_nulls_last(), F.col("enrollment_seq").asc()], folder=i.folder("places")).select("enrollment_seq", "place")


def running_enrolled_days(i: Inputs) -> DataFrame:
    """Enrolled days so far, by start date; open enrollments add nothing."""
    rows = i.st_enrollment().select("enrollment_seq", START, F.datediff(END, START).alias("days"))
    found = ordinals.with_running_total(rows, [F.col(START), F.col("enrollment_seq")], "days", folder=i.folder("totals"))
    return found.select("enrollment_seq", "days", "running_total")


def _weeks(i: Inputs) -> DataFrame:
    """The billing weeks in which an enrollment starts."""
    monday = F.date_trunc("week", START).cast("date")
    return i.st_enrollment().select(monday.alias("week_start")).distinct().withColumn("week_end", F.date_add("week_start", 6))


def interval_billing_weeks(i: Inputs) -> DataFrame:
    """Enrollments and enrolled days by school and billing week."""
    st = i.st_enrollment().select("enrollment_seq", "schoolname", START, END)
    pairs = intervals.overlapping(st, _weeks(i), (START, END), ("week_start", "week_end"))
    return pairs.groupBy("left_schoolname", "right_week_start").agg(F.count(F.lit(1)).alias("enrollments"), F.sum("overlap_days").alias("enrolled_days")).select(
        F.col("left_schoolname").alias("schoolname"), F.col("right_week_start").alias("week_start"), "enrollments", "enrolled_days")


def interval_own_overlaps(i: Inputs) -> DataFrame:
    """Pairs of enrollments of one student that share days."""
    st = i.st_enrollment().select("enrollment_seq", STUDENT, "schoolname", START, END)
    pairs = intervals.overlapping(st, st, (START, END), (START, END), [(STUDENT, STUDENT)], "a_", "b_").filter("a_enrollment_seq < b_enrollment_seq")
    return pairs.select("a_enrollment_seq", "b_enrollment_seq", F.col(f"a_{STUDENT}").alias("student"), "a_schoolname", "b_schoolname", "overlap_days")


def _as_of(i: Inputs, within: int | None) -> DataFrame:
    roster = i.roster().select("c_custkey", "nyssis_id", "st_entry_date")
    return carry.as_of(roster, i.st_enrollment(), "nyssis_id", "st_entry_date", STUDENT, START,
                       {"enrollment_seq": "valid_seq", "schoolname": "valid_school", START: "valid_from"}, "enrollment_seq", ["c_custkey"], within)


def asof_enrollment_on_roster_date(i: Inputs) -> DataFrame:
    """The enrollment that was the last to start on or before the roster's date."""
    return _as_of(i, None)


def asof_enrollment_within_30_days(i: Inputs) -> DataFrame:
    return _as_of(i, 30)


def stays_of_students(i: Inputs) -> DataFrame:
    """Enrollments of a student with gaps of up to 14 days, as one stay."""
    return carry.stays(i.st_enrollment(), STUDENT, START, END, 14)


def _deliveries(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """An export, and the next one: rows gone, changed, repeated, new."""
    old = i.st_enrollment().select("enrollment_seq", STUDENT, "studentid", "grade", "schoolname", START)
    seq = F.col("enrollment_seq")
    new = old.filter(seq % 17 != 0).withColumn("grade", F.when(seq % 19 == 0, F.lit(None)).otherwise(F.col("grade")))
    new = new.unionByName(old.filter(seq % 23 == 0)).unionByName(old.filter(seq % 29 == 0).withColumn("enrollment_seq", -seq))
    return old, new


def snapshot_difference(i: Inputs) -> DataFrame:
    return snapshots.multiset_difference(*_deliveries(i))


def snapshot_changes_by_key(i: Inputs) -> DataFrame:
    return snapshots.changes_by_key(*_deliveries(i), ["enrollment_seq"])


def snapshot_change_counts(i: Inputs) -> DataFrame:
    return snapshots.change_counts(*_deliveries(i), ["enrollment_seq"])


BUILDERS = (ordinals_of_enrollments, running_enrolled_days, interval_billing_weeks, interval_own_overlaps, asof_enrollment_on_roster_date,
            asof_enrollment_within_30_days, stays_of_students, snapshot_difference, snapshot_changes_by_key, snapshot_change_counts)

_AS_OF = """SELECT c_custkey, r.nyssis_id, CAST(r.st_entry_date AS VARCHAR) AS st_entry_date, valid_seq, valid_school, CAST(valid_from AS VARCHAR) AS valid_from
FROM roster r LEFT JOIN (
  SELECT c_custkey AS k, enrollment_seq AS valid_seq, schoolname AS valid_school, st_studentenrollment_startdate AS valid_from,
    row_number() OVER (PARTITION BY c_custkey ORDER BY st_studentenrollment_startdate DESC, enrollment_seq) AS o
  FROM roster q JOIN st_enrollment s ON s.student_universalstudentid = q.nyssis_id AND s.st_studentenrollment_startdate <= q.st_entry_date) f
ON f.k = r.c_custkey AND f.o = 1{within}"""
_DELIVERIES = """old AS (SELECT enrollment_seq, student_universalstudentid, studentid, grade, schoolname, CAST(st_studentenrollment_startdate AS VARCHAR) AS st_studentenrollment_startdate FROM st_enrollment),
new AS (SELECT * REPLACE (CASE WHEN enrollment_seq % 19 = 0 THEN NULL ELSE grade END AS grade) FROM old WHERE enrollment_seq % 17 <> 0
  UNION ALL SELECT * FROM old WHERE enrollment_seq % 23 = 0 UNION ALL SELECT * REPLACE (-enrollment_seq AS enrollment_seq) FROM old WHERE enrollment_seq % 29 = 0),
gone AS (SELECT * FROM old EXCEPT ALL SELECT * FROM new), came AS (SELECT * FROM new EXCEPT ALL SELECT * FROM old)"""
_CHANGES = """changes AS (
  SELECT enrollment_seq, CASE WHEN enrollment_seq NOT IN (SELECT enrollment_seq FROM old) THEN 'inserted' WHEN enrollment_seq NOT IN (SELECT enrollment_seq FROM new) THEN 'deleted'
    WHEN removed > 0 OR enrollment_seq IN (SELECT enrollment_seq FROM (SELECT * FROM came EXCEPT SELECT * FROM old)) THEN 'changed' ELSE 'repeated' END AS change, removed, added
  FROM (SELECT enrollment_seq, CAST(sum(r) AS BIGINT) AS removed, CAST(sum(a) AS BIGINT) AS added
    FROM (SELECT enrollment_seq, 1 AS r, 0 AS a FROM gone UNION ALL SELECT enrollment_seq, 0, 1 FROM came) GROUP BY enrollment_seq))"""


def _delivered(body: str, *more: str) -> str:
    return sql("SELECT * FROM (WITH " + ", ".join((_DELIVERIES, *more)) + " " + body + ")", "st_enrollment")


SQL = {
    "ordinals_of_enrollments": sql("SELECT enrollment_seq, row_number() OVER (ORDER BY st_studentenrollment_startdate DESC NULLS LAST, enrollment_seq) AS place FROM st_enrollment", "st_enrollment"),
    "running_enrolled_days": sql("""SELECT enrollment_seq, CAST(days AS INTEGER) AS days, CAST(coalesce(sum(days) OVER (ORDER BY start, enrollment_seq ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS running_total
FROM (SELECT enrollment_seq, st_studentenrollment_startdate AS start, date_diff('day', st_studentenrollment_startdate, st_studentenrollment_enddate) AS days FROM st_enrollment)""", "st_enrollment"),
    "interval_billing_weeks": sql("""SELECT schoolname, CAST(week_start AS VARCHAR) AS week_start, count(*) AS enrollments,
  CAST(sum(date_diff('day', greatest(week_start, st_studentenrollment_startdate), least(week_start + 6, coalesce(st_studentenrollment_enddate, DATE '9999-01-01'))) + 1) AS BIGINT) AS enrolled_days
FROM st_enrollment JOIN (SELECT DISTINCT CAST(date_trunc('week', st_studentenrollment_startdate) AS DATE) AS week_start FROM st_enrollment) w
ON st_studentenrollment_startdate <= week_start + 6 AND coalesce(st_studentenrollment_enddate, DATE '9999-01-01') >= week_start GROUP BY ALL""", "st_enrollment"),
    "interval_own_overlaps": sql("""SELECT a.enrollment_seq AS a_enrollment_seq, b.enrollment_seq AS b_enrollment_seq, a.student_universalstudentid AS student, a.schoolname AS a_schoolname, b.schoolname AS b_schoolname,
  CASE WHEN a.st_studentenrollment_enddate IS NOT NULL OR b.st_studentenrollment_enddate IS NOT NULL THEN CAST(date_diff('day', greatest(a.st_studentenrollment_startdate, b.st_studentenrollment_startdate),
    least(coalesce(a.st_studentenrollment_enddate, DATE '9999-01-01'), coalesce(b.st_studentenrollment_enddate, DATE '9999-01-01'))) + 1 AS INTEGER) END AS overlap_days
FROM st_enrollment a JOIN st_enrollment b ON a.student_universalstudentid = b.student_universalstudentid AND a.enrollment_seq < b.enrollment_seq
  AND a.st_studentenrollment_startdate <= coalesce(b.st_studentenrollment_enddate, DATE '9999-01-01') AND b.st_studentenrollment_startdate <= coalesce(a.st_studentenrollment_enddate, DATE '9999-01-01')""", "st_enrollment"),
    "asof_enrollment_on_roster_date": sql(_AS_OF.format(within=""), "roster", "st_enrollment"),
    "asof_enrollment_within_30_days": sql(_AS_OF.format(within=" AND date_diff('day', valid_from, r.st_entry_date) <= 30"), "roster", "st_enrollment"),
    "stays_of_students": sql("""SELECT student_universalstudentid, CAST(min(s) AS VARCHAR) AS stay_start, CAST(CASE WHEN max(e) < DATE '9999-12-31' THEN max(e) END AS VARCHAR) AS stay_end, count(*) AS periods
FROM (SELECT *, sum(CASE WHEN reach IS NULL OR date_diff('day', reach, s) > 14 THEN 1 ELSE 0 END) OVER (PARTITION BY student_universalstudentid ORDER BY s, e, q ROWS UNBOUNDED PRECEDING) AS stay
  FROM (SELECT *, max(e) OVER (PARTITION BY student_universalstudentid ORDER BY s, e, q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
    FROM (SELECT student_universalstudentid, enrollment_seq AS q, st_studentenrollment_startdate AS s, coalesce(st_studentenrollment_enddate, DATE '9999-12-31') AS e
      FROM st_enrollment WHERE student_universalstudentid IS NOT NULL AND st_studentenrollment_startdate IS NOT NULL)))
GROUP BY student_universalstudentid, stay""", "st_enrollment"),
    "snapshot_difference": _delivered("SELECT *, -count(*) AS difference FROM gone GROUP BY ALL UNION ALL SELECT *, count(*) FROM came GROUP BY ALL"),
    "snapshot_changes_by_key": _delivered("SELECT * FROM changes", _CHANGES),
    "snapshot_change_counts": _delivered("SELECT change, count(*) AS keys, CAST(sum(removed) AS BIGINT) AS removed, CAST(sum(added) AS BIGINT) AS added FROM changes GROUP BY change", _CHANGES),
}
