"""Reconciliation, variance, key-quality and completeness profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.operators.keys import c, left_on_key


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(100.0 * part, whole).cast("decimal(5,2)")


def union_rosters(rosters: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """All rosters under one schema with their label; each value is (table, student-ID column)."""
    frames = [
        df.select(F.lit(label).alias("charter"), c("nyssis_id").cast("string").alias("nyssis_id"), c(sid).alias("student_id"))
        for label, (df, sid) in rosters.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def reconcile(roster_rows: DataFrame, st_keys: DataFrame) -> DataFrame:
    """Per charter: rows, distinct students, matched and unmatched students, match rate.

    Whether a student is matched depends on the key alone, so rows are first counted
    per (charter, key); the distinct counts are then plain counts. ``st_keys`` is one
    column of distinct keys.
    """
    per_key = roster_rows.groupBy("charter", "nyssis_id").agg(F.count(F.lit(1)).alias("_rows"))
    side = st_keys.select(F.col(st_keys.columns[0]).alias("_k"), F.lit(1).alias("_hit"))
    joined = left_on_key(per_key, side, F.col("nyssis_id"), "_k", ["charter"])
    students = F.count("nyssis_id")
    matched = F.count(F.when(F.col("_hit") == 1, F.col("nyssis_id")))
    return joined.groupBy("charter").agg(
        F.sum("_rows").alias("roster_rows"), students.alias("distinct_rostered_students"), matched.alias("matched_students"),
        (students - matched).alias("unmatched_students"), _percent(matched, students).alias("match_rate_pct"))


def date_variance(st: DataFrame, roster: DataFrame) -> DataFrame:
    """(schoolname, entry_diff_days, n): signed differences over all pairs of enrollment and roster rows with both dates.

    Both sides are counted per key and date before the join, so a key with many rows
    on both sides joins its dates, not its rows; ``n`` is the number of pairs.
    """
    left = st.filter(F.col("st_studentenrollment_startdate").isNotNull() & F.col("st_nyssis_id").isNotNull()).groupBy(
        F.col("st_nyssis_id").cast("string").alias("_k"), "schoolname", F.col("st_studentenrollment_startdate").alias("_st"),
    ).agg(F.count(F.lit(1)).alias("_n_st"))
    right = roster.filter(F.col("st_entry_date").isNotNull() & F.col("nyssis_id").isNotNull()).groupBy(
        F.col("nyssis_id").cast("string").alias("_k"), F.col("st_entry_date").alias("_roster"),
    ).agg(F.count(F.lit(1)).alias("_n_roster"))
    return left.join(right, "_k").select(
        "schoolname", F.datediff("_roster", "_st").alias("entry_diff_days"), (F.col("_n_st") * F.col("_n_roster")).alias("n"))


def variance_stats(diffs: DataFrame, limit: int = 5) -> DataFrame:
    """Per school: pairs, decimal mean and exact median of the absolute difference, pairs beyond the limit and their rate.

    The differences are first summed up per (school, days): a histogram as long as the
    calendar, from which all figures follow, the exact median included.
    """
    days = F.col("days")
    histogram = diffs.groupBy("schoolname", F.abs("entry_diff_days").alias("days")).agg(F.sum("n").alias("n"))
    pairs, over = F.sum("n"), F.sum(F.when(days > limit, F.col("n")).otherwise(0))
    return histogram.groupBy("schoolname").agg(
        pairs.alias("compared_rows"),
        (F.sum(days * F.col("n")).cast("decimal(18,2)") / pairs).cast("decimal(14,6)").alias("avg_abs_variance_days"),
        F.percentile("days", F.lit(0.5), F.col("n")).alias("median_abs_variance_days"),
        over.alias("over_5_day_rows"), _percent(over, pairs).alias("over_5_day_pct"),
    ).orderBy(F.desc("over_5_day_pct"), "schoolname")


def distinct_counts(df: DataFrame, by: Sequence[str], counted: Sequence[str]) -> DataFrame:
    """Rows and distinct values of several columns per group.

    Each (group, column, value) is counted once before the final sum, so no task
    holds the values of a hot group.
    """
    tagged = df.select(
        *[c(b) for b in by],
        F.inline(F.array(
            F.struct(F.lit(-1).alias("_which"), F.lit(None).cast("string").alias("_value")),
            *[F.struct(F.lit(i).alias("_which"), c(n).cast("string").alias("_value")) for i, n in enumerate(counted)])))
    once = tagged.groupBy(*[c(b) for b in by], "_which", "_value").agg(F.count(F.lit(1)).alias("_n"))
    return once.groupBy(*[c(b) for b in by]).agg(
        F.sum(F.when(F.col("_which") == -1, F.col("_n"))).alias("row_count"),
        *[F.count(F.when(F.col("_which") == i, F.col("_value"))).alias(f"distinct_{n}") for i, n in enumerate(counted)])


def conflicting_keys(st: DataFrame) -> DataFrame:
    """State IDs with several rows, student IDs or universal IDs."""
    keyed = st.filter(F.col("st_nyssis_id").isNotNull()).select(
        F.col("st_nyssis_id").cast("string").alias("normalized_nyssis_id"), "studentid", "student_universalstudentid")
    counts = distinct_counts(keyed, ["normalized_nyssis_id"], ["studentid", "student_universalstudentid"]).select(
        "normalized_nyssis_id", F.col("row_count").alias("enrollment_rows"),
        F.col("distinct_studentid").alias("distinct_student_ids"),
        F.col("distinct_student_universalstudentid").alias("distinct_universal_ids"))
    several = (F.col("enrollment_rows") > 1) | (F.col("distinct_student_ids") > 1) | (F.col("distinct_universal_ids") > 1)
    return counts.filter(several).orderBy(F.desc("enrollment_rows"), "normalized_nyssis_id")


def disability_representation(st: DataFrame) -> DataFrame:
    """Per school and grade: distinct students, those with a disability record, and their share."""
    per_student = st.filter(F.col("studentid").isNotNull()).groupBy("schoolname", "grade", "studentid").agg(
        F.max(F.col("schoolyear_disability").isNotNull().cast("int")).alias("_has"))
    students, having = F.count(F.lit(1)), F.sum("_has")
    return per_student.groupBy("schoolname", "grade").agg(
        students.alias("students"), having.alias("students_with_disability_record"),
        _percent(having, students).alias("disability_record_pct")).orderBy("schoolname", "grade")


def counts_by(df: DataFrame, by: Sequence[str], name: str = "rows") -> DataFrame:
    return df.groupBy(*[c(b) for b in by]).agg(F.count(F.lit(1)).alias(name))


def distributions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, value, rows) of several columns in one pass over the table."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), c(n).cast("string").alias("value")) for n in columns])
    return df.select(F.inline(pairs)).groupBy("field", "value").agg(F.count(F.lit(1)).alias("rows"))


def fte_totals(df: DataFrame, charter: str = "Charter_Source Ticket #", fte: str = "SCSD FTE") -> DataFrame:
    """FTE per charter and in all (charter NULL), three decimals."""
    return df.rollup(c(charter)).agg(F.round(F.sum(c(fte)), 3).alias("fte"))


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """Non-NULL keys with more than one row."""
    return df.filter(c(key).isNotNull()).groupBy(c(key)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_detail(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The rows behind duplicate_ids."""
    keys = duplicate_ids(df, key).select(c(key).alias("_dup"))
    return df.join(keys, c(key) == F.col("_dup"), "left_semi").select(*[c(n) for n in columns])


def missing_profile(df: DataFrame, bad_tokens: dict[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """Number of missing values per column, each column with its own pseudo-nulls."""
    return df.groupBy(*[c(b) for b in by]).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(c(n).isNull() | c(n).cast("string").isin(*tokens)).alias(f"missing_{n}")
          for n, tokens in bad_tokens.items()])


def verify(df: DataFrame, null_columns: Sequence[str], range_column: str, distinct_column: str, latest_column: str | None = None) -> DataFrame:
    """One row after a write: row count, NULLs per column, min/max, distinct values, latest ingest time.

    min/max follow the column's type: on text they are lexicographic.
    """
    aggregates = [F.count(F.lit(1)).alias("rows")]
    aggregates += [F.count_if(c(n).isNull()).alias(f"null_{n}") for n in null_columns]
    aggregates += [F.min(c(range_column)).alias(f"min_{range_column}"), F.max(c(range_column)).alias(f"max_{range_column}"),
                   F.count_distinct(c(distinct_column)).alias(f"distinct_{distinct_column}")]
    if latest_column is not None:
        aggregates.append(F.max(c(latest_column)).alias(f"latest_{latest_column}"))
    return df.agg(*aggregates)
