"""Audit that starts from one school's roster (all text, any headers) and looks up the enrollment export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll import config as cfg
from tallyroll.functions.dates import diff_days
from tallyroll.functions.text import blank_to_null, normalize_columns, present, resolve_id, strip
from tallyroll.operators import audit_rules as rules
from tallyroll.operators.keys import c, first_per_key, left_on_key
from tallyroll.session import cut_lineage
from tallyroll.sources.tables import conform_to_roles

NORMALIZED = ("nyssis", "student_id", "universal_id", "entry", "exit")


def _roles(df: DataFrame, patterns: dict, overrides: dict | None, keep: Sequence[str]) -> DataFrame:
    return conform_to_roles(df, patterns, overrides, keep=keep)


def _comparable(roles: DataFrame, patterns: dict, prefix: str, mode: str, done: Sequence[str] = ()) -> DataFrame:
    """Comparable text in every role but the disability column; role columns get the prefix."""
    columns = [r for r in patterns if r in NORMALIZED and r not in done]
    return normalize_columns(roles, columns, mode).withColumnsRenamed({role: prefix + role for role in patterns})


def _as_date(text: Column) -> Column:
    """Only text that the normalizer turned into an ISO date is a date."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def combine_rosters(rosters: dict[str, DataFrame], keep: Sequence[str],
                    overrides: dict[str, str | None] | None = None) -> DataFrame:
    """Several schools' rosters in role columns under one table with their ``school`` label."""
    frames = [
        _roles(df, cfg.AUDIT_ROSTER_PATTERNS, overrides, keep).withColumn("school", F.lit(label))
        for label, df in rosters.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def audit(
    rosters: dict[str, DataFrame], st: DataFrame, tolerance: int = 5, *, row_id: str, st_ordinal: str,
    dedupe_st: bool = True, mode: str = "reference",
    roster_overrides: dict[str, str | None] | None = None, st_overrides: dict[str, str | None] | None = None,
) -> DataFrame:
    """Every row of the rosters (school label -> raw table) with the 13 audit fields and its school label.

    All schools are audited in one join, so the export is read and shuffled once.
    ``row_id`` names a unique roster column, ``st_ordinal`` the ingest order of the
    export. With ``dedupe_st`` the first export row per state ID answers; without it
    every row does, multiplying the roster.
    """
    left = _comparable(combine_rosters(rosters, [row_id], roster_overrides), cfg.AUDIT_ROSTER_PATTERNS, "r_", mode)
    # The export is cut to one row per key before its other columns are normalized.
    keyed = normalize_columns(_roles(st, cfg.AUDIT_EXPORT_PATTERNS, st_overrides, [st_ordinal]), ["nyssis"], mode)
    if dedupe_st:
        keyed = first_per_key(keyed, ["nyssis"], [c(st_ordinal).asc()])
    right = _comparable(keyed, cfg.AUDIT_EXPORT_PATTERNS, "st_", mode, done=["nyssis"])
    right = right.withColumn("_found", F.lit(True)).drop(st_ordinal)
    joined = left_on_key(left, right, c("r_nyssis"), "st_nyssis", [row_id])

    found = F.coalesce(F.col("_found"), F.lit(False))
    ids = [blank_to_null(c(n)) for n in ("st_student_id", "st_universal_id", "r_student_id")]
    resolved = joined.withColumns({
        "resolved_studentid": resolve_id(*ids),
        "id_source": rules.id_source(*ids, blank_counts_as_value=False),
    })
    roster_sped, st_sped = present(strip(c("r_disability").cast("string"))), present(strip(c("st_disability").cast("string")))
    no_roster_exit, no_st_exit = ~present(c("r_exit")), ~present(c("st_exit"))
    compared = resolved.withColumns({
        "id_match_status": rules.roster_id_match(found, F.col("resolved_studentid"), F.col("school")),
        "is_iep_flag": rules.iep_flag(roster_sped),
        "roster_vs_disability_check": rules.roster_disability_check(found, roster_sped, st_sped),
        "entry_diff_days": diff_days(_as_date(c("r_entry")), _as_date(c("st_entry"))),
        "exit_diff_days": diff_days(_as_date(c("r_exit")), _as_date(c("st_exit"))),
    })
    entry_diff, exit_diff = F.col("entry_diff_days"), F.col("exit_diff_days")
    entry_missing = ~present(c("r_entry")) | ~present(c("st_entry"))
    dated = compared.withColumns({
        "entry_status_category": rules.date_category(entry_missing, entry_diff, tolerance),
        "exit_status_category": rules.date_category(no_roster_exit | no_st_exit, exit_diff, tolerance),
        "exit_issue_type": rules.roster_exit_issue(no_roster_exit, no_st_exit, exit_diff, tolerance),
    })
    match, entry_cat, exit_cat = F.col("id_match_status"), F.col("entry_status_category"), F.col("exit_status_category")
    check, issue, rid = F.col("roster_vs_disability_check"), F.col("exit_issue_type"), F.col("resolved_studentid")
    judged = dated.withColumn("final_validation_status", rules.roster_status(match, rid, entry_cat, exit_cat, check))
    return judged.select(
        c(row_id), "resolved_studentid", "id_source", "id_match_status", "is_iep_flag", "roster_vs_disability_check",
        "entry_diff_days", "entry_status_category", "exit_diff_days", "exit_status_category", "exit_issue_type",
        "final_validation_status",
        rules.severity(F.col("final_validation_status"), "roster").alias("severity"),
        rules.roster_action(match, rid, issue, entry_cat, check).alias("recommended_action"),
        "school",
    )


def exceptions(audited: DataFrame) -> DataFrame:
    return audited.filter(rules.is_exception(F.col("severity")))


def severity_summary(audited: DataFrame) -> DataFrame:
    """Rows per severity and status, most frequent first."""
    return (
        audited.groupBy("severity", "final_validation_status").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "severity", "final_validation_status")
    )


def run_counters(audited: DataFrame) -> DataFrame:
    """One row: all rows and rows per severity."""
    sev = F.col("severity")
    return audited.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(sev == s).alias(s.lower()) for s in ("Critical", "High", "Low", "None")],
    )


def report(audited: DataFrame, folder: str | None = None) -> dict[str, DataFrame]:
    """The three tabs of the audit report. The audit is written once, below the shared folder, and the tabs read it from there."""
    audited = cut_lineage(audited, folder)
    return {"Full_Audit": audited, "Exceptions": exceptions(audited), "Severity_Summary": severity_summary(audited)}
