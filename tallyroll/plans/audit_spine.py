"""Audit that starts from the enrollment system and looks the student up in four rosters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.functions.dates import diff_days
from tallyroll.functions.text import resolve_id
from tallyroll.operators import audit_rules as rules
from tallyroll.operators.keys import left_on_key, left_on_same_key

# Roster label -> column carrying its student ID; the order decides which match is reported.
ROSTER_IDS = {
    "Southside": "southside_student_id",
    "SASCCS": "sasccs_student_id",
    "SAS": "sas_student_id",
    "OnTech": "ontech_sped_student_id",
}
CONTEXT = (
    "student_universalstudentid", "studentid", "firstname", "lastname", "person_dob", "grade", "schoolname",
    "st_studentenrollment_startdate", "st_studentenrollment_enddate", "schoolyear_disability", "st_nyssis_id",
)
FIELDS = (
    "resolved_studentid", "id_match_status", "id_source", "is_iep_flag", "roster_vs_disability_check",
    "entry_diff_days", "entry_status_category", "exit_diff_days", "exit_status_category", "exit_issue_type",
    "final_validation_status", "severity", "recommended_action",
)


def join_rosters(st: DataFrame, southside: DataFrame, sasccs: DataFrame, sas: DataFrame, ontech: DataFrame,
                 identity: str = "enrollment_seq") -> DataFrame:
    """LEFT JOIN of the four rosters on the state ID as text; a repeated roster key multiplies rows.

    All four joins use the same key, so the enrollment table is shuffled once.
    """
    key = "_spine_key"
    sides = (
        southside.select(F.col("nyssis_id").cast("string").alias(key), F.col("student_id").alias("southside_student_id"),
                         F.col("st_entry_date").alias("southside_st_entry_date"),
                         F.col("st_exit_date").alias("southside_st_exit_date"), F.col("iep_code").alias("southside_iep_code")),
        sasccs.select(F.col("nyssis_id").cast("string").alias(key), F.col("student_id").alias("sasccs_student_id")),
        sas.select(F.col("nyssis_id").cast("string").alias(key), F.col("student_id").alias("sas_student_id")),
        ontech.select(F.col("nyssis_id").cast("string").alias(key), F.col("sped_student_id").alias("ontech_sped_student_id")),
    )
    return left_on_same_key(st, sides, F.col("st_nyssis_id").cast("string"), key, [identity])


def roster_driven_join(st: DataFrame, roster: DataFrame, roster_columns: dict[str, str], identity: str) -> DataFrame:
    """RIGHT JOIN form: every roster row stays, enrollment columns are NULL where unmatched."""
    renamed = roster.select(F.col("nyssis_id").cast("string").alias("roster_nyssis_id"),
                            *[F.col(n).alias(new) for n, new in roster_columns.items()])
    side = st.withColumn("_st_key", F.col("st_nyssis_id").cast("string"))
    return left_on_key(renamed, side, F.col("roster_nyssis_id"), "_st_key", [identity])


def audit(joined: DataFrame, tolerance: int = 5) -> DataFrame:
    """The 13 audit fields plus context, from the output of join_rosters."""
    st_entry, st_exit = F.col("st_studentenrollment_startdate"), F.col("st_studentenrollment_enddate")
    entry, exit_ = F.col("southside_st_entry_date"), F.col("southside_st_exit_date")
    roster_sped = F.col("southside_iep_code").isNotNull()
    st_sped = F.col("schoolyear_disability").isNotNull()
    ids = [F.col(n) for n in ("studentid", "student_universalstudentid", "studentid_nyssis_export")]
    resolved = joined.withColumns({
        "resolved_studentid": resolve_id(*ids),
        "id_source": rules.id_source(*ids, blank_counts_as_value=True),
        "is_iep_flag": rules.iep_flag(st_sped),
        "roster_vs_disability_check": rules.spine_disability_check(roster_sped, st_sped),
        "entry_diff_days": diff_days(entry, st_entry),
        "exit_diff_days": diff_days(exit_, st_exit),
    })
    entry_diff, exit_diff = F.col("entry_diff_days"), F.col("exit_diff_days")
    compared = resolved.withColumns({
        "id_match_status": rules.spine_id_match(
            F.col("resolved_studentid"), {label: F.col(n) for label, n in ROSTER_IDS.items()}),
        "entry_status_category": rules.date_category(entry_diff.isNull(), entry_diff, tolerance),
        "exit_status_category": rules.date_category(exit_diff.isNull(), exit_diff, tolerance),
        "exit_issue_type": rules.spine_exit_issue(exit_.isNull(), st_exit.isNull(), exit_diff, tolerance),
    })
    entry_cat, exit_cat = F.col("entry_status_category"), F.col("exit_status_category")
    judged = compared.withColumn(
        "final_validation_status", rules.spine_status(F.col("id_match_status"), entry_cat, exit_cat))
    return judged.withColumns({
        "severity": rules.severity(F.col("final_validation_status"), "spine"),
        "recommended_action": rules.spine_action(F.col("exit_issue_type"), entry_cat),
    }).select(*FIELDS, *CONTEXT)


def triage(audited: DataFrame) -> DataFrame:
    """Rows per severity and status, most severe first."""
    return (
        audited.groupBy("severity", "final_validation_status").agg(F.count(F.lit(1)).alias("student_count"))
        .orderBy(rules.severity_order(F.col("severity")), "final_validation_status")
    )
