"""Billing audit: roster against the latest enrollment row, with FTE and special-education flag.

Input tables are role tables (see sources.tables.conform_to_roles): all text, one
column per role, plus an ordinal column giving the row order of the source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.config import BillingConfig
from tallyroll.functions import dates, fte
from tallyroll.functions.text import blank_to_null, name_key, present, split_first, split_last, strip, strip_decimal_zero
from tallyroll.operators import billing_rules as rules
from tallyroll.operators.keys import (
    c, distinct_keys, enrollment_label, first_per_key, flag_members, latest_per_key, latest_with_count, left_on_key, left_on_same_key,
)
from tallyroll.plans import compare_final
from tallyroll.session import cut_lineage

Tab = DataFrame | Callable[[DataFrame], DataFrame] | None
# Output column -> internal column, 30 columns in order.
OUTPUT = {
    "NYSSIS ID": "nyssis", "Student ID": "auto_student_id", "Last Name": "last_name", "First Name": "first_name",
    "Date of Birth": "dob", "Current Grade Level": "grade", "Address": "address", "City": "city", "Zip Code": "zip",
    "District of Residency": "district", "Entry Date": "charter_entry", "Leave Date": "charter_exit", "FTE": "charter_fte",
    "ST Entry Date": "st_entry", "ST Exit Date": "st_exit", "School Name": "st_school",
    "Student Status": "student_status", "ST ID Match": "st_id_match", "Match Method": "match_method",
    "Multiple Enrollments": "multiple_enrollments", "review_notes": "review_notes",
    "Entry Date Discrepancy (>3 Days)": "entry_discrepancy", "Exit Date Discrepancy (>3 Days)": "exit_discrepancy",
    "SPED Status": "sped_status", "SchoolTool FTE": "st_fte", "Charter FTE": "charter_fte",
    "FTE Variance": "fte_variance", "ST SPED FTE": "st_sped_fte", "Charter SPED FTE": "charter_sped_fte",
    "SPED FTE Variance": "sped_fte_variance",
}


def prepare_roster(roster: DataFrame, parse=dates.parse_billing) -> DataFrame:
    """Clean roster roles: key, charter dates, numeric FTE, names out of a full name where that is all there is.

    Rows without a state ID are dropped.
    """
    last, first = c("last_name"), c("first_name")
    if "full_name" in roster.columns:
        only_full = last.isNull() & first.isNull()
        last = F.when(only_full, split_last(c("full_name"))).otherwise(last)
        first = F.when(only_full, split_first(c("full_name"))).otherwise(first)
    return roster.filter(present(strip(c("nyssis")))).withColumns({
        "nyssis": strip_decimal_zero(c("nyssis")),
        "last_name": last, "first_name": first,
        "charter_entry": parse(c("entry")), "charter_exit": parse(c("exit")),
        "charter_fte": strip(c("fte")).try_cast("double"),
    })


def prepare_export(st: DataFrame, parse=dates.parse_billing) -> DataFrame:
    """Clean export roles: key, entry date, name key; rows without a state ID are dropped.

    The exit stays text: only the rows that win a lookup get theirs parsed.
    """
    cleaned = st.filter(present(strip(c("nyssis")))).withColumns({
        "nyssis": strip_decimal_zero(c("nyssis")), "st_entry": parse(c("entry")),
        "st_school": strip(c("school")), "st_student_id": strip(c("student_id")),
    })
    return cleaned.withColumn("name_key", name_key(c("first_name"), c("last_name"), parse(c("dob")), c("grade")))


def written_export(st: DataFrame, ordinal: str, folder: str | None = None, parse=dates.parse_billing) -> DataFrame:
    """prepare_export as a written stage, in the columns that the lookups read: its dates and keys are worked out once for all of them."""
    return cut_lineage(prepare_export(st, parse).select(*[c(n) for n in ("nyssis", "st_entry", "exit", "st_school", "st_student_id", "name_key", ordinal)]), folder)


def latest_by_nyssis(export: DataFrame, ordinal: str, parse=dates.parse_billing) -> DataFrame:
    """Latest enrollment and number of enrollments per state ID, in one aggregation of the export."""
    fields = ["nyssis", "st_entry", "exit", "st_school", "st_student_id"]
    latest = latest_with_count(export.select(*fields, ordinal), "nyssis", "st_entry", ordinal)
    return latest.withColumn("st_exit", parse(c("exit"))).drop("exit", ordinal)


def latest_by_name(export: DataFrame, ordinal: str, parse=dates.parse_billing) -> DataFrame:
    """Latest enrollment per name + birth date + grade."""
    fields = ["name_key", "nyssis", "st_entry", "exit", "st_school", "st_student_id"]
    latest = latest_per_key(export.select(*fields, ordinal), ["name_key"], "st_entry", ordinal)
    return latest.withColumn("st_exit", parse(c("exit"))).drop("exit", ordinal)


def match_latest(roster: DataFrame, export: DataFrame, row_id: str, ordinal: str, parse=dates.parse_billing,
                 name_fallback: bool = True) -> DataFrame:
    """Roster with the latest enrollment per state ID and, where that gave nothing, per name + birth date + grade.

    The fallback key is NULL on rows that need none, so those rows match nothing there.
    """
    fields = ["st_entry", "st_exit", "st_school", "st_student_id"]
    latest = latest_by_nyssis(export, ordinal, parse).withColumnRenamed("nyssis", "_nyssis")
    joined = left_on_key(roster, latest, c("nyssis"), "_nyssis", [row_id])
    missing = F.col("st_entry").isNull() & F.col("st_exit").isNull() & F.col("st_school").isNull()
    if not name_fallback:
        # Here the key alone decides, even if the matched row carries no dates.
        return joined.withColumn(
            "match_method", F.when(F.col("enrollment_count").isNull(), rules.NOT_FOUND).otherwise("NYSSIS"))
    by_name = latest_by_name(export, ordinal, parse).select("name_key", *[F.col(n).alias(f"_{n}") for n in fields])
    key = F.when(missing, name_key(c("first_name"), c("last_name"), parse(c("dob")), c("grade")))
    found = left_on_key(joined, by_name, key, "name_key", [row_id]).withColumn("_missing", missing)
    method = (
        F.when(~F.col("_missing"), "NYSSIS").when(F.col("_st_entry").isNotNull(), "Name+DOB+Grade").otherwise(rules.NOT_FOUND)
    )
    return found.withColumn("match_method", method).withColumns({
        n: F.when(F.col("_missing"), F.coalesce(f"_{n}", n)).otherwise(F.col(n)) for n in fields
    }).drop("_missing", *[f"_{n}" for n in fields])


def match_prepopulated(roster: DataFrame, parse=dates.parse_billing) -> DataFrame:
    """System dates already sit in the roster roles st_entry, st_exit, st_school: no join."""
    filled = roster.withColumns({
        "st_entry": parse(c("st_entry")), "st_exit": parse(c("st_exit")), "st_school": strip(c("st_school")),
        "st_student_id": F.lit(None).cast("string"), "enrollment_count": F.lit(None).cast("long"),
    })
    return filled.withColumn(
        "match_method", F.when(F.col("st_entry").isNotNull(), "Pre-populated").otherwise(rules.NOT_FOUND))


def match_nothing(roster: DataFrame) -> DataFrame:
    """No enrollment data at all."""
    return roster.withColumns({
        "st_entry": F.lit(None).cast("date"), "st_exit": F.lit(None).cast("date"),
        "st_school": F.lit(None).cast("string"), "st_student_id": F.lit(None).cast("string"),
        "enrollment_count": F.lit(None).cast("long"), "match_method": F.lit(rules.NOT_FOUND),
    })


def sped_key_set(sped: DataFrame | None, disability: DataFrame | None, roster: DataFrame) -> DataFrame | None:
    """State IDs that count as special education: the SPED roster plus the disability list cut to this roster.

    ``sped`` has sped_key, ``disability`` has nyssis. None when neither source is there.
    """
    parts = []
    if sped is not None:
        parts.append(distinct_keys(sped, c("sped_key"), "key"))
    if disability is not None:
        listed = distinct_keys(disability, strip_decimal_zero(c("nyssis")), "key")
        parts.append(listed.join(distinct_keys(roster, c("nyssis"), "key"), "key", "left_semi"))
    if not parts:
        return None
    keys = parts[0]
    for part in parts[1:]:
        keys = keys.unionByName(part).distinct()
    return keys


def with_sped_status(matched: DataFrame, keys: DataFrame | None, row_id: str) -> DataFrame:
    """SPED / Gen Ed; Unknown when there is no key set, or none of its keys has a value."""
    if keys is None:
        return matched.withColumn("sped_status", F.lit("Unknown"))
    some = (keys.agg(F.count("key").alias("n")).select(F.col("n") > 0)).scalar()
    flagged = flag_members(matched, c("nyssis"), keys, "_sped", [row_id])
    return flagged.withColumn("sped_status", F.when(~some, "Unknown").when(F.col("_sped"), "SPED").otherwise("Gen Ed")).drop("_sped")


def with_rules(matched: DataFrame, config: BillingConfig = BillingConfig(), summer_rule: str = "deadline") -> DataFrame:
    """Entry/exit texts, status, notes, ID match and enrollment label."""
    texts = matched.withColumns({
        "entry_discrepancy": rules.classify_entry(c("charter_entry"), c("st_entry"), config, summer_rule),
        "exit_discrepancy": rules.classify_exit(c("charter_exit"), c("st_exit"), config, summer_rule == "deadline"),
    })
    judged = texts.withColumn(
        "student_status", rules.status(c("entry_discrepancy"), c("exit_discrepancy"), c("match_method")))
    own_id = blank_to_null(strip_decimal_zero(c("student_id")))
    return judged.withColumns({
        "review_notes": rules.review_notes(c("student_status"), c("entry_discrepancy"), c("exit_discrepancy"))
        if summer_rule == "deadline" else rules.missing_record_note(c("st_entry"), c("st_exit"), c("st_school")),
        "st_id_match": F.coalesce(c("st_student_id"), F.lit("NOT FOUND IN ST")),
        "auto_student_id": F.coalesce(own_id, c("st_student_id")),
        "multiple_enrollments": enrollment_label(c("enrollment_count")),
    })


def with_fte(judged: DataFrame, config: BillingConfig = BillingConfig(), method: str = "weeks") -> DataFrame:
    """System FTE, variance, and their special-education copies."""
    if method == "sheet":
        start, end = fte.billed_period(c("st_entry"), c("st_exit"), F.lit(None).cast("date"), c("charter_exit"), config)
    else:
        start, end = fte.billed_period(c("st_entry"), c("st_exit"), c("charter_entry"), c("charter_exit"), config)
    sped: Column = c("sped_status") == "SPED"
    # The period gets its own projection: the week rule names its two dates dozens of times.
    dated = judged.withColumns({"_start": start, "_end": F.coalesce(end, F.lit(fte.open_end(config, method)))})
    counted = dated.withColumn("st_fte", fte.fte(F.col("_start"), F.col("_end"), config, method)).drop("_start", "_end")
    return counted.withColumns({
        "fte_variance": fte.variance(c("charter_fte"), c("st_fte")),
        "st_sped_fte": F.when(sped, c("st_fte")),
        "charter_sped_fte": F.when(sped, c("charter_fte")),
        "sped_fte_variance": F.when(sped, fte.variance(c("charter_fte"), c("st_fte"))),
    })


def audit(roster: DataFrame, export: DataFrame | None, row_id: str, ordinal: str | None = None, *,
          sped: DataFrame | None = None, disability: DataFrame | None = None, prepopulated: bool = False,
          config: BillingConfig = BillingConfig(), method: str = "weeks", summer_rule: str = "deadline",
          name_fallback: bool = True, parse=dates.parse_billing, prepared: bool = False) -> DataFrame:
    """The whole billing audit; internal column names (see output()). With ``prepared`` the export is the output of prepare_export."""
    clean = prepare_roster(roster, parse)
    if export is not None:
        clean = clean.drop("st_entry", "st_exit", "st_school")
        matched = match_latest(clean, export if prepared else prepare_export(export, parse), row_id, ordinal, parse, name_fallback)
    elif prepopulated:
        matched = match_prepopulated(clean, parse)
    else:
        matched = match_nothing(clean.drop("st_entry", "st_exit", "st_school"))
    flagged = with_sped_status(matched, sped_key_set(sped, disability, clean), row_id)
    return with_fte(with_rules(flagged, config, summer_rule), config, method)


def output(audited: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 30 output columns under their report names."""
    return audited.select(*[c(k) for k in keep], *[c(inner).alias(name) for name, inner in OUTPUT.items()])


# ---------------------------------------------------------------- report tabs
def not_in_st(audited: DataFrame) -> DataFrame:
    return audited.filter(c("match_method") == rules.NOT_FOUND).select(
        c("nyssis").alias("NYSSIS ID"), c("first_name").alias("First Name"), c("last_name").alias("Last Name"),
        c("grade").alias("Grade"), c("dob").alias("Date of Birth"), c("charter_entry").alias("Charter Entry"),
        c("charter_exit").alias("Charter Exit"), c("charter_fte").alias("FTE"))


def multiple_enrollments(audited: DataFrame) -> DataFrame:
    return audited.filter(c("enrollment_count") > 1).select(
        c("nyssis").alias("NYSSIS ID"), c("first_name").alias("First Name"), c("last_name").alias("Last Name"),
        c("grade").alias("Grade"), c("charter_entry").alias("Charter Entry"), c("charter_exit").alias("Charter Exit"),
        c("charter_fte").alias("FTE"), c("st_entry").alias("ST Entry"), c("st_exit").alias("ST Exit"),
        c("st_school").alias("School Name"), c("enrollment_count").alias("Enrollment Count"))


def action_needed(audited: DataFrame) -> DataFrame:
    """Work queue: rows not found and rows that are No Good, in one pass; the former have no system dates."""
    base = ["NYSSIS ID", "Last Name", "First Name", "Date of Birth", "Current Grade Level", "Entry Date", "Leave Date", "Student Status"]
    dated = ["ST Entry Date", "ST Exit Date", "Entry Date Discrepancy (>3 Days)", "Exit Date Discrepancy (>3 Days)"]
    missing = c("student_status") == rules.NEEDS_REVIEW
    return audited.filter(missing | (c("student_status") == "No Good")).select(
        *[c(OUTPUT[n]).alias(n) for n in base],
        F.when(missing, "Look up in ST Enrollment - add ST entry/exit dates via VLOOKUP")
        .otherwise("Review: check for duplicate enrollment or supporting docs from charter").alias("Action Required"),
        F.when(missing, "NOT FOUND IN ST").otherwise("NO GOOD - NEEDS REVIEW").alias("Action Type"),
        *[F.when(~missing, c(OUTPUT[n])).alias(n) for n in dated])


def summary(audited: DataFrame) -> DataFrame:
    """Metric rows (metric, value): counts, then percentages with one decimal."""
    total = F.count(F.lit(1))
    share = lambda n: F.round(100.0 * n / F.greatest(total, F.lit(1)), 1)
    good, bad = F.count_if(c("student_status") == "Good"), F.count_if(c("student_status") == "No Good")
    missing = F.count_if(c("student_status") == rules.NEEDS_REVIEW)
    metrics = {
        "Total Students": total, "Good": good, "No Good": bad, rules.NEEDS_REVIEW: missing,
        "SPED Students": F.count_if(c("sped_status") == "SPED"),
        "Gen Ed Students": F.count_if(c("sped_status") == "Gen Ed"),
        "Unknown SPED Status": F.count_if(c("sped_status") == "Unknown"),
        "Not in ST Enrollment": F.count_if(c("match_method") == rules.NOT_FOUND),
        "Matched by Name+DOB+Grade (fallback)": F.count_if(c("match_method") == "Name+DOB+Grade"),
        "Multiple Enrollments": F.count_if(c("multiple_enrollments") != ""),
        "Good %": share(good), "No Good %": share(bad), f"{rules.NEEDS_REVIEW} %": share(missing),
    }
    one = audited.agg(*[m.cast("double").alias(f"m{i}") for i, m in enumerate(metrics.values())])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("value")) for i, name in enumerate(metrics)])))


def breakdown(audited: DataFrame, column: str) -> DataFrame:
    """Rows per discrepancy text, most frequent first."""
    return audited.groupBy(c(column)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), c(column))


def sped_roster(sped: DataFrame, audited: DataFrame, export: DataFrame, disability: DataFrame | None,
                sped_ordinal: str, row_id: str, ordinal: str, status_column: str = "IEP Enrollment status") -> DataFrame:
    """SPED roster (with sped_key) plus IEP code, enrollment status, system student ID and FTE; first match per key each.

    A status column the roster already has is replaced rather than repeated.
    """
    first_audit = first_per_key(
        audited.select("nyssis", "student_status", "st_sped_fte", row_id), ["nyssis"], [c(row_id).asc()])
    latest = latest_per_key(export, ["nyssis"], "st_entry", ordinal)
    sides = [
        first_audit.select(c("nyssis").alias("k"), c("student_status").alias("_status"), c("st_sped_fte").alias("_fte")),
        latest.select(c("nyssis").alias("k"), blank_to_null(c("st_student_id")).alias("_student")),
    ]
    if disability is not None:
        codes = disability.select(strip_decimal_zero(c("nyssis")).alias("k"), strip_decimal_zero(c("iep_code")).alias("_code"), c(ordinal))
        sides.append(first_per_key(codes, ["k"], [c(ordinal).asc()]).select("k", "_code"))
    target = status_column if status_column in sped.columns else "IEP Enroll status"
    # The roster is shuffled by its key once for all lookups.
    joined = left_on_same_key(sped, sides, c("sped_key"), "k", [sped_ordinal])
    code = F.col("_code") if disability is not None else F.lit(None).cast("string")
    return joined.withColumn(target, F.col("_status")).withColumns({"ST SPED FTE": F.col("_fte"), "IEP Code": code, "ST Student ID": F.col("_student")}).drop(
        "_status", "_fte", "_code", "_student")


def report(audited: DataFrame, sped_tab: Tab = None, matched: Tab = None, folder: str | None = None) -> dict[str, DataFrame]:
    """The tabs of the billing report. The audit is written once, below the shared folder, and all tabs read it from there.

    ``sped_tab`` is the output of sped_roster, ``matched`` that of compare_final.match;
    their tabs are left out where they are not given. Given as functions, they are
    called with the written audit, so that it is not computed again for them.
    """
    audited = cut_lineage(audited, folder)
    tabs = {
        "Roster": output(audited), "Audit_Summary": summary(audited), "Not_In_ST": not_in_st(audited),
        "Multiple_Enrollments": multiple_enrollments(audited), "Action_Needed": action_needed(audited),
    }
    if sped_tab is not None:
        tabs["SPED_Roster"] = sped_tab(audited) if callable(sped_tab) else sped_tab
    if matched is not None:
        matched = cut_lineage(matched(audited) if callable(matched) else matched, folder)
        tabs |= {"VS_Final_Summary": compare_final.summary(matched), "VS_Final_Detail": compare_final.differences(matched)}
    return tabs
