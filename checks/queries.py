"""The check queries: every operator over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from checks import time_queries
from checks.inputs import CHARTER_LABELS, ROSTER_LABELS, Inputs, plain
from tallyroll import config as cfg
from tallyroll.functions import dates, fte, text
from tallyroll.operators import billing_rules, keys, measures, ordinals, quality, windows
from tallyroll.plans import audit_billing, audit_roster, audit_spine, compare_final, statistics, unify
from tallyroll.session import cut_lineage
from tallyroll.sources import pages, sinks, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a builder under its own name; the result is cast to plain types."""
    QUERIES[build.__name__] = lambda spark, sf_dir: plain(build(Inputs(spark, sf_dir)))
    return build


# ---------------------------------------------------------------- audit from the enrollment system
def _spine(i: Inputs) -> DataFrame:
    return audit_spine.audit(audit_spine.join_rosters(i.st_enrollment(), *i.rosters()))


@query
def audit_spine_fields(i: Inputs) -> DataFrame:
    return _spine(i)


@query
def audit_spine_triage(i: Inputs) -> DataFrame:
    return audit_spine.triage(_spine(i))


@query
def roster_driven_join(i: Inputs) -> DataFrame:
    joined = audit_spine.roster_driven_join(
        i.st_enrollment().select("enrollment_seq", "studentid", "schoolname", "st_nyssis_id"), i.monthly(0),
        {"c_custkey": "c_custkey", "student_id": "roster_student_id"}, "c_custkey")
    return joined.select("c_custkey", "roster_nyssis_id", "roster_student_id", "enrollment_seq", "studentid", "schoolname")


# ---------------------------------------------------------------- reporting queries
@query
def reconcile_charters(i: Inputs) -> DataFrame:
    southside, sasccs, sas, ontech = i.rosters()
    rows = quality.union_rosters({
        "Southside": (southside, "student_id"), "SASCCS": (sasccs, "student_id"),
        "SAS": (sas, "student_id"), "OnTech": (ontech, "sped_student_id")})
    st_keys = keys.distinct_keys(i.st_enrollment(), F.col("st_nyssis_id").cast("string"), "key")
    return quality.reconcile(rows, st_keys)


@query
def enrollment_gaps_overlaps(i: Inputs) -> DataFrame:
    found = windows.enrollment_transitions(
        i.st_enrollment(), "student_universalstudentid", "st_studentenrollment_startdate", "st_studentenrollment_enddate",
        "enrollment_seq")
    return found.select("enrollment_seq", "student_universalstudentid", "studentid", "schoolname", "prior_enddate",
                        "st_studentenrollment_startdate", "days_between", "transition_type")


@query
def date_variance_by_school(i: Inputs) -> DataFrame:
    return quality.variance_stats(quality.date_variance(i.st_enrollment(), i.monthly(0)))


@query
def conflicting_state_ids(i: Inputs) -> DataFrame:
    return quality.conflicting_keys(i.st_enrollment())


@query
def disability_representation(i: Inputs) -> DataFrame:
    return quality.disability_representation(i.st_enrollment())


# ---------------------------------------------------------------- matching on names
@query
def fill_ids_by_composite_key(i: Inputs) -> DataFrame:
    joined = keys.fill_by_composite(
        i.gen_roster(), i.export_28(), {"nyssis_id": "e_nyssis", "student_id": "e_student"}, ["c_custkey"])
    return joined.select(
        "c_custkey", "nyssis_id", "student_id", F.coalesce("nyssis_id", "e_nyssis").alias("nyssis_id_filled"),
        F.coalesce("student_id", "e_student", F.lit("Not Found")).alias("student_id_resolved"))


@query
def fill_nyssis_first_match(i: Inputs) -> DataFrame:
    joined = keys.fill_by_composite(
        i.gen_roster(), i.export_28(), {"nyssis_id": "e_nyssis"}, ["c_custkey"], [F.col("enrollment_seq")])
    return joined.select("c_custkey", F.coalesce(
        F.nullif("nyssis_id", F.lit("")), "e_nyssis", F.lit("")).alias("nyssis_id_filled"))


@query
def resolve_student_id(i: Inputs) -> DataFrame:
    lookup, order = i.export_28(), [F.col("enrollment_seq")]
    direct = keys.first_per_key(lookup, ["nyssis_id"], order).select(
        F.col("nyssis_id").alias("_k"), F.col("student_id").alias("d_student"))
    joined = keys.left_on_key(i.gen_roster(), direct, F.col("nyssis_id"), "_k", ["c_custkey"])
    joined = keys.fill_by_composite(joined, lookup, {"student_id": "e_student"}, ["c_custkey"], order)
    return joined.select("c_custkey", F.coalesce("d_student", "e_student", F.lit("Not Found")).alias("student_id_resolved"))


# ---------------------------------------------------------------- audit from the roster
def _roster_audits(i: Inputs, dedupe_st: bool = True) -> DataFrame:
    """All four rosters, each audited under its own headers and label."""
    iep = F.when(F.col("sped_text").startswith("SPED"), "IEP").when(F.col("j") % 4 == 0, "  ")
    rosters = {
        label: i.text_roster(k).select(
            "row_id", F.col("nyssis_text").alias("NYSSIS ID"), F.col("sid_text").alias("Student ID"), iep.alias("IEP"),
            F.col("entered_text").alias("Entry Date"), F.col("withdrew_text").alias("Exit Date"))
        for k, label in ROSTER_LABELS.items()
    }
    # The patterns alone would take the note columns for dates and the universal ID for the student ID.
    st_overrides = {"entry": "StudentEnrollment_StartDate", "exit": "StudentEnrollment_EndDate", "student_id": "StudentID"}
    return audit_roster.audit(rosters, i.raw_export(), row_id="row_id", st_ordinal="enrollment_seq", dedupe_st=dedupe_st,
                              st_overrides=st_overrides)


@query
def audit_roster_fields(i: Inputs) -> DataFrame:
    return _roster_audits(i)


@query
def audit_roster_fanout(i: Inputs) -> DataFrame:
    return _roster_audits(i, dedupe_st=False)


@query
def audit_roster_exceptions(i: Inputs) -> DataFrame:
    return audit_roster.exceptions(_roster_audits(i))


@query
def audit_roster_summary(i: Inputs) -> DataFrame:
    return audit_roster.severity_summary(_roster_audits(i))


@query
def audit_roster_counters(i: Inputs) -> DataFrame:
    return audit_roster.run_counters(_roster_audits(i))


# ---------------------------------------------------------------- billing audit
def _billing_roster(i: Inputs, prepopulated: bool = False) -> DataFrame:
    """Raw headers -> role columns. The pre-filled system columns repeat the headers of the charter columns."""
    raw = i.text_roster().select(
        "row_id", F.col("nyssis_text").alias("NYSSIS ID"), F.col("sid_text").alias("Student ID"),
        F.col("first_text").alias("First Name"), F.col("last_text").alias("Last Name"), F.col("dob_text").alias("Date of Birth"),
        F.col("grade_text").alias("Current Grade Level"), F.col("entered_text").alias("Entry Date"),
        F.col("withdrew_text").alias("Leave Date"), F.col("fte_text").alias("FTE"),
        *([F.when(F.col("row_id") % 7 != 0, F.col("entered_text")).alias("Entry  Date ST"),
           F.when(F.col("row_id") % 5 != 0, F.col("withdrew_text")).alias("Leave Date\nST"),
           F.col("school_text").alias("School Name")] if prepopulated else []))
    named = tables.normalize_headers(raw)
    overrides = tables.prepopulated_columns(named.columns)
    roles = tables.resolve_roles(named.columns, cfg.BILLING_ROSTER_PATTERNS, overrides)
    tables.require(named, roles, ["nyssis"])
    return tables.conform_to_roles(named, cfg.BILLING_ROSTER_PATTERNS, overrides, keep=["row_id"])


def _billing_export(i: Inputs) -> DataFrame:
    return tables.conform_to_roles(i.raw_export(), cfg.BILLING_EXPORT_PATTERNS, keep=["enrollment_seq"])


def _sped(i: Inputs) -> DataFrame:
    rows = i.text_roster().filter(F.col("iep_text").isNotNull())
    return keys.sped_keys(rows.select("row_id", F.col("nyssis_text").alias("NYSSIS")), "NYSSIS", None)


def _disability_list(i: Inputs) -> DataFrame:
    listed = i.st_enrollment().filter("schoolyear_disability IS NOT NULL")
    return listed.select(F.col("st_nyssis_id").cast("string").alias("nyssis"))


def _billing(i: Inputs, export: DataFrame | None = None, **options) -> DataFrame:
    """``export`` is the prepared export, where a report has it as a written stage."""
    return audit_billing.audit(_billing_roster(i), _billing_export(i) if export is None else export, "row_id", "enrollment_seq", sped=_sped(i),
                               disability=_disability_list(i), prepared=export is not None, **options)


@query
def billing_output(i: Inputs) -> DataFrame:
    return audit_billing.output(_billing(i), ("row_id",))


@query
def billing_sheet_fte(i: Inputs) -> DataFrame:
    return audit_billing.output(_billing(i, method="sheet", name_fallback=False), ("row_id",))


@query
def billing_prepopulated(i: Inputs) -> DataFrame:
    audited = audit_billing.audit(_billing_roster(i, prepopulated=True), None, "row_id", prepopulated=True,
                                  method="continuous", summer_rule="window")
    return audit_billing.output(audited, ("row_id",))


@query
def billing_without_export(i: Inputs) -> DataFrame:
    return audit_billing.output(audit_billing.audit(_billing_roster(i), None, "row_id"), ("row_id",))


@query
def billing_sped_without_keys(i: Inputs) -> DataFrame:
    """A special-education list without rows, and one without a key column: nobody's status is known."""
    rows = i.text_roster().filter(F.col("iep_text").isNotNull()).select("row_id", F.col("nyssis_text").alias("NYSSIS"))
    parts = []
    for variant, sped in (("no rows", _sped(i).filter("sped_key = 'none'")), ("no key column", keys.sped_keys(rows, None, None))):
        audited = audit_billing.audit(_billing_roster(i), None, "row_id", sped=sped)
        parts.append(audited.select("row_id", F.lit(variant).alias("variant"), "sped_status"))
    return parts[0].unionByName(parts[1])


@query
def billing_not_in_st(i: Inputs) -> DataFrame:
    return audit_billing.not_in_st(_billing(i))


@query
def billing_multiple_enrollments(i: Inputs) -> DataFrame:
    return audit_billing.multiple_enrollments(_billing(i))


@query
def billing_action_needed(i: Inputs) -> DataFrame:
    return audit_billing.action_needed(_billing(i))


@query
def billing_summary(i: Inputs) -> DataFrame:
    return audit_billing.summary(_billing(i))


@query
def billing_entry_breakdown(i: Inputs) -> DataFrame:
    return audit_billing.breakdown(_billing(i), "entry_discrepancy")


@query
def billing_exit_breakdown(i: Inputs) -> DataFrame:
    return audit_billing.breakdown(_billing(i), "exit_discrepancy")


def _date_pairs(i: Inputs) -> DataFrame:
    return i.table("orders").selectExpr(
        "o_orderkey AS id", "CASE WHEN o_orderkey % 17 <> 0 THEN DATE '2025-06-20' + CAST(o_orderkey % 331 AS INT) END AS a",
        "CASE WHEN o_orderkey % 13 <> 0 THEN DATE '2025-06-20' + CAST((o_orderkey + o_custkey % 23 - 11 + "
        "CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 300 ELSE 0 END) % 380 AS INT) END AS b")


@query
def classify_entry_dates(i: Inputs) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return _date_pairs(i).select("id", billing_rules.classify_entry(a, b).alias("by_deadline"),
                                 billing_rules.classify_entry(a, b, summer_rule="window").alias("by_window"))


@query
def classify_exit_dates(i: Inputs) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return _date_pairs(i).select("id", billing_rules.classify_exit(a, b).alias("end_open"),
                                 billing_rules.classify_exit(a, b, end_date_is_open=False).alias("end_closed"))


@query
def fte_three_methods(i: Inputs) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return _date_pairs(i).select("id", fte.fte(a, b).alias("by_weeks"), fte.fte(a, b, method="continuous").alias("continuous"),
                                 fte.fte(a, b, method="sheet").alias("sheet"))


def _prepared_export(i: Inputs) -> DataFrame:
    return audit_billing.prepare_export(_billing_export(i))


@query
def latest_enrollment(i: Inputs) -> DataFrame:
    latest = audit_billing.latest_by_nyssis(_prepared_export(i), "enrollment_seq")
    return latest.withColumn("label", keys.enrollment_label(F.col("enrollment_count")))


@query
def latest_by_name_key(i: Inputs) -> DataFrame:
    return audit_billing.latest_by_name(_prepared_export(i), "enrollment_seq").select("name_key", "nyssis", "st_entry", "st_school")


def _xref(i: Inputs, export: DataFrame | None = None) -> DataFrame:
    return keys.id_xref(_prepared_export(i) if export is None else export, "st_student_id", "nyssis", [F.col("enrollment_seq")])


@query
def student_id_crossref(i: Inputs) -> DataFrame:
    return _xref(i)


@query
def enrollment_counts(i: Inputs) -> DataFrame:
    roster = audit_billing.prepare_roster(_billing_roster(i))
    return keys.with_enrollment_count(roster, "nyssis", _prepared_export(i), F.col("nyssis"), ["row_id"]).select(
        "row_id", "nyssis", "enrollment_count", "multiple_enrollments")


@query
def sped_key_set(i: Inputs) -> DataFrame:
    return audit_billing.sped_key_set(_sped(i), _disability_list(i), audit_billing.prepare_roster(_billing_roster(i)))


def _sped_bridged(i: Inputs, export: DataFrame | None = None) -> DataFrame:
    rows = i.text_roster().filter(F.col("sped_text").startswith("SPED")).select("row_id", F.col("sid_text").alias("Student Gen Ed ID#"))
    roles = tables.resolve_roles(rows.columns, cfg.SPED_PATTERNS)
    return keys.sped_keys(rows, roles["nyssis"], roles["student_id"], _xref(i, export), "row_id")


@query
def sped_key_bridge(i: Inputs) -> DataFrame:
    return _sped_bridged(i).select("row_id", "sped_key")


def _sped_report(i: Inputs, audited: DataFrame, export: DataFrame) -> DataFrame:
    disability = i.st_enrollment().filter("schoolyear_disability IS NOT NULL").selectExpr(
        "enrollment_seq", "CAST(st_nyssis_id AS STRING) AS Student_UniversalStudentID", "'D' || CAST(enrollment_seq AS STRING) AS StudentID_Disability")
    codes = tables.conform_to_roles(disability, cfg.DISABILITY_PATTERNS, keep=["enrollment_seq"])
    roster = _sped_bridged(i, export).withColumn("IEP Enrollment status", F.lit("stale"))
    report = audit_billing.sped_roster(roster, audited, export, codes, "row_id", "row_id", "enrollment_seq")
    return report.drop("Student Gen Ed ID#")


@query
def sped_roster_report(i: Inputs) -> DataFrame:
    return _sped_report(i, _billing(i), _prepared_export(i))


# ---------------------------------------------------------------- comparison with the final table
def _compared(i: Inputs, audited: DataFrame | None = None) -> DataFrame:
    final = i.text_roster().selectExpr(
        "row_id", "nyssis_text AS nyssis",
        "CASE WHEN j % 11 = 0 THEN 'Not in ST System' WHEN j % 11 < 4 THEN 'Good' WHEN j % 11 < 7 THEN 'No Good' "
        "WHEN j % 11 = 7 THEN 'NA' WHEN j % 11 = 8 THEN ' ' ELSE 'Good' END AS final_status")
    return compare_final.match(_billing(i) if audited is None else audited, final, "nyssis", "student_status", "final_status", [F.col("row_id")],
                               [F.col("row_id")], ["entry_discrepancy"])


@query
def compare_final_match(i: Inputs) -> DataFrame:
    return _compared(i).select("nyssis", "engine_status", "final_status", "status_match")


@query
def compare_final_rate(i: Inputs) -> DataFrame:
    return compare_final.match_rate(_compared(i))


@query
def compare_final_summary(i: Inputs) -> DataFrame:
    return compare_final.summary(_compared(i))


@query
def compare_final_differences(i: Inputs) -> DataFrame:
    return compare_final.differences(_compared(i), ["entry_discrepancy"])


@query
def compare_final_categories(i: Inputs) -> DataFrame:
    return compare_final.category_counts(compare_final.differences(_compared(i)))


# ---------------------------------------------------------------- unified roster
def _unified(i: Inputs) -> DataFrame:
    layouts, specs = i.raw_layouts(), {spec.label: spec for spec in cfg.CHARTERS}
    return unify.combine([
        unify.build_source(layouts[k], specs[label], date(2026, 6, 1), f"roster_{k}", keep=["row_id"])
        for k, label in CHARTER_LABELS.items()])


def _built(i: Inputs) -> DataFrame:
    """The unified roster as a written stage: the steps after it read files, not its date parsing."""
    return cut_lineage(_unified(i), i.folder("unified"))


def _exports(i: Inputs) -> DataFrame:
    """Four exports, one per charter, in source order; the last also holds the district's own schools. Cleaned."""
    roles, school = i.export_roles(), F.col("school")
    named = {"Southside ST": school == "Southside Academy", "SAS ST": school == "Syracuse Academy of Science",
             "SASCCS ST": school == "Citizenship & Science Academy"}
    rest = ~F.coalesce(school.isin("Southside Academy", "Syracuse Academy of Science", "Citizenship & Science Academy"), F.lit(False))
    parts = {label: roles.filter(condition) for label, condition in {**named, "OnTech ST": rest}.items()}
    return unify.clean_export(unify.combine_exports(parts, "enrollment_seq"))


@query
def unified_roster(i: Inputs) -> DataFrame:
    return _unified(i)


@query
def unified_patch_student_id(i: Inputs) -> DataFrame:
    return unify.patch_student_id(_built(i), _exports(i), "row_id")


@query
def unified_patch_nyssis(i: Inputs) -> DataFrame:
    st = _exports(i)
    return unify.patch_nyssis(unify.patch_student_id(_built(i), st, "row_id"), st, "row_id")


def _patched(i: Inputs, st: DataFrame | None = None) -> DataFrame:
    return unify.patch_all(_built(i), _exports(i) if st is None else st, "row_id")


@query
def unified_patch_dob_school(i: Inputs) -> DataFrame:
    return _patched(i)


def _final_roster(i: Inputs, st: DataFrame | None = None) -> DataFrame:
    """``st`` is the cleaned export, where a report has it as a written stage."""
    return unify.dedupe_within_charter(cut_lineage(_patched(i, st), i.folder("patched")), "row_id")


@query
def unified_dedupe(i: Inputs) -> DataFrame:
    return _final_roster(i)


@query
def unified_patch_counters(i: Inputs) -> DataFrame:
    before = _built(i)
    return unify.patch_counters(before, unify.patch_all(before, _exports(i), "row_id"), "row_id")


@query
def unified_counts_by_charter(i: Inputs) -> DataFrame:
    return quality.counts_by(_final_roster(i), ["Charter_Source Ticket #", "SPED_Flag", "Student Status"])


@query
def unified_fte_totals(i: Inputs) -> DataFrame:
    return quality.fte_totals(_final_roster(i))


@query
def unified_duplicate_ids(i: Inputs) -> DataFrame:
    return quality.duplicate_ids(_unified(i), "NYSSIS ID")


@query
def unified_duplicate_detail(i: Inputs) -> DataFrame:
    return quality.duplicate_detail(_unified(i), "NYSSIS ID", ["row_id", "NYSSIS ID", "Charter_Source Ticket #", "Last Name", "First Name"])


@query
def unified_missing_profile(i: Inputs) -> DataFrame:
    tokens = {"NYSSIS ID": ("0", "Not Found", "None", ""), "SCSD FTE": ("",), "Student Status": ("", "None", "NA"),
              "School Name": ("", "0", "None"), "Student ID": ("0", "Not Found", "None", ""), "Last Name": ("", "0", "None")}
    return quality.missing_profile(_unified(i), tokens, ["Charter_Source Ticket #"])


@query
def export_dedupe(i: Inputs) -> DataFrame:
    return unify.export_tab(unify.dedupe_export(_exports(i)))


@query
def unified_patch_and_classify(i: Inputs) -> DataFrame:
    done = unify.patch_and_classify(_unified(i), unify.dedupe_export(_exports(i)), "row_id")
    return done.select("row_id", "Charter_Source Ticket #", "NYSSIS ID", "Last Name", "School Name", "Student ID", "Student Status", "review_notes")


@query
def unified_classify_counters(i: Inputs) -> DataFrame:
    before = _built(i)
    after = unify.patch_and_classify(before, unify.dedupe_export(_exports(i)), "row_id")
    return unify.patch_counters(before, after, "row_id", unify.BLANKS)


NOT_FOUND_COLUMNS = ["row_id", "NYSSIS ID", "Student Status", "Action Needed"]


@query
def unified_not_found(i: Inputs) -> DataFrame:
    return unify.not_found(_final_roster(i)).select(*NOT_FOUND_COLUMNS)


@query
def unified_update_log(i: Inputs) -> DataFrame:
    return unify.update_log_seed(_final_roster(i))


@query
def unified_export_lookups(i: Inputs) -> DataFrame:
    looked = unify.export_lookups(_unified(i), unify.dedupe_export(_exports(i)), "row_id")
    return looked.select("row_id", "NYSSIS ID", "Student ID", "ST_NYSSIS_Lookup", "ST_School_Lookup", "ST_SID_Lookup", "Match_Source")


@query
def unified_resolve_from_log(i: Inputs) -> DataFrame:
    log = i.st_enrollment().filter("schoolname = 'Southside Academy' AND st_nyssis_id IS NOT NULL AND studentid <> ''").select(
        "enrollment_seq", F.col("studentid").alias("Student ID"), F.concat(F.lit("R"), F.col("st_nyssis_id").cast("string")).alias("NYSSIS ID"))
    resolved = unify.resolve_from_log(_unified(i), log, "row_id", [F.col("enrollment_seq")])
    return resolved.select("row_id", "Resolved_NYSSIS", "Match_Source")


# ---------------------------------------------------------------- statistics layers
SOURCE, INGESTED = "landed pages", "2026-01-02 03:04:05"


def _bronze(i: Inputs) -> DataFrame:
    return pages.with_audit_columns(pages.conform_columns(i.stats()), SOURCE, INGESTED)


def _silver(i: Inputs) -> DataFrame:
    return statistics.silver(_bronze(i))


@query
def bronze_records(i: Inputs) -> DataFrame:
    return _bronze(i)


@query
def silver_table(i: Inputs) -> DataFrame:
    return _silver(i)


def _register_gold(name: str) -> None:
    build = statistics.GOLD[name][0]
    QUERIES[name] = lambda spark, sf_dir: plain(build(_silver(Inputs(spark, sf_dir))))


for _table in statistics.GOLD:
    _register_gold(_table)


def _county_year(i: Inputs) -> DataFrame:
    return statistics.gold_county_year(_silver(i))


@query
def agency_rankings(i: Inputs) -> DataFrame:
    """The rank operator over all rows, unknown totals included."""
    base = _silver(i).select("year", "agency", "total_index_crimes")
    return windows.dense_rank_desc(base, ["year"], "total_index_crimes", "agency_rank")


@query
def rank_movement(i: Inputs) -> DataFrame:
    return statistics.rank_movement(statistics.gold_rankings(_silver(i)))


@query
def top_counties_per_year(i: Inputs) -> DataFrame:
    return statistics.top_counties(statistics.gold_rankings(_silver(i)))


@query
def county_trend_last_years(i: Inputs) -> DataFrame:
    return statistics.county_history(statistics.gold_violent_trends(_silver(i)), "Nation_3",
                                     ["year", "violent_crime_total", "yoy_change", "rolling_3yr_avg"], 10)


@query
def county_rank_last_years(i: Inputs) -> DataFrame:
    return statistics.county_history(statistics.gold_rankings(_silver(i)), "Nation_3",
                                     ["year", "county", "total_index_crimes", "county_rank"], 5)


@query
def population_rate(i: Inputs) -> DataFrame:
    population = _county_year(i).filter("data_quality_flag = 'COMPLETE'").selectExpr(
        "county", "year", "CASE WHEN year = 2000 THEN 0 ELSE 100000 + total_index_crimes * 7 END AS population")
    return statistics.with_population_rate(_silver(i), population).select(
        "county", "agency", "year", "total_index_crimes", "crime_rate_per_100k")


@query
def verify_bronze(i: Inputs) -> DataFrame:
    return quality.verify(_bronze(i), ["county", "agency", "year", "total_index_crimes"], "year", "county", "ingested_at")


@query
def verify_silver(i: Inputs) -> DataFrame:
    return quality.verify(_silver(i), ["county", "agency", "year", "total_index_crimes", "violent_crime_total", "property_crime_total"],
                          "year", "county")


@query
def silver_distributions(i: Inputs) -> DataFrame:
    return quality.distributions(_silver(i), ["crime_category", "data_quality_flag", "is_county_total", "decade"])


@query
def table_row_counts(i: Inputs) -> DataFrame:
    silver = _silver(i)
    return sinks.table_counts({"bronze": _bronze(i), "silver": silver,
                               "gold_county_year_crime": statistics.gold_county_year(silver),
                               "gold_agency_activity": statistics.gold_agency_activity(silver)})


# ---------------------------------------------------------------- measures
@query
def measure_totals(i: Inputs) -> DataFrame:
    return measures.totals(_county_year(i))


@query
def measure_totals_by_year(i: Inputs) -> DataFrame:
    return measures.totals(_county_year(i), ["year"])


@query
def measure_totals_by_county(i: Inputs) -> DataFrame:
    return measures.totals(_county_year(i), ["county"])


@query
def measure_yoy_change(i: Inputs) -> DataFrame:
    return measures.yoy_change(_county_year(i))


@query
def measure_yoy_change_by_county(i: Inputs) -> DataFrame:
    return measures.yoy_change(_county_year(i), ["county"])


@query
def measure_top_county_by_year(i: Inputs) -> DataFrame:
    return measures.top_county(_county_year(i), ["year"])


@query
def measure_top_category_by_decade(i: Inputs) -> DataFrame:
    return measures.top_county(_county_year(i), ["decade", "data_quality_flag"])


@query
def measure_one_county_by_year(i: Inputs) -> DataFrame:
    return measures.county_measures(_county_year(i), "Nation_3", ["year"])


@query
def measure_moving_avg_violent(i: Inputs) -> DataFrame:
    return measures.moving_average(_county_year(i), "violent_crime_total")


@query
def measure_moving_avg_property(i: Inputs) -> DataFrame:
    return measures.moving_average(_county_year(i), "property_crime_total")


@query
def measure_average_per_county(i: Inputs) -> DataFrame:
    return measures.average_per_county(_county_year(i))


@query
def measure_average_per_county_by_year(i: Inputs) -> DataFrame:
    return measures.average_per_county(_county_year(i), ["year"])


@query
def measure_quality_matrix(i: Inputs) -> DataFrame:
    return measures.quality_matrix(_county_year(i))


@query
def measure_above_ten_year_average(i: Inputs) -> DataFrame:
    return measures.above_trailing_average(_county_year(i), "total_index_crimes")


# ---------------------------------------------------------------- sources
ORDER_RECORDS = StructType([StructField(n, StringType()) for n in ("o_orderkey", "o_custkey", "o_orderstatus", "absent_key")])


def _order_pages(i: Inputs) -> str:
    """All orders as page files; order keys are sparse, so pages differ in length."""
    records = i.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.floor(F.col("o_orderkey") / 700).alias("page"))
    return pages.land_pages(records, i.folder("pages"), "page")


@query
def source_paged_rows(i: Inputs) -> DataFrame:
    """Pages of uneven length, pulled in ranges that don't know where pages end."""
    fetch = pages.LandedPages(_order_pages(i))
    return pages.read_pages(i.spark, fetch, schema=ORDER_RECORDS, page_limit=500, tasks=8, name="paged_orders")


@query
def source_landed_pages(i: Inputs) -> DataFrame:
    return pages.read_landed_pages(i.spark, _order_pages(i), ORDER_RECORDS)


@query
def source_conformed_records(i: Inputs) -> DataFrame:
    """Records with a key too many and a key too few."""
    records = i.stats().drop("months_reported").withColumn("extra_key", F.lit(1))
    return pages.conform_records(records.select(F.to_json(F.struct("*")).alias("record")), "record")


@query
def source_header_rows(i: Inputs) -> DataFrame:
    return tables.header_rows(i.lines())


@query
def source_rows_by_header(i: Inputs) -> DataFrame:
    roles = {r: cfg.BILLING_ROSTER_PATTERNS[r] for r in ("nyssis", "student_id", "first_name", "last_name", "grade")}
    return tables.select_by_header(tables.table_rows(i.lines()), roles)


@query
def source_junk_rows_dropped(i: Inputs) -> DataFrame:
    """Three rosters judged by their state IDs, the fourth by a column that holds no such IDs and so stays whole."""
    rows = i.text_roster().withColumn("id", F.when(F.col("k") == 3, F.col("sid_text")).otherwise(F.col("nyssis_text")))
    return tables.drop_junk_rows(rows, "id", "k").select("k", "row_id", "nyssis_text")


@query
def source_blank_rows_dropped(i: Inputs) -> DataFrame:
    return tables.drop_blank_rows(i.text_roster(), ["school_text", "status_text"]).select("row_id", "school_text", "status_text")


@query
def source_export_rows_identified(i: Inputs) -> DataFrame:
    return tables.filter_export_rows(i.st_enrollment(), ["student_universalstudentid", "studentid", "firstname"]).select("enrollment_seq")


@query
def source_newest_snapshot(i: Inputs) -> DataFrame:
    rows = i.st_enrollment().select("enrollment_seq", F.col("st_studentenrollment_startdate").alias("modified"))
    return tables.newest_snapshot(rows, "modified")


# ---------------------------------------------------------------- scalar functions over messy text
@query
def normalize_values(i: Inputs) -> DataFrame:
    txt = F.col("txt")
    return i.messy().select("id", text.normalize_value(txt).alias("reference"), text.normalize_value(txt, "id_safe").alias("id_safe"))


@query
def parse_dates(i: Inputs) -> DataFrame:
    txt = F.col("txt")
    return i.messy().select(
        "id", dates.normalize_dob(txt).alias("dob"), dates.parse_billing(txt).alias("billing"),
        dates.parse_billing_mixed(txt).alias("billing_mixed"), dates.parse_roster(txt).alias("roster"),
        dates.parse_roster_recent(txt).alias("roster_recent"))


@query
def clean_texts(i: Inputs) -> DataFrame:
    txt, full = F.col("txt"), F.col("full_name")
    named = i.messy().withColumn("full_name", F.expr(
        "CASE WHEN id % 5 = 0 THEN 'SOLO' ELSE ' Last' || (id % 7) || ', First M' || (id % 3) || ' ' END"))
    return named.select(
        "id", text.clean_id(txt).alias("clean_id"), text.strip_decimal_zero(txt).alias("one_zero"),
        text.normalize_name(txt).alias("name"), text.clean_fte(txt).alias("fte"), text.split_last(full).alias("last"),
        text.split_first(full).alias("first"), text.name_key(txt, F.nullif(full, F.lit("SOLO"))).alias("name_key"),
        dates.short_date(F.col("day")).alias("short_day"))


# ---------------------------------------------------------------- written tables, reports and their order
def _placed(i: Inputs, df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a sorted report with their place in the written files."""
    return ordinals.number_sorted(df.select(*columns), folder=i.folder("placed"))


@query
def order_conflicting_state_ids(i: Inputs) -> DataFrame:
    return _placed(i, quality.conflicting_keys(i.st_enrollment()), "normalized_nyssis_id")


@query
def order_spine_triage(i: Inputs) -> DataFrame:
    return _placed(i, audit_spine.triage(_spine(i)), "severity", "final_validation_status")


@query
def order_roster_summary(i: Inputs) -> DataFrame:
    return _placed(i, audit_roster.severity_summary(_roster_audits(i)), "severity", "final_validation_status")


@query
def order_of_written_rankings(i: Inputs) -> DataFrame:
    """Places in the written files: by file, then by row."""
    rankings = statistics.GOLD["gold_county_rankings"][0](_silver(i)).select("county", "year")
    return _placed(i, sinks.sorted_for_write(rankings, ["county", "year"]), "county", "year")


@query
def sink_refreshed_table(i: Inputs) -> DataFrame:
    """Written twice under one name, then scanned by name."""
    folder = i.folder("silver")
    name = "checks_" + folder.rsplit("-", 1)[1]
    sinks.write_table(_silver(i).limit(0).drop("agency"), name, path=folder)
    sinks.write_table(_silver(i), name, path=folder)
    return i.spark.table(name)


@query
def source_roster_file(i: Inputs) -> DataFrame:
    folder = i.folder("roster")
    columns = {"c_custkey": "Cust  Key", "nyssis_id": " NYSSIS ID", "student_id": "Student ID", "grade": "Grade"}
    i.gen_roster().select(*[F.col(n).alias(h) for n, h in columns.items()]).write.option("header", True).csv(folder)
    back = tables.read_roster(i.spark, folder)
    return back.select(*[F.col(f"`{tables.normalize_header(h)}`").alias(n) for n, h in columns.items()])


@query
def source_fallback(i: Inputs) -> DataFrame:
    return tables.with_fallback([None, i.monthly(1)], "c_custkey long, nyssis_id string").select("c_custkey", "nyssis_id")


@query
def source_required_rows(i: Inputs) -> DataFrame:
    return sinks.require_rows(i.st_enrollment()).select("enrollment_seq")


def _report_counts(i: Inputs, tabs: dict[str, DataFrame]) -> DataFrame:
    """Rows of every tab, read back from where the report was written."""
    paths = sinks.write_report(tabs, i.folder("report"))
    return sinks.table_counts({tab: i.spark.read.parquet(path) for tab, path in paths.items()})


@query
def report_roster_audit(i: Inputs) -> DataFrame:
    return _report_counts(i, audit_roster.report(_roster_audits(i), i.folder("audit")))


@query
def report_billing(i: Inputs) -> DataFrame:
    return _report_counts(i, audit_billing.report(_billing(i), folder=i.folder("audit")))


@query
def report_unified(i: Inputs) -> DataFrame:
    return _report_counts(i, unify.report(_final_roster(i), unify.dedupe_export(_exports(i)), "row_id", i.folder("audit")))


for _build in time_queries.BUILDERS:
    query(_build)
