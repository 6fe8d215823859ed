"""Queries over what was written: every tab of the reports, landed files with headers, newest deliveries, wide headers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import queries as q
from checks.inputs import Inputs, StagedInputs
from checks.oracles import ORACLES
from checks.oracles import query as sql
from tallyroll import config as cfg
from tallyroll.operators.keys import c
from tallyroll.plans import audit_billing, audit_roster, unify
from tallyroll.session import cut_lineage
from tallyroll.sources import sinks, tables

#: Reports written so far: each is written once per session and scale, all its tabs are read from there.
_WRITTEN: dict[tuple[str, str, str], dict[str, tuple[str, list[str]]]] = {}


def _billing_report(i: Inputs) -> dict[str, DataFrame]:
    """One prepared export for all lookups, one audit for all tabs."""
    export = audit_billing.written_export(q._billing_export(i), "enrollment_seq", i.folder("export"))
    return audit_billing.report(
        q._billing(i, export), lambda audited: q._sped_report(i, audited, export), lambda audited: q._compared(i, audited), i.folder("audit"))


def _unified_report(i: Inputs) -> dict[str, DataFrame]:
    """One cleaned export for the patch passes and the lookups."""
    st = cut_lineage(q._exports(i).drop("source", "enrollment_seq"), i.folder("export"))  # both are in st_ord
    return unify.report(q._final_roster(i, st), unify.dedupe_export(st), "row_id", i.folder("audit"))


REPORTS: dict[str, Callable[[Inputs], dict[str, DataFrame]]] = {
    "roster": lambda i: audit_roster.report(q._roster_audits(i), i.folder("audit")),
    "billing": _billing_report,
    "unified": _unified_report,
}
#: tab -> the query whose rows it holds.
TABS = {
    "roster": {"Full_Audit": "audit_roster_fields", "Exceptions": "audit_roster_exceptions", "Severity_Summary": "audit_roster_summary"},
    "billing": {"Roster": "billing_output", "Audit_Summary": "billing_summary", "Not_In_ST": "billing_not_in_st", "Multiple_Enrollments": "billing_multiple_enrollments",
                "Action_Needed": "billing_action_needed", "SPED_Roster": "sped_roster_report", "VS_Final_Summary": "compare_final_summary", "VS_Final_Detail": "compare_final_differences"},
    "unified": {"All Charters Unified": "unified_dedupe", "Copy Paste": "unified_dedupe", "Not Found in ST": "unified_not_found",
                "Update Log": "unified_update_log", "ST Enroll Export": "export_dedupe"},
}
#: Columns of those queries that the tab leaves out.
WITHOUT = {"Roster": "row_id", "VS_Final_Detail": "entry_discrepancy", "All Charters Unified": "row_id", "Copy Paste": "row_id"}
#: Tabs of which the query shows some columns; of the others it shows all.
SHOWN = {"Not Found in ST": q.NOT_FOUND_COLUMNS}


def _tab(i: Inputs, report: str, tab: str) -> DataFrame:
    """The tab as written, read back under its own column names."""
    key = (i.spark.sparkContext.applicationId, i.dir, report)
    if key not in _WRITTEN:
        tabs = REPORTS[report](StagedInputs(i.spark, i.dir))
        paths = sinks.write_report(tabs, i.folder("report"))
        _WRITTEN[key] = {name: (paths[name], df.columns) for name, df in tabs.items()}
    path, columns = _WRITTEN[key][tab]
    return i.spark.read.parquet(path).toDF(*columns)


def _tab_query(report: str, tab: str) -> Callable[[Inputs], DataFrame]:
    def build(i: Inputs) -> DataFrame:
        written = _tab(i, report, tab)
        return written.select(*[c(n) for n in SHOWN.get(tab, written.columns)])

    build.__name__ = f"report_{report}_tab_{tab.lower().replace(' ', '_')}"
    return build


# ---------------------------------------------------------------- landed files
def _landed_lines(i: Inputs) -> DataFrame:
    """The lines written as one text file each, then read in splits of a few lines."""
    folder = i.folder("lines")
    lines = i.lines().withColumn("of", F.col("file"))
    lines.repartition("of").sortWithinPartitions("of", "pos").select("of", "line").write.partitionBy("of").text(folder)
    before = i.spark.conf.get("spark.sql.files.maxPartitionBytes")
    i.spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 << 10))
    try:
        read = tables.read_lines(i.spark, folder)
        name = F.url_decode(F.regexp_extract("file", r"/of=([^/]*)/", 1))
        return cut_lineage(read.withColumn("file", name), i.folder("read"))
    finally:
        i.spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def source_landed_header_rows(i: Inputs) -> DataFrame:
    return tables.header_rows(_landed_lines(i).withColumn("file", F.col("file").cast(i.lines().schema["file"].dataType)))


def source_landed_rows_by_header(i: Inputs) -> DataFrame:
    roles = {r: cfg.BILLING_ROSTER_PATTERNS[r] for r in ("nyssis", "student_id", "first_name", "last_name", "grade")}
    lines = _landed_lines(i).withColumn("file", F.col("file").cast(i.lines().schema["file"].dataType))
    return tables.select_by_header(tables.table_rows(lines), roles).drop("pos")  # files have no gaps between lines, the derived lines do


def source_newest_delivery(i: Inputs) -> DataFrame:
    """Two deliveries into one folder; the newest counts by the time of its files. Each is written by as many tasks as its rows take."""
    folder, rows = i.folder("deliveries"), i.gen_roster().select("c_custkey", "nyssis_id", "grade")
    rows.write.option("header", True).csv(f"{folder}/delivery-1")
    later = rows.filter("c_custkey % 5 <> 0").withColumn("grade", F.concat(F.lit("G"), "grade"))
    later.write.option("header", True).csv(f"{folder}/delivery-2")
    return tables.read_newest_file(i.spark, folder, in_folders=True)


def source_newest_disability_file(i: Inputs) -> DataFrame:
    """The same for files that Spark has read already: the file's time travels as a column."""
    folder = i.folder("disability")
    rows = i.st_enrollment().filter("schoolyear_disability IS NOT NULL").select("enrollment_seq", "studentid")
    rows.write.parquet(f"{folder}/delivery-1")
    rows.filter("enrollment_seq % 3 = 0").write.parquet(f"{folder}/delivery-2")
    dated = i.spark.read.option("recursiveFileLookup", True).parquet(folder).select(
        "enrollment_seq", "studentid", F.col("_metadata.file_modification_time").alias("file_modification_time"), tables.folder_of(F.col("_metadata.file_path")).alias("delivery"))
    return tables.newest_snapshot(dated, delivery="delivery").select("enrollment_seq", "studentid")


# ---------------------------------------------------------------- wide header lists
WIDE_ROSTER = {"row_id": "row_id", "Universal Student Identifier / NYSSIS": "nyssis_text", "Student ID": "sid_text", "Legal First Name of Student": "first_text", "Legal Last Name of Student": "last_text",
               "Student Birth Date": "dob_text", "Grade Level 2025": "grade_text", "Student Entry Date": "entered_text", "Student Leave Date": "withdrew_text", "SCSD FTE": "fte_text"}


def source_wide_headers(i: Inputs) -> DataFrame:
    """A roster whose headers only the wide lists resolve."""
    roster = i.text_roster().select(*[F.col(s).alias(h) for h, s in WIDE_ROSTER.items()])
    patterns = tables.widened(cfg.BILLING_ROSTER_PATTERNS, cfg.BILLING_ROSTER_PATTERNS_WIDE)
    found = tables.conform_to_roles(roster, patterns, keep=["row_id"])
    return found.select("row_id", "nyssis", "student_id", "first_name", "last_name", "dob", "grade", "entry", "exit", "fte")


def source_wide_export_headers(i: Inputs) -> DataFrame:
    export = i.st_enrollment().selectExpr(
        "enrollment_seq", "CAST(st_nyssis_id AS STRING) AS `Universal Student Identifier (ID)`", "studentid AS `District Student ID`", "CAST(st_studentenrollment_startdate AS STRING) AS `Entry Date of Student`",
        "CAST(st_studentenrollment_enddate AS STRING) AS `Exit Date of Student`", "schoolname AS `School Long Name`", "firstname AS `Legal First Name`")
    patterns = tables.widened(cfg.BILLING_EXPORT_PATTERNS, cfg.BILLING_EXPORT_PATTERNS_WIDE)
    return tables.conform_to_roles(export, patterns, keep=["enrollment_seq"]).select("enrollment_seq", "nyssis", "student_id", "entry", "exit", "school", "first_name")


BUILDERS = [_tab_query(report, tab) for report, tabs in TABS.items() for tab in tabs] + [
    source_landed_header_rows, source_landed_rows_by_header, source_newest_delivery, source_newest_disability_file, source_wide_headers, source_wide_export_headers]
for _build in BUILDERS:
    q.query(_build)

SQL = {
    **{f"report_{report}_tab_{tab.lower().replace(' ', '_')}": f"SELECT * EXCLUDE ({WITHOUT[tab]}) FROM ({ORACLES[source]})" if tab in WITHOUT else ORACLES[source] for report, tabs in TABS.items() for tab, source in tabs.items()},
    "source_landed_header_rows": ORACLES["source_header_rows"],
    "source_landed_rows_by_header": f"SELECT * EXCLUDE (pos) FROM ({ORACLES['source_rows_by_header']})",
    "source_newest_delivery": sql("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, nyssis_id, 'G' || grade AS grade FROM gen_roster WHERE c_custkey % 5 <> 0", "gen_roster"),
    "source_newest_disability_file": sql("SELECT enrollment_seq, studentid FROM st_enrollment WHERE schoolyear_disability IS NOT NULL AND enrollment_seq % 3 = 0", "st_enrollment"),
    "source_wide_headers": sql("SELECT row_id, nyssis_text AS nyssis, sid_text AS student_id, first_text AS first_name, last_text AS last_name, dob_text AS dob, grade_text AS grade, entered_text AS entry, withdrew_text AS exit, fte_text AS fte FROM text_roster", "text_roster"),
    "source_wide_export_headers": sql("SELECT enrollment_seq, CAST(st_nyssis_id AS VARCHAR) AS nyssis, studentid AS student_id, CAST(st_studentenrollment_startdate AS VARCHAR) AS entry, CAST(st_studentenrollment_enddate AS VARCHAR) AS exit, schoolname AS school, firstname AS first_name FROM st_enrollment", "st_enrollment"),
}
