"""Unified roster: four raw layouts to one template, patched from the enrollment exports, de-duplicated, with queues."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll import config as cfg
from tallyroll.functions import dates, text
from tallyroll.functions.ladders import ladder
from tallyroll.operators import lookups
from tallyroll.operators.keys import c, first_per_key, left_on_key
from tallyroll.session import cut_lineage

DATE_COLUMNS = ("DOB", "Enroll Date", "Withdraw Date")
ID_COLUMNS = ("NYSSIS ID", "Student ID")
# Texts of the two work queues.
LOOK_UP = "Look up NYSSIS in SchoolTool — enter in Update Log tab"
VERIFY = "Student not found in ST enrollment — verify with reviewer"
LOG_NO_NAME = "No name in source file — manual lookup required."
LOG_DEFAULT = "Not found in any ST export — verify enrollment with reviewer."
NOT_IN_ST = "Not in ST System"
NOT_IN_ST_NOTE = "Not pulling up in ST. Need more student information."
CHANGE_IN_ST = "Need charter attendance record to change in ST."
NO_RECORD = "No enrollment record in ST. " + CHANGE_IN_ST
# What counts as blank, column by column.
BLANKS = {
    "NYSSIS ID": ("0", "", "Not Found"), "Last Name": ("0", "", "None"), "School Name": ("", "0", "None"),
    "Student ID": ("", "0", "Not Found", "None"), "Student Status": ("", "None", "NA"),
}


PATCHED_BLANKS = {"Student ID": ("0", "", "NA"), "NYSSIS ID": ("0", "", "NA"), "DOB": (), "School Name": ("0", "", "NA")}


# ---------------------------------------------------------------- build
def build_source(raw: DataFrame, spec: cfg.CharterSpec, month: date, source_file: str, keep: Sequence[str] = (),
                 parse=dates.parse_roster) -> DataFrame:
    """One charter's raw text table in template columns; rows without state ID and name are dropped."""
    id_column, last_column = spec.columns["NYSSIS ID"], spec.full_name or spec.columns["Last Name"]
    rows = raw.filter(c(id_column).isNotNull() | c(last_column).isNotNull())

    def value(target: str) -> Column:
        if target in spec.constants:
            return F.lit(spec.constants[target])
        if spec.full_name and target in ("Last Name", "First Name"):
            split = text.split_last if target == "Last Name" else text.split_first
            return split(c(spec.full_name))
        name = spec.columns.get(target)
        if name is None or name not in raw.columns:
            return F.lit(None).cast({"SCSD FTE": "double"}.get(target, "date" if target in DATE_COLUMNS else "string"))
        if target in ID_COLUMNS:
            return text.clean_id(c(name))
        if target in DATE_COLUMNS:
            return parse(c(name))
        return text.clean_fte(c(name)) if target == "SCSD FTE" else text.strip(c(name).cast("string"))

    fixed = {"Charter_Source Ticket #": F.lit(spec.label), "Charter Month": F.lit(month), "Source_File": F.lit(source_file)}
    return rows.select(*[c(k) for k in keep], *[
        (fixed[t] if t in fixed else value(t)).alias(t) for t in cfg.UNIFIED_COLUMNS])


def combine(frames: Sequence[DataFrame]) -> DataFrame:
    """All sources under one template, pseudo-nulls NULL."""
    from tallyroll.sources.tables import clean_null_tokens

    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return clean_null_tokens(result)


def combine_exports(exports: dict[str, DataFrame], row_ordinal: str) -> DataFrame:
    """Enrollment exports with their source label and one total order ``st_ord`` (source, row)."""
    frames = [
        df.withColumns({"source": F.lit(label), "st_ord": F.struct(F.lit(i).alias("source_ord"), c(row_ordinal).cast("long").alias("row_ord"))})
        for i, (label, df) in enumerate(exports.items())
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def clean_export(st: DataFrame) -> DataFrame:
    """Export roles nyssis, sid, fname, lname, dob, school, start, end + st_ord, cleaned; rows without any identifier go."""
    identified = st.filter(text.present(c("nyssis")) | text.present(c("sid")) | text.present(c("fname")))
    return identified.withColumns({
        "nyssis": text.clean_id(c("nyssis"), cfg.NULLS_EXPORT_ID), "sid": text.clean_id(c("sid"), cfg.NULLS_EXPORT_ID),
        "fname": text.null_tokens(text.upper_trim(c("fname")), cfg.NULLS_EXPORT_NAME),
        "lname": text.null_tokens(text.upper_trim(c("lname")), cfg.NULLS_EXPORT_NAME),
        "school": text.strip(c("school")),
    })


def dedupe_export(st: DataFrame) -> DataFrame:
    """First row per (state ID, student ID, start day, school); NULL parts count as ''."""
    parts = {f"_key_{n}": F.coalesce(c(n).cast("string"), F.lit("")) for n in ("nyssis", "sid", "start", "school")}
    return first_per_key(st.withColumns(parts), list(parts), [c("st_ord").asc()]).drop(*parts)


# ---------------------------------------------------------------- three patch passes
def _names() -> tuple[Column, Column, Column]:
    first = text.null_tokens(text.upper_trim(c("First Name")), cfg.NULLS_EXPORT_NAME)
    last = text.null_tokens(text.upper_trim(c("Last Name")), cfg.NULLS_EXPORT_NAME)
    return first, last, c("DOB").cast("string")


def _both(a: Column, b: Column) -> Column:
    """Composite key, NULL if a part is NULL."""
    return F.concat(a, F.lit("\u001f"), b)


def _long(name: Column) -> Column:
    """Names of one letter identify nobody."""
    return F.when(F.length(name) > 1, name)


def missing(col: Column, *tokens: str) -> Column:
    """TRUE/FALSE, never NULL: no value, '0' or one of the tokens."""
    return ~text.present(col, ("0", *tokens))


def _patch_id(roster: DataFrame, st: DataFrame, row_id: str, target: str, st_target: str, direct: str, st_direct: str) -> DataFrame:
    """Fill an ID by the other ID, first + last name, last name + birth date, first name + birth date (if unique)."""
    first, last, dob = _names()
    row_levels = [F.when(c(direct) != "0", c(direct)), _both(_long(first), _long(last)), _both(_long(last), dob), _both(_long(first), dob)]
    s_dob = c("dob").cast("string")
    st_levels = [c(st_direct), _both(c("fname"), c("lname")), _both(c("lname"), s_dob), _both(c("fname"), s_dob)]
    source = st.filter(c(st_target).isNotNull())
    table = lookups.level_table(source, st_levels, [F.min_by(c(st_target), c("st_ord")).alias("_found")],
                                [c(st_target), c("st_ord")], unique_levels=[3])
    needs = missing(c(target))
    patched = lookups.patch(roster, row_id, needs, row_levels, table, ["_found"])
    return patched.withColumn(target, F.coalesce("_found", c(target))).drop("_found")


def patch_student_id(roster: DataFrame, st: DataFrame, row_id: str) -> DataFrame:
    return _patch_id(roster, st, row_id, "Student ID", "sid", "NYSSIS ID", "nyssis")


def patch_nyssis(roster: DataFrame, st: DataFrame, row_id: str) -> DataFrame:
    return _patch_id(roster, st, row_id, "NYSSIS ID", "nyssis", "Student ID", "sid")


def patch_dob_and_school(roster: DataFrame, st: DataFrame, row_id: str) -> DataFrame:
    """Fill birth date and school from one export row, found by student ID, state ID, or first + last name."""
    first, last, _ = _names()
    row_levels = [F.when(c("Student ID") != "0", c("Student ID")), F.when(c("NYSSIS ID") != "0", c("NYSSIS ID")),
                  _both(_long(first), _long(last))]
    st_levels = [c("sid"), c("nyssis"), _both(c("fname"), c("lname"))]
    found = F.struct(c("dob").alias("dob"), c("school").alias("school"))
    table = lookups.level_table(st, st_levels, [F.min_by(found, c("st_ord")).alias("_found")], [c("dob"), c("school"), c("st_ord")])
    no_dob, no_school = c("DOB").isNull(), missing(c("School Name"), "", "NA")
    patched = lookups.patch(roster, row_id, no_dob | no_school, row_levels, table, ["_found"])
    school = text.null_tokens(F.col("_found.school"), ("NA",))
    return patched.withColumns({
        "DOB": F.coalesce(c("DOB"), F.col("_found.dob")),
        "School Name": F.when(no_school, F.coalesce(school, c("School Name"))).otherwise(c("School Name")),
    }).drop("_found")


def patch_all(roster: DataFrame, st: DataFrame, row_id: str) -> DataFrame:
    """Student IDs, then state IDs (seeing the new student IDs), then birth date and school.

    Only the columns that the lookups read and fill go through them, and only those of
    incomplete rows; what they found is joined to the whole rows once, by row.
    """
    incomplete = (
        missing(c("Student ID")) | missing(c("NYSSIS ID")) | c("DOB").isNull() | missing(c("School Name"), "", "NA"))
    filled = ["Student ID", "NYSSIS ID", "DOB", "School Name"]
    gaps = roster.filter(incomplete).select(c(row_id), *[c(n) for n in (*filled, "First Name", "Last Name")])
    for step in (patch_student_id, patch_nyssis, patch_dob_and_school):
        gaps = step(gaps, st, row_id)
    found = gaps.select(c(row_id).alias("_id"), *[c(n).alias(f"_{k}") for k, n in enumerate(filled)])
    joined = roster.join(found, c(row_id) == F.col("_id"), "left")
    new = {n: F.when(F.col("_id").isNotNull(), F.col(f"_{k}")).otherwise(c(n)).alias(n) for k, n in enumerate(filled)}
    return joined.select(*[new[n] if n in new else c(n) for n in roster.columns])


def patch_counters(before: DataFrame, after: DataFrame, row_id: str, blanks: dict[str, tuple[str, ...]] = PATCHED_BLANKS) -> DataFrame:
    """Per field: values filled and values still missing; ``blanks`` tells what counts as missing in each field."""
    def gap(prefix: str, name: str) -> Column:
        return ~text.present(c(prefix + name).cast("string"), blanks[name])

    old = before.select(c(row_id).alias("_id"), *[c(n).alias("_old" + n) for n in blanks])
    joined = after.join(old, c(row_id) == F.col("_id"))
    one = joined.agg(*[
        m for i, n in enumerate(blanks) for m in (
            F.count_if(gap("_old", n) & ~gap("", n)).alias(f"p{i}"), F.count_if(gap("", n)).alias(f"s{i}"))
    ])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("field"), F.col(f"p{i}").alias("patched"), F.col(f"s{i}").alias("still_missing"))
        for i, n in enumerate(blanks)])))


# ---------------------------------------------------------------- de-duplication
def dedupe_within_charter(roster: DataFrame, row_id: str) -> DataFrame:
    """Per charter and state ID: rows of the general roster beat rows marked 'not on gen roster'; else rows with
    different enroll dates are re-enrollments and all stay; else the first row stays. Rows without a state ID and
    the same ID in another charter are untouched.

    The decision needs five numbers per group, aggregated before the shuffle; no group is collected.
    """
    label = c("Charter_Source Ticket #")
    nyssis = text.clean_id(c("NYSSIS ID"), cfg.NULLS_EXPORT_ID)
    marked = roster.withColumns({
        "_off_gen": F.coalesce(F.lower(c("SPED_Flag")).contains("not on gen roster"), F.lit(False)),
        "_group": F.when(nyssis.isNotNull(), F.concat_ws("\u001f", label, nyssis)),
    })
    groups = marked.filter("_group is not null").groupBy(F.col("_group").alias("_g")).agg(
        F.max((~F.col("_off_gen")).cast("int")).alias("_gen"), F.max(F.col("_off_gen").cast("int")).alias("_off"),
        F.min(c("Enroll Date")).alias("_lo"), F.max(c("Enroll Date")).alias("_hi"), F.min(c(row_id)).alias("_first"))
    joined = left_on_key(marked, groups, F.col("_group"), "_g", [row_id])
    both = (F.col("_gen") == 1) & (F.col("_off") == 1)
    keep = (
        F.when(F.col("_group").isNull(), True).when(both, ~F.col("_off_gen"))
        .when(F.col("_lo") < F.col("_hi"), True).otherwise(c(row_id) == F.col("_first"))
    )
    return joined.filter(keep).drop("_off_gen", "_group", "_gen", "_off", "_lo", "_hi", "_first")


# ---------------------------------------------------------------- classification against all export rows
def school_matches(school: Column, spec: cfg.CharterSpec) -> Column:
    return text.contains_any(school, spec.keywords)


def classify(st_found: Column, first: Column, best: Column, enroll: Column, withdraw: Column) -> tuple[Column, Column]:
    """(status, notes) of one roster row.

    ``first`` is the first export row of the student, ``best`` the latest one at this
    charter (NULL if none), both structs of school, start, end.
    """
    short = dates.short_date
    entry_gap = F.abs(dates.diff_days(enroll, best["start"])) > 3
    exit_gap = F.abs(dates.diff_days(withdraw, best["end"])) > 3
    no_start = best["start"].isNull() & enroll.isNotNull()
    period = F.concat(
        F.coalesce(short(first["start"]), F.lit("")),
        F.when(first["end"].isNotNull(), F.concat(F.lit(" - "), short(first["end"])))
        .when(first["start"].isNotNull(), "-current").otherwise(""))
    elsewhere = F.concat(F.lit("ST states: student started "), F.coalesce(first["school"], F.lit("")), F.lit(" "), period,
                         F.lit(".  " + CHANGE_IN_ST))
    here = F.concat_ws(
        " ",
        F.when(entry_gap, F.concat(
            F.lit("ST states: student enrolled at "), F.coalesce(best["school"], F.lit("")), F.lit(" "), short(best["start"]),
            F.lit(" . Entry date is "), F.abs(dates.diff_days(enroll, best["start"])).cast("string"),
            F.lit("> discrepancy. " + CHANGE_IN_ST))),
        F.when(no_start, NO_RECORD),
        F.when(withdraw.isNotNull() & best["end"].isNull(), F.concat(
            F.lit("Charter has exit date "), short(withdraw), F.lit(" but no ST exit — this will update in ST."))),
        F.when(exit_gap, F.concat(
            F.lit("Charter exit "), short(withdraw), F.lit(" does not match ST exit "), short(best["end"]),
            F.lit(". This will update in ST."))))
    status = ladder([(~st_found, NOT_IN_ST), (best.isNull(), "No Good"), (entry_gap | no_start | exit_gap, "No Good")], "Good")
    notes = ladder([(~st_found, NOT_IN_ST_NOTE), (best.isNull(), elsewhere)], text.blank_to_null(here))
    return status, notes


def _export_table(st: DataFrame, charters: Sequence[cfg.CharterSpec]) -> DataFrame:
    """Per lookup key: the first export row, and per charter its latest row and its first row's school."""
    start = F.coalesce(c("start"), F.lit(date(2000, 1, 1)))
    brief = F.struct(c("school").alias("school"), c("start").alias("start"), c("end").alias("end"))
    whole = F.struct(*[c(n).alias(n) for n in ("nyssis", "sid", "lname_text", "school", "start", "end")])
    by_recency = F.struct(start, -F.col("st_ord")["source_ord"], -F.col("st_ord")["row_ord"])
    aggregates = [F.min_by(whole, c("st_ord")).alias("first")]
    for i, spec in enumerate(charters):
        ok = school_matches(c("school"), spec)
        aggregates.append(F.max_by(brief, F.when(ok, by_recency)).alias(f"best_{i}"))
        aggregates.append(F.min_by(c("school"), F.when(ok, c("st_ord"))).alias(f"school_{i}"))
    levels = [c("nyssis"), c("sid"), _both(c("lname"), c("fname"))]
    return lookups.level_table(st, levels, aggregates,
                               [c(n) for n in ("nyssis", "sid", "lname_text", "school", "start", "end", "st_ord")])


def patch_and_classify(roster: DataFrame, st: DataFrame, row_id: str,
                       charters: Sequence[cfg.CharterSpec] = cfg.CHARTERS) -> DataFrame:
    """Fill blank state ID, last name, school, student ID and status from the first lookup level that knows the student.

    Levels: state ID, student ID, last + first name. ``st`` is a cleaned, de-duplicated
    export with its original last name in ``lname_text``. Values that are there stay,
    and rows with nothing blank are not looked up.
    """
    key = lambda name: text.null_tokens(text.clean_id(c(name)), cfg.NULLS_LOOKUP_KEY)
    last = text.null_tokens(text.upper_trim(c("Last Name")), ("",))
    first_name = text.null_tokens(text.upper_trim(c("First Name")), ("",))
    levels = [key("NYSSIS ID"), key("Student ID"), _both(last, first_name)]
    table = _export_table(st, charters)
    payload = [n for n in table.columns if n not in ("level", "key")]
    wanting = F.lit(False)
    for name, tokens in BLANKS.items():
        wanting = wanting | ~text.present(c(name), tokens)
    found = lookups.patch(roster, row_id, wanting, levels, table, payload)

    labels = [(c("Charter_Source Ticket #") == spec.label, i) for i, spec in enumerate(charters)]
    best = ladder([(cond, F.col(f"best_{i}")) for cond, i in labels])
    school = ladder([(cond, F.col(f"school_{i}")) for cond, i in labels])
    picked = found.withColumns({"_best": best, "_school": school, "_found": F.col("first").isNotNull()}).drop(
        *[n for n in payload if n != "first"])
    status, notes = classify(F.col("_found"), F.col("first"), F.col("_best"), c("Enroll Date"), c("Withdraw Date"))
    no_status = ~text.present(c("Student Status"), BLANKS["Student Status"])
    no_notes = ~text.present(c("review_notes"), ("", "None", "NA"))

    def fill(name: str, value: Column) -> Column:
        return F.when(~text.present(c(name), BLANKS[name]), F.coalesce(value, c(name))).otherwise(c(name))

    return picked.withColumns({
        "NYSSIS ID": fill("NYSSIS ID", F.col("first.nyssis")),
        "Last Name": fill("Last Name", text.blank_to_null(F.col("first.lname_text"))),
        "School Name": fill("School Name", text.blank_to_null(F.col("_school"))),
        "Student ID": fill("Student ID", F.col("first.sid")),
        "review_notes": F.when(no_status & no_notes, F.coalesce(notes, c("review_notes"))).otherwise(c("review_notes")),
        "Student Status": F.when(no_status, status).otherwise(c("Student Status")),
    }).drop("first", "_best", "_school", "_found")


# ---------------------------------------------------------------- queues and lookups
def no_nyssis(*extra: str) -> Column:
    return missing(c("NYSSIS ID"), "", *extra)


def not_found(roster: DataFrame) -> DataFrame:
    """Rows without a state ID or not in the enrollment system, with what to do."""
    unresolved = no_nyssis("Not Found", "None")
    absent = F.coalesce(c("Student Status") == NOT_IN_ST, F.lit(False))
    return roster.filter(unresolved | absent).withColumn("Action Needed", F.when(unresolved, LOOK_UP).otherwise(VERIFY))


def update_log_seed(roster: DataFrame) -> DataFrame:
    """Unresolved rows as the starting point of the update log."""
    columns = ["NYSSIS ID", "Student ID", "Last Name", "First Name", "DOB", "Grade Level", "School Name", "Charter_Source Ticket #"]
    nameless = ~text.present(c("First Name"), ("NA", ""))
    return roster.filter(no_nyssis("Not Found")).select(
        *[c(n) for n in columns], F.lit("Pending").alias("Resolved_By"), F.lit(None).cast("date").alias("Resolved_Date"),
        F.when(nameless, LOG_NO_NAME).otherwise(LOG_DEFAULT).alias("Notes"))


def export_lookups(roster: DataFrame, st: DataFrame, row_id: str) -> DataFrame:
    """State ID, school and student ID as the export has them, and which key found them."""
    order = [c("st_ord").asc()]
    by_sid = first_per_key(st, ["sid"], order).select(
        c("sid").alias("_k"), c("nyssis").alias("_s_nyssis"), c("school").alias("_s_school"), c("sid").alias("_s_sid"))
    by_nyssis = first_per_key(st, ["nyssis"], order).select(
        c("nyssis").alias("_k"), c("nyssis").alias("_n_nyssis"), c("school").alias("_n_school"), c("sid").alias("_n_sid"))
    joined = left_on_key(roster, by_sid, c("Student ID"), "_k", [row_id])
    joined = left_on_key(joined, by_nyssis, c("NYSSIS ID"), "_k", [row_id])
    missing_text = F.lit("Not Found")
    looked = joined.withColumns({
        "ST_NYSSIS_Lookup": F.coalesce("_s_nyssis", "_n_nyssis", missing_text),
        "ST_School_Lookup": F.coalesce("_n_school", "_s_school", missing_text),
        "ST_SID_Lookup": F.coalesce("_n_sid", "_s_sid", missing_text),
    }).drop("_s_nyssis", "_s_school", "_s_sid", "_n_nyssis", "_n_school", "_n_sid")
    return looked.withColumn("Match_Source", ladder([
        (F.col("ST_NYSSIS_Lookup") == "Not Found", "No ST Match"),
        (F.col("ST_NYSSIS_Lookup") == c("NYSSIS ID"), "NYSSIS Match"),
    ], "SID Match"))


def resolve_from_log(roster: DataFrame, log: DataFrame, row_id: str, order: Sequence[Column]) -> DataFrame:
    """State ID from the update log by student ID, else the roster's own."""
    entry = first_per_key(log, ["Student ID"], order).select(
        c("Student ID").alias("_k"), c("NYSSIS ID").alias("_log_nyssis"), F.lit(True).alias("_logged"))
    key = text.null_tokens(c("Student ID"), ("", "Not Found"))
    joined = left_on_key(roster, entry, key, "_k", [row_id])
    return joined.withColumns({
        "Resolved_NYSSIS": F.coalesce("_log_nyssis", c("NYSSIS ID")),
        "Match_Source": ladder([(key.isNull(), "No Student ID"), (F.col("_logged"), "Update Log")], "Master Roster"),
    }).drop("_log_nyssis", "_logged")


EXPORT_TAB = {"nyssis": "NYSSIS_ID", "sid": "Student_ID", "lname_text": "Last_Name", "fname_text": "First_Name", "dob": "DOB",
              "grade": "Grade", "school": "School_Name", "start": "Enroll_Start", "end": "Enroll_End",
              "entry_note": "Entry_Note", "exit_note": "Exit_Note"}


def export_tab(st: DataFrame) -> DataFrame:
    """The combined enrollment export in lookup order of columns."""
    return st.select(*[c(n).alias(new) if n in st.columns else F.lit(None).cast("string").alias(new) for n, new in EXPORT_TAB.items()])


def report(roster: DataFrame, st: DataFrame, row_id: str, folder: str | None = None) -> dict[str, DataFrame]:
    """The tabs of the unified-roster report. Roster and export are written once, below the shared folder, and the tabs read them from there."""
    # Only what the tabs read of the export is shuffled by its de-duplication and written.
    st = st.select(*[c(n) for n in st.columns if n in EXPORT_TAB or n == "st_ord"])
    roster, st = cut_lineage(roster, folder), cut_lineage(st, folder)
    plain = roster.select(*[c(n) for n in cfg.UNIFIED_COLUMNS])
    return {
        "All Charters Unified": plain, "Formula Version": export_lookups(roster, st, row_id), "Copy Paste": plain,
        "Not Found in ST": not_found(roster), "Update Log": update_log_seed(roster), "ST Enroll Export": export_tab(st),
    }
