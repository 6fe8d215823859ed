"""Rule ladders of the two roster audits.

The two dialects disagree on labels, order and severity on purpose; they are kept
apart and never blended. ``spine`` starts from the enrollment system, ``roster``
starts from one school's roster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroll.functions.ladders import is_in, ladder
from tallyroll.functions.text import present

# Labels shared by both dialects.
FROM_STUDENT_ID = "SchoolTool StudentID"
FROM_UNIVERSAL_ID = "Universal StudentID"
FROM_MAPPING = "NYSSID Mapping"
NO_SOURCE = "No Match"
NO_ID = "Missing Student ID Match"
NO_ROSTER = "No Roster Match"
MISSING, EXACT, WITHIN, RISK = "Missing Date", "Exact Match", "Within Tolerance", "Finance Risk"
INVALID_ID, INCOMPLETE, MISMATCH = "Invalid - No ID Match", "Incomplete - Missing Dates", "Invalid - Date Mismatch"
VALID, WARNING = "Valid", "Valid with Warning"

# Recommended actions, in the order in which they are looked up.
SPINE_EXIT_ACTIONS = {
    "Missing Roster Exit": "Add exit date to Southside roster",
    "Missing ST Exit": "Verify exit date in StudentTracker",
    "Both Dates Missing": "Investigate enrollment record - both exit dates absent",
    "Roster Exit Late": "Review late exit discrepancy with billing team",
    "Roster Exit Early": "Review early exit discrepancy with billing team",
}
SPINE_ENTRY_ACTIONS = {RISK: "Do not approve billing prior to ST entry", MISSING: "Add entry date to enrollment record"}
SPINE_NO_ACTION = "No Action Required"
ROSTER_ID_ACTIONS = (
    "Locate student in SchoolTool; confirm NYSSIS on roster.", "Resolve Student ID via NYSSIS mapping or Universal ID.")
ROSTER_EXIT_ACTIONS = {
    "Missing Roster Exit": "Add exit/withdrawal date to roster.",
    "Missing ST Exit": "Enter exit date in SchoolTool.",
    "Both Dates Missing": "Verify enrollment status; both exit dates absent.",
    "Roster Exit Late (>5)": "Reconcile roster exit date - billed beyond ST exit.",
    "Roster Exit Early (<-5)": "Reconcile roster exit date - earlier than ST exit.",
}
ROSTER_ENTRY_ACTIONS = {RISK: "Reconcile entry dates - FTE/billing risk.", MISSING: "Add missing entry/enrollment date."}
ROSTER_SPED_ACTIONS = {
    "Mismatch - Roster SPED / ST Gen Ed": "Confirm IEP classification; roster says SPED.",
    "Mismatch - Roster Gen Ed / ST SPED": "Confirm IEP classification; ST says SPED.",
}
ROSTER_NO_ACTION = "No action - record valid."


def _looked_up(value: Column, actions: dict[str, str]) -> list[tuple[Column, str]]:
    return [(value == label, action) for label, action in actions.items()]


def id_source(student_id: Column, universal_id: Column, mapped_id: Column, blank_counts_as_value: bool) -> Column:
    """Which ID won. The spine dialect looks at NULL only, so '' still names the student ID."""
    has = (lambda x: x.isNotNull()) if blank_counts_as_value else present
    return ladder(
        [(has(student_id), FROM_STUDENT_ID), (has(universal_id), FROM_UNIVERSAL_ID), (has(mapped_id), FROM_MAPPING)],
        NO_SOURCE,
    )


def spine_id_match(resolved: Column, roster_ids: dict[str, Column]) -> Column:
    """First roster (in the given order) that carries the resolved ID."""
    steps = [(resolved == "", NO_ID)]
    steps += [(roster_id == resolved, f"Matched - {label}") for label, roster_id in roster_ids.items()]
    return ladder(steps, NO_ROSTER)


def roster_id_match(found: Column, resolved: Column, school: Column) -> Column:
    return ladder([(~found, NO_ROSTER), (resolved == "", NO_ID)], F.concat(F.lit("Matched - "), school))


def iep_flag(is_sped: Column) -> Column:
    return F.when(is_sped, "IEP").otherwise("Gen Ed")


def spine_disability_check(roster_sped: Column, st_sped: Column) -> Column:
    return ladder([
        (~roster_sped & ~st_sped, "Consistent - Gen Ed"),
        (roster_sped & st_sped, "Consistent - SPED"),
        (~roster_sped & st_sped, "Mismatch - Roster Gen Ed but Disability Record IEP"),
        (roster_sped & ~st_sped, "Mismatch - Roster SPED but No Disability Record"),
    ], "Unknown")


def roster_disability_check(found: Column, roster_sped: Column, st_sped: Column) -> Column:
    return ladder([
        (~found, "No SchoolTool Record"),
        (roster_sped & st_sped, "Consistent SPED"),
        (~roster_sped & ~st_sped, "Consistent Gen Ed"),
        (roster_sped, "Mismatch - Roster SPED / ST Gen Ed"),
        (st_sped, "Mismatch - Roster Gen Ed / ST SPED"),
    ], "Unknown")


def date_category(missing: Column, diff: Column, tolerance: int) -> Column:
    """A present but unreadable date has no difference and counts as a finance risk."""
    return ladder([(missing, MISSING), (diff == 0, EXACT), (F.abs(diff) <= tolerance, WITHIN)], RISK)


def spine_exit_issue(roster_missing: Column, st_missing: Column, diff: Column, tolerance: int) -> Column:
    return ladder([
        (roster_missing & ~st_missing, "Missing Roster Exit"),
        (~roster_missing & st_missing, "Missing ST Exit"),
        (roster_missing & st_missing, "Both Dates Missing"),
        (diff == 0, "No Issue"),
        (diff > tolerance, "Roster Exit Late"),
        (diff < -tolerance, "Roster Exit Early"),
    ], WITHIN)


def roster_exit_issue(roster_missing: Column, st_missing: Column, diff: Column, tolerance: int) -> Column:
    return ladder([
        (roster_missing & st_missing, "Both Dates Missing"),
        (roster_missing, "Missing Roster Exit"),
        (st_missing, "Missing ST Exit"),
        (diff > tolerance, "Roster Exit Late (>5)"),
        (diff < -tolerance, "Roster Exit Early (<-5)"),
        (F.abs(diff) <= tolerance, WITHIN),
    ], "No Issue")


def _either(entry: Column, exit_: Column, label: str) -> Column:
    return (entry == label) | (exit_ == label)


def spine_status(id_match: Column, entry: Column, exit_: Column) -> Column:
    """One date within tolerance is enough for a warning, even if the other is a finance risk."""
    return ladder([
        (id_match == NO_ID, INVALID_ID),
        (_either(entry, exit_, MISSING), INCOMPLETE),
        ((entry == EXACT) & (exit_ == EXACT), VALID),
        (_either(entry, exit_, WITHIN), WARNING),
    ], MISMATCH)


def roster_status(id_match: Column, resolved: Column, entry: Column, exit_: Column, disability: Column) -> Column:
    """Any finance risk is a date mismatch; a special-education mismatch is a warning."""
    return ladder([
        ((id_match == NO_ROSTER) | (resolved == ""), INVALID_ID),
        (_either(entry, exit_, MISSING), INCOMPLETE),
        (_either(entry, exit_, RISK), MISMATCH),
        (disability.startswith("Mismatch"), WARNING),
        (_either(entry, exit_, WITHIN), WARNING),
    ], VALID)


def severity(status: Column, dialect: str) -> Column:
    """A date mismatch is High in the spine dialect and Critical in the roster dialect."""
    mismatch = {"spine": "High", "roster": "Critical"}[dialect]
    return ladder([
        (status == INVALID_ID, "Critical"),
        (status == MISMATCH, mismatch),
        (status == INCOMPLETE, "High"),
        (status == WARNING, "Low"),
    ], "None")


def spine_action(exit_issue: Column, entry: Column) -> Column:
    """The exit decides, then the entry."""
    return ladder(_looked_up(exit_issue, SPINE_EXIT_ACTIONS) + _looked_up(entry, SPINE_ENTRY_ACTIONS), SPINE_NO_ACTION)


def roster_action(id_match: Column, resolved: Column, exit_issue: Column, entry: Column, disability: Column) -> Column:
    """The identity decides, then exit, entry and special-education record."""
    locate, resolve = ROSTER_ID_ACTIONS
    return ladder(
        [(id_match == NO_ROSTER, locate), (resolved == "", resolve)]
        + _looked_up(exit_issue, ROSTER_EXIT_ACTIONS) + _looked_up(entry, ROSTER_ENTRY_ACTIONS)
        + _looked_up(disability, ROSTER_SPED_ACTIONS), ROSTER_NO_ACTION)


def severity_order(sev: Column) -> Column:
    """Critical 1, High 2, Low 3, None 4, anything else 5."""
    return ladder([(sev == s, F.lit(i)) for i, s in enumerate(("Critical", "High", "Low", "None"), 1)], F.lit(5))


def is_exception(sev: Column) -> Column:
    return is_in(sev, "Critical", "High", "Low")
