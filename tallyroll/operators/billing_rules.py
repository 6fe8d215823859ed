"""Rule ladders of the billing audit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroll.config import BillingConfig
from tallyroll.functions.dates import clamp_to
from tallyroll.functions.ladders import ladder

# Match and status labels.
NOT_FOUND = "NOT FOUND"
NEEDS_REVIEW = "Not Found-Needs Manual Review"
UPDATE_IN_ST = "(Discrepancy – update in ST)"
# Notes for the reviewer, and how an analyst's final status can depart from the computed one.
NOTE_BOTH = "Entry AND exit date discrepancy >3 days - update charter attendance record in ST"
NOTE_ENTRY = "Entry date discrepancy >3 days - update charter school attendance record in ST"
NOTE_EXIT = "Exit date discrepancy >3 days - update charter school attendance record in ST"
NOTE_NO_RECORD = "Student not found in ST Enrollment report"
DIFFERENCES = {
    "A": "R Engine: Not Found (no ST data) → Analyst manually resolved to Good",
    "B": "R Engine: Not Found (no ST data) → Analyst manually confirmed No Good",
    "C": "R Engine: No Good (entry UNFAVORABLE) → Analyst overrode to Good (ST updated or docs provided)",
    "D": "R Engine: Good (July/Aug rule applied) → Analyst found post-audit issue, changed to No Good",
}
OTHER_DIFFERENCE = "Other difference"


def _days(prefix: str, days: Column, suffix: str) -> Column:
    return F.concat(F.lit(f"{prefix} is "), days.cast("string"), F.lit(f" days {suffix}"))


def classify_entry(charter: Column, st: Column, config: BillingConfig = BillingConfig(), summer_rule: str = "deadline") -> Column:
    """Entry-date text.

    ``summer_rule="deadline"``: both before the first day, or the system before it and
    the charter by the grace deadline. ``summer_rule="window"``: the system date inside
    July 1 - deadline is favorable whatever the charter date.
    """
    first, deadline, july = F.lit(config.first_day), F.lit(config.grace_deadline), F.lit(config.july_start)
    if summer_rule == "deadline":
        both_summer = (charter < first) & (st < first)
        st_summer = (st < first) & (charter <= deadline)
    elif summer_rule == "window":
        st_summer = st.between(july, deadline)
        both_summer = st_summer & charter.between(july, deadline)
    else:
        raise ValueError(f"unknown summer rule {summer_rule!r}")
    diff = F.datediff(clamp_to(charter, config.first_day), clamp_to(st, config.first_day))
    return ladder([
        (charter.isNull() & st.isNull(), ""),
        (st.isNull(), "Charter has entry date but ST does not (UNFAVORABLE)"),
        (charter.isNull(), "ST has entry date but Charter does not (UNFAVORABLE)"),
        (both_summer, "Charter and ST both enrolled in July/August (FAVORABLE)"),
        (st_summer, "ST enrolled in July/August by school-year first day deadline (FAVORABLE)"),
        (diff == 0, "Entry dates match (FAVORABLE)"),
        (diff > 0, _days("Charter entry", diff, "later than ST entry date (FAVORABLE)")),
        (diff >= -config.grace_days, _days("Charter entry", -diff, "earlier than ST entry date (FAVORABLE)")),
    ], _days("Charter entry", -diff, "earlier than ST entry date (UNFAVORABLE)"))


def classify_exit(charter: Column, st: Column, config: BillingConfig = BillingConfig(), end_date_is_open: bool = True) -> Column:
    """Exit-date text. With ``end_date_is_open`` the program end date counts as no exit."""
    if end_date_is_open:
        c_open = charter.isNull() | (charter == F.lit(config.end_date))
        s_open = st.isNull() | (st == F.lit(config.end_date))
    else:
        c_open, s_open = charter.isNull(), st.isNull()
    diff = F.datediff(charter, st)
    return ladder([
        (c_open & s_open, "No Charter or ST exit dates on file (FAVORABLE)"),
        (c_open & st.isNotNull(), "ST has exit date but Charter does not (UNFAVORABLE)"),
        (s_open, f"Charter has exit date but ST does not {UPDATE_IN_ST}"),
        (diff == 0, "Exit dates match (FAVORABLE)"),
        (diff < -config.grace_days, _days("Charter exit", -diff, f"earlier {UPDATE_IN_ST}")),
        (diff < 0, _days("Charter exit", -diff, "earlier (FAVORABLE)")),
        (diff <= config.grace_days, _days("Charter exit", diff, "later (FAVORABLE)")),
    ], _days("Charter exit", diff, "later (UNFAVORABLE)"))


def unfavorable(text: Column) -> Column:
    """'UNFAVORABLE' contains 'FAVORABLE', so test the longer word."""
    return F.coalesce(text.contains("UNFAVORABLE"), F.lit(False))


def status(entry_text: Column, exit_text: Column, match_method: Column) -> Column:
    return ladder([
        (match_method == NOT_FOUND, NEEDS_REVIEW),
        (unfavorable(entry_text) | unfavorable(exit_text), "No Good"),
    ], "Good")


def review_notes(student_status: Column, entry_text: Column, exit_text: Column) -> Column:
    """Only rows that are No Good carry a note; those always have an unfavorable date."""
    bad = student_status == "No Good"
    entry, exit_ = unfavorable(entry_text), unfavorable(exit_text)
    return ladder([
        (bad & entry & exit_, NOTE_BOTH),
        (bad & entry, NOTE_ENTRY),
        (bad & exit_, NOTE_EXIT),
    ], "")


def missing_record_note(st_entry: Column, st_exit: Column, st_school: Column) -> Column:
    """Note on rows without any system date or school."""
    return F.when(st_entry.isNull() & st_exit.isNull() & st_school.isNull(), NOTE_NO_RECORD).otherwise("")


def difference_category(engine: Column, final: Column) -> Column:
    """How an analyst's final status departs from the computed one."""
    return ladder([
        ((engine == NEEDS_REVIEW) & (final == "Good"), "A"),
        ((engine == NEEDS_REVIEW) & (final == "No Good"), "B"),
        ((engine == "No Good") & (final == "Good"), "C"),
        ((engine == "Good") & (final == "No Good"), "D"),
    ], "Other")


def difference_explanation(category: Column) -> Column:
    return ladder([(category == k, text) for k, text in DIFFERENCES.items()], OTHER_DIFFERENCE)
