"""Every check query against its SQL counterpart, and every branch of every rule ladder at work."""

import os
import re

import pytest

import __spark_entry__ as entry
import check
from checks import oracles, time_queries, written_queries
from checks.queries import QUERIES

ORACLES = {**oracles.ORACLES, **time_queries.SQL, **written_queries.SQL}
SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    return check.duck(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_counterpart(spark, duck, name):
    verdict, _ = check.compare(spark, duck, name, QUERIES[name], ORACLES[name], SMALL)
    assert verdict.startswith("ok"), verdict


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def texts(spark, name, column):
    found = {r[0] for r in QUERIES[name](spark, LARGER).select(column).distinct().collect()}
    return {re.sub(r"\d+ days", "n days", t) if t else t for t in found}


SPINE = {
    "id_match_status": {"Missing Student ID Match", "Matched - Southside", "Matched - SASCCS", "Matched - SAS", "Matched - OnTech", "No Roster Match"},
    "id_source": {"SchoolTool StudentID", "Universal StudentID", "NYSSID Mapping", "No Match"},
    "roster_vs_disability_check": {"Consistent - Gen Ed", "Consistent - SPED", "Mismatch - Roster Gen Ed but Disability Record IEP", "Mismatch - Roster SPED but No Disability Record"},
    "entry_status_category": {"Missing Date", "Exact Match", "Within Tolerance", "Finance Risk"},
    "exit_issue_type": {"Missing Roster Exit", "Missing ST Exit", "Both Dates Missing", "No Issue", "Roster Exit Late", "Roster Exit Early", "Within Tolerance"},
    "final_validation_status": {"Invalid - No ID Match", "Incomplete - Missing Dates", "Valid", "Valid with Warning", "Invalid - Date Mismatch"},
    "severity": {"Critical", "High", "Low", "None"},
}
ROSTER = {
    "id_match_status": {"No Roster Match", "Missing Student ID Match", "Matched - Southside", "Matched - SASCCS", "Matched - SAS", "Matched - OnTech"},
    "id_source": {"SchoolTool StudentID", "Universal StudentID", "NYSSID Mapping", "No Match"},
    "roster_vs_disability_check": {"No SchoolTool Record", "Consistent SPED", "Consistent Gen Ed", "Mismatch - Roster SPED / ST Gen Ed", "Mismatch - Roster Gen Ed / ST SPED"},
    "final_validation_status": {"Invalid - No ID Match", "Incomplete - Missing Dates", "Invalid - Date Mismatch", "Valid with Warning", "Valid"},
    "severity": {"Critical", "High", "Low", "None"},
}


@pytest.mark.parametrize("name,column,expected", [("audit_spine_fields", c, e) for c, e in SPINE.items()] + [("audit_roster_fanout", c, e) for c, e in ROSTER.items()])
def test_all_labels_occur(spark, name, column, expected):
    found = texts(spark, name, column)
    assert found <= expected
    assert len(expected - found) <= (1 if column == "id_match_status" else 0), expected - found


def test_all_date_texts_occur(spark):
    assert len(texts(spark, "classify_entry_dates", "by_deadline")) == 9
    assert len(texts(spark, "classify_entry_dates", "by_window")) == 9
    assert len(texts(spark, "classify_exit_dates", "end_open")) == 8


def test_severity_follows_from_the_status(spark):
    pairs = QUERIES["audit_roster_fields"](spark, SMALL).select("final_validation_status", "severity").distinct()
    assert pairs.count() == pairs.select("final_validation_status").distinct().count()


def test_deduped_audit_keeps_one_row_per_roster_row(spark):
    audited = QUERIES["audit_roster_fields"](spark, SMALL)
    assert audited.count() == audited.select("row_id").distinct().count()
