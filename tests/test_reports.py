"""Whole report sets, written and read back."""

import os

import pytest

from checks import queries as q
from checks.inputs import Inputs
from tallyroll.plans import audit_billing, audit_roster, unify
from tallyroll.session import cut_lineage
from tallyroll.sources import sinks

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")


def counts(spark, tabs, folder):
    paths = sinks.write_report(tabs, str(folder))
    return {tab: spark.read.parquet(path).count() for tab, path in paths.items()}


def test_roster_audit_report(spark, tmp_path):
    audited = cut_lineage(q._roster_audits(Inputs(spark, SMALL)))
    n = counts(spark, audit_roster.report(audited), tmp_path)
    assert n["Full_Audit"] == audited.count() and 0 < n["Exceptions"] <= n["Full_Audit"] and n["Severity_Summary"] > 0


def test_billing_report(spark, tmp_path):
    i = Inputs(spark, SMALL)
    audited = cut_lineage(q._billing(i))
    n = counts(spark, audit_billing.report(audited, q._sped_bridged(i), q._compared(i)), tmp_path)
    assert n["Roster"] == audited.count() and n["Audit_Summary"] == 13 and n["VS_Final_Summary"] == 10
    assert n["Action_Needed"] == audited.filter("student_status <> 'Good'").count()
    assert n["Not_In_ST"] == audited.filter("match_method = 'NOT FOUND'").count()


def test_unified_report(spark, tmp_path):
    i = Inputs(spark, SMALL)
    roster, st = cut_lineage(q._final_roster(i)), cut_lineage(unify.dedupe_export(q._exports(i)))
    n = counts(spark, unify.report(roster, st, "row_id"), tmp_path)
    assert n["All Charters Unified"] == n["Copy Paste"] == n["Formula Version"] == roster.count()
    assert n["ST Enroll Export"] == st.count() and n["Update Log"] <= n["Not Found in ST"]
