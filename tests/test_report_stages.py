"""What the report tabs compute, and how often. Rows are made here."""

import os

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from checks import written_queries as w
from checks.inputs import Inputs, StagedInputs
from tallyroll.functions import dates
from tallyroll.plans import audit_billing
from tallyroll.sources import tables as tables_module


@pytest.fixture
def tables(spark, tmp_path):
    spark.range(60).select(F.col("id").alias("c_custkey")).write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(300).select(F.col("id").alias("o_orderkey"), (F.col("id") * 7 % 50).alias("o_custkey")).write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def counted(monkeypatch, module, name):
    calls, plain = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **k: calls.append(name) or plain(*a, **k))
    return calls


def rows(df):
    return sorted(map(str, df.collect()))


def test_billing_tabs_share_one_audit_and_one_prepared_export(spark, tables, monkeypatch):
    expected = {tab: rows(getattr(q, source)(Inputs(spark, tables)).drop(w.WITHOUT.get(tab, ""))) for tab, source in w.TABS["billing"].items()}
    audits, exports = counted(monkeypatch, audit_billing, "audit"), counted(monkeypatch, audit_billing, "prepare_export")
    found = {tab: rows(w._tab_query("billing", tab)(Inputs(spark, tables))) for tab in w.TABS["billing"]}
    assert found == expected and found["SPED_Roster"] and found["Multiple_Enrollments"]
    assert (len(audits), len(exports)) == (1, 1)


def test_iso_days_are_cast_at_once(spark):
    texts = ["2026-02-03", "2026-13-01", "2026-02-30", "0000-01-01", "2026-00-10", " 2026-02-03\n", "2026-2-3", "20260203", "46056", "2/3/26", "Feb 3, 2026", "2026-02-03 08:30", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    days = [str(r[0]) for r in df.select(dates.parse_billing(F.col("t")).cast("string")).collect()]
    assert days == ["2026-02-03", "None", "None", "0000-01-01", "None", "2026-02-03", "2026-02-03", "None", "2026-02-03", "2026-02-03", "2026-02-03", "2026-02-03", "None"]


def test_unified_tabs_come_from_the_written_report_alone(spark, tables, monkeypatch):
    expected = {tab: rows(getattr(q, source)(Inputs(spark, tables)).drop(w.WITHOUT.get(tab, ""))) for tab, source in w.TABS["unified"].items()}
    rosters, exports = counted(monkeypatch, q, "_unified"), counted(monkeypatch, q, "_exports")
    found = {tab: rows(w._tab_query("unified", tab)(Inputs(spark, tables))) for tab in w.TABS["unified"]}
    assert found == expected and all(found.values())
    assert (len(rosters), len(exports)) == (1, 1)


def test_a_delivery_of_several_files_is_read_whole(spark, tmp_path):
    times = {"old/a.csv": 100, "old/b.csv": 300, "new/a.csv": 200, "new/b.csv": 400}
    for n, (name, at) in enumerate(times.items()):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"k\n{n}\n")
        os.utime(path, (at, at))
    assert rows(tables_module.read_newest_file(spark, str(tmp_path / "in"), in_folders=True)) == ["Row(k='2')", "Row(k='3')"]
    dated = spark.createDataFrame([("x/old", 1, 100), ("x/old", 2, 300), ("x/new", 3, 200), ("x/new", 4, 400)], "d string, k long, t long")
    assert rows(tables_module.newest_snapshot(dated, "t", "d").select("k")) == ["Row(k=3)", "Row(k=4)"]


def test_deliveries_are_not_written_by_one_task(spark, tables):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        i = Inputs(spark, tables)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        found = w.source_newest_delivery(i)
        assert found.count() == 48 and len(found.inputFiles()) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_report_derives_its_rosters_once(spark, tables):
    i = StagedInputs(spark, tables)
    assert rows(i.text_roster()) == rows(Inputs(spark, tables).text_roster())
    assert all(rows(i.text_roster(k)) == rows(Inputs(spark, tables).text_roster(k)) for k in range(4))
    read = i.text_roster(2).inputFiles() + i.gen_roster().inputFiles()
    assert read and not any("orders.parquet" in name for name in read)
