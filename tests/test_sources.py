"""Reading and writing files: layouts, header rows, pages, snapshots, tables, reports, the landed-page stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tallyroll import config as cfg
from tallyroll.sources import pages, sinks, tables
from tallyroll.streaming import landed_pages


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_headers_are_normalized_and_made_unique(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], "w string, x string, y string, z string").toDF(
        " NYSSIS ID ", "Entry\r\nDate", "Entry  Date", "")
    assert tables.normalize_headers(df).columns == ["NYSSIS ID", "Entry Date...2", "Entry Date...3", "...4"]


def test_columns_are_found_pattern_by_pattern():
    columns = ["StudentEnrollment_EntryNote", "StudentEnrollment_StartDate", "GENDER", "Student ID"]
    assert tables.find_column(columns, ["START", "ENTRY"]) == "StudentEnrollment_StartDate"
    assert tables.find_column(columns, ["ENTRY", "START"]) == "StudentEnrollment_EntryNote"
    assert tables.find_column(columns, ["END"]) == "GENDER"
    assert tables.find_column(columns, ["nothing"]) is None
    assert tables.resolve_roles(columns, {"exit": ["END"], "id": ["STUDENT.?ID"]}, {"exit": None}) == {"exit": None, "id": "Student ID"}


def test_second_date_column_is_the_prefilled_one():
    columns = ["Entry Date...3", "Leave Date...4", "Entry Date...9", "Leave Date...10", "Entry Date Discrepancy", "School Name"]
    assert tables.prepopulated_columns(columns) == {"st_entry": "Entry Date...9", "st_exit": "Leave Date...10", "st_school": "School Name"}
    assert tables.prepopulated_columns(["Entry Date", "ST Entry Date", "Entry Date Variance"])["st_entry"] == "ST Entry Date"
    assert tables.prepopulated_columns(["Entry Date", "Entry Date Match"])["st_entry"] is None


def test_conform_fills_missing_roles_with_null_and_require_fails(spark):
    df = spark.createDataFrame([("1", "2")], "`NYSSIS ID` string, Grade string")
    roles = {"nyssis": ["NYSSIS"], "grade": ["^Grade$"], "exit": ["EXIT"]}
    out = tables.conform_to_roles(df, roles)
    assert [tuple(r) for r in out.collect()] == [("1", "2", None)]
    with pytest.raises(ValueError, match="exit"):
        tables.require(df, tables.resolve_roles(df.columns, roles), ["nyssis", "exit"])


def test_fallback_source(spark):
    df = spark.createDataFrame([("1",)], "k string")
    assert tables.with_fallback([None, df], "k string").count() == 1
    empty = tables.with_fallback([None, None], "k string, v int")
    assert empty.columns == ["k", "v"] and empty.isEmpty()


def test_landed_files_of_four_layouts_become_one_table(spark, tmp_path):
    write(tmp_path / "plain.csv", "NYSSIS ID,First Name,Last Name,Grade\n100001,Ann,Lee,3\n,,,\n100002,Bob,Ray,4\n")
    write(tmp_path / "blank_first.csv", "\r\n,,,\r\nStateID,Student First Name,Student Last Name,Grade Level\r\n100003,Cy,Fox,5\r\n")
    write(tmp_path / "title.csv", "Monthly roster,,,\nNYSSIS,FirstName,LastName,Current Grade\n100004,Di,Kim,6\n")
    write(tmp_path / "legend.csv", "COLOR KEY: red = check,,,\n,,,\nGrade,LastName,FirstName,NYSSIS\n7,Poe,Ed,100005\n")
    lines = tables.read_lines(spark, str(tmp_path))
    heads = {os.path.basename(r.file): r.header_pos for r in tables.header_rows(lines).collect()}
    assert heads == {"plain.csv": 0, "blank_first.csv": 2, "title.csv": 1, "legend.csv": 2}
    roles = {r: cfg.BILLING_ROSTER_PATTERNS[r] for r in ("nyssis", "first_name", "last_name", "grade")}
    out = tables.select_by_header(tables.table_rows(lines), roles)
    assert sorted(tuple(r) for r in out.select("nyssis", "first_name", "last_name", "grade").collect()) == [
        ("100001", "Ann", "Lee", "3"), ("100002", "Bob", "Ray", "4"), ("100003", "Cy", "Fox", "5"),
        ("100004", "Di", "Kim", "6"), ("100005", "Ed", "Poe", "7")]


def test_header_rules_look_at_the_whole_file(spark, tmp_path):
    write(tmp_path / "late.csv", "\n" * 12 + "NYSSIS ID,Full Name,Grade\n100001,\"Lee, Ann\",3\n100002,\"Ray, \"\"Bo\"\"\",4\n")
    write(tmp_path / "third.csv", "Audit,of,June\nprinted,,\nGrade,NYSSIS,Full Name\n5,100003,Fox\n")
    write(tmp_path / "empty.csv", ",,\n\n")
    write(tmp_path / "narrow.csv", "NYSSIS,Grade\n100004,6\n100005,7\n")
    lines = tables.read_lines(spark, str(tmp_path))
    heads = {os.path.basename(r.file): r.header_pos for r in tables.header_rows(lines).collect()}
    assert heads == {"late.csv": 12, "third.csv": 2, "empty.csv": -1, "narrow.csv": 0}
    roles = {"nyssis": ["NYSSIS"], "full_name": ["Full.?Name"], "grade": ["Grade"]}
    out = tables.select_by_header(tables.table_rows(lines), roles)
    assert sorted((tuple(r) for r in out.select("nyssis", "full_name", "grade").collect()), key=repr) == [
        ("100001", "Lee, Ann", "3"), ("100002", 'Ray, "Bo"', "4"), ("100003", "Fox", "5"), ("100004", None, "6"), ("100005", None, "7")]


def test_lines_keep_their_numbers_over_splits(spark, tmp_path):
    write(tmp_path / "long.txt", "".join(f"line {n}\n" for n in range(5000)))
    write(tmp_path / "short.txt", "line 0\r\n\r\nline 2")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = tables.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 5003 and all(r.line in ("", f"line {r.pos}") for r in rows)
    assert sorted(r.pos for r in rows if r.file.endswith("long.txt")) == list(range(5000))


def test_cells_in_quotes(spark):
    lines = ['a,b', '"x, y",z', ' "q ""r""" ,', ',"",w', 'say "hi", you', '"open, end', ',']
    df = tables.with_cells(spark.createDataFrame([(n, x) for n, x in enumerate(lines)], "n int, line string"))
    assert [r.cells for r in df.orderBy("n").collect()] == [["a", "b"], ["x, y", "z"], ['q "r"', ""], ["", "", "w"], ['say "hi"', "you"], ['"open', "end"], ["", ""]]


def test_junk_rows_go_only_where_half_the_rows_have_ids(spark):
    df = spark.createDataFrame(
        [("a", "100001"), ("a", "100002.0"), ("a", "Total"), ("b", "x"), ("b", "y"), ("b", "100003"), ("c", None)], "file string, id string")
    kept = tables.drop_junk_rows(df, "id", "file")
    assert sorted((r.file, r.id or "") for r in kept.collect()) == [("a", "100001"), ("a", "100002.0"), ("b", "100003"), ("b", "x"), ("b", "y"), ("c", "")]


def test_null_tokens_and_blank_rows(spark):
    df = spark.createDataFrame([("NA", 1), ("ok", 2), ("", None), (None, None)], "a string, b int")
    assert [r.a for r in tables.clean_null_tokens(df).collect()] == [None, "ok", None, None]
    assert tables.drop_blank_rows(df).count() == 2


def test_newest_file_of_a_folder(spark, tmp_path):
    write(tmp_path / "old.csv", "k,v\n1,old\n")
    write(tmp_path / "new.csv", "k,v\n1,new\n2,new\n")
    os.utime(tmp_path / "old.csv", (1_700_000_000, 1_700_000_000))
    os.utime(tmp_path / "new.csv", (1_800_000_000, 1_800_000_000))
    out = tables.read_newest_file(spark, str(tmp_path))
    assert sorted(tuple(r) for r in out.collect()) == [("1", "new"), ("2", "new")]
    scans = [n for n in _nodes(out._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan csv")]
    assert [s.metrics().apply("numFiles").value() for s in scans] == [1]


def _nodes(plan):
    yield plan
    children = plan.children()
    for k in range(children.size()):
        yield from _nodes(children.apply(k))


def test_tables_are_judged_without_a_shuffle_of_their_rows(spark):
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS id", "'a' AS file", "'p' AS pad")
    plan = tables.drop_junk_rows(df, "id", "file")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_read_roster_is_all_text(spark, tmp_path):
    write(tmp_path / "r.csv", "NYSSIS ID, Entry  Date \n00123,45839\n")
    out = tables.read_roster(spark, str(tmp_path / "r.csv"))
    assert out.columns == ["NYSSIS ID", "Entry Date"] and tuple(out.head()) == ("00123", "45839")


def land(folder, records, lengths):
    """Page files of the given lengths, the last one repeated, each under its start."""
    at, k = 0, 0
    while at < len(records):
        size = lengths[min(k, len(lengths) - 1)]
        write(folder / f"start={at}" / "part-0.json", "".join(json.dumps(r) + "\n" for r in records[at:at + size]))
        at, k = at + size, k + 1


@pytest.mark.parametrize("total", [0, 1, 49, 50, 51, 250])
@pytest.mark.parametrize("lengths", [[50], [40], [7, 1, 120, 13]])
def test_pages_are_read_whole_by_any_number_of_tasks(spark, tmp_path, total, lengths):
    records = [{"county": f"c{n}", "year": n, "agency": {"a": [1, True]}, "robbery": n % 2 == 0, "extra": 1} for n in range(total)]
    land(tmp_path, records, lengths)
    tmp_path.mkdir(exist_ok=True)
    fetch = pages.LandedPages(f"file://{tmp_path}")
    assert pages.count_records(fetch) == total
    for tasks in (1, 2, 6, 100):
        df = pages.read_pages(spark, fetch, page_limit=50, tasks=tasks)
        assert df.columns == list(cfg.BRONZE_COLUMNS)
        assert sorted(r.county for r in df.collect()) == sorted(r["county"] for r in records)
    if total:
        first = df.filter("county = 'c0'").head()
        assert first.year == "0" and first.agency == '{"a":[1,true]}' and first.robbery == "true" and first.murder_non_negl_manslaughter is None
        landed = pages.read_landed_pages(spark, str(tmp_path))
        assert sorted(map(str, landed.collect())) == sorted(map(str, df.collect()))


def test_records_that_arrive_after_the_count_are_read(spark):
    class Growing:
        def __call__(self, offset, limit):
            return [{"county": str(n)} for n in range(offset, min(130, offset + min(limit, 30)))]

    reader = pages._Reader(Growing(), pages.BRONZE_SCHEMA, 50, 3)
    ranges = [pages.PageRange(0, 50), pages.PageRange(50, None)]
    assert [r[0] for p in ranges for r in reader.read(p)] == [str(n) for n in range(130)]
    assert sorted(r[0] for p in reader.partitions() for r in reader.read(p)) == sorted(str(n) for n in range(130))


def test_rest_transport_asks_for_pages_in_order(monkeypatch):
    import io
    import urllib.request

    asked = []
    monkeypatch.setattr(urllib.request, "urlopen", lambda request, timeout: asked.append((request.full_url, request.headers, timeout)) or io.BytesIO(b'[{"county": "a"}]'))
    assert pages.RestPages("https://host/x", "key")(40, 20) == [{"county": "a"}]
    assert asked == [("https://host/x?%24limit=20&%24offset=40&%24order=%3Aid", {"X-app-token": "key"}, 60)]


def test_empty_source_is_refused(spark):
    with pytest.raises(ValueError):
        sinks.require_rows(spark.createDataFrame([], "a int"))
    assert sinks.require_rows(spark.range(1)).count() == 1


def test_write_table_twice_gives_the_same_table(spark):
    sinks.write_table(spark.range(5).withColumn("x", F.lit("a")), "refreshed")
    sinks.write_table(spark.range(3), "refreshed")
    assert spark.table("refreshed").columns == ["id"] and spark.table("refreshed").count() == 3
    assert [tuple(r) for r in sinks.row_counts(spark, ["refreshed"]).collect()] == [("refreshed", 3)]


def test_sorted_files_are_globally_ordered(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(10000).select(((F.col("id") * 7919) % 10007).alias("k"))
    parts = sinks.sorted_for_write(df, ["k"]).select(F.spark_partition_id().alias("p"), "k").groupBy("p").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("p").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(a.hi < b.lo for a, b in zip(parts, parts[1:])) and len(parts) > 1


def test_report_has_one_directory_per_tab(spark, tmp_path):
    paths = sinks.write_report({"Full Audit": spark.createDataFrame([(1,)], "`Entry (>3 Days)` int"), "Empty": spark.range(0)}, str(tmp_path))
    assert spark.read.parquet(paths["Full Audit"]).columns == ["Entry___3_Days_"]
    assert spark.read.parquet(paths["Empty"]).count() == 0


def test_stream_reads_each_landed_page_once_and_equals_the_batch(spark, tmp_path):
    land, target, state = tmp_path / "land", str(tmp_path / "bronze"), str(tmp_path / "state")
    write(land / "0.json", '{"county": "a", "year": "1990", "extra": 1}\n{"county": "b"}\n')

    def run():
        landed_pages.ingest_available(landed_pages.read_landed(spark, str(land), "api"), target, state).awaitTermination()

    run()
    write(land / "2.json", '{"county": "c"}\n')
    run()
    run()
    got = spark.read.parquet(target)
    batch = pages.with_audit_columns(spark.read.schema(pages.BRONZE_SCHEMA).json(str(land)), "api")
    key = ["county", "year", "source_api"]
    assert sorted(map(tuple, got.select(*key).collect()), key=repr) == sorted(map(tuple, batch.select(*key).collect()), key=repr)
    assert got.filter("ingested_at is null").count() == 0
