"""Skew handling and plan shape."""

import pytest
from pyspark.sql import functions as F

from tallyroll.operators import keys
from tallyroll.plans import audit_spine, statistics


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k in limits:
        spark.conf.unset(k)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split_between_tasks(spark, small_skew_limits):
    left = spark.range(0, 200000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    right = spark.range(0, 200000, 1, 4).select(F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("rk"), F.col("id").alias("v"))
    out = keys.left_on_key(left, right, F.col("k"), "rk", ["id"])
    plan = final_plan(out)
    assert "skew=true" in plan
    assert out.count() == 200000 and out.filter("k = 'hot' and v = 0").count() == 66667


def test_spine_shuffles_the_enrollments_once(spark, small_skew_limits):
    st = spark.range(100).selectExpr("id AS enrollment_seq", "id AS st_nyssis_id")
    roster = spark.range(50).selectExpr("CAST(id AS STRING) AS nyssis_id", "'s' AS student_id", "'s' AS sped_student_id", "DATE '2026-01-01' AS st_entry_date", "DATE '2026-01-01' AS st_exit_date", "'x' AS iep_code")
    plan = audit_spine.join_rosters(st, roster, roster, roster, roster)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_left_key") == 1


def test_silver_needs_no_shuffle(spark):
    bronze = spark.createDataFrame([tuple(["1"] * 14)], ", ".join(f"{n} string" for n in statistics.cfg.BRONZE_COLUMNS)).withColumns(
        {"ingested_at": F.current_timestamp(), "source_api": F.lit("x")})
    assert "Exchange" not in statistics.silver(bronze)._jdf.queryExecution().executedPlan().toString()


def test_no_broadcast_hint_and_no_local_checkpoint_in_the_library():
    import pathlib

    root = pathlib.Path(statistics.__file__).parents[1]
    for path in sorted(p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts):  # the text operators broadcast and collect bounded tables
        source = path.read_text()
        for word in ("broadcast(", "localCheckpoint", "crossJoin", "toPandas", ".collect()", "udf("):
            assert word not in source, (path, word)


def test_layers_are_written_and_read_back(spark):
    records = [tuple([f"county {n % 3}", f"county {n % 3} county total", str(1990 + n // 3), "12", "9", "1", "1", "0", "2", "3", "1", "4", "5", None]) for n in range(12)]
    bronze = spark.createDataFrame(records, ", ".join(f"{n} string" for n in statistics.cfg.BRONZE_COLUMNS)).withColumns(
        {"ingested_at": F.lit("2026-01-01").cast("timestamp"), "source_api": F.lit("x")})
    names = statistics.build_tables(bronze)
    assert [spark.table(n).count() for n in names] == [12] * 8
    again = statistics.build_tables(bronze)
    assert again == names and spark.table("gold_violent_crime_trends").filter("yoy_change = 0 AND rolling_3yr_avg = 6").count() == 9


def test_lookups_shuffle_narrow_rows(spark):
    """A fallback lookup sends ids and keys through its shuffle, and a whole row once."""
    from pyspark.sql import functions as F

    from tallyroll.operators import lookups

    rows = spark.range(50).select(F.col("id"), *[F.lit("x" * 50).alias(f"wide_{k}") for k in range(6)], F.col("id").cast("string").alias("k0"), F.lit("none").alias("k1"))
    source = spark.range(0, 50, 2).select(F.col("id").cast("string").alias("key"), F.col("id").alias("found"), F.lit(0).alias("level"))
    patched = lookups.patch(rows, "id", F.lit(True), [F.col("k1"), F.col("k0")], source.withColumn("level", F.lit(1)), ["found"])
    assert {r.id: r.found for r in patched.collect()} == {k: k if k % 2 == 0 else None for k in range(50)}
    text = patched._jdf.queryExecution().optimizedPlan().toString()
    assert "any_value" not in text and "first(_row" not in text


def test_sped_roster_is_shuffled_once(spark):
    from tallyroll.plans import audit_billing

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sped = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "row_id long, sped_key string")
        audited = spark.createDataFrame([("a", "Good", 0.5, 1), ("a", "Bad", 0.1, 2)], "nyssis string, student_status string, st_sped_fte double, row_id long")
        export = spark.createDataFrame([("a", None, "S1", 1), ("c", None, "", 2)], "nyssis string, st_entry date, st_student_id string, ord long")
        codes = spark.createDataFrame([("c", "D9", 1)], "nyssis string, iep_code string, ord long")
        result = audit_billing.sped_roster(sped, audited, export, codes, "row_id", "row_id", "ord")
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(_left_key") == 1, plan
        rows = {r.row_id: (r["IEP Enroll status"], r["ST SPED FTE"], r["IEP Code"], r["ST Student ID"]) for r in result.collect()}
        assert rows == {1: ("Good", 0.5, None, "S1"), 2: (None, None, None, None), 3: (None, None, "D9", None)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")

