from pyspark.sql import functions as F

from tidemill.operators import changes as cdc, reconcile, sets

COLUMNS = "client_id string, name string, risk string, region string, manager string, aum double"
TARGET = [
    ("CLT-001", "Apex", "moderate", "north_america", "Chen", 420.0),
    ("CLT-003", "Marcus", "aggressive", "north_america", "Chen", 12.5),
    ("CLT-005", "Pacific", "aggressive", "apac", "Lim", 310.0),
    ("CLT-007", "Nordic", "moderate", "europe", "Brandt", 195.0),
    ("CLT-009", "Riverside", "conservative", "north_america", "Whitfield", 225.0),
    ("CLT-010", "Gone", "moderate", "europe", "Brandt", 1.0),
]
BATCH = [
    ("CLT-001", "Apex", "moderate", "north_america", "Chen", 420.0),
    ("CLT-003", "Marcus", "aggressive", "north_america", "Chen", 12.5),
    ("CLT-005", "Pacific", "moderate", "apac", "Lim", 325.0),
    ("CLT-007", "Nordic", "moderate", "north_america", "Brandt", 195.0),
    ("CLT-009", "Riverside", "conservative", "north_america", "Chen", 225.0),
    ("CLT-011", "Global", "moderate", "north_america", "Whitfield", 500.0),
]


def frames(spark):
    return spark.createDataFrame(TARGET, COLUMNS), spark.createDataFrame(BATCH, COLUMNS)


def test_classify(spark):
    target, batch = frames(spark)
    stamp = lambda df: cdc.dimension_audit(df, ["client_id"], "2024-10-01 00:00:00", overwritten=["region"])
    got = {r.client_id: r.change_type for r in cdc.classify(stamp(batch), stamp(target), ["client_id"], with_deleted=True).collect()}
    assert got == {
        "CLT-001": "unchanged", "CLT-003": "unchanged", "CLT-005": "type_ii_changed", "CLT-007": "type_i_changed",
        "CLT-009": "type_ii_changed", "CLT-010": "deleted", "CLT-011": "new",
    }


def test_scd2_keeps_history_and_repeats_without_change(spark):
    target, batch = frames(spark)
    once = cdc.scd2_merge(cdc.scd2_open(target, "2020-01-01"), batch, ["client_id"], ["region"], "2024-10-01")
    again = cdc.scd2_merge(once, batch, ["client_id"], ["region"], "2024-10-01")
    assert sets.same_rows(once, again)
    rows = {(r.client_id, r.is_current): r for r in once.collect()}
    assert len(rows) == 9
    assert rows["CLT-005", False].risk == "aggressive" and str(rows["CLT-005", False].valid_to) == "2024-10-01"
    assert rows["CLT-005", True].risk == "moderate" and str(rows["CLT-005", True].valid_from) == "2024-10-01"
    assert rows["CLT-007", True].region == "north_america" and str(rows["CLT-007", True].valid_from) == "2020-01-01"
    assert rows["CLT-010", True].name == "Gone"


def test_scd2_merges_only_the_keys_of_the_batch(spark, tmp_path):
    """No full join, the small batch is broadcast, and the dimension is not shuffled; null keys match nothing."""
    rows = [(f"c{i}", "n", "r", "east", "m", 1.0) for i in range(2000)] + [(None, "n", "r", "east", "m", 1.0)]
    cdc.scd2_open(spark.createDataFrame(rows, COLUMNS), "2020-01-01").write.parquet(f"{tmp_path}/dim")
    dimension = spark.read.parquet(f"{tmp_path}/dim")
    batch = spark.createDataFrame([("c1", "n", "other", "east", "m", 1.0), ("new", "n", "r", "x", "m", 1.0), (None, "n", "r", "x", "m", 1.0)], COLUMNS)
    batch.write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    merged = cdc.scd2_merge(dimension, batch, ["client_id"], ["region"], "2024-10-01")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and plan.count("BroadcastHashJoin") >= 2
    assert merged.count() == 2001 + 1 + 2 and merged.where("NOT is_current").count() == 1
    assert merged.where("client_id IS NULL").count() == 2


def test_hash_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    count = lambda legacy: df.select(cdc.row_hash(["x", "y"], legacy).alias("h")).distinct().count()
    assert count(False) == 2 and count(True) == 1
    sizes = df.select(F.length(cdc.row_hash(["x"])).alias("n"), F.length(cdc.row_hash(["x"], True)).alias("m")).first()
    assert (sizes.n, sizes.m) == (32, 64)


def test_lookback():
    assert cdc.lookback("20240131", 31) == ("20231231", "2023-12", "2023 Q4")
    assert cdc.quarter_of("2024-08") == "2024 Q3"


def test_compare_rules(spark):
    expected = spark.createDataFrame([(1, "", "TRUE", "1.0", "2024-01-02T03:04:05.000Z"), (2, "a", "b", "2", None)], "id int, a string, b string, c string, d string")
    actual = spark.createDataFrame([(1, None, "true", "1.004", "2024-01-02 03:04:05"), (3, "a", "b", "2", None)], "id int, a string, b string, c string, d string")
    got = {(r.id, r.column_name, r.expected, r.actual) for r in reconcile.compare(actual, expected, ["ID"], 0.01).collect()}
    assert got == {(2, "*", "present", "absent"), (3, "*", "absent", "present")}
    assert [r.column_name for r in reconcile.compare(actual, expected, ["id"], 0.001).where("id = 1").collect()] == ["c"]


def test_key_columns():
    assert reconcile.key_columns({"OUT": ["a", "b"]}, "out", ["x"]) == ["a", "b"]
    assert reconcile.key_columns({}, "out", ["x", "y"]) == ["x"]
    assert reconcile.schema_difference(["A", "b"], ["a", "B"]) == []
    assert reconcile.schema_difference(["b", "a"], ["a", "b"]) != []


def test_upsert_does_not_shuffle_the_target(spark):
    target = spark.range(1000).selectExpr("id AS k", "id AS v")
    batch = spark.createDataFrame([(5, -5), (2000, 7)], "k long, v long")
    out = cdc.upsert(target, F.broadcast(batch), ["k"])
    rows = {r.k: r.v for r in out.collect()}
    assert rows[5] == -5 and rows[2000] == 7 and rows[6] == 6 and len(rows) == 1001
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "LeftAnti" in plan


def test_row_hash_tells_separators_and_nulls_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("\\N", "c"), (None, "c"), ("a\\", "b"), ("a", "\\b")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(cdc.row_hash(["x", "y"]).alias("h")).distinct().count() == len(rows)


def test_both_forms_of_a_linear_model_agree(spark):
    from tidemill.operators import models

    df = spark.createDataFrame([(1.0, 2.0), (None, 0.5), (-3.0, None)], "a double, b double")
    model = models.logistic({"a": 0.3, "b": -1.2}, 0.4)
    both = models.score_native(models.score(df, model, "p"), model, "q").collect()
    assert all(abs(r.p - r.q) < 1e-12 for r in both)
