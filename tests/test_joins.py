import pytest
from pyspark.sql import functions as F

from ledgermill.operators.joins import best_per_key, first_per_key, heavy_keys, keyed_join


@pytest.fixture(scope="module")
def sides(spark):
    # Key 0 holds more than a third of the rows, a twentieth has a null key.
    left = spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 20 == 7, None)
        .when(F.col("id") % 5 < 2, F.lit(0))
        .otherwise(F.col("id") % 50)
        .alias("k"),
    )
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(sides, how):
    left, right = sides
    plain = left.join(right, "k", how)
    salted = keyed_join(left, right, ["k"], how, share=0.05, min_rows=10, force_salt=True)
    assert salted.columns == left.columns + ([] if how in ("left_semi", "left_anti") else ["v"])
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted(map(key, salted.select(plain.columns).collect()))
    assert got == sorted(map(key, plain.collect()))


def test_salted_join_with_null_safe_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "i int, k string")
    right = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    got = keyed_join(left, right, ["k"], "left", null_safe=True, force_salt=True)
    assert sorted((r.i, r.v) for r in got.collect()) == [(1, 1), (2, 2)]


def test_heavy_keys_are_few_and_right(sides):
    left, _ = sides
    heavy = heavy_keys(left, F.xxhash64("k"), share=0.05, min_rows=10).collect()
    expected = left.filter("k = 0").select(F.xxhash64("k")).first()[0]
    nulls = left.filter("k is null").select(F.xxhash64("k")).first()[0]
    hashes = {r.heavy_hash: r.salts for r in heavy}
    assert expected in hashes and len(hashes) <= 64
    assert hashes[expected] >= 2
    assert nulls not in hashes or hashes[nulls] >= 1


def test_copies_of_a_heavy_row_are_spread(spark):
    # Without room for another name, all left rows are equal; only the partition tells them apart.
    left = spark.range(0, 400, 1, 8).select(F.lit(0).alias("k"))
    right = spark.createDataFrame([(0, "v")], "k int, v string")
    joined = keyed_join(left, right, ["k"], "inner", share=0.05, min_rows=10, force_salt=True)
    assert joined.count() == 400
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "SPARK_PARTITION_ID" in text


def test_hot_key_on_both_sides(spark):
    left = spark.range(600).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"))
    right = spark.range(500).select(F.col("id").alias("b"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 40).alias("k"))
    joined = keyed_join(left, right, ["k"], "inner", share=0.01, min_rows=10, force_salt=True)
    assert joined.columns == ["a", "k", "b"]
    plain = left.join(right, "k")
    assert sorted(map(tuple, joined.select("a", "k", "b").collect())) == sorted(map(tuple, plain.select("a", "k", "b").collect()))


def test_sketches_are_not_merged_in_one_task(sides):
    left, right = sides
    plan = keyed_join(left, right, ["k"], "inner", force_salt=True)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "_sl_" in plan and "_sr_" in plan


def test_planner_chooses_the_join(spark, sides):
    left, right = sides
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keyed_join(left, right, ["k"], "inner")._jdf.queryExecution().toString()
        assert "Broadcast" not in plan and "approx_top_k" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_first_and_best_per_key(spark):
    df = spark.createDataFrame(
        [("a", 2, 0.9, "x"), ("a", 1, 0.8, "y"), ("a", 3, 0.9, "z"), ("b", 5, 0.1, "w")],
        "k string, ord int, score double, v string",
    )
    assert {r.k: r.v for r in first_per_key(df, ["k"], ["ord"]).collect()} == {"a": "y", "b": "w"}
    assert {r.k: r.v for r in best_per_key(df, ["k"], "score", ["ord"]).collect()} == {"a": "x", "b": "w"}
