"""Dedup, merge, nesting and quantiles, with hot keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from review_engine.operators import dedup, merge
from review_engine.operators.quantiles import approx_quantiles, exact_quantiles
from review_engine.session import small_table


def test_keep_first_null_equals_empty(spark):
    df = small_table(spark, "k string, v int", [(None, 1), ("", 2), ("x", 3)])
    assert sorted(r.v for r in dedup.keep_first(df, ["k"], [F.col("v")]).collect()) == [1, 3]


def test_keys_are_compared_column_by_column(spark):
    df = small_table(spark, "a string, b string, v int", [("x||y", "z", 1), ("x", "y||z", 2)])
    assert dedup.keep_first(df, ["a", "b", "absent"], [F.col("v")]).count() == 2


def test_nested_keys(spark):
    df = spark.sql("SELECT named_struct('a', array(1)) AS k, v FROM VALUES (1), (2) AS t(v)")
    assert [r.v for r in dedup.keep_first(df, ["k"], [F.col("v")]).collect()] == [1]


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(10_000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    first = dedup.unique_by_id(df, "k", [F.col("id")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    # every third id falls to key 0; the other keys are unique
    assert first.count() == 1 + 10_000 - 3334


def test_legacy_consolidation_keys(spark):
    df = small_table(spark, "canonical_title string, v int", [("a", 2), ("a", 1), ("b", 3)])
    assert sorted(r.v for r in dedup.consolidate(df, [F.col("v")]).collect()) == [1, 3]
    with_id = df.withColumn("review_id", F.col("v").cast("string"))
    assert dedup.consolidate(with_id, [F.col("v")]).count() == 3


MERGE_ROWS = [(0, "t", "a", 1.5), (1, "t", None, None), (2, "t", " a ", 2.5), (3, "t", "b", None), (4, "t", "", None),
              (5, "empty", None, None)]


def test_merge_group(spark):
    df = small_table(spark, "ord bigint, t string, c string, n double", MERGE_ROWS)
    rows = {r.t: r for r in merge.merge_entities(df, "t", ["c"], "ord", first_columns=["n"]).collect()}
    assert (rows["t"].c, rows["t"].n) == ("a, b", "1.5")
    assert (rows["empty"].c, rows["empty"].n) == (None, None)


def test_hot_merge_is_one_whole_row(spark):
    rows = spark.range(2000).select(F.lit("hot").alias("t"), F.col("id").alias("ord"), (F.col("id") % 700).cast("string").alias("c"),
                                    F.col("id").alias("n"))
    row, = merge.merge_entities(rows, "t", ["c"], "ord", first_columns=["n"]).collect()
    assert row.c == ", ".join(str(i) for i in range(700))
    assert row.n == "0" and row.n_all == ", ".join(str(i) for i in range(2000))


def test_nested_children_of_any_number_are_one_row(spark):
    rows = spark.range(1050).select((F.col("id") % 1).alias("p"), F.col("id").alias("n"))
    row, = merge.nest_children(rows, "p", "n", ["n"], "kids").collect()
    assert row.total_kids == 1050 and [k.n for k in row.kids] == list(range(1050))


@pytest.mark.parametrize("parts", ["1", "8", "60"])
def test_exact_quantiles(spark, parts):
    rng = np.random.default_rng(3)
    data = np.round(rng.lognormal(2, 3, 5000), 3)
    data[:1700] = 4.25  # a third of all values are the same
    ints = rng.integers(0, 7, 5000)
    frame = spark.createDataFrame(
        [(float(a), int(b), None) for a, b in zip(data, ints)], "x double, y int, z double").repartition(7)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many range parts as asked for
    try:
        found = exact_quantiles(frame, ["x", "y", "z"], probabilities)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert found["z"] == (0, [])
    for name, values in (("x", data), ("y", ints)):
        n, got = found[name]
        assert n == 5000
        assert np.allclose(got, np.quantile(values, probabilities), rtol=1e-12, atol=1e-12)


def test_approx_quantiles(spark):
    n, (median,) = approx_quantiles(spark.range(1001).select(F.col("id").cast("double").alias("x")), ["x"], [0.5])["x"]
    assert n == 1001 and abs(median - 500) <= 1
