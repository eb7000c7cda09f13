"""Nothing is left out because of size, missing means NULL or NaN, and offsets cost no digits."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.functions.quantile import quantile_values
from stratiform.operators import density_blocks
from stratiform.operators.density_blocks import dbscan_blocks
from stratiform.operators import centers, density, describe, evaluate, mixture, quality


def test_start_points_see_a_small_far_group(spark):
    """Five rows far away among 50,000 get a center of their own."""
    df = spark.range(50_000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") < 5, 500.0 + F.col("id") / 10).otherwise(F.sin(F.col("id").cast("double"))).alias("x"),
        F.when(F.col("id") < 5, -400.0).otherwise(F.cos(F.col("id") * 7.0)).alias("y"),
    )
    found, _ = centers.kmeans(df, "key", ["x", "y"], 3, n_init=2)
    far = found.points[np.abs(found.points - [500.2, -400.0]).sum(axis=1) < 1]
    assert len(far) == 1
    assert centers.assign_nearest(df, found).filter(F.col("label") == int(np.argmin(found.points[:, 1]))).count() == 5


def test_ends_merge_alike_on_the_driver_and_in_rounds(spark):
    r = np.random.default_rng(3)
    rows = [(float(x), float(y), int(n)) for x, y, n in zip(r.uniform(0, 12, 400), r.uniform(0, 12, 400), r.integers(1, 40, 400))]
    found = spark.createDataFrame(rows, "x double, y double, n bigint")
    want = density.merge_centers(found, ["x", "y"], 1.5)
    got = density.merge_centers(found, ["x", "y"], 1.5, few=10)
    assert 10 < len(want.points) == len(got.points) and np.array_equal(want.points, got.points)


def test_confusion_of_many_labels(spark):
    pred = spark.range(1500).select((F.col("id") % 150).cast("int").alias("label"), ((F.col("id") * 7) % 150).cast("int").alias("prediction"))
    out = evaluate.confusion_matrix(pred)
    assert len(out.columns) == 151 and out.count() == 150
    assert sum(sum(tuple(r)[1:]) for r in out.collect()) == 1500


def test_missing_is_null_or_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, t string")
    assert quality.drop_null_rows(df).count() + quality.null_rows(df).count() == 4
    assert quality.drop_null_rows(df).count() == quality.dropna_impact(df).first()["after"] == 1
    assert {r["column"]: r["pct_null"] for r in quality.null_profile(df).collect()} == {"x": 50.0, "t": 25.0}
    assert quality.missing_summary(df).first()["missing_cells"] == 3


def test_every_column_is_described(spark):
    schema = "flag boolean, day date, at timestamp, none string, n int"
    df = spark.createDataFrame([(True, dt.date(2020, 1, 1), dt.datetime(2020, 1, 1), None, 1), (True, None, dt.datetime(2021, 1, 1), None, 3)], schema)
    out = {r["column"]: r for r in describe.describe_all(df).collect()}
    assert set(out) == set(df.columns)
    assert (out["flag"]["top"], out["flag"]["freq"], out["day"]["count"], out["at"]["n_distinct"]) == ("true", 2, 1, 2)
    assert (out["none"]["count"], out["none"]["n_distinct"], out["none"]["top"], out["n"]["mean"]) == (0, 0, None, 2.0)
    assert describe.describe_all(df.select("flag")).count() == 1


def test_mixture_with_a_large_offset(spark):
    df = spark.range(400).select(
        F.col("id").alias("key"),
        (F.lit(1e8) + F.when(F.col("id") % 2 == 0, 0.0).otherwise(10.0) + F.sin(F.col("id") * 1.7)).alias("x"),
        (F.lit(1e8) + F.cos(F.col("id") * 2.3)).alias("y"),
    )
    model, _ = mixture.gmm(df, "key", ["x", "y"], 2, n_init=2)
    assert np.allclose(model.means[:, 0] - 1e8, [0, 10], atol=0.2) and np.allclose(model.weights, [0.5, 0.5], atol=0.01)
    assert mixture.gmm_score(df, model, "key").groupBy("label").count().count() == 2


@pytest.mark.parametrize("p", [0.01, 0.25, 0.333, 0.9])
def test_both_quantile_routes_give_the_same_digits(spark, p):
    df = spark.range(3000).select(F.sin(F.col("id") * 1.1).alias("x"), (F.col("id") % 7 / 3).alias("y"))
    assert quantile_values(df, ["x", "y"], [p]) == quantile_values(df, ["x", "y"], [p], small_rows=10)


@pytest.mark.parametrize("block_rows", [10, 5000])
def test_blocks_give_the_labels_of_cells(spark, block_rows):
    r = np.random.default_rng(8)
    n = 300 if block_rows > 10 else 150
    x = np.concatenate([r.normal(0, 0.3, (120, 3)), r.normal(2, 0.4, (100, 3)), r.uniform(-2, 4, (60, 3)), np.zeros((15, 3))])
    x = x[r.permutation(len(x))[:n]]
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], "key bigint, x double, y double, z double").repartition(4)
    want = density.dbscan(df, "key", ["x", "y", "z"], 0.45, 6)
    got = dbscan_blocks(df, "key", ["x", "y", "z"], 0.45, 6, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("eps", [0.9, 50.0])
def test_no_task_judges_more_than_two_blocks(spark, eps):
    """Nine columns; the largest eps is far beyond the spread, so everything is near everything."""
    r = np.random.default_rng(9)
    cols = [f"c{j}" for j in range(9)]
    x = r.normal(size=(700, 9)).round(6)
    df = spark.createDataFrame([(i, 1, *map(float, row)) for i, row in enumerate(x)], "pid bigint, w bigint, " + ", ".join(f"{c} double" for c in cols))
    dealt = density_blocks.blocks(df, cols, eps, 64)
    sizes = [row["count"] for row in dealt.groupBy("block").count().collect()]
    assert sum(sizes) == 700 and max(sizes) <= 64 and len(sizes) <= 4 * 700 // 64 + 4
    pairs = {tuple(p) for p in density_blocks.block_pairs(dealt, cols, eps).collect()}
    block = {row.pid: row.block for row in dealt.select("pid", "block").collect()}
    near = np.argwhere(((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps)
    assert {(block[a], block[b]) for a, b in near.tolist() if block[a] != block[b]} <= pairs and all((b, a) in pairs for a, b in pairs)
    assert eps < 1 or len(pairs) == len(sizes) * (len(sizes) - 1)
    labels = dbscan_blocks(df.withColumnRenamed("pid", "key"), "key", cols, eps, 5, block_rows=64)
    want = density.dbscan(df.withColumnRenamed("pid", "key"), "key", cols, eps, 5)
    assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, want.collect()))


def test_blocks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "key bigint, x double, y double")
    assert dbscan_blocks(df, "key", ["x", "y"], 1.0, 3).count() == 0


def test_block_pairs_are_done_in_shares(spark):
    """Where all blocks are near each other, their rows travel a few times at once, not once per block."""
    pairs = spark.range(81 * 4).select((F.col("id") % 18).alias("home"), (F.col("id") / 18).cast("bigint").alias("other")).filter("home != other")
    shares = density_blocks._in_shares(pairs, 18)
    assert len(shares) == 5 and sum(s.count() for s in shares) == 306
