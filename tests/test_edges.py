"""Hand-made tables for the edge cases of the row-level and descriptive operators."""

import time
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratiform.functions import quantile as qt
from stratiform.functions import skew
from stratiform.functions.expr import HASH_FACTOR, HASH_PRIME, key_hash
from stratiform.functions.rank import ranked
from stratiform.functions.skew import salted_join
from stratiform.operators import columns as c
from stratiform.operators import describe as d
from stratiform.operators import quality as q
from stratiform.operators import scale, tree
from stratiform.session import RELEASE, cut_lineage, cut_plan
from stratiform.sources import io


def test_zero_over_zero_share_is_null(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, -1.0, 2.0)], "k int, a double, b double")
    out = c.share_across(df, ["a", "b"], lambda x: x < 0, lambda x: x != 0, "s").orderBy("k").collect()
    assert out[0].s is None and out[1].s == 0.5


def test_zero_total_share_and_null_total(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, 1.0, 4.0), (3, None, 4.0)], "k int, a double, t double")
    out = [r.a_pct for r in c.shares_of_total(df, ["a"], "t").orderBy("k").collect()]
    assert out == [None, 0.25, None]
    assert [r.x for r in c.row_total(df, ["a", "t"], "x").orderBy("k").collect()] == [1.0, 5.0, None]


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (2.1,), (None,)], "v double")
    got = [r.b for r in c.cut(df, "v", [0, 1, 2], ["low", "high"], "b").collect()]
    assert got == [None, "low", "high", "high", None, None]
    assert [r.b for r in c.cut(df, "v", [0, 1, 2], ["low", "high"], "b", "nan").collect()][-1] == "nan"


def test_split_without_separator(spark):
    df = spark.createDataFrame([("1 - Basic",), ("plain",), (None,)], "s string")
    got = [(r.a, r.b) for r in c.split_column(df, "s", " - ", ["a", "b"]).collect()]
    assert got == [("1", "Basic"), ("plain", None), (None, None)]


def test_null_is_never_outside_a_fence(spark):
    df = spark.createDataFrame([(i, float(i) if i else None) for i in range(200)], "k int, v double")
    inside, outside = q.quantile_fence(df, ["v"], 0.01, 0.99)
    assert inside.count() + outside.count() == 200
    assert inside.filter("v is null").count() == 1
    assert outside.filter("v is null").count() == 0
    lo, hi = np.quantile(np.arange(1, 200), [0.01, 0.99])
    assert sorted(r.v for r in outside.collect()) == [v for v in range(1, 200) if v < lo or v > hi]


def test_duplicates_count_every_copy(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    assert q.duplicate_rows(df, "k").first()[0] == 5
    assert q.duplicate_rows(df.distinct(), "k").first()[0] == 0


def test_compare_tables_uses_bags(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, s string")
    assert tuple(q.compare_tables(a, b).first()) == (True, 1, 1, False)
    assert tuple(q.compare_tables(a, a).first()) == (True, 0, 0, True)
    assert tuple(q.compare_tables(a, b.withColumnRenamed("s", "t")).first()) == (False, 3, 3, False)


def test_validation_counts_null_as_outside_the_set(spark):
    df = spark.createDataFrame([(0, 2000), (1, 2020), (None, None)], "flag int, year int")
    got = {r.rule: (r.violations, r.passed) for r in q.validate(df, {"set": q.rule_in_set("flag", [0, 1]), "max": q.rule_max("year", 2016), "big": q.rule_max("year", 3000)}).collect()}
    assert got == {"set": (1, False), "max": (1, False), "big": (0, True)}


def test_drop_values_keeps_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert sorted(str(r.v) for r in q.drop_values(df, "v", [2]).collect()) == ["1", "None"]


def test_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    r = {(x.a, x.b): x.r for x in d.correlation(df, ["a", "b"]).collect()}
    assert r[("a", "b")] is None and r[("b", "b")] is None and r[("a", "a")] == pytest.approx(1.0)
    stats = scale.scaler_fit(df, ["a", "b"])
    assert [row.b for row in scale.scaler_apply(df, stats).collect()] == [0.0, 0.0, 0.0]
    back = scale.scaler_invert(scale.scaler_apply(df, stats), stats).collect()
    assert [row.a for row in back] == pytest.approx([1.0, 2.0, 4.0])
    hist = d.histogram(df, ["b"], 4).collect()
    assert sum(h.n for h in hist) == 3 and len(hist) == 4


def test_correlation_is_pairwise_complete(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, None), (4.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    r = {(x.a, x.b): x.r for x in d.correlation(df, ["a", "b"]).collect()}
    both = np.array([x for x in rows if x[1] is not None])
    assert r[("a", "b")] == pytest.approx(np.corrcoef(both.T)[0, 1])


def test_empty_bin_is_kept(spark):
    df = spark.createDataFrame([(0.5, 3.0), (2.5, 4.0)], "v double, m double")
    got = [(r.bin, r.m) for r in d.sum_by_bin(df, "v", [0, 1, 2, 3], ["a", "b", "c"], ["m"]).orderBy("position").collect()]
    assert got == [("a", 3.0), ("b", 0.0), ("c", 4.0)]


def test_kde_matches_definition(spark):
    x = np.array([1.0, 2.0, 4.0, 7.0])
    df = spark.createDataFrame([("g", float(v)) for v in x] + [("one", 5.0)], "c string, v double")
    got = d.kde(df, "v", [0.0, 3.0, 6.0], by="c").orderBy("position").collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    want = [np.mean(np.exp(-0.5 * ((g - x) / h) ** 2)) / (h * np.sqrt(2 * np.pi)) for g in (0.0, 3.0, 6.0)]
    assert {r.c for r in got} == {"g"}
    assert [r.density for r in got] == pytest.approx(want)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 7.0])), min_size=1, max_size=60))
def test_bracketed_quantiles_match_sorting(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.01, 0.37, 0.5, 1.0]
    got = qt.quantile_values(df, ["v"], probs, small_rows=0)["v"]
    present = [v for v in values if v is not None]
    if not present:
        assert got == [None] * 5
    else:
        assert got == pytest.approx(list(np.quantile(present, probs)), rel=1e-9, abs=1e-9)


def test_bracketed_quantiles_on_heavy_repetition(spark, monkeypatch):
    monkeypatch.setattr(qt, "LIST_ROWS", 5)
    monkeypatch.setattr(qt, "BUCKETS", 4)
    rng = np.random.default_rng(1)
    x = np.concatenate([np.full(400, 3.25), rng.lognormal(3, 3, 800)])
    df = spark.createDataFrame([(float(v), float(-v)) for v in x], "v double, w double")
    got = qt.quantile_values(df, ["v", "w"], [0.01, 0.25, 0.99], small_rows=10)
    assert got["v"] == pytest.approx(list(np.quantile(x, [0.01, 0.25, 0.99])))
    assert got["w"] == pytest.approx(list(np.quantile(-x, [0.01, 0.25, 0.99])))


def test_ranks_inside_a_dominant_group(spark):
    rows = [("hot" if i % 3 else "cold", float((i * 37) % 101), i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, v double, k int").repartition(6)
    got = {(r.g, r.k): r["rank"] for r in ranked(df, ["v", "k"], "g").collect()}
    for g in ("hot", "cold"):
        want = sorted((v, k) for name, v, k in rows if name == g)
        assert [got[(g, k)] for _, k in want] == list(range(1, len(want) + 1))


def test_salted_join_equals_join(spark):
    big = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k int, v int")
    small = spark.createDataFrame([(1, "a"), (3, "b")], "k int, s string")
    for how in ("inner", "left"):
        got = sorted(map(str, salted_join(big, small, ["k"], F.col("v"), how).select("k", "v", "s").collect()))
        assert got == sorted(map(str, big.join(small, "k", how).select("k", "v", "s").collect()))


def test_split_is_complete_and_reproducible(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = tree.split_by_key(df, "k", 0.7, 1)
    a, b = {r.k for r in train.collect()}, {r.k for r in test.collect()}
    assert not a & b and len(a | b) == 5000
    assert 0.67 < len(a) / 5000 < 0.73
    h = df.select("k", key_hash(F.col("k"), 3).alias("h")).filter("k = 41").first().h
    assert h == ((41 + 3) % HASH_PRIME) * HASH_FACTOR % HASH_PRIME


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, -2.25)], "k int, s string, v double")
    io.write_csv(df, str(tmp_path / "t"))
    back = io.read_csv(spark, str(tmp_path / "t"), df.schema)
    assert q.compare_tables(df, back).first().equal


def test_left_join_suffixes(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, index int")
    b = spark.createDataFrame([(1, 30)], "k int, index int")
    out = c.left_join(a, b, "k").orderBy("k")
    assert out.columns == ["k", "index_x", "index_y"]
    assert [tuple(r) for r in out.collect()] == [(1, 10, 30), (2, 20, None)]


def _dealt_rows(spark):
    """Half of the rows have one key, a tenth none."""
    k = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 501).cast("bigint")
    return spark.range(60_000).select("id", k.alias("k"), F.lit("x").alias("shares"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_counted_join_equals_a_plain_join(spark, how):
    big = _dealt_rows(spark)
    small = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    got = skew.counted_join(big, small, ["k"], F.col("id"), how)
    want = big.join(small, "k", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    counts = big.groupBy("k").agg(F.count("*").alias("n"))
    assert skew.counted_join(big, small, ["k"], F.col("id"), how, counted=counts, counts="n").count() == want.count()
    assert skew.counted_join(big.limit(0), small, ["k"], F.col("id"), how).count() == 0
    with pytest.raises(TypeError):
        skew.counted_join(big, small.withColumn("k", F.col("k").cast("int")), ["k"], F.col("id"), how)


def test_counted_join_deals_a_hot_key_evenly(spark):
    """No task gets more than twice the median, and keys that are not hot travel once."""
    big = _dealt_rows(spark)
    heavy = {r.name: r.shares for r in skew.key_shares(big, ["k"], 128).collect()}
    assert sorted(heavy.values()) == [13, 65]  # 6,000 and 30,048 of 60,000 rows, 468.75 a share
    small = spark.range(501).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled",)}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = skew.counted_join(big, small.hint("merge"), ["k"], F.col("id"), "left").withColumn("part", F.spark_partition_id())
        sizes = sorted(r["count"] for r in joined.groupBy("part").count().collect())
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum(sizes) == 60_000 and len(sizes) == 8
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_a_written_step_leaves_no_shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    held = lambda: {f for d in folders for f in Path(d).rglob("shuffle_*")}
    before, setting = held(), spark.conf.get(RELEASE, None)
    grouped = spark.range(20_000).groupBy(F.xxhash64("id").alias("k")).agg(F.sum("id").alias("s"))
    kept = [cut_lineage(grouped), cut_plan(grouped), cut_lineage(grouped)]  # the same table again
    assert [t.agg(F.sum("s")).first()[0] for t in kept] == [sum(range(20_000))] * 3
    wait = time.monotonic() + 20
    while (left := {f for f in held() - before if f.stat().st_size > 20_000}) and time.monotonic() < wait:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(RELEASE, None) == setting
