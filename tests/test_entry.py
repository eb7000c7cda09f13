"""The registered queries themselves, at the smallest scale, against their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from stratiform.operators import tree
from stratiform.plans import flows
from stratiform.sources.mart import KEY

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "embeddings"]
SAMPLE = ["IO3_describe_sources", "A1_describe_all", "E3_model_frame", "C2_update_centers", "C12_kmodes", "C15_dbscan", "V5_compare_methods", "D6_classification_report"]


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in TABLES:
        out.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return out


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(float(r[i])) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


def test_every_check_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_runs(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and {"geographic_area", "n", "mean_active", "premiums"} == set(rows[0].asDict())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    got = entry_points.queries()[name](spark, SF)
    want = con.execute(entry_points.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert canon(map(tuple, got.collect()), got.columns) == canon(want.fetchall(), cols)


def test_fences_lose_no_row(spark):
    inside, outside = flows.split_outliers(spark, SF)
    assert inside.count() + outside.count() == flows.valued(spark, SF).count()
    assert inside.join(outside, KEY, "left_semi").count() == 0


def test_filters_and_columns_reach_the_scan(spark):
    """The mart reads only the columns it needs."""
    plan = flows.valued(spark, SF)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "l_orderkey" in line)
    schema = scan.split("ReadSchema:")[1]
    assert "l_extendedprice" in schema and "l_comment" not in schema and "l_partkey" not in schema
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_split_sides_make_the_whole(spark):
    frame = flows.model_frame(spark, SF).features
    train, test = tree.split_by_key(frame, KEY, 0.7, 1)
    assert train.count() + test.count() == frame.count()


def test_explain_and_extend_reports_and_extends(spark):
    """The report alone is half of the job: matrix, leaves and placed outliers belong to it."""
    out = entry_points.queries()["E5_explain_and_extend"](spark, SF).toPandas()
    s = flows.segment(spark, SF)
    model, train, test = flows.explain(s)
    whole = flows.extend(s, model).toPandas()
    of = {name: part for name, part in out.groupby("section")}
    assert set(of) == {"report", "confusion", "leaf", "profile", "inside", "with_outliers"}
    assert whole["outlier"].any() and of["profile"]["n"].sum() == len(whole)
    want = whole.groupby("label")[flows.FEATURES].mean()
    got = of["profile"].assign(label=of["profile"]["label"].astype(int)).set_index("label")[flows.FEATURES].sort_index()
    assert abs(got.to_numpy() - want.to_numpy()).max() < 1e-3
    assert of["leaf"]["n"].sum() == train.count() and of["confusion"]["n"].sum() == test.count()
    report = of["report"].set_index("label")
    hits = of["confusion"][of["confusion"]["label"].astype(float) == of["confusion"]["prediction"]]["n"].sum()
    assert report.loc["accuracy", "precision"] == pytest.approx(hits / test.count(), abs=1e-4)
    n = of["inside"].groupby("variable")["n"].sum()
    more = of["with_outliers"].groupby("variable")["n"].sum()
    assert set(n) == {int((~whole["outlier"]).sum())} and set(more) == {len(whole)}
