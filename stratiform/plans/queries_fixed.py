"""Trained models from fixed starts with a fixed number of rounds, unrolled in their SQL, and
identities that hold for any solution."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from stratiform.operators import bisecting as bi
from stratiform.operators import centers as ce
from stratiform.operators import columns as c
from stratiform.operators import describe as d
from stratiform.operators import evaluate as ev
from stratiform.operators import hierarchy as hi
from stratiform.operators import kmodes as km
from stratiform.operators import mixture as mi
from stratiform.operators import pca
from stratiform.operators import profile as pr
from stratiform.operators import tree
from stratiform.operators.density_blocks import dbscan_blocks
from stratiform.plans import flows
from stratiform.plans import model_sql as ms
from stratiform.plans.queries_models import CAT, MODE_ROUNDS, REPORT, REPORT_CTES, K, X, _categories, _modes_sql, _near_labels, first_centers, fixed_labels
from stratiform.plans.registry import ctes, query, r, rounded, rs
from stratiform.session import small_table
from stratiform.sources.mart import KEY, PREMIUMS

ROUNDS = 2


def _std(spark, sf):
    return flows.model_frame(spark, sf).std


def _renamed(sql: str, names: str, tag: str) -> str:
    """A chain of CTEs once more under other names."""
    return re.sub(rf"\b({names})(\d+)\b", rf"\1{tag}\2", sql)


def _lloyd(k: int, tag: str, rounds: int = ROUNDS, last: bool = False) -> str:
    sql = ms.lloyd("std", X, k, rounds)
    if last:
        sql = sql.replace(f"ORDER BY {KEY})", f"ORDER BY {KEY} DESC)").replace(f"ORDER BY {KEY} LIMIT", f"ORDER BY {KEY} DESC LIMIT")
    return _renamed(sql, "a|c", tag)


def _last_centers(std, k):
    rows = std.select(KEY, *X).orderBy(F.desc(KEY)).limit(k).collect()
    return np.array([[row[x] for x in X] for row in rows])


@query("M3_rebuilt_covariance", ctes("std") + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'covar_samp({a}, {b})', 'cov')} FROM std" for a in X for b in X))
def _(spark, sf):
    """Loadings times variances times loadings give the covariance back: checks M2 and M3."""
    std = _std(spark, sf)
    model = pca.pca_fit(std, X)
    total = std.agg(F.sum(F.lit(0.0)), *[F.var_samp(x).alias(x) for x in X]).first()
    share = model.explainedVariance.toArray()
    load = np.zeros((len(X), len(X)))
    for row in pca.pca_loadings(std, X).collect():
        load[X.index(row["variable"]), int(row["pc"][2:]) - 1] = row["loading"]
    back = load @ np.diag(share * sum(total[x] for x in X)) @ load.T
    return rounded(small_table(spark, [(a, b, float(back[i, j])) for i, a in enumerate(X) for j, b in enumerate(X)], "a string, b string, cov double"))


@query("M4_projection_length", ctes("std") + f"SELECT {KEY}, {r(' + '.join(f'power({x} - (SELECT avg({x}) FROM std), 2)' for x in X), 'sq_length')} FROM std")
def _(spark, sf):
    """All components keep the length of every centred row."""
    parts = pca.pca_project(_std(spark, sf), X, len(X), KEY)
    return rounded(parts.select(KEY, sum((F.col(f"PC{i + 1}") ** 2 for i in range(len(X))), F.lit(0.0)).alias("sq_length")))


@query("W1_cumulative", "SELECT CAST(n_nationkey AS INTEGER) AS place, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY n_nationkey) AS BIGINT) AS so_far FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey")
def _(spark, sf):
    per = spark.read.parquet(f"{sf}/customer.parquet").groupBy(F.col("c_nationkey").alias("place")).agg(F.count(F.lit(1)).alias("n"))
    return d.cumulative(per, "place", "n", "so_far")


@query(
    "C3_kmeans_best_of_two",
    ctes("std", _lloyd(K, "x") + ",\n" + _lloyd(K, "y", last=True))
    + f", cost AS (SELECT (SELECT sum(sq_dist) FROM ax{ROUNDS}) AS x, (SELECT sum(sq_dist) FROM ay{ROUNDS}) AS y), "
    f"best AS (SELECT {', '.join(X)}, x AS cost FROM cx{ROUNDS} CROSS JOIN cost WHERE x <= y UNION ALL SELECT {', '.join(X)}, y FROM cy{ROUNDS} CROSS JOIN cost WHERE y < x) "
    f"SELECT CAST(row_number() OVER (ORDER BY {', '.join(X)}) - 1 AS INTEGER) AS label, {rs(X)}, {r('cost')} FROM best",
)
def _(spark, sf):
    std = _std(spark, sf)
    starts = {K: [first_centers(std, X, K).points, _last_centers(std, K)]}
    found, cost = ce.kmeans(std, KEY, X, K, starts=starts, max_iter=ROUNDS, tol=0.0)
    return rounded(found.table(spark).withColumn("cost", F.lit(cost)))


@query(
    "C4_elbow_fixed",
    ctes("std", ",\n".join(_lloyd(k, f"k{k}_") for k in (2, 3, 4)))
    + f"SELECT CAST(1 AS INTEGER) AS k, {r(' + '.join(f'var_pop({x}) * count(*)' for x in X), 'sse')} FROM std"
    + "".join(f" UNION ALL SELECT {k}, {r('sum(sq_dist)', 'sse')} FROM ak{k}_{ROUNDS}" for k in (2, 3, 4)),
)
def _(spark, sf):
    std = _std(spark, sf)
    starts = {k: [first_centers(std, X, k).points] for k in (2, 3, 4)}
    return rounded(ce.elbow(std, KEY, X, 4, starts=starts, max_iter=ROUNDS, tol=0.0))


@query("C5_compare_init_sizes", ctes("std") + "SELECT m AS method, count(*) AS n FROM std CROSS JOIN (SELECT unnest(['random', 'k-means||']) AS m) GROUP BY m")
def _(spark, sf):
    """Every row is in one cluster of each start method."""
    return ce.compare_init(_std(spark, sf), X, ["random", "k-means||"], K).groupBy("method").agg(F.sum("size").alias("n"))


@query("C6_pca_kmeans_all_components", ctes("std", ms.lloyd("std", X, K, ROUNDS)) + f"SELECT {KEY}, min({KEY}) OVER (PARTITION BY label) AS first_key FROM a{ROUNDS}")
def _(spark, sf):
    """On all components k-means finds what it finds on the columns: distances are the same."""
    std = _std(spark, sf)
    keys = [row[KEY] for row in std.select(KEY).orderBy(KEY).limit(K).collect()]
    labels, _ = ce.pca_kmeans(std, KEY, X, len(X), K, start_keys=keys, max_iter=ROUNDS, tol=0.0)
    first = labels.groupBy("label").agg(F.min(KEY).alias("first_key"))
    return labels.join(first, "label").select(KEY, "first_key")


@query(
    "V4_silhouette_fixed",
    ctes("std", ",\n".join(_lloyd(k, f"k{k}_") + ",\n" + ms.silhouette(f"ak{k}_{ROUNDS}", X, f"_{k}") for k in (2, 3)))
    + " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS k, {r('avg(silhouette)', 'silhouette')} FROM sil_{k}" for k in (2, 3)),
)
def _(spark, sf):
    std = _std(spark, sf)
    starts = {k: [first_centers(std, X, k).points] for k in (2, 3)}
    return rounded(ev.silhouette_by_k(std, KEY, X, 2, 3, starts=starts, max_iter=ROUNDS, tol=0.0))


@query("V2_bounds_hold", ctes("std", ms.lloyd("std", X, K, 0) + ",\n" + ms.silhouette("a0", X)) + f"SELECT {r('avg(silhouette)', 'silhouette')}, true AS lower_holds, true AS upper_holds FROM sil")
def _(spark, sf):
    std = _std(spark, sf)
    exact = ev.silhouette_score(std, _near_labels(std), KEY, X).first()["silhouette"]
    low, high, _ = ev.silhouette_bounds(std, _near_labels(std), KEY, X).first()
    return rounded(small_table(spark, [(exact, low <= exact + 1e-12, exact <= high + 1e-12)], "silhouette double, lower_holds boolean, upper_holds boolean"))


TWO = X[:2]


def _em_sql() -> str:
    """One round of expectation and maximisation over two columns, from the first K rows."""
    x, y = TWO
    return f"""{ms.first_rows("s0", "std", TWO, K)},
{ms.nearest("h0", "std", "s0", TWO)},
p0 AS (SELECT label, count(*) * 1.0 / (SELECT count(*) FROM std) AS w, avg({x}) AS mx, avg({y}) AS my,
  var_pop({x}) + {mi.RIDGE} AS cxx, covar_pop({x}, {y}) AS cxy, var_pop({y}) + {mi.RIDGE} AS cyy FROM h0 GROUP BY label),
dens AS (SELECT s.{KEY}, s.{x}, s.{y}, label, ln(w) - ln(2 * pi()) - 0.5 * ln(cxx * cyy - cxy * cxy)
  - 0.5 * (cyy * power(s.{x} - mx, 2) - 2 * cxy * (s.{x} - mx) * (s.{y} - my) + cxx * power(s.{y} - my, 2)) / (cxx * cyy - cxy * cxy) AS lj FROM std s CROSS JOIN p0),
norm AS (SELECT *, max(lj) OVER k + ln(sum(exp(lj - top)) OVER k) AS total FROM (SELECT *, max(lj) OVER (PARTITION BY {KEY}) AS top FROM dens) WINDOW k AS (PARTITION BY {KEY})),
p1 AS (SELECT label, sum(exp(lj - total)) / (SELECT count(*) FROM std) AS w, sum(exp(lj - total) * {x}) / sum(exp(lj - total)) AS {x},
  sum(exp(lj - total) * {y}) / sum(exp(lj - total)) AS {y} FROM norm GROUP BY label)"""


@query(
    "C14_gmm_one_round",
    ctes("std", _em_sql())
    + f"SELECT CAST(row_number() OVER (ORDER BY {', '.join(TWO)}) - 1 AS INTEGER) AS label, {rs(TWO)}, {r('w', 'weight')}, "
    f"{r(f'(SELECT sum(total) / (SELECT count(*) FROM std) FROM (SELECT DISTINCT {KEY}, total FROM norm))', 'mean_log_likelihood')} FROM p1",
)
def _(spark, sf):
    std = _std(spark, sf)
    mix, ll = mi.gmm(std, KEY, TWO, K, max_iter=1, starts=[first_centers(std, TWO, K).points])
    weights = small_table(spark, [(i, float(w), float(ll)) for i, w in enumerate(mix.weights)], "label int, weight double, mean_log_likelihood double")
    return rounded(ce.Centers.of(TWO, mix.means).table(spark).join(weights, "label").select("label", *TWO, "weight", "mean_log_likelihood"))


@query("C12_kmodes_sizes", ctes("categories", _modes_sql(3)) + f"SELECT CAST(label AS INTEGER) AS label, {', '.join('m.' + x for x in CAT)}, CAST(n AS BIGINT) AS n FROM m_{MODE_ROUNDS} m JOIN (SELECT label, sum(w) AS n FROM t_{MODE_ROUNDS} GROUP BY label) USING (label)")
def _(spark, sf):
    """The modes with how many customers each stands for."""
    cat = _categories(spark, sf)
    modes, _ = km.kmodes(cat, KEY, CAT, 3)
    sizes = km.kmodes_labels(cat, KEY, CAT, modes).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return km.modes_table(cat, CAT, modes).join(sizes, "label").select("label", *CAT, "n")


@query(
    "V5_compare_without_noise",
    ctes("std", f"kept AS (SELECT *, CAST({KEY} % 4 - 1 AS INTEGER) AS label FROM std WHERE {KEY} % 4 <> 0),\n" + ms.silhouette("kept", X))
    + f"SELECT 'by_key' AS method, count(DISTINCT label) AS n_clusters, {r('avg(silhouette)', 'silhouette')} FROM sil",
)
def _(spark, sf):
    """Noise left out of the score."""
    std = _std(spark, sf)
    return rounded(ev.compare_methods(std, {"by_key": fixed_labels(std)}, KEY, X, exclude_noise=True))


@query(
    "C17_profiles_by_method",
    ctes("std", ms.lloyd("std", X, K, 1) + f",\nfixed AS (SELECT *, CAST({KEY} % 4 - 1 AS INTEGER) AS label FROM std)")
    + " UNION ALL ".join(
        f"SELECT '{n}' AS method, label, {rs_avg}, count(*) AS n FROM {t} WHERE label <> -1 GROUP BY label"
        for rs_avg in [", ".join(r(f"avg({x})", x) for x in X)]
        for n, t in (("first", "a0"), ("moved", "a1"), ("by_key", "fixed"))
    ),
)
def _(spark, sf):
    std = _std(spark, sf)
    moved = ce.assign_nearest(std, ce.lloyd_rounds(std, first_centers(std, X, K), 1)).select(KEY, "label")
    return rounded(pr.profiles_by_method(std, {"first": _near_labels(std), "moved": moved, "by_key": fixed_labels(std)}, KEY, X))


@query("D7_outlier_comparison")
def _(spark, sf):
    """Profiles of the segments on scaled columns, without and with the placed outliers."""
    s = flows.segment(spark, sf)
    whole = flows.extend(s, flows.explain(s)[0]).persist()
    return rounded(pr.outlier_comparison(whole.filter("not outlier"), whole, KEY, X, s.frame.scaler))


@query("C5_compare_init_labels", ctes("std") + f"SELECT m AS method, count(DISTINCT {KEY}) AS n FROM std CROSS JOIN (SELECT unnest(['random', 'k-means||']) AS m) GROUP BY m")
def _(spark, sf):
    """Every row has one label of each start method."""
    labels = ce.compare_init_labels(_std(spark, sf), KEY, X, ["random", "k-means||"], K)
    return labels.filter(F.col("label").between(0, K - 1)).groupBy("method").agg(F.count_distinct(KEY).alias("n"))


FEATURE_EPS, FEATURE_MIN = 0.9, 50


@query("C15_dbscan_features", ctes("std", ms.dbscan("std", X, FEATURE_EPS, FEATURE_MIN)) + f"SELECT {KEY}, label FROM labelled")
def _(spark, sf):
    """All nine features."""
    return dbscan_blocks(_std(spark, sf), KEY, X, FEATURE_EPS, FEATURE_MIN)


# ---- flows ---------------------------------------------------------------------------

_RULES = {
    "policy_year_after_limit": "policy_creation_year > 2016",
    "birth_year_after_limit": "birth_year > 2016",
    "children_not_binary": "NOT coalesce(has_children IN (0, 1), false)",
    "policy_before_age_18": "policy_creation_year < birth_year + 18",
}
_FILLED = [KEY, "policy_creation_year", "birth_year", "gross_monthly_salary", "geographic_area", "has_children", "customer_monetary_value", "claims_rate", *PREMIUMS, "edu_desc"]


def _report_sql() -> str:
    gap = " OR ".join(f"{x} IS NULL" for x in _FILLED)
    parts = [f"SELECT 'missing' AS section, '{x}' AS name, {r(f'avg(CASE WHEN {x} IS NULL THEN 100.0 ELSE 0 END)', 'value', 2)} FROM filled" for x in _FILLED]
    parts.append("SELECT 'rows' AS section, 'before' AS name, CAST(count(*) AS DOUBLE) AS value FROM filled")
    parts.append(f"SELECT 'rows', 'after', CAST(count(*) FILTER (WHERE NOT ({gap})) AS DOUBLE) FROM filled")
    parts += [f"SELECT 'rule', '{n}', CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) FROM filled" for n, cond in _RULES.items()]
    parts.append(f"SELECT 'rows', 'duplicate_keys', CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS DOUBLE) FROM (SELECT count(*) AS n FROM filled GROUP BY {KEY})")
    return " UNION ALL ".join(parts)


@query("E1_clean_report", ctes("filled") + _report_sql())
def _(spark, sf):
    """What cleaning meets: missing shares, rows lost, rules violated, repeated keys."""
    return rounded(flows.clean_report(spark, sf), 2)


def _pack_sql() -> str:
    parts = []
    for x in flows.CATEGORIES:
        parts.append(f"SELECT 'count' AS section, '{x}' AS name, CAST({x} AS VARCHAR) AS item, CAST(count(*) AS DOUBLE) AS value FROM inside WHERE {x} IS NOT NULL GROUP BY 3")
    for section, cond in (("premium_total", None), ("positive_policies", "{0} > 0"), ("reversals", "{0} < 0")):
        for x in PREMIUMS:
            v = f"sum({x})" if cond is None else f"count(*) FILTER (WHERE {cond.format(x)})"
            parts.append(f"SELECT '{section}', 'all', '{x}', CAST({v} AS DOUBLE) FROM inside")
    for col, edges, labels in (("claims_rate", flows.CLAIM_EDGES, flows.CLAIM_LABELS), ("gross_monthly_salary", flows.SALARY_EDGES, flows.SALARY_LABELS), ("cust_tenure", flows.TENURE_EDGES, flows.TENURE_LABELS)):
        case = "CASE " + " ".join(f"WHEN {col} > {a} AND {col} <= {b} THEN '{n}'" for a, b, n in zip(edges, edges[1:], labels)) + " END"
        parts.append(f"SELECT 'binned', '{col}', {case}, CAST(count(*) AS DOUBLE) FROM inside WHERE {case} IS NOT NULL GROUP BY 3")
    for a, b in flows.RELATED:
        parts.append(f"SELECT 'correlation', '{a}', '{b}', corr({a}, {b}) FROM inside")
    numbers, (x, y), n = flows.NUMBERS, flows.JOINT, flows.PACK_BINS
    parts += [f"SELECT 'correlation_matrix', '{a}', '{b}', corr({a}, {b}) FROM inside HAVING stddev_pop({a}) * stddev_pop({b}) > 0" for a in numbers for b in numbers]
    label = lambda col, edges, labels: "CASE " + " ".join(f"WHEN {col} > {a} AND {col} <= {b} THEN '{t}'" for a, b, t in zip(edges, edges[1:], labels)) + " END"
    claims = label("claims_rate", flows.CLAIM_EDGES, flows.CLAIM_LABELS)
    parts += [f"SELECT 'premium_by_claims', '{p}', '{t}', coalesce(sum({p}) FILTER (WHERE {claims} = '{t}'), 0) FROM inside" for p in PREMIUMS for t in flows.CLAIM_LABELS]
    salary = label("gross_monthly_salary", flows.SALARY_EDGES, flows.SALARY_LABELS)
    parts.append(f"SELECT 'salary_by_area', {salary}, geographic_area, count(*) FROM inside WHERE {salary} IS NOT NULL GROUP BY 2, 3")
    grid = ", ".join(f"({i}, {g})" for i, g in enumerate(flows.SALARY_GRID))
    gap = "(x - gross_monthly_salary) / h"
    parts.append(
        f"SELECT 'salary_density_per_million', edu_desc, CAST(position AS VARCHAR), avg(exp(-0.5 * ({gap}) * ({gap}))) / max(h * sqrt(2 * pi())) * 1e6 FROM inside "
        "JOIN (SELECT edu_desc, stddev_samp(gross_monthly_salary) * pow(count(*), -0.2) AS h FROM inside GROUP BY 1) USING (edu_desc) "
        f"CROSS JOIN (VALUES {grid}) g(position, x) WHERE h > 0 GROUP BY edu_desc, position"
    )
    place = lambda col, lo, hi: f"CAST(least(floor(({col} - {lo}) / (({hi} - {lo}) / {n})), {n - 1}) AS INTEGER)"
    parts += [
        f"SELECT 'histogram', '{c}', CAST(i AS VARCHAR), coalesce(m, 0) FROM range({n}) t(i) LEFT JOIN (SELECT {place(c, 'lo', 'hi')} AS b, count(*) AS m FROM inside CROSS JOIN "
        f"(SELECT min({c}) AS lo, max({c}) AS hi FROM inside) GROUP BY 1) ON b = i"
        for c in numbers
    ]
    parts.append(
        f"SELECT 'joint_histogram', '{x}, {y}', {place(x, 'xl', 'xh')} || ',' || {place(y, 'yl', 'yh')}, count(*) FROM inside CROSS JOIN "
        f"(SELECT min({x}) AS xl, max({x}) AS xh, min({y}) AS yl, max({y}) AS yh FROM inside) GROUP BY 3"
    )
    for c in numbers:
        shares = dict(zip(flows.BOX, (flows.FENCE_LO, 0.25, 0.5, 0.75, flows.FENCE_HI)))
        parts += [f"SELECT 'box', '{c}', '{name}', quantile_cont({c}, {p}) FROM inside" for name, p in shares.items()]
        parts.append(f"SELECT 'box', '{c}', 'n_outside', count(*) FROM inside CROSS JOIN (SELECT quantile_cont({c}, {flows.FENCE_LO}) AS lo, quantile_cont({c}, {flows.FENCE_HI}) AS hi FROM inside) WHERE {c} < lo OR {c} > hi")
    # Interpolated quantiles of four-decimal money have six decimals; at two, some would be ties.
    return "SELECT section, name, item, CASE section WHEN 'box' THEN round(CAST(value AS DOUBLE), 6) ELSE round(CAST(value AS DOUBLE), 2) END + 0.0 AS value FROM (" + " UNION ALL ".join(parts) + ")"


@query("E6_descriptive_pack", ctes("inside") + _pack_sql())
def _(spark, sf):
    """All descriptive views of the customers inside the fences."""
    pack = flows.descriptive_pack(spark, sf)
    return pack.withColumn("value", F.when(F.col("section") == "box", F.round("value", 6)).otherwise(F.round("value", 2)) + F.lit(0.0))


@query("E5_tree_scores_agree")
def _(spark, sf):
    """On real tree output: matrix, report and accuracy tell the same story."""
    s = flows.segment(spark, sf, 3)
    model, train, test = flows.explain(s)
    pred = tree.predict(model, test).select(KEY, "label", "prediction").persist()
    try:
        matrix = ev.confusion_matrix(pred).collect()
        cells = [v for row in matrix for v in list(row)[1:]]
        hits = sum(row[f"p{row['actual']}"] for row in matrix)
        share = ev.accuracy(pred).first()["accuracy"]
        told = ev.classification_report(pred).filter("label = 'accuracy'").first()
        n = pred.count()
        same = abs(share - hits / n) < 1e-9 and abs(told["precision"] - share) < 1e-9
        return small_table(spark, [(same, sum(cells) == n == told["support"], train.count() + n == s.frame.features.count())], "same_accuracy boolean, same_rows boolean, splits_all boolean")
    finally:
        pred.unpersist()



# ---- trees ---------------------------------------------------------------------------

TWO = X[:2]
_TREE = ms.lloyd("std", X, K, 0) + f",\nlabelled AS (SELECT f.{KEY}, {', '.join('f.' + x for x in TWO)}, a0.label FROM features f JOIN a0 USING ({KEY})),\n" + ms.tree("labelled", TWO, K, 3, 2)


def _two_levels(spark, sf):
    """A tree of two levels on two unscaled columns, for the labels of fixed centers."""
    m = flows.model_frame(spark, sf)
    rows = c.attach_labels(m.features.select(KEY, *TWO), _near_labels(m.std), KEY)
    return tree.fit_tree(rows, TWO, max_depth=2), rows


@query("D2_tree_two_levels", ctes("std", _TREE) + f"SELECT path, feature, {r('threshold')}, n, majority, hits FROM nodes")
def _(spark, sf):
    return rounded(_two_levels(spark, sf)[0].nodes)


@query("D3_predict_two_levels", ctes("std", _TREE) + f"SELECT p.{KEY}, p.path AS leaf, n.majority AS prediction FROM placed p JOIN nodes n USING (path)")
def _(spark, sf):
    model, rows = _two_levels(spark, sf)
    return tree.leaves(model, rows).select(KEY, "leaf", "prediction")


@query("D8_leaf_profile_two_levels", ctes("std", _TREE) + f"SELECT path AS leaf, n, majority, {r('hits / n', 'purity')} FROM nodes WHERE feature IS NULL")
def _(spark, sf):
    model, rows = _two_levels(spark, sf)
    return rounded(tree.tree_leaf_profile(model, rows))


@query(
    "E5_explain_two_levels",
    ctes("std", f"{_TREE},\npred AS (SELECT p.label, n.majority AS prediction FROM placed p JOIN nodes n USING (path)),\n{REPORT_CTES}") + REPORT,
)
def _(spark, sf):
    """How well the two levels tell the labels apart."""
    model, rows = _two_levels(spark, sf)
    return rounded(ev.classification_report(tree.predict(model, rows)))


_OUTSIDE = f"""far AS (SELECT * FROM (SELECT {KEY}, {', '.join(X[:4])}, {', '.join(f'CASE WHEN total_premiums <> 0 THEN {p} / total_premiums END AS {p}_pct' for p in PREMIUMS)} FROM outside)
  WHERE {' AND '.join(f'{x} IS NOT NULL' for x in X)})"""
_WHOLE = (
    f"{_TREE},\n{_OUTSIDE},\n{ms.walk('far', TWO, 2)},\nwhole AS (SELECT f.{KEY}, {', '.join('f.' + x for x in X)}, a0.label, false AS outlier FROM features f JOIN a0 USING ({KEY}) "
    f"UNION ALL SELECT o.{KEY}, {', '.join('o.' + x for x in X)}, n.majority, true FROM far_leaf o JOIN nodes n USING (path))"
)


def _placed_outliers(spark, sf):
    m = flows.model_frame(spark, sf)
    labels = _near_labels(m.std)
    model = tree.fit_tree(c.attach_labels(m.features.select(KEY, *TWO), labels, KEY), TWO, max_depth=2)
    return flows.extend(flows.Segments(m, labels), model)


@query("D7_outliers_by_two_levels", ctes("std", _WHOLE) + f"SELECT {KEY}, {rs(X)}, label, outlier FROM whole")
def _(spark, sf):
    """Labelled rows, and outliers placed by the tree of two levels."""
    return rounded(_placed_outliers(spark, sf))


@query("D7_profile_by_two_levels", ctes("std", _WHOLE) + f"SELECT label, {', '.join(r(f'avg({x})', x) for x in X)}, count(*) AS n FROM whole GROUP BY label")
def _(spark, sf):
    whole = _placed_outliers(spark, sf)
    return rounded(pr.cluster_profile(whole.drop("label", "outlier"), whole.select(KEY, "label"), KEY, X))


@query(
    "E4_segment_profile_rounds",
    ctes("std", ms.lloyd("std", X, K, 2)) + f"SELECT a2.label, {', '.join(r(f'avg(f.{x})', x) for x in X)}, count(*) AS n FROM a2 JOIN features f USING ({KEY}) GROUP BY a2.label",
)
def _(spark, sf):
    """Segments after two rounds from fixed centers, in original units."""
    m = flows.model_frame(spark, sf)
    labels = ce.assign_nearest(m.std, ce.lloyd_rounds(m.std, first_centers(m.std, X, K), 2)).select(KEY, "label")
    return rounded(pr.cluster_profile(m.std, labels, KEY, X, m.scaler))


# ---- hierarchies ---------------------------------------------------------------------

EIGHT = 8


def _merges(name):
    def run(spark, sf):
        """The merges of eight groups that hold all rows, each by its mean and size."""
        std = _std(spark, sf)
        groups = ce.update_centers(ce.assign_nearest(std, first_centers(std, X, EIGHT)), X)
        return rounded(hi.merge_rounds(groups, X, name, few=4).select(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"), "h"))

    return run


for _name in hi.LINKAGES:
    _groups = f"grp AS (SELECT label, {', '.join(f'avg({x}) AS {x}' for x in X)}, count(*) AS n FROM a0 GROUP BY label)"
    query(
        f"C16c_merges_{_name}",
        ctes("std", ms.lloyd("std", X, EIGHT, 0) + f",\n{_groups},\n{ms.linkage('grp', X, _name, EIGHT - 1)}")
        + " UNION ALL ".join(f"SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, {r('h')} FROM p{i}" for i in range(EIGHT - 1)),
    )(_merges(_name))


# ---- top-down splits -----------------------------------------------------------------

_SPLIT = f"""{ms.lloyd('std', X, 2, ROUNDS)},
pick AS (SELECT label AS worst FROM a{ROUNDS} GROUP BY label ORDER BY sum(sq_dist) DESC, label LIMIT 1),
sub AS (SELECT {KEY}, {', '.join(X)} FROM a{ROUNDS} JOIN pick ON label = worst),
{_renamed(ms.lloyd('sub', X, 2, ROUNDS), 'a|c', 'b')}"""


@query(
    "C16d_bisecting_rounds",
    ctes("std", _SPLIT)
    + f"""SELECT o.{KEY}, CAST(CASE WHEN o.label < worst THEN o.label WHEN o.label = worst THEN worst + i.label ELSE o.label + 1 END AS INTEGER) AS label
    FROM a{ROUNDS} o CROSS JOIN pick LEFT JOIN ab{ROUNDS} i USING ({KEY})""",
)
def _(spark, sf):
    """Three clusters by two splits of two rounds, each from the two rows with the lowest keys."""
    return bi.bisecting(_std(spark, sf), KEY, X, 3, max_iter=ROUNDS, tol=0.0, lowest_keys=True)
