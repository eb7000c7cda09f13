"""Registered queries: scaling, components, clustering, evaluation, trees, flows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from stratiform.operators import bisecting as bi
from stratiform.operators import centers as ce
from stratiform.operators import columns as c
from stratiform.operators import density as de
from stratiform.operators import evaluate as ev
from stratiform.operators import hierarchy as hi
from stratiform.operators import kmodes as km
from stratiform.operators import mixture as mi
from stratiform.operators import pca
from stratiform.operators import profile as pr
from stratiform.operators import scale, som, tree
from stratiform.plans import flows
from stratiform.plans import model_sql as ms
from stratiform.plans.registry import ctes, query, r, rounded, rs
from stratiform.session import small_table
from stratiform.sources import io
from stratiform.sources.mart import KEY

X = flows.FEATURES
D3 = flows.DENSITY
K = 5
EPS, MIN_SAMPLES = 0.4, 10
BANDWIDTH = 0.8


def first_centers(df, cols, k, key=KEY):
    """The rows with the lowest keys, as fixed start points."""
    rows = df.select(key, *cols).orderBy(key).limit(k).collect()
    return ce.Centers.of(cols, np.array([[row[x] for x in cols] for row in rows]))


def fixed_labels(df, key=KEY):
    """A labelling that depends on the key only, noise included."""
    return df.select(key, (F.pmod(F.col(key), F.lit(4)) - 1).cast("int").alias("label"))


_FIXED = f"fixed AS (SELECT *, CAST({KEY} % 4 - 1 AS INTEGER) AS label FROM std)"

# ---- scaling and components ----------------------------------------------------------


@query("M1a_scaler_fit", ctes("features") + " UNION ALL ".join(f"SELECT '{x}' AS \"column\", {r(f'avg({x})', 'mean')}, {r(f'stddev_pop({x})', 'std')} FROM features" for x in X))
def _(spark, sf):
    return rounded(flows.model_frame(spark, sf).scaler.table(spark))


@query("M1b_scaler_apply", ctes("std") + f"SELECT {KEY}, {rs(X)} FROM std")
def _(spark, sf):
    m = flows.model_frame(spark, sf)
    return rounded(scale.scaler_apply(m.features, m.scaler))


@query("M1c_scaler_invert", ctes("features") + f"SELECT {KEY}, {rs(X)} FROM features")
def _(spark, sf):
    m = flows.model_frame(spark, sf)
    return rounded(scale.scaler_invert(m.std, m.scaler))


@query("M2_covariance", ctes("std") + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'covar_samp({a}, {b})', 'cov')} FROM std" for a in X for b in X))
def _(spark, sf):
    return rounded(pca.covariance(flows.model_frame(spark, sf).std, X))


@query("M2_pca_variance")
def _(spark, sf):
    return pca.pca_variance(flows.model_frame(spark, sf).std, X)


@query("M3_pca_loadings")
def _(spark, sf):
    return rounded(pca.pca_loadings(flows.model_frame(spark, sf).std, X))


@query("M4_pca_project")
def _(spark, sf):
    return rounded(pca.pca_project(flows.model_frame(spark, sf).std, X, 4, KEY))


# ---- nearest centers and k-means -----------------------------------------------------


@query("C1_assign_nearest", ctes("std", ms.lloyd("std", X, K, 0)) + f"SELECT {KEY}, label, {r('sq_dist')} FROM a0")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(ce.assign_nearest(std, first_centers(std, X, K)).select(KEY, "label", "sq_dist"))


E64 = [f"e{i}" for i in range(64)]


def vectors(spark, sf):
    """Embeddings spread into columns."""
    return io.read_table(spark, sf, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(E64)]
    )


_EDIST = "list_distance(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) ** 2"


@query(
    "C1_assign_embeddings",
    "WITH first AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS unit, embedding FROM embeddings ORDER BY vec_id LIMIT 10) "
    f"SELECT vec_id, unit, {r('d', 'sq_dist')} FROM (SELECT x.vec_id, y.unit, {_EDIST} AS d, row_number() OVER (PARTITION BY vec_id ORDER BY {_EDIST}, unit) AS rn "
    "FROM embeddings x CROSS JOIN first y) WHERE rn = 1",
)
def _(spark, sf):
    vec = vectors(spark, sf).drop("label")
    return rounded(ce.assign_nearest(vec, first_centers(vec, E64, 10, "vec_id"), "unit").select("vec_id", "unit", "sq_dist"))


@query("C2_update_centers", ctes("std", ms.lloyd("std", X, K, 3)) + f"SELECT label, {rs(X)} FROM c3")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(ce.lloyd_rounds(std, first_centers(std, X, K), 3).table(spark))


@query("C3_kmeans")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    centers, cost = ce.kmeans(std, KEY, X, K)
    return rounded(centers.table(spark).withColumn("cost", F.lit(cost)))


@query("C4_elbow")
def _(spark, sf):
    return rounded(ce.elbow(flows.model_frame(spark, sf).std, KEY, X, 8))


@query("C4_elbow_single", ctes("features") + f"SELECT CAST(1 AS INTEGER) AS k, {r(' + '.join(f'var_pop({x}) * count(*)' for x in X[1:4]), 'sse')} FROM features")
def _(spark, sf):
    return rounded(ce.elbow(flows.model_frame(spark, sf).features, KEY, X[1:4], 1))


@query("C5_compare_init")
def _(spark, sf):
    return rounded(ce.compare_init(flows.model_frame(spark, sf).std, X, ["random", "k-means||"], K))


@query("C6_pca_kmeans")
def _(spark, sf):
    return ce.pca_kmeans(flows.model_frame(spark, sf).std, KEY, X, 4, K)[0]


# ---- self-organising map -------------------------------------------------------------

SIDE = 20
RADII = [7.0, 2.0]


@query("C7_som_epochs", ctes("std", ms.som("std", X, SIDE, SIDE, RADII)) + f"SELECT unit, {rs(X)} FROM b2")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    book, _ = som.som_fit(std, KEY, X, SIDE, SIDE, start=first_centers(std, X, SIDE * SIDE), radii=RADII)
    return rounded(book.table(spark, "unit"))


@query("C7_som_fit")
def _(spark, sf):
    book, costs = som.som_fit(flows.model_frame(spark, sf).std, KEY, X, SIDE, SIDE)
    return rounded(book.table(spark, "unit").withColumns({"first_cost": F.lit(costs[0]), "last_cost": F.lit(costs[-1])}))


@query("C8_som_assign", ctes("std", ms.first_rows("b0", "std", X, SIDE * SIDE, "unit") + ",\n" + ms.nearest("u0", "std", "b0", X, "unit")) + f"SELECT {KEY}, unit, {r('sq_dist')} FROM u0")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(som.som_assign(std, first_centers(std, X, SIDE * SIDE)).select(KEY, "unit", "sq_dist"))


@query(
    "C9_som_hits",
    ctes("std", ms.som("std", X, SIDE, SIDE, RADII) + ",\n" + ms.nearest("u2", "std", "b2", X, "unit"))
    + f"SELECT CAST(i AS INTEGER) AS unit, CAST(i // {SIDE} AS INTEGER) AS grid_row, CAST(i % {SIDE} AS INTEGER) AS grid_col, count(u2.unit) AS hits "
    f"FROM range({SIDE * SIDE}) t(i) LEFT JOIN u2 ON u2.unit = i GROUP BY i",
)
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    book, _ = som.som_fit(std, KEY, X, SIDE, SIDE, start=first_centers(std, X, SIDE * SIDE), radii=RADII)
    return som.som_hits(som.som_assign(std, book), SIDE, SIDE)


@query("C11_som_segments")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    book, _ = som.som_fit(std, KEY, X, SIDE, SIDE)
    return som.som_segments(std, book, K, KEY)


# ---- k-modes and mixtures ------------------------------------------------------------

CAT = flows.CATEGORICAL
MODE_ROUNDS = 8


def _modes_sql(k: int, rounds: int = MODE_ROUNDS, tag: str = "") -> str:
    return ms.tuples("categories", CAT) + ",\n" + ms.kmodes(CAT, k, rounds, tag)


def _categories(spark, sf):
    return flows.categorical_frame(flows.split_outliers(spark, sf)[0])


@query("C12_cao_seeds", ctes("categories", _modes_sql(3, 0)) + f"SELECT CAST(label AS INTEGER) AS label, {', '.join(CAT)} FROM m_0")
def _(spark, sf):
    cat = _categories(spark, sf)
    return km.modes_table(cat, CAT, km.cao_seeds(km.collapse(cat, CAT, KEY).persist(), CAT, 3))


@query("C12_kmodes", ctes("categories", _modes_sql(3)) + f"SELECT CAST(m.label AS INTEGER) AS label, {', '.join('m.' + x for x in CAT)}, CAST(c.cost AS BIGINT) AS cost FROM m_{MODE_ROUNDS} m CROSS JOIN (SELECT sum(w * d) AS cost FROM t_{MODE_ROUNDS}) c")
def _(spark, sf):
    cat = _categories(spark, sf)
    modes, cost = km.kmodes(cat, KEY, CAT, 3)
    return km.modes_table(cat, CAT, modes).withColumn("cost", F.lit(cost).cast("bigint"))


@query(
    "C12_kmodes_labels",
    ctes("categories", _modes_sql(3))
    + f"SELECT c.{KEY}, CAST(t.label AS INTEGER) AS label, CAST(t.d AS INTEGER) AS mismatches FROM categories c JOIN t_{MODE_ROUNDS} t USING ({', '.join(CAT)})",
)
def _(spark, sf):
    cat = _categories(spark, sf)
    return km.kmodes_labels(cat, KEY, CAT, km.kmodes(cat, KEY, CAT, 3)[0])


@query(
    "C13_kmodes_elbow",
    ctes("categories", ms.tuples("categories", CAT) + ",\n" + ",\n".join(ms.kmodes(CAT, k, MODE_ROUNDS, f"e{k}") for k in range(1, 10)))
    + " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS k, CAST(sum(w * d) AS BIGINT) AS cost FROM te{k}_{MODE_ROUNDS}" for k in range(1, 10)),
)
def _(spark, sf):
    return km.kmodes_elbow(_categories(spark, sf), KEY, CAT, 9)


@query("C14_gmm")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    mix, ll = mi.gmm(std, KEY, X, K)
    rows = [(i, float(w), float(ll)) for i, w in enumerate(mix.weights)]
    weights = small_table(spark, rows, "label int, weight double, mean_log_likelihood double")
    return rounded(ce.Centers.of(X, mix.means).table(spark).join(weights, "label"))


@query("C14_gmm_labels")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return mi.gmm_score(std, mi.gmm(std, KEY, X, K)[0], KEY).select(KEY, "label")


MIX = mi.Mixture(
    tuple(D3),
    np.array([0.6, 0.4]),
    np.array([[-0.3, 0.2, 0.1], [0.8, -0.4, 0.0]]),
    np.array([[[0.8, 0.1, 0.0], [0.1, 0.9, -0.2], [0.0, -0.2, 1.1]], [[1.2, -0.3, 0.2], [-0.3, 0.7, 0.0], [0.2, 0.0, 0.9]]]),
)


def _mix_sql() -> str:
    inv, const = MIX.whitening()
    logs = []
    for j in range(2):
        z = [" + ".join(f"({float(inv[j][i, t])!r}) * ({x} - ({float(MIX.means[j][t])!r}))" for t, x in enumerate(D3[: i + 1])) for i in range(3)]
        logs.append(f"{float(const[j])!r} - 0.5 * ({' + '.join(f'({v}) * ({v})' for v in z)}) AS l{j}")
    return (
        f"SELECT {KEY}, {r('ld', 'log_density')}, {r('exp(l0 - ld)', 'p0')}, {r('exp(l1 - ld)', 'p1')}, CAST(CASE WHEN l0 >= l1 THEN 0 ELSE 1 END AS INTEGER) AS label "
        f"FROM (SELECT *, greatest(l0, l1) + ln(exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) AS ld FROM (SELECT {KEY}, {', '.join(logs)} FROM density))"
    )


@query("C14b_gmm_score", ctes("density") + _mix_sql())
def _(spark, sf):
    return rounded(mi.gmm_score(flows.density_frame(spark, sf), MIX, KEY))


# ---- density -------------------------------------------------------------------------


@query("J5_pairs_within", ctes("density") + f"SELECT x.{KEY} AS key_a, y.{KEY} AS key_b, {r('sqrt(' + ms.sq('x', 'y', D3) + ')', 'distance')} FROM density x JOIN density y ON x.{KEY} < y.{KEY} AND {ms.sq('x', 'y', D3)} <= {EPS} * {EPS}")
def _(spark, sf):
    return rounded(de.pairs_within(flows.density_frame(spark, sf), KEY, D3, EPS))


_DBSCAN = ms.dbscan("density", D3, EPS, MIN_SAMPLES)


@query("C15_dbscan", ctes("density", _DBSCAN) + f"SELECT {KEY}, label FROM labelled")
def _(spark, sf):
    return de.dbscan(flows.density_frame(spark, sf), KEY, D3, EPS, MIN_SAMPLES)


@query(
    "C15_dbscan_profile",
    ctes("density", _DBSCAN) + f"SELECT label, count(*) AS n, {', '.join(r(f'avg({x})', x) for x in D3)} FROM density JOIN labelled USING ({KEY}) WHERE label <> -1 GROUP BY label",
)
def _(spark, sf):
    base = flows.density_frame(spark, sf)
    return rounded(pr.cluster_profile(base, de.dbscan(base, KEY, D3, EPS, MIN_SAMPLES), KEY, D3))


SAMPLE = 3000


@query(
    "C16a_bandwidth",
    ctes("density", f"smp AS (SELECT * FROM density ORDER BY {ms.hashed(KEY, 1)}, {KEY} LIMIT {SAMPLE}), kk AS (SELECT CAST(greatest(1, floor(count(*) * 0.1)) AS BIGINT) AS k, count(*) AS n FROM smp), "
    f"rk AS (SELECT x.{KEY}, {ms.sq('x', 'y', D3)} AS d, row_number() OVER (PARTITION BY x.{KEY} ORDER BY {ms.sq('x', 'y', D3)}) AS rn FROM smp x CROSS JOIN smp y)")
    + f"SELECT {r('avg(sqrt(d))', 'bandwidth')}, count(*) AS n FROM rk JOIN kk ON rk.rn = kk.k",
)
def _(spark, sf):
    return rounded(de.estimate_bandwidth(flows.density_frame(spark, sf), KEY, D3, 0.1, SAMPLE))


def _shift_sql(rounds: int) -> str:
    h = BANDWIDTH
    moved = lambda: " + ".join(f"(avg(p.{x}) - s.{x}) * (avg(p.{x}) - s.{x})" for x in D3)
    parts = [f"g0 AS (SELECT row_number() OVER (ORDER BY {', '.join(D3)}) AS seed, {', '.join(D3)}, false AS still, CAST(0 AS BIGINT) AS n FROM (SELECT DISTINCT {', '.join(f'round_even({x} / {h}, 0) * {h} + 0.0 AS {x}' for x in D3)} FROM density))"]
    for i in range(rounds):
        parts.append(
            f"g{i + 1} AS (SELECT s.seed, {', '.join(f'avg(p.{x}) AS {x}' for x in D3)}, sqrt({moved()}) < {1e-3 * h} AS still, count(*) AS n FROM g{i} s JOIN density p ON {ms.sq('p', 's', D3)} <= {h} * {h} "
            f"WHERE NOT s.still GROUP BY s.seed, {', '.join('s.' + x for x in D3)} UNION ALL SELECT * FROM g{i} WHERE still)"
        )
    return ",\n".join(parts)


@query("C16b_mean_shift_rounds", ctes("density", _shift_sql(2)) + f"SELECT {rs(D3)}, n FROM g2")
def _(spark, sf):
    return rounded(de.mean_shift_seeds(flows.density_frame(spark, sf), KEY, D3, BANDWIDTH, max_rounds=2).select(*D3, "n"))


@query("C16b_mean_shift")
def _(spark, sf):
    return de.mean_shift(flows.density_frame(spark, sf), KEY, D3, BANDWIDTH)[0]


# ---- hierarchies ---------------------------------------------------------------------


def _linkage(name):
    def run(spark, sf):
        return hi.hierarchy(flows.model_frame(spark, sf).std, KEY, X, name, [4, 5], micro=None)

    return run


for _name in hi.LINKAGES:
    query(f"C16c_hierarchy_{_name}")(_linkage(_name))


@query("C16d_bisecting")
def _(spark, sf):
    return bi.bisecting(flows.model_frame(spark, sf).std, KEY, X, K)


# ---- profiles ------------------------------------------------------------------------


@query("J3_attach_labels", ctes("std", _FIXED) + f"SELECT {KEY}, {rs(X)}, label FROM fixed")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(c.attach_labels(std, fixed_labels(std), KEY))


@query("A26_label_counts", ctes("std", ms.lloyd("std", X, K, 0)) + "SELECT label, count(*) AS n FROM a0 GROUP BY label")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return pr.label_counts(ce.assign_nearest(std, first_centers(std, X, K)))


@query("A27_n_clusters", ctes("std", _FIXED) + "SELECT count(DISTINCT label) AS n_clusters FROM fixed WHERE label <> -1")
def _(spark, sf):
    return pr.n_clusters(fixed_labels(flows.model_frame(spark, sf).std))


@query("C17_cluster_profile", ctes("std", _FIXED) + f"SELECT label, {', '.join(r(f'avg(f.{x})', x) for x in X)}, count(*) AS n FROM features f JOIN (SELECT {KEY}, label FROM fixed) USING ({KEY}) WHERE label <> -1 GROUP BY label")
def _(spark, sf):
    m = flows.model_frame(spark, sf)
    return rounded(pr.cluster_profile(m.std, fixed_labels(m.std), KEY, X, m.scaler))


@query(
    "C18_profile_long",
    ctes("std", _FIXED) + " UNION ALL ".join(f"SELECT label, '{x}' AS variable, {r(f'avg({x})', 'mean')}, count({x}) AS n, {r(f'stddev_samp({x}) / sqrt(count({x}))', 'stderr')} FROM fixed GROUP BY label" for x in X),
)
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(pr.cluster_profile_long(std, fixed_labels(std), KEY, X))


@query("P17_tidy", ctes("std", _FIXED) + " UNION ALL ".join(f"SELECT {KEY}, label, '{x}' AS variable, {r(x, 'value')} FROM fixed" for x in X))
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(pr.tidy(std, fixed_labels(std), KEY, X))


@query("C19_projection")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(pr.cluster_projection(std, fixed_labels(std), KEY, X, 3))


@query("C19_projection_preview")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(pr.cluster_projection(std, fixed_labels(std), KEY, X, 3, limit=250))


# ---- evaluation ----------------------------------------------------------------------


def _near_labels(std):
    return ce.assign_nearest(std, first_centers(std, X, K)).select(KEY, "label")


_SIL = ms.lloyd("std", X, K, 0) + ",\n" + ms.silhouette("a0", X)


@query("V1_silhouette_samples", ctes("std", _SIL) + f"SELECT {KEY}, label, {r('silhouette')} FROM sil")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(ev.silhouette_samples(std, _near_labels(std), KEY, X))


@query("V1_silhouette_embeddings", f"WITH {ms.silhouette('embeddings', [], key='vec_id', dist=_EDIST)} SELECT vec_id, label, {r('silhouette')} FROM sil")
def _(spark, sf):
    vec = vectors(spark, sf)
    return rounded(ev.silhouette_samples(vec.drop("label"), vec.select("vec_id", "label"), "vec_id", E64))


@query("W2_silhouette_ranked", ctes("std", _SIL) + f"SELECT {KEY}, label, {r('silhouette')}, row_number() OVER (PARTITION BY label ORDER BY silhouette, {KEY}) AS position FROM sil")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(ev.silhouette_samples(std, _near_labels(std), KEY, X, ranked=True))


@query("V2_silhouette_score", ctes("std", _SIL) + f"SELECT {r('avg(silhouette)', 'silhouette')} FROM sil")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(ev.silhouette_score(std, _near_labels(std), KEY, X))


@query("V2_silhouette_bounds")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(ev.silhouette_bounds(std, _near_labels(std), KEY, X))


@query("V3_silhouette_fast", ctes("std", ms.lloyd("std", X, K, 0) + ",\n" + ms.silhouette("a0", X, squared=True)) + f"SELECT {r('avg(silhouette)', 'silhouette')} FROM sil")
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(ev.silhouette_fast(std, _near_labels(std), KEY, X))


@query("V4_silhouette_by_k")
def _(spark, sf):
    return rounded(ev.silhouette_by_k(flows.model_frame(spark, sf).std, KEY, X, 4, 5))


_THREE_LABELINGS = _FIXED + ",\n" + ms.lloyd("std", X, K, 1) + ",\n" + ms.silhouette("a0", X, "0") + ",\n" + ms.silhouette("a1", X, "1") + ",\n" + ms.silhouette("fixed", X, "f")


def _three_labelings(std):
    start = first_centers(std, X, K)
    moved = ce.assign_nearest(std, ce.lloyd_rounds(std, start, 1)).select(KEY, "label")
    return {"first": _near_labels(std), "moved": moved, "by_key": fixed_labels(std)}


def _scores(columns: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS method, {columns} FROM {t}" for n, t in (("first", "sil0"), ("moved", "sil1"), ("by_key", "silf")))


@query(
    "V5_compare_methods",
    ctes("std", _THREE_LABELINGS) + _scores(f"count(DISTINCT CASE WHEN label <> -1 THEN label END) AS n_clusters, {r('avg(silhouette)', 'silhouette')}"),
)
def _(spark, sf):
    std = flows.model_frame(spark, sf).std
    return rounded(ev.compare_methods(std, _three_labelings(std), KEY, X))


@query(
    "V5_compare_within",
    ctes("std", _THREE_LABELINGS)
    + _scores(f"count(DISTINCT CASE WHEN label <> -1 THEN label END) AS n_clusters, {r('avg(silhouette)', 'silhouette')}, true AS bracketed, true AS narrow"),
)
def _(spark, sf):
    """The exact means beside bounds found without them, at most 0.05 apart."""
    std = flows.model_frame(spark, sf).std
    labelings = _three_labelings(std)
    bounds = ev.compare_within(std, labelings, KEY, X, 0.05).select("method", "n_clusters", "lower", "upper")
    both = ev.compare_methods(std, labelings, KEY, X).drop("n_clusters").join(bounds, "method")
    held = F.col("silhouette").between(F.col("lower") - 1e-9, F.col("upper") + 1e-9)
    return rounded(both.select("method", "n_clusters", "silhouette", held.alias("bracketed"), (F.col("upper") - F.col("lower") <= 0.05).alias("narrow")))


_PRED = ms.lloyd("std", X, K, 2) + f",\npred AS (SELECT a2.{KEY}, a0.label, a2.label AS prediction FROM a0 JOIN a2 USING ({KEY}))"


def _predictions(spark, sf):
    """Two assignments of the same rows stand in for truth and prediction."""
    std = flows.model_frame(spark, sf).std
    start = first_centers(std, X, K)
    both = ce.assign_nearest(std, start).drop("sq_dist")
    return ce.assign_nearest(both, ce.lloyd_rounds(std, start, 2), "prediction").select(KEY, "label", "prediction")


@query(
    "D4_confusion_matrix",
    ctes("std", _PRED) + "SELECT label AS actual, " + ", ".join(f"count(*) FILTER (WHERE prediction = {i}) AS p{i}" for i in range(K)) + " FROM pred GROUP BY label",
)
def _(spark, sf):
    return ev.confusion_matrix(_predictions(spark, sf))


@query("D5_accuracy", ctes("std", _PRED) + f"SELECT {r('avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)', 'accuracy')} FROM pred")
def _(spark, sf):
    return rounded(ev.accuracy(_predictions(spark, sf)))


REPORT_CTES = (
    "ids AS (SELECT DISTINCT label AS c FROM pred UNION SELECT DISTINCT prediction FROM pred),\n"
    "cnt AS (SELECT c, (SELECT count(*) FROM pred WHERE label = c) AS support, (SELECT count(*) FROM pred WHERE prediction = c) AS guessed, (SELECT count(*) FROM pred WHERE label = c AND prediction = c) AS hit FROM ids),\n"
    "prf AS (SELECT c, support, hit, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS recall FROM cnt),\n"
    "rep AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM prf)"
)
REPORT = (
    f"SELECT CAST(c AS VARCHAR) AS label, {rs(['precision', 'recall', 'f1'])}, support FROM rep"
    f" UNION ALL SELECT 'macro avg', {', '.join(r(f'avg({m})', m) for m in ('precision', 'recall', 'f1'))}, CAST(sum(support) AS BIGINT) FROM rep"
    f" UNION ALL SELECT 'weighted avg', {', '.join(r(f'sum({m} * support) / sum(support)', m) for m in ('precision', 'recall', 'f1'))}, CAST(sum(support) AS BIGINT) FROM rep"
    f" UNION ALL SELECT 'accuracy', {', '.join(r('sum(hit) / sum(support)', m) for m in ('precision', 'recall', 'f1'))}, CAST(sum(support) AS BIGINT) FROM rep"
)


@query("D6_classification_report", ctes("std", f"{_PRED},\n{REPORT_CTES}") + REPORT)
def _(spark, sf):
    return rounded(ev.classification_report(_predictions(spark, sf)))


# ---- trees ---------------------------------------------------------------------------


@query("D1_split_by_key", ctes("features") + f"SELECT {KEY}, {ms.hashed(KEY, 1)} < {int(0.7 * ms.HASH_PRIME)} AS in_train FROM features")
def _(spark, sf):
    train, test = tree.split_by_key(flows.model_frame(spark, sf).features.select(KEY), KEY, 0.7, 1)
    return c.stack(train.withColumn("in_train", F.lit(True)), test.withColumn("in_train", F.lit(False)))


@query("D2_fit_tree")
def _(spark, sf):
    """Depth, nodes and training size of the tree on the k-means labels."""
    s = flows.segment(spark, sf)
    model, train, _ = flows.explain(s)
    return small_table(spark, [(model.depth, model.size, train.count())], "depth int, nodes int, train_rows bigint")


@query("D3_predict")
def _(spark, sf):
    s = flows.segment(spark, sf)
    model, _, test = flows.explain(s)
    return tree.predict(model, test).select(KEY, "label", "prediction")


@query("D7_label_outliers")
def _(spark, sf):
    s = flows.segment(spark, sf)
    return rounded(flows.extend(s, flows.explain(s)[0]))


@query("D7_profile_with_outliers")
def _(spark, sf):
    s = flows.segment(spark, sf)
    whole = flows.extend(s, flows.explain(s)[0])
    return rounded(pr.cluster_profile(whole.drop("label", "outlier"), whole.select(KEY, "label"), KEY, X))


@query("D8_tree_leaf_profile")
def _(spark, sf):
    s = flows.segment(spark, sf)
    model, train, _ = flows.explain(s)
    return rounded(tree.tree_leaf_profile(model, train))


# ---- flows ---------------------------------------------------------------------------


@query("E4_segment_profile")
def _(spark, sf):
    s = flows.segment(spark, sf)
    return rounded(pr.cluster_profile(s.frame.std, s.labels, KEY, X, s.frame.scaler))


@query("E4_scoreboard")
def _(spark, sf):
    """Silhouette of every clustering of the model frame, in one pass over the distances."""
    return rounded(flows.scoreboard(spark, sf))


@query("E5_explain_and_extend")
def _(spark, sf):
    """The tree on the segments: its report, matrix and leaves, and the segments with the outliers it places."""
    return rounded(flows.explain_and_extend(flows.segment(spark, sf)))
