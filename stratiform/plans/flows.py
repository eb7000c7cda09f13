"""End-to-end flows: clean and validate, derive value features, split outliers, prepare
the model frame, segment, explain and extend."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators import columns as c
from stratiform.operators import quality as q
from stratiform.operators.centers import assign_nearest, kmeans, pca_kmeans, spread
from stratiform.operators import describe as d
from stratiform.operators.density import estimate_bandwidth, mean_shift
from stratiform.operators.density_blocks import dbscan_blocks
from stratiform.operators.evaluate import classification_report, compare_methods, compare_within, confusion_matrix
from stratiform.operators.hierarchy import hierarchy
from stratiform.operators.mixture import gmm, gmm_score
from stratiform.operators import profile as pr
from stratiform.operators.scale import Scaler, scaler_apply, scaler_fit
from stratiform.operators.tree import fit_tree, label_outliers, predict, split_by_key, tree_leaf_profile
from stratiform.sources.mart import KEY, PREMIUMS, customer_orders, engage, lob

AS_OF_YEAR = 2025
FENCE_LO, FENCE_HI = 0.01, 0.99
BAD_POLICY_YEARS = (2001,)
BAD_BIRTH_YEARS = (1950,)

# Bin edges and labels of the categorical views.
SALARY_EDGES = [0, 1000, 2000, 3000, 4000, 5000, 6000]
SALARY_LABELS = ["0-1k", "1k-2k", "2k-3k", "3k-4k", "4k-5k", "5k-6k"]
TENURE_EDGES = [20, 25, 30, 35, 40, 45, 50]
TENURE_LABELS = ["20-25", "25-30", "30-35", "35-40", "40-45", "45-50"]
CLAIM_EDGES = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, 1.1, 1.2, 1.3, 1.4, 1.5]
CLAIM_LABELS = ["0-10%", "10-20%", "20-30%", "30-40%", "40-50%", "50-60%", "60-70%", "70-80%", "80-90%", "90-100%", "100-110%", "110-120%", "120-130%", "130-140%", "140-150%"]

TYPES = {
    "policy_creation_year": "int",
    "birth_year": "int",
    "gross_monthly_salary": "double",
    "geographic_area": "string",
    "has_children": "int",
    "customer_monetary_value": "double",
    "claims_rate": "double",
    **{p: "double" for p in PREMIUMS},
    "edu_desc": "string",
}
CATEGORIES = ["geographic_area", "has_children", "edu_desc"]
NUMBERS = [
    "policy_creation_year",
    "gross_monthly_salary",
    "customer_monetary_value",
    "claims_rate",
    *PREMIUMS,
    "active_premiums",
    "cancelled_premiums_pct",
    "cust_tenure",
    "total_premiums",
    "amt_paidby_comp",
    "cust_acq_cost",
    "premium_wage_ratio",
]
SHARES = [f"{p}_pct" for p in PREMIUMS]
VALUES = ["cancelled_premiums_pct", "claims_rate", "customer_monetary_value", "premium_wage_ratio"]
FEATURES = ["customer_monetary_value", "claims_rate", "cancelled_premiums_pct", "premium_wage_ratio", *SHARES]


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both customer tables side by side. They share one kept pass over orders and lines;
    pruned separately they would read and join the lines twice."""
    per = customer_orders(spark, sf_dir).persist()
    return c.left_join(engage(spark, sf_dir, per), lob(spark, sf_dir, per), KEY)


def filled(df: DataFrame) -> DataFrame:
    """Education split into its text part, missing premiums read as "no such policy"."""
    out = c.split_column(df, "education_lvl", "-", ["edu_code", "edu_desc"])
    return c.fill_null(c.drop_cols(out, ["education_lvl", "edu_code"]), PREMIUMS, 0.0)


def validation_rules(max_year: int = 2016) -> dict:
    return {
        "policy_year_after_limit": q.rule_max("policy_creation_year", max_year),
        "birth_year_after_limit": q.rule_max("birth_year", max_year),
        "children_not_binary": q.rule_in_set("has_children", [0, 1]),
        "policy_before_age_18": q.rule_min_gap("policy_creation_year", "birth_year", 18),
    }


def cleaned(
    df: DataFrame,
    bad_policy_years: Sequence[int] = BAD_POLICY_YEARS,
    bad_birth_years: Sequence[int] = BAD_BIRTH_YEARS,
) -> DataFrame:
    """Complete rows only, typed, bad literals removed, children recoded, birth year dropped."""
    out = c.cast_schema(q.drop_null_rows(filled(df)), TYPES)
    out = q.drop_values(out, "policy_creation_year", bad_policy_years)
    out = q.drop_values(out, "birth_year", bad_birth_years)
    return c.drop_cols(c.recode(out, "has_children", {1: "Yes", 0: "No"}), ["birth_year"])


def valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean customers with every derived value column."""
    return c.value_features(cleaned(combined(spark, sf_dir)), PREMIUMS, AS_OF_YEAR)


def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(section, name, value)`` of the frame that ``cleaned`` starts from: percent missing
    per column, rows before and after dropping incomplete ones, rows sharing their key, and
    violations per rule."""
    base = filled(combined(spark, sf_dir)).persist()
    tell = lambda df, section, name, value: df.select(F.lit(section).alias("section"), F.col(name).alias("name"), F.col(value).cast("double").alias("value"))
    lost = q.dropna_impact(base).unpivot([], ["before", "after"], "name", "value")
    same = q.duplicate_rows(base, KEY).select(F.lit("duplicate_keys").alias("name"), F.col("duplicate_rows").alias("value"))
    return (
        tell(q.null_profile(base), "missing", "column", "pct_null")
        .unionByName(tell(lost, "rows", "name", "value"))
        .unionByName(tell(same, "rows", "name", "value"))
        .unionByName(tell(q.validate(base, validation_rules()), "rule", "rule", "violations"))
    )


SALARY_GRID = list(range(0, 7000, 500))
PACK_BINS = 20
RELATED = [("claims_rate", "customer_monetary_value"), ("gross_monthly_salary", "total_premiums"), ("cust_tenure", "total_premiums")]


def descriptive_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(section, name, item, value)``: the descriptive views of the customers inside the
    fences in one long table: counts, totals, positives and reversals, binned counts and sums, a
    cross table, densities, histograms, a joint histogram, box tables with their quantiles, and
    correlations. The frame is kept once; every section is an aggregate of it."""
    inside = split_outliers(spark, sf_dir)[0].persist()

    def tell(df, section, name, item, value):
        return df.select(F.lit(section).alias("section"), (F.lit(name) if isinstance(name, str) else name).alias("name"), item.cast("string").alias("item"), value.cast("double").alias("value"))

    parts = [tell(d.category_share(inside, x), "count", x, F.col(x), F.col("n")) for x in CATEGORIES]
    parts.append(tell(d.sum_by_measure(inside, PREMIUMS), "premium_total", "all", F.col("variable"), F.col("total")))
    positive = inside.agg(*[F.count_if(F.col(x) > 0).alias(x) for x in PREMIUMS]).unpivot([], PREMIUMS, "variable", "n")
    parts.append(tell(positive, "positive_policies", "all", F.col("variable"), F.col("n")))
    parts.append(tell(d.reversal_counts(inside, PREMIUMS).filter(F.col("variable").isin(*PREMIUMS)), "reversals", "all", F.col("variable"), F.col("n")))
    for col, edges, labels in (("claims_rate", CLAIM_EDGES, CLAIM_LABELS), ("gross_monthly_salary", SALARY_EDGES, SALARY_LABELS), ("cust_tenure", TENURE_EDGES, TENURE_LABELS)):
        binned = c.cut(inside, col, edges, labels, "bin").filter(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
        parts.append(tell(binned, "binned", col, F.col("bin"), F.col("n")))
    one = inside.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(RELATED)])
    parts += [tell(one, "correlation", a, F.lit(b), F.col(f"c{i}")) for i, (a, b) in enumerate(RELATED)]
    parts.append(tell(d.correlation(inside, NUMBERS).filter(F.col("r").isNotNull()), "correlation_matrix", F.col("a"), F.col("b"), F.col("r")))
    spent = d.sum_by_bin(inside, "claims_rate", CLAIM_EDGES, CLAIM_LABELS, PREMIUMS).unpivot(["bin"], PREMIUMS, "variable", "total")
    parts.append(tell(spent, "premium_by_claims", F.col("variable"), F.col("bin"), F.col("total")))
    binned = c.cut(inside, "gross_monthly_salary", SALARY_EDGES, SALARY_LABELS, "salary_bin").filter(F.col("salary_bin").isNotNull())
    parts.append(tell(d.count_by(binned, ["salary_bin", "geographic_area"]), "salary_by_area", F.col("salary_bin"), F.col("geographic_area"), F.col("n")))
    parts.append(tell(d.kde(inside, "gross_monthly_salary", SALARY_GRID, by="edu_desc"), "salary_density_per_million", F.col("edu_desc"), F.col("position"), F.col("density") * 1e6))
    parts.append(tell(d.histogram(inside, NUMBERS, PACK_BINS), "histogram", F.col("column"), F.col("bin"), F.col("n")))
    x, y = JOINT
    parts.append(tell(d.joint_histogram(inside, x, y, PACK_BINS), "joint_histogram", F.lit(f"{x}, {y}"), F.concat_ws(",", "x_bin", "y_bin"), F.col("n")))
    boxes = d.box_stats(inside, NUMBERS, FENCE_LO, FENCE_HI).withColumn("n_outside", F.col("n_outside").cast("double"))
    parts.append(tell(boxes.unpivot(["column"], [*BOX, "n_outside"], "variable", "value"), "box", F.col("column"), F.col("variable"), F.col("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


JOINT = ("cust_acq_cost", "customer_monetary_value")
BOX = ["whisker_lo", "q1", "median", "q3", "whisker_hi"]


@dataclass(frozen=True)
class ModelFrame:
    """What every clustering starts from. ``std`` is cached, dealt by key, so labels made
    from it join back without a shuffle."""

    inside: DataFrame
    outside: DataFrame
    features: DataFrame
    scaler: Scaler
    std: DataFrame


def split_outliers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers inside and outside the quantile fences. The valued table is kept, as
    the fence pass and both halves read it."""
    base = valued(spark, sf_dir).persist()
    return q.quantile_fence(base, NUMBERS, FENCE_LO, FENCE_HI)


def model_frame(spark: SparkSession, sf_dir: str) -> ModelFrame:
    inside, outside = split_outliers(spark, sf_dir)
    features = q.drop_null_rows(c.model_features(inside, KEY, PREMIUMS))
    scaler = scaler_fit(features, FEATURES)
    std = spread(scaler_apply(features, scaler), KEY).persist()
    return ModelFrame(inside, outside, features, scaler, std)


def categorical_frame(inside: DataFrame) -> DataFrame:
    """String view of the inside customers: three categories plus binned salary and tenure."""
    out = c.cut(inside, "gross_monthly_salary", SALARY_EDGES, SALARY_LABELS, "salary_bin", missing="nan")
    out = c.cut(out, "cust_tenure", TENURE_EDGES, TENURE_LABELS, "tenure_bin", missing="nan")
    return out.select(KEY, *CATEGORIES, "salary_bin", "tenure_bin")


CATEGORICAL = [*CATEGORIES, "salary_bin", "tenure_bin"]


def density_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three z-scored columns with visible density structure: sales, returned share, balance."""
    per = customer_orders(spark, sf_dir).persist()
    e = engage(spark, sf_dir, per)
    sales = per.select(F.col("o_custkey").alias(KEY), (F.col("gross") / F.lit(10000.0)).alias("gross_sales"))
    base = e.join(sales, KEY).select(
        KEY, "gross_sales", F.col("claims_rate").alias("returned_share"), F.col("gross_monthly_salary").alias("balance")
    ).dropna().persist()
    return spread(scaler_apply(base, scaler_fit(base, DENSITY)), KEY).persist()


DENSITY = ["gross_sales", "returned_share", "balance"]


# ---- segmentation ----------------------------------------------------------------------


@dataclass(frozen=True)
class Segments:
    frame: ModelFrame
    labels: DataFrame


def segment(spark: SparkSession, sf_dir: str, k: int = 5) -> Segments:
    """k-means labels of the model frame."""
    m = model_frame(spark, sf_dir)
    centers, _ = kmeans(m.std, KEY, FEATURES, k)
    return Segments(m, assign_nearest(m.std, centers).select(KEY, "label"))


def explain(s: Segments, frac: float = 0.7, seed: int = 1):
    """Tree on the unscaled features of the training side: ``(model, train, test)``."""
    train, test = split_by_key(c.attach_labels(s.frame.features, s.labels, KEY), KEY, frac, seed)
    return fit_tree(train, FEATURES), train, test


def extend(s: Segments, model) -> DataFrame:
    """Inside rows with their label and outliers with a predicted one."""
    outside = c.model_features(s.frame.outside, KEY, PREMIUMS)
    return label_outliers(s.frame.features, s.labels, outside, model, KEY, FEATURES)


def explain_and_extend(s: Segments) -> DataFrame:
    """Everything the tree tells, one ``section`` after the other; what a section has no value
    for is NULL.

    * ``report``: precision, recall, f1 and support on the rows held out, averages and accuracy.
    * ``confusion``: held out rows ``n`` per label and prediction, zeros kept.
    * ``leaf``: training rows ``n``, majority (as ``label``) and purity of each leaf.
    * ``profile``: size and means of each segment in original units, placed outliers included.
    * ``inside``, ``with_outliers``: mean, n and standard error of each scaled variable per
      segment, without and with the placed outliers.
    """
    model, train, test = explain(s)
    pred = predict(model, test).select("label", "prediction").persist()
    whole = extend(s, model).persist()
    matrix = confusion_matrix(pred)
    guesses = [F.struct(F.lit(int(p[1:])).alias("prediction"), F.col(p).alias("n")) for p in matrix.columns[1:]]
    parts = {
        "report": classification_report(pred),
        **({"confusion": matrix.select(F.col("actual").alias("label"), F.inline(F.array(*guesses)))} if guesses else {}),
        "leaf": tree_leaf_profile(model, train).withColumnRenamed("majority", "label"),
        "profile": pr.cluster_profile(whole.drop("label", "outlier"), whole.select(KEY, "label"), KEY, FEATURES),
    }
    compared = pr.outlier_comparison(whole.filter("not outlier"), whole, KEY, FEATURES, s.frame.scaler).withColumnRenamed("rows", "section")
    sections = [*[p.withColumn("section", F.lit(name)) for name, p in parts.items()], compared]
    out = c.stack(*[p.withColumn("label", F.col("label").cast("string")) for p in sections])
    return out.select("section", *[x for x in out.columns if x != "section"])


def scoreboard(spark: SparkSession, sf_dir: str, k: int = 5, eps: float = 0.9, min_samples: int = 50, within: float | None = None) -> DataFrame:
    """Score of k-means, component k-means, mixture, density, mean shift and ward labels: exact,
    or with ``within`` the middle of bounds that are at most so far apart."""
    m = model_frame(spark, sf_dir)
    std = m.std
    centers, _ = kmeans(std, KEY, FEATURES, k)
    mix, _ = gmm(std, KEY, FEATURES, k)
    width = estimate_bandwidth(std, KEY, FEATURES, 0.1, 3000).first()["bandwidth"]
    ward = hierarchy(std, KEY, FEATURES, "ward", [k], micro=None)
    labelings = {
        "kmeans": assign_nearest(std, centers).select(KEY, "label"),
        "pca_kmeans": pca_kmeans(std, KEY, FEATURES, 4, k)[0],
        "dbscan": dbscan_blocks(std, KEY, FEATURES, eps, min_samples),
        "mean_shift": mean_shift(std, KEY, FEATURES, width)[0],
        "gaussian_mixture": gmm_score(std, mix, KEY).select(KEY, "label"),
        "hierarchy_ward": ward.withColumnRenamed(f"label_k{k}", "label"),
    }
    if within is None:
        return compare_methods(std, labelings, KEY, FEATURES)
    return compare_within(std, labelings, KEY, FEATURES, within).drop("lower", "upper")
