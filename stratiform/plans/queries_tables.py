"""Registered queries: sources, columns, filters, joins, aggregates, windows, sets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators import columns as c
from stratiform.operators import describe as d
from stratiform.operators import quality as q
from stratiform.plans import flows
from stratiform.plans.registry import ctes, query, r, rounded, rs, sql_bin
from stratiform.session import ensure_checkpoint_dir
from stratiform.sources import io
from stratiform.sources.mart import KEY, PREMIUMS, engage, lob

P = PREMIUMS
NUM = flows.NUMBERS
ENGAGE = ["policy_creation_year", "birth_year", "education_lvl", "gross_monthly_salary", "geographic_area", "has_children", "customer_monetary_value", "claims_rate"]
COMBINED = [KEY, *ENGAGE, *P]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def scratch_path(spark, name: str) -> str:
    """A fresh folder beside the checkpoints, which every executor can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


# ---- sources and sinks -------------------------------------------------------------


@query("IO1_read_table", "SELECT * FROM customer")
def _(spark, sf):
    return io.read_table(spark, sf, "customer")


CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


@query("IO2_read_csv", "SELECT * FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "customer")
    io.write_csv(io.read_table(spark, sf, "customer"), path)
    return io.read_csv(spark, path, CUSTOMER)


@query(
    "IO3_describe_sources",
    'SELECT table_name AS "table", CAST(ordinal_position AS INTEGER) AS position, column_name AS "column", '
    "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
    "WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS type "
    "FROM (SELECT table_name, column_name, data_type, row_number() OVER (PARTITION BY table_name ORDER BY column_index) AS ordinal_position "
    f"FROM duckdb_columns() WHERE table_name IN {tuple(TABLES)})",
)
def _(spark, sf):
    return io.describe_sources(spark, {t: io.read_table(spark, sf, t) for t in TABLES})


@query("IO4_write_csv", ctes("valued") + f"SELECT {KEY}, active_premiums, {rs(['total_premiums', 'cust_acq_cost'])} FROM valued")
def _(spark, sf):
    path = scratch_path(spark, "valued")
    out = flows.valued(spark, sf).select(KEY, "active_premiums", "total_premiums", "cust_acq_cost")
    io.write_csv(out, path)
    return rounded(io.read_csv(spark, path, out.schema))


@query("IO5_shape", ctes("combined") + f"SELECT count(*) AS n_rows, CAST({len(COMBINED)} AS INTEGER) AS n_cols FROM combined")
def _(spark, sf):
    return io.shape(flows.combined(spark, sf))


@query("IO7_head", ctes("combined") + f"SELECT {', '.join(COMBINED)} FROM combined ORDER BY {KEY} LIMIT 5")
def _(spark, sf):
    return io.head(flows.combined(spark, sf), 5, KEY)


# ---- projections -------------------------------------------------------------------

_NAMES = [f"col_{i:02d}" for i in range(len(COMBINED))]


@query("P1_rename_all", ctes("combined") + f"SELECT {', '.join(f'{a} AS {b}' for a, b in zip(COMBINED, _NAMES))} FROM combined")
def _(spark, sf):
    return c.rename_all(flows.combined(spark, sf), _NAMES)


@query("P2_drop_cols", ctes("combined") + "SELECT * EXCLUDE (education_lvl, birth_year) FROM combined")
def _(spark, sf):
    return c.drop_cols(flows.combined(spark, sf), ["education_lvl", "birth_year"])


@query(
    "P3_split_column",
    ctes("combined") + f"SELECT {KEY}, education_lvl, split_part(education_lvl, '-', 1) AS edu_code, "
    "nullif(split_part(education_lvl, '-', 2), '') AS edu_desc FROM combined",
)
def _(spark, sf):
    return c.split_column(engage(spark, sf).select(KEY, "education_lvl"), "education_lvl", "-", ["edu_code", "edu_desc"])


@query(
    "P4_cast_schema",
    ctes("combined") + f"SELECT {KEY}, CAST(geographic_area AS VARCHAR) AS geographic_area, CAST(has_children AS BIGINT) AS has_children, "
    "CAST(trunc(gross_monthly_salary) AS BIGINT) AS gross_monthly_salary, TRY_CAST(education_lvl AS INTEGER) AS education_lvl FROM combined",
)
def _(spark, sf):
    base = engage(spark, sf).select(KEY, "geographic_area", "has_children", "gross_monthly_salary", "education_lvl")
    return c.cast_schema(
        base, {"geographic_area": "string", "has_children": "bigint", "gross_monthly_salary": "bigint", "education_lvl": "int"}
    )


@query(
    "P5_recode",
    ctes("combined") + f"SELECT {KEY}, CASE education_lvl WHEN '1-URGENT' THEN 'first' WHEN '2-HIGH' THEN 'second' END AS education_lvl FROM combined",
)
def _(spark, sf):
    return c.recode(engage(spark, sf).select(KEY, "education_lvl"), "education_lvl", {"1-URGENT": "first", "2-HIGH": "second"})


@query("P6_fill_null", ctes("combined") + f"SELECT {KEY}, {', '.join(f'coalesce({p}, 0.0) AS {p}' for p in P)} FROM combined")
def _(spark, sf):
    return c.fill_null(flows.combined(spark, sf).select(KEY, *P), P, 0.0)


@query("P7_count_across", ctes("valued") + f"SELECT {KEY}, active_premiums FROM valued")
def _(spark, sf):
    return c.count_across(flows.cleaned(flows.combined(spark, sf)), P, lambda x: x > 0, "active_premiums").select(KEY, "active_premiums")


@query("P8_share_across", ctes("valued") + f"SELECT {KEY}, {r('cancelled_premiums_pct')} FROM valued")
def _(spark, sf):
    base = flows.cleaned(flows.combined(spark, sf))
    out = c.share_across(base, P, lambda x: x < 0, lambda x: x != 0, "cancelled_premiums_pct")
    return rounded(out.select(KEY, "cancelled_premiums_pct"))


@query("P9_tenure", ctes("combined") + f"SELECT {KEY}, {flows.AS_OF_YEAR} - policy_creation_year AS cust_tenure FROM combined")
def _(spark, sf):
    return c.tenure(engage(spark, sf), "policy_creation_year", flows.AS_OF_YEAR).select(KEY, "cust_tenure")


@query("P10_row_total", ctes("combined") + f"SELECT {KEY}, {r(' + '.join(P), 'total_premiums')} FROM combined")
def _(spark, sf):
    return rounded(c.row_total(flows.combined(spark, sf), P, "total_premiums").select(KEY, "total_premiums"))


def _value_column(name):
    def run(spark, sf):
        return rounded(flows.valued(spark, sf).select(KEY, name))

    return run


for _id, _name in (("P11_paid_amount", "amt_paidby_comp"), ("P12_acquisition_cost", "cust_acq_cost"), ("P13_wage_ratio", "premium_wage_ratio")):
    query(_id, ctes("valued") + f"SELECT {KEY}, {r(_name)} FROM valued")(_value_column(_name))


@query(
    "P14_shares_of_total",
    ctes("valued") + f"SELECT {KEY}, {', '.join(r(f'CASE WHEN total_premiums <> 0 THEN {p} / total_premiums END', p + '_pct') for p in P)} FROM valued",
)
def _(spark, sf):
    return rounded(c.shares_of_total(flows.valued(spark, sf), P, "total_premiums").select(KEY, *flows.SHARES))


@query("P15_split_by_type_text", ctes("valued") + f"SELECT {KEY}, {', '.join(flows.CATEGORIES)} FROM valued")
def _(spark, sf):
    return c.split_by_type(flows.valued(spark, sf), KEY)[0]


@query("P15_split_by_type_numeric", ctes("valued") + f"SELECT {KEY}, policy_creation_year, active_premiums, cust_tenure, {rs([n for n in NUM if n not in ('policy_creation_year', 'active_premiums', 'cust_tenure')])} FROM valued")
def _(spark, sf):
    return rounded(c.split_by_type(flows.valued(spark, sf), KEY)[1])


@query("P16_feature_view_product", ctes("features") + f"SELECT {KEY}, {rs(flows.SHARES)} FROM features")
def _(spark, sf):
    return rounded(c.feature_view(flows.model_frame(spark, sf).features, flows.SHARES, KEY))


@query("P16_feature_view_value", ctes("features") + f"SELECT {KEY}, {rs(flows.VALUES)} FROM features")
def _(spark, sf):
    return rounded(c.feature_view(flows.model_frame(spark, sf).features, flows.VALUES, KEY))


_MELT = " UNION ALL ".join(f"SELECT {KEY}, '{p}' AS variable, {p} AS value FROM combined" for p in P)


@query("P17_melt", ctes("combined") + f"SELECT {KEY}, variable, {r('value')} FROM ({_MELT}) WHERE value IS NOT NULL OR value IS NULL")
def _(spark, sf):
    return rounded(c.melt(flows.combined(spark, sf), [KEY], P))


@query("P19_model_features", ctes("flagged") + f"SELECT {KEY}, is_out, {rs(flows.FEATURES[:4])}, " + ", ".join(r(f"CASE WHEN total_premiums <> 0 THEN {p} / total_premiums END", f"{p}_pct") for p in P) + " FROM flagged")
def _(spark, sf):
    inside, outside = flows.split_outliers(spark, sf)
    halves = [c.model_features(h, KEY, P).withColumn("is_out", F.lit(o)) for h, o in ((inside, False), (outside, True))]
    return rounded(c.stack(*halves))


# ---- filters -----------------------------------------------------------------------


@query("F1_drop_values", ctes("combined") + f"SELECT {KEY}, policy_creation_year FROM combined WHERE policy_creation_year IS NULL OR policy_creation_year NOT IN (1996, 1998)")
def _(spark, sf):
    return q.drop_values(engage(spark, sf).select(KEY, "policy_creation_year"), "policy_creation_year", [1996, 1998])


_ALL_SET = " AND ".join(f"{x} IS NOT NULL" for x in COMBINED)


@query("F2_drop_null_rows", ctes("combined") + f"SELECT {', '.join(COMBINED)} FROM combined WHERE {_ALL_SET}")
def _(spark, sf):
    return q.drop_null_rows(flows.combined(spark, sf))


@query("F3_null_rows", ctes("combined") + f"SELECT {', '.join(COMBINED)} FROM combined WHERE NOT ({_ALL_SET})")
def _(spark, sf):
    return q.null_rows(flows.combined(spark, sf))


@query("F4_fence_inside", ctes("inside") + f"SELECT {KEY}, {rs(['total_premiums', 'claims_rate', 'premium_wage_ratio'])} FROM inside")
def _(spark, sf):
    return rounded(flows.split_outliers(spark, sf)[0].select(KEY, "total_premiums", "claims_rate", "premium_wage_ratio"))


@query("F4_fence_outside", ctes("outside") + f"SELECT {KEY}, {rs(['total_premiums', 'claims_rate', 'premium_wage_ratio'])} FROM outside")
def _(spark, sf):
    return rounded(flows.split_outliers(spark, sf)[1].select(KEY, "total_premiums", "claims_rate", "premium_wage_ratio"))


# ---- joins -------------------------------------------------------------------------


@query("J1_left_join", ctes("combined") + f"SELECT {', '.join(COMBINED)} FROM combined")
def _(spark, sf):
    return c.left_join(engage(spark, sf), lob(spark, sf), KEY)


@query("J2_attach", ctes("inside") + f"SELECT {KEY}, edu_desc, {r('gross_monthly_salary')} FROM inside")
def _(spark, sf):
    text, numbers = c.split_by_type(flows.split_outliers(spark, sf)[0], KEY)
    return rounded(c.attach(text.select(KEY, "edu_desc"), numbers.select(KEY, "gross_monthly_salary"), KEY))


# ---- aggregates --------------------------------------------------------------------


def _numeric_sql(frame, cols, digits=2):
    return " UNION ALL ".join(
        f"SELECT '{x}' AS \"column\", count({x}) AS count, {r(f'avg({x})', 'mean', digits)}, {r(f'stddev_samp({x})', 'std', digits)}, "
        f"{r(f'CAST(min({x}) AS DOUBLE)', 'min', digits)}, {r(f'quantile_cont({x}, 0.25)', 'p25', digits)}, {r(f'quantile_cont({x}, 0.5)', 'p50', digits)}, "
        f"{r(f'quantile_cont({x}, 0.75)', 'p75', digits)}, {r(f'CAST(max({x}) AS DOUBLE)', 'max', digits)} FROM {frame}"
        for x in cols
    )


_COMBINED_NUM = [x for x in COMBINED if x != "education_lvl"]
_TEXT = """SELECT count(education_lvl) AS count, count(DISTINCT education_lvl) AS n_distinct,
 (SELECT education_lvl FROM combined GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
 (SELECT count(*) FROM combined GROUP BY education_lvl ORDER BY 1 DESC LIMIT 1) AS freq FROM combined"""


@query(
    "A1_describe_all",
    ctes("combined") + f"SELECT *, CAST(NULL AS BIGINT) AS n_distinct, CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq FROM ({_numeric_sql('combined', _COMBINED_NUM)})"
    f" UNION ALL SELECT 'education_lvl', count, NULL, NULL, NULL, NULL, NULL, NULL, NULL, n_distinct, top, freq FROM ({_TEXT})",
)
def _(spark, sf):
    return rounded(d.describe_all(flows.combined(spark, sf).persist()), 2)


@query("A2_describe_numeric", ctes("inside") + _numeric_sql("inside", ["cust_tenure", "gross_monthly_salary"]))
def _(spark, sf):
    return rounded(d.describe_numeric(flows.split_outliers(spark, sf)[0], ["cust_tenure", "gross_monthly_salary"]), 2)


@query("A3_null_profile", ctes("combined") + " UNION ALL ".join(f"SELECT '{x}' AS \"column\", {r(f'avg(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) * 100', 'pct_null', 2)} FROM combined" for x in COMBINED))
def _(spark, sf):
    return q.null_profile(flows.combined(spark, sf))


_ZERO = ["has_children", "geographic_area", "claims_rate", *P]


@query("A4_zero_profile", ctes("combined") + " UNION ALL ".join(f"SELECT '{x}' AS \"column\", {r(f'avg(CASE WHEN {x} = 0 THEN 1 ELSE 0 END) * 100', 'pct_zero', 2)} FROM combined" for x in _ZERO))
def _(spark, sf):
    return q.zero_profile(flows.combined(spark, sf), _ZERO)


_CELLS = " + ".join(f"CASE WHEN {x} IS NULL THEN 1 ELSE 0 END" for x in COMBINED)


@query("A5_missing_summary", ctes("combined") + f"SELECT CAST(sum({_CELLS}) AS BIGINT) AS missing_cells, round(sum({_CELLS}) / count(*) * 100, 2) AS sum_pct, count(*) AS n_rows FROM combined")
def _(spark, sf):
    return q.missing_summary(flows.combined(spark, sf))


@query("A6_dropna_impact", ctes("combined") + f"SELECT before, after, before - after AS lost, round((before - after) / before * 100, 2) AS lost_pct FROM (SELECT count(*) AS before, count(*) FILTER (WHERE {_ALL_SET}) AS after FROM combined)")
def _(spark, sf):
    return q.dropna_impact(flows.combined(spark, sf))


_RULES = {
    "policy_year_after_limit": "policy_creation_year > 2000",
    "birth_year_after_limit": "birth_year > 2000",
    "children_not_binary": "has_children IS NULL OR has_children NOT IN (0, 1)",
    "policy_before_age_18": "policy_creation_year < birth_year + 18",
}


@query("A7_validate", ctes("combined") + " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS violations, count(*) = 0 AS passed FROM combined WHERE {s}" for n, s in _RULES.items()))
def _(spark, sf):
    return q.validate(engage(spark, sf), flows.validation_rules(2000))


@query("A8_duplicate_rows", "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1)")
def _(spark, sf):
    return q.duplicate_rows(io.read_table(spark, sf, "orders").select("o_custkey"), "o_custkey")


@query("A9_group_count", ctes("combined") + "SELECT policy_creation_year, count(motor_premiums) AS n FROM combined GROUP BY 1")
def _(spark, sf):
    return d.group_count(flows.combined(spark, sf), "policy_creation_year", "motor_premiums")


@query("A10_category_share", ctes("inside") + f"SELECT geographic_area, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER ()', 'pct')} FROM inside GROUP BY 1")
def _(spark, sf):
    return rounded(d.category_share(flows.split_outliers(spark, sf)[0], "geographic_area"))


@query(
    "X4_percent_label",
    ctes("inside") + "SELECT edu_desc, n, printf('%.1f%%', n * 100.0 / t) || chr(10) || '(' || format('{:,}', CAST(floor(CAST(n * 100.0 / t AS DOUBLE) / 100.0 * t) AS BIGINT)) || ')' AS label "
    "FROM (SELECT edu_desc, CAST(count(*) AS DOUBLE) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS t FROM inside GROUP BY 1)",
)
def _(spark, sf):
    return d.category_share(flows.split_outliers(spark, sf)[0], "edu_desc", label=True).drop("pct")


_MELT_IN = " UNION ALL ".join(f"SELECT '{p}' AS variable, {p} AS value FROM inside" for p in P)


@query("A11_sum_by_measure", ctes("inside") + f"SELECT variable, {r('sum(value)', 'total', 2)} FROM ({_MELT_IN}) GROUP BY 1")
def _(spark, sf):
    return rounded(d.sum_by_measure(flows.split_outliers(spark, sf)[0], P), 2)


@query("A12_positive_count", ctes("inside") + f"SELECT variable, count(value) AS n FROM ({_MELT_IN}) WHERE value > 0 GROUP BY 1")
def _(spark, sf):
    return d.positive_count_by_measure(flows.split_outliers(spark, sf)[0], P)


_NEG = f"SELECT variable, count(*) FILTER (WHERE value < 0) AS n FROM ({_MELT_IN}) GROUP BY 1"


@query("A13_reversal_counts", ctes("inside") + f"{_NEG} UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM ({_NEG})")
def _(spark, sf):
    return d.reversal_counts(flows.split_outliers(spark, sf)[0], P)


@query("F6_reversal_rows", ctes("inside") + " UNION ALL ".join(f"SELECT {KEY}, '{p}' AS variable, {r(p, 'total_premiums')} FROM (SELECT {KEY}, {p} AS neg, total_premiums AS {p} FROM inside) WHERE neg < 0" for p in P))
def _(spark, sf):
    return rounded(d.reversal_rows(flows.split_outliers(spark, sf)[0], P).select(KEY, "variable", "total_premiums"))


_CLAIM_BIN = sql_bin("claims_rate", flows.CLAIM_EDGES, flows.CLAIM_LABELS)
_CLAIM_ROWS = ", ".join(f"({i}, '{n}')" for i, n in enumerate(flows.CLAIM_LABELS))


@query(
    "A14_sum_by_bin",
    ctes("inside", f"bins(position, bin) AS (VALUES {_CLAIM_ROWS}), sums AS (SELECT {_CLAIM_BIN} AS bin, {', '.join(f'sum({p}) AS {p}' for p in P)} FROM inside GROUP BY 1)")
    + f"SELECT position, bins.bin, {', '.join(r(f'coalesce({p}, 0.0)', p, 2) for p in P)} FROM bins LEFT JOIN sums ON bins.bin = sums.bin",
)
def _(spark, sf):
    return rounded(d.sum_by_bin(flows.split_outliers(spark, sf)[0], "claims_rate", flows.CLAIM_EDGES, flows.CLAIM_LABELS, P), 2)


_SAL_BIN = sql_bin("gross_monthly_salary", flows.SALARY_EDGES, flows.SALARY_LABELS)


@query("A15_count_by", ctes("inside") + f"SELECT {_SAL_BIN} AS salary_segment, geographic_area, count(*) AS n FROM inside GROUP BY 1, 2")
def _(spark, sf):
    base = c.cut(flows.split_outliers(spark, sf)[0], "gross_monthly_salary", flows.SALARY_EDGES, flows.SALARY_LABELS, "salary_segment")
    return d.count_by(base, ["salary_segment", "geographic_area"])


@query(
    "A16_crosstab",
    ctes("inside", f"seg AS (SELECT *, {_SAL_BIN} AS b FROM inside)")
    + "SELECT has_children, " + ", ".join(f"nullif(count(*) FILTER (WHERE b = '{n}'), 0) AS \"{n}\"" for n in flows.SALARY_LABELS) + " FROM seg GROUP BY 1",
)
def _(spark, sf):
    base = c.cut(flows.split_outliers(spark, sf)[0], "gross_monthly_salary", flows.SALARY_EDGES, flows.SALARY_LABELS, "b")
    return d.crosstab(base, "has_children", "b", flows.SALARY_LABELS)


@query("A17_value_counts", ctes("inside", f"seg AS (SELECT {_SAL_BIN} AS b FROM inside)") + "SELECT b AS salary_segment, count(*) AS n FROM seg WHERE b IS NOT NULL GROUP BY 1")
def _(spark, sf):
    base = c.cut(flows.split_outliers(spark, sf)[0], "gross_monthly_salary", flows.SALARY_EDGES, flows.SALARY_LABELS, "salary_segment")
    return d.value_counts(base, "salary_segment")


@query("A18_distinct_values", ctes("categories") + " UNION ALL ".join(f"SELECT DISTINCT '{x}' AS variable, {x} AS value FROM categories" for x in flows.CATEGORICAL))
def _(spark, sf):
    return d.distinct_values(flows.categorical_frame(flows.split_outliers(spark, sf)[0]), flows.CATEGORICAL)


_GRID = [250.0 * i for i in range(-4, 45)]


@query(
    "A19_kde",
    ctes("inside", "w AS (SELECT edu_desc, stddev_samp(gross_monthly_salary) * pow(count(*), -0.2) AS h FROM inside GROUP BY 1), "
    f"grid(position, x) AS (VALUES {', '.join(f'({i}, CAST({g} AS DOUBLE))' for i, g in enumerate(_GRID))})")
    + "SELECT edu_desc, position, " + r("avg(exp(-0.5 * ((x - gross_monthly_salary) / h) * ((x - gross_monthly_salary) / h)) / (h * sqrt(2 * pi())))", "density", 10)
    + ", x FROM inside JOIN w USING (edu_desc) CROSS JOIN grid WHERE h > 0 GROUP BY edu_desc, position, x",
)
def _(spark, sf):
    return rounded(d.kde(flows.split_outliers(spark, sf)[0], "gross_monthly_salary", _GRID, by="edu_desc"), 10)


_HIST = ["gross_monthly_salary", "claims_rate", "total_premiums", "cust_tenure"]


def _hist_sql(x, bins):
    w = f"((hi - lo) / {bins})"
    return (
        f"SELECT '{x}' AS \"column\", CAST(b.i AS INTEGER) AS bin, {r(f'lo + b.i * {w}', 'lo')}, coalesce(n, 0) AS n FROM range({bins}) b(i) "
        f"CROSS JOIN (SELECT CAST(min({x}) AS DOUBLE) AS lo, CAST(max({x}) AS DOUBLE) AS hi FROM inside) "
        f"LEFT JOIN (SELECT least(floor((CAST({x} AS DOUBLE) - lo) / {w}), {bins - 1}) AS k, count(*) AS n FROM inside CROSS JOIN "
        f"(SELECT CAST(min({x}) AS DOUBLE) AS lo, CAST(max({x}) AS DOUBLE) AS hi FROM inside) GROUP BY 1) ON k = b.i"
    )


@query("A20_histogram", ctes("inside") + " UNION ALL ".join(_hist_sql(x, 20) for x in _HIST))
def _(spark, sf):
    return rounded(d.histogram(flows.split_outliers(spark, sf)[0], _HIST, 20))


@query(
    "A21_joint_histogram",
    ctes("inside", "e AS (SELECT min(cust_acq_cost) AS xl, max(cust_acq_cost) AS xh, min(customer_monetary_value) AS yl, max(customer_monetary_value) AS yh, corr(cust_acq_cost, customer_monetary_value) AS r FROM inside)")
    + "SELECT CAST(least(floor((cust_acq_cost - xl) / ((xh - xl) / 20)), 19) AS INTEGER) AS x_bin, CAST(least(floor((customer_monetary_value - yl) / ((yh - yl) / 20)), 19) AS INTEGER) AS y_bin, count(*) AS n, "
    + r("max(r)", "r") + " FROM inside CROSS JOIN e GROUP BY 1, 2",
)
def _(spark, sf):
    return rounded(d.joint_histogram(flows.split_outliers(spark, sf)[0], "cust_acq_cost", "customer_monetary_value", 20))


# Interpolated quantiles of four-decimal money have six decimals, so six are compared.


@query(
    "A22_box_stats",
    ctes("valued") + " UNION ALL ".join(
        f"SELECT '{x}' AS \"column\", {r('a', 'whisker_lo', 6)}, {r('b', 'q1', 6)}, {r('c', 'median', 6)}, {r('d', 'q3', 6)}, {r('e', 'whisker_hi', 6)}, "
        f"(SELECT count(*) FROM valued WHERE {x} < a OR {x} > e) AS n_outside FROM (SELECT quantile_cont({x}, 0.01) a, quantile_cont({x}, 0.25) b, "
        f"quantile_cont({x}, 0.5) c, quantile_cont({x}, 0.75) d, quantile_cont({x}, 0.99) e FROM valued)"
        for x in NUM
    ),
)
def _(spark, sf):
    return rounded(d.box_stats(flows.valued(spark, sf).persist(), NUM, 0.01, 0.99), 6)


@query(
    "A23_quantiles",
    ctes("valued") + " UNION ALL ".join(f"SELECT '{x}' AS \"column\", CAST({p} AS DOUBLE) AS p, {r(f'quantile_cont({x}, {p})', 'value', 6)} FROM valued" for x in NUM for p in (0.01, 0.5, 0.99)),
)
def _(spark, sf):
    return rounded(d.quantiles(flows.valued(spark, sf).persist(), NUM, [0.01, 0.5, 0.99]), 6)


@query("A23_quantiles_lines", " UNION ALL ".join(f"SELECT '{x}' AS \"column\", CAST({p} AS DOUBLE) AS p, {r(f'quantile_cont({x}, {p})', 'value')} FROM lineitem" for x in ("l_quantity", "l_extendedprice", "l_discount") for p in (0.01, 0.25, 0.99)))
def _(spark, sf):
    lines = io.read_table(spark, sf, "lineitem")
    return rounded(d.quantiles(lines, ["l_quantity", "l_extendedprice", "l_discount"], [0.01, 0.25, 0.99]))


_CORR = [n for n in NUM if n != "policy_creation_year"]


def _corr_sql(frame, cols, lower=False):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {r(f'CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END', 'r')} FROM {frame}"
        for i, a in enumerate(cols) for j, b in enumerate(cols) if not lower or i > j
    )


@query("A24_correlation", ctes("std") + _corr_sql("std", flows.FEATURES))
def _(spark, sf):
    return rounded(d.correlation(flows.model_frame(spark, sf).std, flows.FEATURES))


@query("A25_correlation_lower", ctes("inside") + _corr_sql("inside", _CORR, lower=True))
def _(spark, sf):
    return rounded(d.correlation_lower(flows.split_outliers(spark, sf)[0], _CORR))


# ---- ordering, stacking, binning ---------------------------------------------------


@query("T1_bottom_k", ctes("combined") + f"SELECT {KEY}, gross_monthly_salary FROM combined WHERE gross_monthly_salary IS NOT NULL ORDER BY gross_monthly_salary, {KEY} LIMIT 3")
def _(spark, sf):
    return c.bottom_k(engage(spark, sf).select(KEY, "gross_monthly_salary"), "gross_monthly_salary", 3, KEY)


@query("U1_stack", ctes("inside") + f"SELECT {KEY}, {r('health_premiums')}, {r('NULL', 'work_premiums')} FROM inside WHERE health_premiums < 0 UNION ALL SELECT {KEY}, NULL, {r('work_premiums')} FROM inside WHERE work_premiums < 0")
def _(spark, sf):
    inside = flows.split_outliers(spark, sf)[0]
    return rounded(c.stack(*[inside.filter(F.col(p) < 0).select(KEY, p) for p in ("health_premiums", "work_premiums")]))


@query(
    "U2_compare_tables",
    "SELECT true AS same_schema, (SELECT count(*) FROM (SELECT o_custkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_custkey, 'F' FROM orders)) AS only_left, "
    "(SELECT count(*) FROM (SELECT o_custkey, 'F' FROM orders EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders)) AS only_right, "
    "(SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') = 0 AS equal",
)
def _(spark, sf):
    orders = io.read_table(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    return q.compare_tables(orders, orders.withColumn("o_orderstatus", F.lit("F")))


@query("U2_compare_csv_copy", "SELECT true AS same_schema, CAST(0 AS BIGINT) AS only_left, CAST(0 AS BIGINT) AS only_right, true AS equal")
def _(spark, sf):
    table = flows.combined(spark, sf).persist()
    path = scratch_path(spark, "combined")
    io.write_csv(table, path)
    return q.compare_tables(io.read_csv(spark, path, table.schema), table)


@query("X1_cut", ctes("inside") + f"SELECT {KEY}, {_CLAIM_BIN} AS claims_bin FROM inside")
def _(spark, sf):
    return c.cut(flows.split_outliers(spark, sf)[0], "claims_rate", flows.CLAIM_EDGES, flows.CLAIM_LABELS, "claims_bin").select(KEY, "claims_bin")


@query("X2_cut_missing_text", ctes("categories") + "SELECT * FROM categories")
def _(spark, sf):
    return flows.categorical_frame(flows.split_outliers(spark, sf)[0])


# ---- flows -------------------------------------------------------------------------


@query("E1_clean", ctes("clean") + f"SELECT {KEY}, policy_creation_year, {rs(['gross_monthly_salary'])}, geographic_area, has_children, edu_desc, {rs(['customer_monetary_value', 'claims_rate', *P])} FROM clean")
def _(spark, sf):
    return rounded(flows.cleaned(flows.combined(spark, sf)))


@query("E2_value_features", ctes("valued") + f"SELECT {KEY}, active_premiums, cust_tenure, {rs(['cancelled_premiums_pct', 'total_premiums', 'amt_paidby_comp', 'cust_acq_cost', 'premium_wage_ratio'])} FROM valued")
def _(spark, sf):
    return rounded(flows.valued(spark, sf).select(KEY, "active_premiums", "cust_tenure", "cancelled_premiums_pct", "total_premiums", "amt_paidby_comp", "cust_acq_cost", "premium_wage_ratio"))


@query("E3_model_frame", ctes("std") + f"SELECT {KEY}, {rs(flows.FEATURES)} FROM std")
def _(spark, sf):
    return rounded(flows.model_frame(spark, sf).std)


@query("E6_active_by_area", ctes("inside") + f"SELECT geographic_area, count(*) AS n, {r('avg(active_premiums)', 'mean_active')}, {r('sum(total_premiums)', 'premiums', 2)} FROM inside GROUP BY 1")
def active_by_area(spark, sf):
    inside, _ = flows.split_outliers(spark, sf)
    out = inside.groupBy("geographic_area").agg(
        F.count(F.lit(1)).alias("n"), F.avg("active_premiums").alias("mean_active"), F.sum("total_premiums").alias("premiums")
    )
    return out.select("geographic_area", "n", (F.round("mean_active", 4) + 0.0).alias("mean_active"), (F.round("premiums", 2) + 0.0).alias("premiums"))
