"""Registration of queries with their check SQL, and the shared CTEs of that SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.plans import flows
from stratiform.sources.mart import KEY, LINE_OF_PRIORITY, PREMIUMS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round floating columns so both engines print the same value; ``+ 0.0`` drops the sign of zero."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def r(expr: str, name: str | None = None, digits: int = 4) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {name or expr}"


def rs(cols: Sequence[str], digits: int = 4) -> str:
    return ", ".join(r(c, digits=digits) for c in cols)


_VALUE = "CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))"
_P = PREMIUMS
_N = flows.NUMBERS

CTES: dict[str, str] = {
    "order_line": f"""SELECT l_orderkey, CAST(sum(v) AS BIGINT) AS gross,
        CAST(sum(CASE WHEN l_returnflag = 'R' THEN v ELSE 0 END) AS BIGINT) AS returned
        FROM (SELECT l_orderkey, l_returnflag, {_VALUE} AS v FROM lineitem) GROUP BY l_orderkey""",
    "first_order": """SELECT o_custkey, o_orderpriority AS first_priority FROM (
        SELECT o_custkey, o_orderpriority,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "per_customer": f"""SELECT o_custkey, min(o_orderdate) AS first_date,
        CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS order_cents,
        CAST(sum(gross) AS BIGINT) AS gross, CAST(sum(returned) AS BIGINT) AS returned,
        {", ".join(f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN gross - 2 * returned END) AS BIGINT) AS {c}" for p, c in LINE_OF_PRIORITY.items())}
        FROM orders LEFT JOIN order_line ON o_orderkey = l_orderkey GROUP BY o_custkey""",
    "engage": f"""SELECT c_custkey AS {KEY}, CAST(year(first_date) AS INTEGER) AS policy_creation_year,
        CAST(1950 + c_nationkey + c_custkey % 10 AS INTEGER) AS birth_year, first_priority AS education_lvl,
        c_acctbal AS gross_monthly_salary, n_regionkey AS geographic_area, c_nationkey % 2 AS has_children,
        CAST(order_cents AS DOUBLE) / 100.0 AS customer_monetary_value,
        CASE WHEN gross <> 0 THEN CAST(returned AS DOUBLE) / CAST(gross AS DOUBLE) END AS claims_rate
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN per_customer p ON c_custkey = p.o_custkey LEFT JOIN first_order f ON c_custkey = f.o_custkey""",
    "lob": f"""SELECT o_custkey AS {KEY}, {", ".join(f"CAST({c} AS DOUBLE) / 10000.0 AS {c}" for c in _P)} FROM per_customer""",
    "combined": f"SELECT e.*, {', '.join('lob.' + c for c in _P)} FROM engage e LEFT JOIN lob ON e.{KEY} = lob.{KEY}",
    "filled": f"""SELECT {KEY}, policy_creation_year, birth_year, gross_monthly_salary, geographic_area, has_children,
        customer_monetary_value, claims_rate, {", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _P)},
        nullif(split_part(education_lvl, '-', 2), '') AS edu_desc FROM combined""",
    "clean": f"""SELECT {KEY}, policy_creation_year, gross_monthly_salary, CAST(geographic_area AS VARCHAR) AS geographic_area,
        CASE has_children WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS has_children, customer_monetary_value, claims_rate,
        {", ".join(_P)}, edu_desc FROM filled
        WHERE policy_creation_year IS NOT NULL AND birth_year IS NOT NULL AND gross_monthly_salary IS NOT NULL
        AND geographic_area IS NOT NULL AND has_children IS NOT NULL AND customer_monetary_value IS NOT NULL
        AND claims_rate IS NOT NULL AND edu_desc IS NOT NULL
        AND policy_creation_year NOT IN {str(flows.BAD_POLICY_YEARS).replace(",)", ")")}
        AND birth_year NOT IN {str(flows.BAD_BIRTH_YEARS).replace(",)", ")")}""",
    "valued": f"""SELECT *, (total_premiums - amt_paidby_comp) * cust_tenure - customer_monetary_value AS cust_acq_cost,
        CASE WHEN gross_monthly_salary <> 0 THEN total_premiums / (gross_monthly_salary * 12) END AS premium_wage_ratio
        FROM (SELECT *, claims_rate * total_premiums AS amt_paidby_comp FROM (SELECT *,
          {" + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in _P)} AS active_premiums,
          CASE WHEN ({" + ".join(f"CASE WHEN {c} <> 0 THEN 1 ELSE 0 END" for c in _P)}) <> 0
            THEN CAST({" + ".join(f"CASE WHEN {c} < 0 THEN 1 ELSE 0 END" for c in _P)} AS DOUBLE)
              / ({" + ".join(f"CASE WHEN {c} <> 0 THEN 1 ELSE 0 END" for c in _P)}) END AS cancelled_premiums_pct,
          {flows.AS_OF_YEAR} - policy_creation_year AS cust_tenure, {" + ".join(_P)} AS total_premiums FROM clean))""",
    "fence": f"SELECT {', '.join(f'quantile_cont({c}, {flows.FENCE_LO}) AS lo_{c}, quantile_cont({c}, {flows.FENCE_HI}) AS hi_{c}' for c in _N)} FROM valued",
    "flagged": f"SELECT v.*, ({' OR '.join(f'coalesce(v.{c} < lo_{c} OR v.{c} > hi_{c}, false)' for c in _N)}) AS is_out FROM valued v CROSS JOIN fence",
    "inside": "SELECT * EXCLUDE (is_out) FROM flagged WHERE NOT is_out",
    "outside": "SELECT * EXCLUDE (is_out) FROM flagged WHERE is_out",
    "features": f"""SELECT {KEY}, {", ".join(flows.FEATURES[:4])},
        {", ".join(f"{c} / total_premiums AS {c}_pct" for c in _P)} FROM inside
        WHERE total_premiums <> 0 AND cancelled_premiums_pct IS NOT NULL AND premium_wage_ratio IS NOT NULL""",
    "stats": f"SELECT {', '.join(f'avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}' for c in flows.FEATURES)} FROM features",
    "std": f"SELECT {KEY}, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in flows.FEATURES)} FROM features CROSS JOIN stats",
}
_ORDER = list(CTES)
_BIN = lambda col, edges, labels, missing: (
    "CASE " + " ".join(f"WHEN {col} > {a} AND {col} <= {b} THEN '{n}'" for a, b, n in zip(edges, edges[1:], labels))
    + (f" ELSE '{missing}'" if missing else "") + " END"
)
CTES["categories"] = f"""SELECT {KEY}, {", ".join(flows.CATEGORIES)},
    {_BIN("gross_monthly_salary", flows.SALARY_EDGES, flows.SALARY_LABELS, "nan")} AS salary_bin,
    {_BIN("cust_tenure", flows.TENURE_EDGES, flows.TENURE_LABELS, "nan")} AS tenure_bin FROM inside"""
CTES["density_raw"] = f"""SELECT e.{KEY}, CAST(p.gross AS DOUBLE) / 10000.0 AS gross_sales, claims_rate AS returned_share,
    gross_monthly_salary AS balance FROM engage e JOIN per_customer p ON e.{KEY} = p.o_custkey WHERE claims_rate IS NOT NULL"""
CTES["density"] = f"""SELECT {KEY}, {", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in flows.DENSITY)}
    FROM density_raw"""


def sql_bin(col: str, edges, labels, missing: str | None = None) -> str:
    return _BIN(col, edges, labels, missing)


def ctes(upto: str, extra: str = "") -> str:
    """``WITH`` clause holding everything the named frame is built from."""
    chain = _ORDER[: _ORDER.index(upto) + 1] if upto in _ORDER else None
    if upto == "categories":
        chain = _ORDER[: _ORDER.index("inside") + 1] + ["categories"]
    elif upto == "density":
        chain = _ORDER[: _ORDER.index("engage") + 1] + ["density_raw", "density"]
    parts = [f"{n} AS ({CTES[n]})" for n in chain]
    return "WITH RECURSIVE " + ",\n".join(parts) + (",\n" + extra if extra else "") + "\n"
