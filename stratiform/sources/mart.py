"""Customer mart: the two customer tables the flows start from, derived from the
order tables.

Money is added up in whole ten-thousandths, so sums do not depend on the order in
which partitions arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.sources.io import read_table

KEY = "customer_identity"
PREMIUMS = ["motor_premiums", "household_premiums", "health_premiums", "life_premiums", "work_premiums"]
LINE_OF_PRIORITY = {
    "1-URGENT": "motor_premiums",
    "2-HIGH": "household_premiums",
    "3-MEDIUM": "health_premiums",
    "4-NOT SPECIFIED": "life_premiums",
    "5-LOW": "work_premiums",
}


def _cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its line totals.

    Lines are added up per order before the join, so the join and the later
    group-by see one row per order however many lines an order has.
    """
    amount = _cents("l_extendedprice") * (F.lit(100) - _cents("l_discount"))
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .select("l_orderkey", amount.alias("amount"), (F.col("l_returnflag") == "R").alias("returned"))
        .groupBy("l_orderkey")
        .agg(
            F.sum("amount").alias("gross"),
            F.sum(F.when(F.col("returned"), F.col("amount")).otherwise(0)).alias("returned"),
        )
    )
    orders = read_table(spark, sf_dir, "orders")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer: first order, money totals and one net premium per priority."""
    net = F.col("gross") - F.col("returned") * 2
    return (
        order_lines(spark, sf_dir)
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderdate").alias("first_date"),
            F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first_priority"),
            F.sum(_cents("o_totalprice")).alias("order_cents"),
            F.sum("gross").alias("gross"),
            F.sum("returned").alias("returned"),
            *[
                F.sum(F.when(F.col("o_orderpriority") == p, net)).alias(c)
                for p, c in LINE_OF_PRIORITY.items()
            ],
        )
    )


def engage(spark: SparkSession, sf_dir: str, per: DataFrame | None = None) -> DataFrame:
    """Customer master data; ``per`` hands in a ``customer_orders`` table already at hand."""
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    per = customer_orders(spark, sf_dir) if per is None else per
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(per, customer.c_custkey == per.o_custkey, "left")
        .select(
            F.col("c_custkey").alias(KEY),
            F.year("first_date").alias("policy_creation_year"),
            (F.lit(1950) + F.col("c_nationkey") + F.pmod(F.col("c_custkey"), F.lit(10)))
            .cast("int")
            .alias("birth_year"),
            F.col("first_priority").alias("education_lvl"),
            F.col("c_acctbal").alias("gross_monthly_salary"),
            F.col("n_regionkey").alias("geographic_area"),
            F.pmod(F.col("c_nationkey"), F.lit(2)).alias("has_children"),
            (F.col("order_cents") / F.lit(100.0)).alias("customer_monetary_value"),
            F.try_divide(F.col("returned").cast("double"), F.col("gross").cast("double")).alias("claims_rate"),
        )
    )


def lob(spark: SparkSession, sf_dir: str, per: DataFrame | None = None) -> DataFrame:
    """Premium per line of business; NULL means the customer has no such policy."""
    per = customer_orders(spark, sf_dir) if per is None else per
    return per.select(
        F.col("o_custkey").alias(KEY), *[(F.col(c) / F.lit(10000.0)).alias(c) for c in PREMIUMS]
    )
