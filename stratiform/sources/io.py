"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.expr import without_nan
from stratiform.session import small_table


def read_table(
    spark: SparkSession,
    source: str | Mapping[str, str],
    name: str,
    schema: T.StructType | None = None,
    partition: Mapping[str, object] | None = None,
) -> DataFrame:
    """Read one whole table, lazily. NaN becomes NULL.

    ``source`` is a folder of Parquet tables (``<name>.parquet``), the word
    ``catalog`` for a metastore table, or a dictionary of JDBC options.
    ``partition`` (``partitionColumn``, ``lowerBound``, ``upperBound``,
    ``numPartitions``) splits a JDBC read over executors; without it JDBC reads
    through one connection, which suits small tables only.
    """
    if isinstance(source, Mapping):
        reader = spark.read.format("jdbc").options(**source).option("dbtable", name)
        for k, v in (partition or {}).items():
            reader = reader.option(k, v)
        return without_nan(reader.load())
    if source == "catalog":
        return without_nan(spark.table(name))
    reader = spark.read if schema is None else spark.read.schema(schema)
    return without_nan(reader.parquet(f"{source}/{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read CSV with a header under a declared schema (no inference pass over the data)."""
    return without_nan(spark.read.schema(schema).option("header", True).csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write a result as CSV, one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def describe_sources(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of every table as rows ``(table, position, column, type)``, in name order.

    Reads schemas only; no data is touched.
    """
    rows = [
        (t, i, f.name, f.dataType.simpleString())
        for t in sorted(tables)
        for i, f in enumerate(tables[t].schema.fields, start=1)
    ]
    return small_table(spark, rows, "`table` string, position int, `column` string, type string")


def shape(df: DataFrame) -> DataFrame:
    """Row and column count, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def head(df: DataFrame, n: int, key: str) -> DataFrame:
    """First ``n`` rows in key order (a top-k, not a full sort)."""
    return df.orderBy(key).limit(n)
