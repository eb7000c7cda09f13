"""Sizes, profiles and projections of a labelling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.operators.columns import attach_labels, melt
from stratiform.operators.pca import pca_project
from stratiform.operators.scale import Scaler, scaler_apply, scaler_invert

NOISE = -1


def label_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def n_clusters(labels: DataFrame) -> DataFrame:
    """Number of clusters; noise is not one."""
    return (
        labels.filter(F.col("label") != NOISE)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.lit(1)).alias("n_clusters"))
    )


def cluster_profile(df: DataFrame, labels: DataFrame, key: str, cols: Sequence[str], stats: Scaler | None = None) -> DataFrame:
    """Mean of each column per label with the label's size, noise left out; in original
    units when the scaler is given (means are mapped back, not the rows)."""
    members = attach_labels(df.select(key, *cols), labels.filter(F.col("label") != NOISE), key)
    means = members.groupBy("label").agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n"))
    return scaler_invert(means, stats) if stats else means


def profiles_by_method(df: DataFrame, labelings: Mapping[str, DataFrame], key: str, cols: Sequence[str], stats: Scaler | None = None) -> DataFrame:
    """``(method, label, <means>, n)`` of several labelings, noise left out: rows are read once
    and averaged under each of their labels."""
    members = df.select(key, *cols)
    for i, labels in enumerate(labelings.values()):
        members = members.join(labels.select(key, F.col("label").cast("int").alias(f"__l{i}")), key, "left")
    under = F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"__l{i}").alias("label")) for i, m in enumerate(labelings)]))
    rows = members.withColumn("__t", under).select("__t.method", "__t.label", *cols).filter(F.col("label") != NOISE)
    means = rows.groupBy("method", "label").agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n"))
    return scaler_invert(means, stats) if stats else means


def outlier_comparison(inside: DataFrame, whole: DataFrame, key: str, cols: Sequence[str], stats: Scaler) -> DataFrame:
    """``(rows, label, variable, mean, n, stderr)`` on the scaled columns, without and with the
    labelled outliers; both frames hold the key, the columns and a label."""
    out = None
    for name, frame in (("inside", inside), ("with_outliers", whole)):
        scaled = scaler_apply(frame.select(key, *cols), stats)
        part = cluster_profile_long(scaled, frame.select(key, "label"), key, cols).withColumn("rows", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def cluster_profile_long(df: DataFrame, labels: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``(label, variable, mean, n, stderr)``. The wide aggregate runs first, so rows are
    not multiplied by the number of columns."""
    members = attach_labels(df.select(key, *cols), labels, key)
    wide = members.groupBy("label").agg(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.avg(c).alias("mean"),
                F.count(c).alias("n"),
                F.try_divide(F.stddev_samp(c), F.sqrt(F.count(c).cast("double"))).alias("stderr"),
            ).alias(f"s{i}")
            for i, c in enumerate(cols)
        ]
    )
    return wide.select("label", F.explode(F.array(*[f"s{i}" for i in range(len(cols))])).alias("s")).select("label", "s.*")


def tidy(df: DataFrame, labels: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One row per customer and variable, with the label: the chart input itself."""
    return melt(attach_labels(df.select(key, *cols), labels, key), [key, "label"], cols)


def cluster_projection(df: DataFrame, labels: DataFrame, key: str, cols: Sequence[str], n: int, limit: int | None = None) -> DataFrame:
    """``(key, label, PC1 .. PCn)``; ``limit`` gives the preview in key order."""
    out = attach_labels(pca_project(df, cols, n, key), labels, key)
    return out if limit is None else out.orderBy(key).limit(limit)
