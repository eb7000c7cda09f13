"""Principal components on top of Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.operators.describe import cumulative
from stratiform.session import small_table


def _centred_vector(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``PCAModel.transform`` does not centre, so the mean is taken off first."""
    row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centred = df.select(*keep, *[(F.col(c) - F.lit(row[c])).alias(f"__{c}") for c in cols])
    return VectorAssembler(inputCols=[f"__{c}" for c in cols], outputCol="__v").transform(centred)


def pca_fit(df: DataFrame, cols: Sequence[str], n: int | None = None) -> PCAModel:
    vec = VectorAssembler(inputCols=list(cols), outputCol="__v").transform(df.select(*cols))
    return PCA(k=n or len(cols), inputCol="__v", outputCol="__p").fit(vec)


def covariance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample covariance matrix in long form ``(a, b, cov)``: what the components come from."""
    d = len(cols)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    row = df.agg(*[F.covar_samp(cols[i], cols[j]).alias(f"{i}_{j}") for i, j in pairs]).first()
    rows = [(cols[i], cols[j], row[f"{min(i, j)}_{max(i, j)}"]) for i in range(d) for j in range(d)]
    return small_table(df.sparkSession, rows, "a string, b string, cov double")


def pca_variance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(pc, explained_pct, cumulative_pct)``; one row per component."""
    ratio = pca_fit(df, cols).explainedVariance.toArray()
    table = small_table(df.sparkSession, [(i + 1, float(v) * 100) for i, v in enumerate(ratio)], "pc int, v double")
    return cumulative(table, "pc", "v", "c").select(
        "pc", F.round("v", 1).alias("explained_pct"), F.round("c", 2).alias("cumulative_pct")
    )


def _signed_components(model: PCAModel):
    """Component matrix with the largest absolute loading of each component made positive."""
    m = model.pc.toArray().copy()
    for j in range(m.shape[1]):
        if m[abs(m[:, j]).argmax(), j] < 0:
            m[:, j] = -m[:, j]
    return m


def pca_loadings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    m = _signed_components(pca_fit(df, cols))
    rows = [(f"PC{j + 1}", cols[i], float(m[i, j])) for j in range(m.shape[1]) for i in range(len(cols))]
    return small_table(df.sparkSession, rows, "pc string, variable string, loading double")


def pca_project(df: DataFrame, cols: Sequence[str], n: int, key: str) -> DataFrame:
    """``(key, PC1 .. PCn)`` with the same sign rule as the loadings."""
    model = pca_fit(df, cols, n)
    raw = model.pc.toArray()
    sign = [1.0 if raw[abs(raw[:, j]).argmax(), j] >= 0 else -1.0 for j in range(n)]
    out = model.transform(_centred_vector(df, cols, [key])).withColumn("__a", vector_to_array("__p"))
    return out.select(key, *[(F.col("__a")[j] * F.lit(sign[j])).alias(f"PC{j + 1}") for j in range(n)])
