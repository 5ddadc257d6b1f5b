"""Corpus profiling aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def class_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows per label, count desc then label asc (deterministic ties)."""
    return (df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc(label_col)))


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    """A3/A5: rows per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def cross_tab(df: DataFrame, row_key: str, col_key: str, values: list[str]) -> DataFrame:
    """row_key x col_key counts, zero-filled, columns in ``values`` order.

    ``values`` is passed in (a known vocabulary), so pivot needs no extra
    distinct pass over the data.
    """
    return (df.groupBy(row_key).pivot(col_key, values).agg(F.count(F.lit(1)))
              .fillna(0, subset=[str(v) for v in values]))


def vector_profile(df: DataFrame, vec_col: str = "features", label_col: str = "label") -> DataFrame:
    """A1/A7/M1/M3/M6/P9/S8 in one pass: row count, vector length range,
    null labels, all-zero vectors, vectors holding NaN/Inf."""
    from .learn import has_nan_inf
    v = F.col(vec_col)
    bad = has_nan_inf(v)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.size(v)).alias("min_len"),
        F.max(F.size(v)).alias("max_len"),
        F.count_if(F.col(label_col).isNull()).alias("n_null_label"),
        F.count_if(F.forall(v, lambda x: x == 0)).alias("n_all_zero"),
        F.count_if(bad).alias("n_nan_inf"),
    ).withColumn("equal_len", F.col("min_len") == F.col("max_len"))
