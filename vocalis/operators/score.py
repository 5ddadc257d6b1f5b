"""Scoring records (R2-R5, J1, J3, T2-T5): table in, table out.

The probability vector of a row is zipped with the class names (J3), sorted
descending with vocabulary order on ties (T2), decorated with display text
and emoji by a broadcast join with the fixed 8-row display table (J1) and
rounded to 4 places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from . import labels as LB


def class_name(idx: Column) -> Column:
    """Display name of class index idx: the serving vocabulary by position,
    'class_<idx>' beyond it."""
    names = F.array(*[F.lit(n) for n in vocab.EMOTIONS_8])
    return F.when(idx < len(vocab.EMOTIONS_8), F.element_at(names, (idx + 1).cast("int"))) \
        .otherwise(F.concat(F.lit("class_"), idx.cast("string")))


RANKED_SQL = ("array_sort(zip_with({names}, {probs}, (n, p) -> named_struct('emotion', n, 'probability', p)),"
              " (a, b) -> CASE WHEN a.probability > b.probability THEN -1"
              " WHEN a.probability < b.probability THEN 1 ELSE 0 END)")


def ranked_sql(probs: str, names: str) -> str:
    """T2 as SQL text: array<struct<emotion, probability>> sorted by
    probability desc; ``array_sort`` is stable, so ties keep vocabulary order."""
    return RANKED_SQL.format(names=names, probs=probs)


def prediction_records(scored: DataFrame, key: str, names: Column) -> DataFrame:
    """R2: main class (first index on ties, T3), confidence rounded to 4."""
    probs = F.col("probs")
    best = F.array_position(probs, F.array_max(probs)).cast("int")
    out = scored.select(key, F.element_at(names, best).alias("main_emotion"),
                        F.round(F.array_max(probs), 4).alias("confidence"))
    out = LB.with_display(out, "main_emotion", prefix="main_")
    return out


def ranked_probabilities(scored: DataFrame, key: str, names: Column) -> DataFrame:
    """One row per (record, rank), with display text; ``is_main`` marks
    rank 1 so the rest can be listed without it."""
    r = scored.withColumn("_names", names).selectExpr(key, f"posexplode({ranked_sql('probs', '_names')}) AS (rank0, e)")
    r = r.select(key, (F.col("rank0") + 1).cast("long").alias("rank"), F.col("e.emotion").alias("emotion"),
                 F.round(F.col("e.probability"), 4).alias("probability"))
    r = LB.with_display(r, "emotion")
    return r.withColumn("is_main", F.col("rank") == 1)


def top_k_per_key(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """T4: newest-k rows per key, exact and skew-safe.

    ``row_number() <= k`` lets Spark plan a partial ``WindowGroupLimit``
    below the exchange: every map task keeps at most k rows per key before
    shuffling, so even a key holding a third of all rows sends at most
    k x (map tasks) rows to its reducer. The result is exact (the global
    top-k of a key is inside the union of per-task top-k)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
