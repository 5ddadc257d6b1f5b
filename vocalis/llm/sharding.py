"""Sharding: contiguous shards of near equal bytes from global prefix sums.

Rows are put in a total order, each range partition sums its bytes, the
per-partition totals become offsets, and a row's shard follows from where its
middle byte falls among ``n_shards`` equal targets. Only a few numbers per row
move, never the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ordered


def byte_shards(rows: DataFrame, order_by: list[str], size: str = "size",
                n_shards: int = 40) -> DataFrame:
    """``rows`` with ``shard`` (int, 0 to n_shards - 1) and ``slot`` (long,
    gapless from 0 in each shard), contiguous in ``order_by`` (nulls first).

    A shard holds the rows whose middle byte lies in its share of the total,
    so its bytes miss the target by at most one row's size at either end.
    Null sizes count 0; rows equal in every ordering column are
    interchangeable; an empty table gives an empty result; other columns are
    kept, existing ``shard`` and ``slot`` columns replaced. Pass few narrow
    columns: they are sorted once and stored.
    """
    own = [c for c in rows.columns if c not in ("shard", "slot")]
    stored = ordered(rows.select(*own), order_by)
    bytes_ = F.coalesce(F.col(size), F.lit(0))
    totals = stored.groupBy("_part").agg(F.sum(bytes_).alias("_b"), F.count("*").alias("_n"))
    # One row per range partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b0"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.sum("_b").over(Window.partitionBy()).alias("_all"),
    )
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    middle = 2 * (F.col("_b0") + F.col("_upto")) - bytes_
    placed = (
        stored.withColumn("_upto", F.sum(bytes_).over(inside))
        .withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy("_at")))
        .join(F.broadcast(offsets), "_part")  # as many rows as range partitions
        .withColumn("_mid", middle)
        .withColumn("shard", F.expr(
            f"if(_all > 0, least({n_shards - 1}, (_mid * {n_shards}) div (2 * _all)), 0)").cast("int"))
        .withColumn("_row", F.col("_n0") + F.col("_row") - 1)
    )
    placed = cut(placed.select(*own, "shard", "_row"))
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # n_shards rows
    return (
        placed.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("_row") - F.col("_first"))
        .select(*own, "shard", "slot")
    )
