"""Reproducible train/test split (X1), disjointness check (X2/U2) and task
sizing for CPU-heavy audio work (X3).

X3 in Spark terms: blobs are never shuffled to resize partitions (the
reference's ``repartition(200)`` moved every clip). File scans already split
by bytes (``spark.sql.files.maxPartitionBytes``); :func:`byte_ranges` deals
files to tasks by their lengths alone, and :func:`spread` adds a parallelism
floor for small inputs, on small rows, before they become audio.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..session import shared_dir
from ..sources import sinks


def split_bucket(key) -> F.Column:
    """0..99 from the first 32 bits of md5(key). Depends only on the key, never
    on partitioning or row order, so it is stable across re-runs and engines."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % 100


def with_split(df: DataFrame, key: str = "path", train_percent: int = vocab.TRAIN_PERCENT) -> DataFrame:
    """``split`` = 'train' for buckets < train_percent else 'test'.

    Split *before* augmentation and keyed by the file, so every variant of a
    clip (and every repeat of the same path) lands on the same side."""
    return df.withColumn("split", F.when(split_bucket(key) < train_percent, F.lit("train"))
                                   .otherwise(F.lit("test")))


def split_overlap(df: DataFrame, key: str = "path") -> DataFrame:
    """Number of keys present on both sides, as a one-row report.

    One aggregation keyed by ``key`` with two integer flags (fixed-width
    buffers, so a hash aggregate combined map side; string min/max would fall
    back to a sort-based aggregate) instead of two distincts and a semi-join."""
    per = df.groupBy(key).agg(
        F.max(F.when(F.col("split") == "train", 1).otherwise(0)).alias("in_train"),
        F.max(F.when(F.col("split") == "test", 1).otherwise(0)).alias("in_test"))
    return per.agg(F.count_if((F.col("in_train") == 1) & (F.col("in_test") == 1)).cast("long").alias("n_overlap"))


def assert_disjoint(df: DataFrame, key: str = "path") -> None:
    n = split_overlap(df, key).first()["n_overlap"]
    if n:
        raise AssertionError(f"{n} keys in both splits")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core on CPU-heavy work: when the input has fewer splits than
    the cluster's default parallelism, hash-repartition it by ``key`` to that
    many partitions (an explicit count, which AQE keeps). At scale the input
    already has more splits than cores and this is a no-op. Apply it to small
    rows (paths, vectors) *before* they are expanded into audio."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key)


def byte_ranges(files: DataFrame, target: int, order: str = "path", size: str = "length", shards: int = 64) -> DataFrame:
    """``files`` with ``part``: consecutive files in the order of their names
    whose lengths add up to ``target`` bytes, and no more than one file above.

    A file's part is the number of whole targets in the bytes before it. Those
    are prefix sums in two steps: inside each of ``shards`` ranges of the
    order, whose totals alone meet in one task. Names should be unique; equal
    ones follow each other in any order. Null lengths count as 0. Only
    metadata is read."""
    n = F.coalesce(F.col(size), F.lit(0)).cast("long")
    # A scan of many small files has thousands of tasks; rows of metadata need few.
    ranged = files.coalesce(shards).repartitionByRange(shards, F.col(order)).withColumns(
        {"_range": F.spark_partition_id(), "_bytes": n})
    # The ranges hold for what was dealt out, so that is stored.
    stored = sinks.materialize(ranged, shared_dir(files.sparkSession, "ranges-" + uuid.uuid4().hex))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy("_range").agg(F.sum("_bytes").alias("_n")).select(  # one row per range
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    upto = F.col("_start") + F.coalesce(F.sum("_bytes").over(inside), F.lit(0))
    return (stored.join(F.broadcast(totals), "_range")
            .withColumn("part", F.floor(upto / target).cast("long")).drop("_range", "_bytes", "_start"))


def in_parts(df: DataFrame, n_parts: int, part: str = "part") -> DataFrame:
    """One task for each part, by its number."""
    return df.repartitionById(n_parts, F.col(part).cast("int"))
