"""Augmentation fan-out (G4, U1), variant pairing (J2, P7) and the 4x check.

The fan-out is one lazy frame: each training row is exploded into the four
tags; test rows keep only 'original'. Audio kernels that act on the tag live
in ``operators.augment``; this module is the relational shape only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab


def fan_out(df: DataFrame, split_col: str = "split") -> DataFrame:
    tags = F.array(*[F.lit(t) for t in vocab.AUGMENTATIONS])
    only_original = F.array(F.lit("original"))
    return df.withColumn(
        "augmentation",
        F.explode(F.when(F.col(split_col) == "train", tags).otherwise(only_original)))


def variant_pairs(fanned: DataFrame, key: str, value: str, values: list[str] | None = None) -> DataFrame:
    """Each clip's original beside its variants, one row per clip.

    A single aggregation keyed by the clip with a fixed tag list (no distinct
    pass, no self-join), combined map side. When the value vocabulary is
    known, values travel as their integer position: fixed-width buffers keep
    the hash aggregate (string max would fall back to a sort-based one)."""
    tags = vocab.AUGMENTATIONS
    aggs = [F.count(F.lit(1)).alias("n_versions")]
    if values:
        arr = F.array(*[F.lit(v) for v in values])
        code = F.array_position(arr, F.col(value))
        for t in tags:
            aggs.append(F.max(F.when(F.col("augmentation") == t, code)).alias(f"_{t}"))
        out = fanned.groupBy(key).agg(*aggs)
        return out.select(key, "n_versions", *[
            F.when(F.col(f"_{t}") > 0, F.element_at(arr, F.col(f"_{t}").cast("int"))).alias(f"{value}_{t}")
            for t in tags])
    for t in tags:
        aggs.append(F.max(F.when(F.col("augmentation") == t, F.col(value))).alias(f"{value}_{t}"))
    return fanned.groupBy(key).agg(*aggs)


def variant_sample(fanned: DataFrame, order_cols: list[str], keep: list[str], key: str) -> DataFrame:
    """The four versions of one clip: that of the smallest ``order_cols``
    among the train rows, chosen once (an aggregate with a map-side partial)."""
    cols = list(dict.fromkeys(order_cols + keep))
    train = fanned.filter(F.col("split") == "train")
    one = train.agg(F.min(F.struct(*order_cols)).alias("m")).select(F.col("m." + key).alias("_key"))
    return train.join(F.broadcast(one), F.col(key) == F.col("_key")).select("augmentation", *cols)


def fanout_check(fanned: DataFrame, key: str) -> DataFrame:
    """Clips whose version count is not 4 (train) / 1 (test)."""
    per = fanned.groupBy(key, "split").agg(F.count(F.lit(1)).alias("n"))
    expected = F.when(F.col("split") == "train", F.lit(len(vocab.AUGMENTATIONS))).otherwise(F.lit(1))
    return per.agg(F.count(F.lit(1)).alias("n_clips"),
                   F.count_if(F.col("n") != expected).alias("n_bad"))
