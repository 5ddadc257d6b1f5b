"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target share of all words. A document's copies have the
expectation target / source size; the whole part is certain, the fraction is
rounded dependently: pairs of documents of one source exchange word mass at
random until one of the two is integral, so the source's taken words stay
fixed all along. Small groups leave one residual each, and residuals meet
again in groups of the next level, up to one per source.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, n_words_of, numbered, private, ready

#: Documents (or residuals) that one task rounds together at each level.
FAN_IN = 128
#: Parts a source's rows are dealt to when targets are joined to documents.
SALTS = 32


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1),
                   max_repeat: float = 3) -> DataFrame:
    """One row per source: ``source, source_size, docs, target``.

    Sources by code point, null last, weigh ``weights`` in rotation and share
    the words of all; a target stops at ``max_repeat`` times its source's size
    and the excess is shared again by weight. The water level behind that
    follows from prefix sums over the sources in order of size / weight, so
    no rounds are needed. One row per source meets in one task: the sources
    are the lines of a mixture's configuration. Sources without words get 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.col("_i") % len(weights))
    per = (
        per.withColumn("_i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
    )
    by_fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_i"))
    full = by_fill.rowsBetween(Window.unboundedPreceding, -1)  # sources that are full before
    rest = by_fill.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("_cap").over(full), F.lit(0.0)))
             / F.sum("_w").over(rest))
    # The level is that of the first source, in this order, that it doesn't fill.
    per = per.withColumn("_level", level).withColumn("_open", F.col("_cap") / F.col("_w") >= F.col("_level"))
    final = F.first(F.when(F.col("_open"), F.col("_level")), ignorenulls=True).over(
        by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("_cap"), F.col("_w") * F.coalesce(final, F.lit(float("inf"))))
    return per.withColumn("target", target).select("source", "source_size", "docs", "target")


def _round_group(rows: pd.DataFrame, last: bool) -> pd.DataFrame:
    """Pivotal rounding of one group: every row but at most one gets a ``bit``;
    the open one keeps its fraction ``x`` (closed to the nearer whole number
    where ``last``)."""
    rows = rows.sort_values(["r", "uid"], kind="stable").reset_index(drop=True)
    a, x = rows["size"].tolist(), rows["x"].tolist()
    u = ((rows["r"].to_numpy() >> 11) & ((1 << 53) - 1)) / float(1 << 53)
    bit, hold = [None] * len(rows), -1
    for i in range(len(rows)):
        if not 0.0 < x[i] < 1.0 or a[i] <= 0:  # certain, or without mass
            bit[i] = int(u[i] < x[i])
            continue
        if hold < 0:
            hold = i
            continue
        j = hold
        up = min(a[i] * (1 - x[i]), a[j] * x[j])  # words that i can take from j
        down = min(a[i] * x[i], a[j] * (1 - x[j]))
        if u[i] * (up + down) < down:
            i_full, t = a[i] * (1 - x[i]) <= a[j] * x[j], up
        else:
            i_full, t = a[i] * x[i] <= a[j] * (1 - x[j]), -down
        x[i], x[j] = x[i] + t / a[i], x[j] - t / a[j]
        done, hold = (i, j) if i_full else (j, i)
        bit[done] = int(x[done] > 0.5)
        if not 1e-9 < x[hold] < 1 - 1e-9:  # both became integral
            bit[hold], hold = int(x[hold] > 0.5), -1
    if hold >= 0 and last:
        bit[hold], hold = int(x[hold] >= 0.5), -1
    rows["x"] = x
    rows["bit"] = pd.array([-1 if b is None else b for b in bit], dtype="int32")
    return rows


def _rounder(last: bool):
    return lambda pdf: _round_group(pdf, last)


def dependent_copies(sizes: DataFrame, targets: DataFrame, seed: int = 11) -> DataFrame:
    """``uid, copies`` for rows ``uid, source, size`` (uid: unique long).

    Level after level, groups of about FAN_IN rows of one source are rounded
    and leave at most one open row each; the number of levels is the logarithm
    of the largest source's row count. Group and random numbers come from a
    hash of the uid, so reruns agree however the rows are dealt out.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    per = targets.withColumn("_s", F.coalesce("source", F.lit(""))).withColumn("_n", F.col("source").isNull())
    rows = (
        sizes.withColumn("_s", F.coalesce("source", F.lit(""))).withColumn("_n", F.col("source").isNull())
        .withColumn("_salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
        .join(per.drop("source").withColumn("_salt", salts), ["_s", "_n", "_salt"])
        .withColumn("_p", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0)))
        .withColumn("whole", F.floor(F.col("_p") + 1e-12).cast("int"))
        .select("uid", "_s", "_n", "size", "whole", "docs",
                F.greatest(F.lit(0.0), F.col("_p") - F.col("whole")).alias("x"))
    )
    most = targets.agg(F.max("docs")).first()[0] or 0
    levels = max(1, math.ceil(math.log(max(most, 2), FAN_IN)))
    schema = "uid long, _s string, _n boolean, size long, whole int, docs long, x double, g long, r long, bit int"
    closed, at, groups = [], rows, F.ceil(F.col("docs") / FAN_IN)
    for level in range(levels + 1):
        last = level == levels
        # At the last level a source is one group: by then few rows are open.
        at = at.withColumn("g", F.lit(0).cast("long") if last else F.pmod(F.xxhash64("uid", F.lit(seed)), groups))
        at = at.withColumn("r", F.xxhash64("uid", F.lit(seed + 1 + level)))
        done = cut(at.groupBy("_s", "_n", "g").applyInPandas(_rounder(last), schema))
        closed.append(done.filter("bit >= 0").select("uid", (F.col("whole") + F.col("bit")).alias("copies")))
        at = done.filter("bit < 0").drop("g", "r", "bit")
        groups = F.greatest(F.lit(1), F.ceil(F.col("docs") / FAN_IN ** (level + 2)))
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out


def mix(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeat: float = 3,
        seed: int = 11) -> DataFrame:
    """``uid, source, size, source_size, target, copies`` for stored rows
    ``uid`` (unique long), ``source`` (null is a source of its own), ``size``
    (long; null counts 0).

    The words taken of a source miss its target by at most half of one of its
    documents. No document gets more than ``max_repeat`` copies. Rows without
    words are rounded alone. An empty table gives an empty result.
    """
    ready(sizes)
    sizes = sizes.select("uid", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    targets = cut(source_targets(sizes, weights, max_repeat).coalesce(1))
    copies = dependent_copies(sizes, targets, seed)
    per = targets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    full = sizes.join(copies, "uid").withColumn("_salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
    same = full["source"].eqNullSafe(per["source"]) & (full["_salt"] == per["_salt"])
    return full.join(per, same).select(full["uid"], full["source"], "size", "source_size", "target", "copies")


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                  weights: tuple[float, ...] = (5, 2, 1), max_repeat: float = 3, seed: int = 11) -> DataFrame:
    """``docs`` with every row as often as the mixture takes it (0 to
    ``max_repeat`` times). Rows that agree in key, source and text are one
    item of their joint size and get the same number of copies each.

    Null sources are one source, the last; a null text has no words and, like
    every text without any, is not taken. All columns stay, whatever they are
    called; an empty table stays empty."""
    ready(docs)
    h, k, src, th, c = private(docs, "h", "k", "src", "th", "copies")
    its = docs.withColumn(h, F.xxhash64(text))
    items = its.select(F.col(key).alias("k"), F.col(source).cast("string").alias("source"), F.col(h).alias("th"),
                       n_words_of(F.col(text)).alias("size"))
    items = items.groupBy("k", "source", "th").agg(F.sum("size").alias("size"))
    items = cut(numbered(items, ["k", "size", "source", "th"]))
    taken = mix(items, weights, max_repeat, seed).filter("copies > 0").select("uid", "copies")
    taken = items.join(taken, "uid").select(F.col("k").alias(k), F.col("source").alias(src), F.col("th").alias(th),
                                            F.col("copies").alias(c))
    same = (F.col(key).eqNullSafe(F.col(k)) & F.col(source).cast("string").eqNullSafe(F.col(src))
            & (F.col(h) == F.col(th)))
    out = its.join(cut(taken).hint("shuffle_hash"), same)
    return out.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(c))).alias(c)).select(*docs.columns)
