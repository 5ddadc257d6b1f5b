"""Approximate nearest neighbours by an adaptive dimension scan.

Unit vectors are rotated at random and filed in lists around centroids. A
query scans its nearest lists column block by column block: after each block a
candidate's partial distance, scaled to all dimensions, is tested against the
distance of the k-th best so far, and rejected candidates are dropped before
the next block. Only survivors get their exact cosine on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ready

#: Rotated columns read before each test, and the test's significance: a
#: candidate goes if its scaled partial distance exceeds (1 + SLACK / sqrt(d))
#: times the k-th best distance.
COLUMNS, SLACK = 16, 2.1
#: Of n lists a query scans this share and twice the root of n. Vectors
#: without structure need that much; clustered ones far less.
PROBE_SHARE = 0.5
#: The lists' centroids are fitted on at most this many vectors and bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 16_384, 32_000_000
#: Index rows and queries that meet in one task.
BLOCK_ROWS, QUERY_ROWS = 1_024, 4_096


def usable(vectors: DataFrame, vector: str, dims: int | None = None) -> DataFrame:
    """Rows whose vector has length ``dims`` (the table's commonest if None),
    no null or non-finite component, and isn't zero."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = vectors.filter(x.isNotNull() & (F.size(x) > 0)).filter(~bad & F.exists(x, lambda v: v != 0))
    if dims is not None:
        return good.filter(F.size(x) == dims)
    top = good.groupBy(F.size(x).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return good.filter(F.size(x) == (top[0]["n"] if top else -1))


def _unit(rows) -> tuple[np.ndarray, np.ndarray]:
    """Original vectors and, scaled without overflow, their unit vectors."""
    v = np.array([np.asarray(x, dtype=np.float64) for x in rows])
    s = v / np.abs(v).max(axis=1, keepdims=True)
    return v, s / np.sqrt((s * s).sum(axis=1, keepdims=True))


def rotation(dims: int, seed: int = 3) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def fit_lists(distinct: DataFrame, n: int, dims: int) -> np.ndarray:
    """Unit centroids, about sqrt(n) of them, by spherical k-means on a sample
    (by hash of the row's id) of bounded rows and bytes."""
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dims)))
    share = max(1, math.ceil(n / most))
    rows = distinct.filter(F.pmod(F.xxhash64("rep"), F.lit(share)) == 0).select("rep", "vec").limit(2 * most).collect()
    rows = sorted(rows, key=lambda r: r["rep"])
    if not rows:
        rows = distinct.orderBy("rep").select("rep", "vec").limit(1).collect()
    unit = _unit([r["vec"] for r in rows])[1]
    rng = np.random.default_rng(4)
    k = min(len(unit), max(1, round(math.sqrt(n))))
    centers = unit[rng.choice(len(unit), k, replace=False)]
    for _ in range(8):
        of = (unit @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, of, unit)
        norm = np.sqrt((sums * sums).sum(axis=1))
        centers[norm > 1e-9] = sums[norm > 1e-9] / norm[norm > 1e-9, None]
    return centers


def scan_list(rotated: np.ndarray, query: np.ndarray, best: float) -> np.ndarray:
    """Rows of one list that no test rejects, reading column block after column
    block; ``best`` is the squared distance to beat (inf: no test)."""
    rows, dims = np.arange(len(rotated)), rotated.shape[1]
    part = np.zeros(len(rotated), dtype=np.float64)
    for a in range(0, dims, COLUMNS):
        b = min(dims, a + COLUMNS)
        gap = rotated[rows, a:b] - query[a:b]
        part = part + np.einsum("ij,ij->i", gap, gap)
        limit = best * (1 + SLACK / math.sqrt(b)) ** 2 if b < dims else best * (1 + 1e-5) + 1e-9
        keep = part * (dims / b) <= limit
        rows, part = rows[keep], part[keep]
        if not len(rows):
            break
    return rows


def scan_block(index: pd.DataFrame, queries: pd.DataFrame, centers: np.ndarray,
               turn: np.ndarray, k: int, probes: int) -> pd.DataFrame:
    """The k best candidates of one index block for each of its queries."""
    vec, unit = _unit(index["vec"])
    rot = (unit @ turn).astype(np.float32)
    norm = np.sqrt((vec * vec).sum(axis=1))
    lists = index["list"].to_numpy()
    order = np.argsort(lists, kind="stable")
    names, first = np.unique(lists[order], return_index=True)
    rows_of = np.split(order, first[1:])
    parts = [np.ascontiguousarray(rot[r]) for r in rows_of]
    ids = index["ids"].tolist()
    qvec, qunit = _unit(queries["vec"])
    qrot = (qunit @ turn).astype(np.float32)
    near = qunit @ centers.T
    bound = -np.partition(-near, min(probes, near.shape[1]) - 1, axis=1)[:, min(probes, near.shape[1]) - 1]
    out_q, out_id, out_s = [], [], []
    for i, rep in enumerate(queries["rep"].tolist()):
        here = near[i, names]
        found, dist, best = np.zeros(0, dtype=np.int64), np.zeros(0), np.inf
        for j in np.argsort(-here, kind="stable"):
            if here[j] < bound[i]:
                break
            rows = rows_of[j][scan_list(parts[j], qrot[i], best)]
            gap = rot[rows] - qrot[i]
            found = np.r_[found, rows]
            dist = np.r_[dist, np.einsum("ij,ij->i", gap, gap)]
            if len(found) >= k:
                best = float(np.partition(dist, k - 1)[k - 1])
                keep = dist <= best * (1 + 1e-5) + 1e-9
                found, dist = found[keep], dist[keep]
        if not len(found):
            continue
        score = (vec[found] * qvec[i]).sum(axis=1) / (norm[found] * math.sqrt(float((qvec[i] * qvec[i]).sum())))
        each = sorted((-s, v) for s, r in zip(score.tolist(), found.tolist()) for v in ids[r])[:k]
        out_q += [rep] * len(each)
        out_id += [v for _, v in each]
        out_s += [-s for s, _ in each]
    return pd.DataFrame({"rep": np.array(out_q, dtype=np.int64), "vec_id": np.array(out_id, dtype=np.int64),
                         "score": np.array(out_s, dtype=np.float64)})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id",
            vector: str = "embedding", probe_share: float = PROBE_SHARE) -> DataFrame:
    """``query_id, rank`` (from 1), ``vec_id, score``: each query's ``k``
    nearest found by cosine, ties to the smaller id, without its own row.

    ``queries`` are rows of ``vectors`` (by id). Vectors that are null, zero,
    of another length or with null or non-finite components take no part; nor
    do rows with a null id. Equal vectors are one index row with their k + 1
    smallest ids (an id of several vectors is listed once, at its best), so a
    vector of any frequency costs one comparison; equal
    queries are searched once. A list of any size is dealt to several blocks.
    With fewer candidates than k all are returned; an empty table gives an
    empty result.
    """
    spark = ready(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    plain = lambda df, dims=None: usable(df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).filter("id is not null"), "vec", dims)
    rows = plain(vectors)
    firsts = Window.partitionBy("vec").orderBy("id")
    distinct = cut(
        rows.withColumn("_n", F.dense_rank().over(firsts)).filter(F.col("_n") <= k + 1)
        .groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))  # k + 1 at most
        .withColumn("rep", F.get("ids", F.lit(0)))
    )
    n = distinct.count()
    if not n:
        return spark.createDataFrame([], schema)
    dims = len(distinct.select("vec").first()["vec"])
    centers, turn = fit_lists(distinct, n, dims), rotation(dims)
    probes = math.ceil(len(centers) * probe_share + 2 * math.sqrt(len(centers)))
    held = spark.sparkContext.broadcast((centers, turn))  # sqrt(n) and dims rows of dims

    @F.pandas_udf("int")
    def list_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series((_unit(x)[1] @ held.value[0].T).argmax(axis=1).astype(np.int32) if len(x) else np.zeros(0, np.int32))

    asked = cut(plain(queries, dims).select(F.col("id").alias("query_id"), "vec"))
    points = cut(asked.select("vec").distinct().join(distinct.select("vec", "rep"), "vec").select("rep", "vec"))
    n_points = points.count()
    blocks, turns = max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(n_points / QUERY_ROWS))
    # Rows of a list lie together; a list over a block's size goes on to the next.
    filed = cut(distinct.withColumn("list", list_of("vec")))
    sizes = filed.groupBy("list").agg(F.count("*").alias("_size"))
    start = Window.orderBy("list").rowsBetween(Window.unboundedPreceding, -1)  # sqrt(n) rows
    sizes = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(start), F.lit(0)))
    index = (
        filed.join(F.broadcast(sizes), "list")  # sqrt(n) rows
        .withColumn("block", ((F.col("_start") + F.pmod(F.xxhash64("rep"), F.col("_size"))) / BLOCK_ROWS).cast("int"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
        .select("block", "turn", "list", "ids", "vec")
    )
    sent = (
        points.withColumn("turn", F.pmod(F.xxhash64("rep"), F.lit(turns)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"rep": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"),
                                 "score": pd.Series([], dtype="float64")})
        c, t = held.value
        return scan_block(left, right, c, t, k + 1, probes)

    keys = ["block", "turn"]
    found = index.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(scan, "rep long, vec_id long, score double")
    best = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1).drop("_r")
    its = asked.join(distinct.select("vec", "rep"), "vec").select("query_id", "rep")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        its.distinct().join(found, "rep").filter("vec_id <> query_id")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
