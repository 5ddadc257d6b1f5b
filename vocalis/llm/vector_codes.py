"""Vector codes by product quantization, assigned by slicing and intersecting.

A vector is cut into equal parts, each part named by its nearest codebook
entry. To find that entry without comparing all: per dimension the entries'
coordinates are sorted, with bit masks of the first j entries in that order.
The entries within a radius of a coordinate are a range of the order, hence
the difference of two prefix masks; ANDed over all dimensions they are the
entries inside a box, which holds every entry within the radius.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import cut, ready

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integer components stay below this in size, so that the squared distances
#: of vectors of up to 2,000 dimensions fit 64 bits.
LIMIT = 1 << 25
#: Parts compared at once.
AT_ONCE = 2_048


class Codebook:
    """Entries (rows of integers) of one part position, sliced for search."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.ascontiguousarray(entries, dtype=np.int64)
        n, dims = self.entries.shape
        self.order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(self.entries, self.order, axis=0).T)
        words = (n + 63) // 64
        self.masks = np.zeros((dims, n + 1, words), dtype=np.uint64)  # [d, j]: the first j entries in order
        for d in range(dims):
            bit = np.zeros((n, words), dtype=np.uint64)
            bit[np.arange(n), self.order[:, d] // 64] = np.uint64(1) << (self.order[:, d] % 64).astype(np.uint64)
            self.masks[d, 1:] = np.bitwise_or.accumulate(bit, axis=0)
        # The dimension that spreads the entries most gives the first guesses.
        self.largest = int(np.abs(self.entries).max(initial=0))
        self.widest = int(np.argmax(self.entries.astype(np.float64).var(axis=0))) if n else 0

    def within(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """[point, word] masks of the entries whose every coordinate is within
        ``radius`` of the point's."""
        held = None
        for d in range(points.shape[1]):
            x = points[:, d]
            low = np.searchsorted(self.sorted[d], x - radius, "left")
            high = np.searchsorted(self.sorted[d], x + radius, "right")
            slice_ = self.masks[d, high] & ~self.masks[d, low]
            held = slice_ if held is None else held & slice_
        return held

    def guess(self, points: np.ndarray) -> np.ndarray:
        """An entry close in the widest dimension, to set the radius by."""
        d = self.widest
        at = np.searchsorted(self.sorted[d], points[:, d])
        return self.order[np.minimum(at, len(self.entries) - 1), d]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index (ties: lowest) and squared distance of each point's nearest
        entry. The distance of an entry at hand, rounded up, is a radius whose
        box holds the nearest entry and all that tie with it. A box of a third
        of that radius comes first: the nearest entry inside, where there is
        one, makes the last box smaller."""
        best = self.guess(points)
        kind = np.float64 if 4 * max(self.largest, int(np.abs(points).max(initial=0))) ** 2 * points.shape[1] < 1 << 53 else np.int64
        exact, entries = points.astype(kind), self.entries.astype(kind)  # floats hold these integers exactly
        gap = exact - entries[best]
        far = np.einsum("ij,ij->i", gap, gap)
        for part in (3, 1):
            radius = np.ceil(np.sqrt(far.astype(np.float64)) / part).astype(np.int64) + 1
            self._better(exact, entries, self.within(points, radius), best, far)
        return best, far.astype(np.int64)

    def _better(self, points: np.ndarray, entries: np.ndarray, masks: np.ndarray, best: np.ndarray, far: np.ndarray) -> None:
        """Compare each point with the entries of its mask, a byte at a time:
        points with any of eight entries in their boxes meet those together."""
        own = np.einsum("ij,ij->i", points, points)
        none = np.inf if points.dtype == np.float64 else np.iinfo(np.int64).max
        for k, byte in enumerate(np.ascontiguousarray(masks.view(np.uint8)[:, :(len(entries) + 7) // 8].T)):
            row = np.flatnonzero(byte)
            if not len(row):
                continue
            some = entries[8 * k:8 * k + 8]
            inside = np.unpackbits(byte[row][:, None], axis=1, count=len(some), bitorder="little").astype(bool)
            d = own[row][:, None] - 2 * (points[row] @ some.T) + np.einsum("ij,ij->i", some, some)
            d = np.where(inside, d, none)
            at = d.argmin(axis=1)  # the lowest of those that tie
            d, at, had = d[np.arange(len(row)), at], at + 8 * k, far[row]
            closer = (d < had) | ((d == had) & (at < best[row]))
            best[row[closer]], far[row[closer]] = at[closer], d[closer]


def assign(points: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    found = [book.nearest(points[a:a + AT_ONCE]) for a in range(0, len(points), AT_ONCE)]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def integers(rows: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """``rows`` with the vector as integers floor(scale * x); without those
    whose vector is null or has null or non-finite components."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    small = F.forall(vector, lambda x: F.abs(x.cast("double")) < LIMIT / scale)
    kept = rows.filter(F.col(vector).isNotNull() & fine)
    too_big = F.raise_error(F.lit(f"a vector component of {LIMIT / scale} or more")).cast("array<bigint>")
    return kept.withColumn(vector, F.when(small, whole).otherwise(too_big))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def train(rows: DataFrame, dims: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks [part, entry, dimension] from stored rows ``key, v``: the
    vectors of the least keys (nulls last, ties by vector) to begin with, then
    ``rounds`` times floor means of the parts assigned to each entry. Tasks
    send sums per batch; the driver sees parts * entries rows of them."""
    width = dims // parts
    order = [F.col("key").asc_nulls_last(), F.col("v")]
    first = rows.orderBy(*order).limit(entries).select("v").collect()
    books = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    sums = [f"s{k}" for k in range(width)]
    for _ in range(rounds):
        sent = books.copy()

        def add(batches):
            sliced = [Codebook(b) for b in sent]
            for batch in batches:
                v = _matrix(batch.column(0), dims)
                for p, book in enumerate(sliced):
                    points = v[:, p * width:(p + 1) * width]
                    at, _ = assign(points, book)
                    n = np.bincount(at, minlength=len(book.entries))
                    total = np.zeros((len(n), width), dtype=np.int64)
                    np.add.at(total, at, points)
                    on = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(on), p)), pa.array(on), pa.array(n[on]),
                         *[pa.array(total[on, k]) for k in range(width)]], ["part", "entry", "n", *sums])

        schema = "part long, entry long, n long, " + ", ".join(f"{s} long" for s in sums)
        found = rows.select("v").mapInArrow(add, schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in sums])
        books = books.copy()
        for r in found.collect():
            books[r["part"], r["entry"]] = [int(r[s]) // r["n"] for s in sums]
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in order, as comma-joined decimals."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """Stored rows ``key, label, v`` with ``codes`` (array of entry indexes) and
    ``error`` (squared distances summed over the parts)."""
    parts, n, width = books.shape
    sent = books.copy()
    schema = StructType([*rows.drop("v").schema.fields, StructField("codes", ArrayType(IntegerType())),
                         StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = [Codebook(b) for b in sent]
        for batch in batches:
            v = _matrix(batch.column(batch.num_columns - 1), parts * width)
            codes, error = np.zeros((len(v), parts), dtype=np.int32), np.zeros(len(v), dtype=np.int64)
            for p, book in enumerate(sliced):
                codes[:, p], far = assign(v[:, p * width:(p + 1) * width], book)
                error += far
            listed = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * parts, codes.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], listed, pa.array(error)], [*batch.schema.names[:-1], "codes", "error"])

    plain = [c for c in rows.columns if c != "v"]
    return rows.select(*plain, "v").mapInArrow(run, schema)


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``key, label, codes, error, label_error`` of every kept vector, and the
    codebooks [part, entry, dimension] that the codes point into.

    Rows with a null vector, or null or non-finite components, are dropped, as
    are those of another length than the commonest (ties: the longest), which
    must be a multiple of ``parts``; a component of LIMIT / SCALE or more is an error,
    as its squares would not fit. Fewer vectors than ``entries`` give as many
    entries; none give an empty result. Repeated keys and rows stay, null keys
    too. ``label_error`` sums ``error`` over equal labels, nulls together; a
    label may hold any share of the rows. Only the three columns are read.
    """
    ready(vectors)
    plain = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("v"))
    rows = integers(plain, "v")
    sizes = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = sizes["dims"] if sizes else parts
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    rows = cut(rows.filter(F.size("v") == dims))
    books = train(rows, dims, parts, entries, rounds)
    coded = cut(encode(rows, books)) if books.size else rows.drop("v").withColumns(
        {"codes": F.array().cast("array<int>"), "error": F.lit(0).cast("long")})
    total = coded.groupBy(F.col("label").alias("its")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(total, F.col("label").eqNullSafe(F.col("its"))).drop("its"), books
