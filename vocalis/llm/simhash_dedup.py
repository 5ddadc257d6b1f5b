"""SimHash near-duplicates: vantage-point trees over Hamming distance.

Two fingerprints at distance 3 or less agree in one of four 16-bit words, so a
tree of vantage points over the values of each word, descended with reach 0,
brings each such pair together in a shard of that word: a fingerprint lies in
one shard a word, whatever the table's size. A word's value that alone is too
big for a shard is cut again by the trees of the other words, in one of which
the pair differs in a bit at most; there a fingerprint lives in one shard and
visits, as a query, those that the triangle bounds don't exclude. Inside a
shard a tree over the whole 64 bits is descended for all queries together;
only a spanning forest of the links leaves a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, private, ready

#: Distinct fingerprints that one shard should hold, and the size below which
#: a tree node is compared directly.
SHARD, LEAF = 8_000, 128
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bytes of text whose shingles are counted at once.
AT_ONCE = 400_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]").search


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """A bit is 1 if set in over half of the shingles' XXH64 hashes."""
    if text is None:
        return 0
    h, raw = xxhash.xxh64_intdigest, text.encode("utf-8", "surrogatepass").translate(_LOWER)
    counts, n, held, at = np.zeros(64, dtype=np.int64), 0, [], 0
    while at < len(raw):
        end = at + AT_ONCE
        space = _SPACE(raw, end) if end < len(raw) else None
        end = space.start() if space else len(raw)
        words = held + raw[at:end].split()
        at = end
        hashes = [h(b" ".join(s), seed) for s in zip(*[words[k:] for k in range(shingle)])]
        if hashes:
            bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            n += len(hashes)
        held = words[-(shingle - 1):] if shingle > 1 else []
    if not n:  # fewer words than a shingle has
        return h(b" ".join(held), seed) if held else 0
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with ``fp`` (long, the 64 bits) of each whole text; 0 for a
    null text or one without words."""
    ready(docs)

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(out.view(np.int64))

    return docs.withColumn("fp", fp(F.col(text)))


def _distance(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to).astype(np.int16)


def _vantage(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The vantage point, of a few, whose median cut leaves the fewest points
    within reach of the boundary; None if nothing can be cut."""
    best = None
    for v in points[:: max(1, len(points) // 6)][:6]:
        d = _distance(points, v)
        mu = int(np.median(d))
        if d.max() <= mu:
            mu -= 1
        if mu < 0 or not (d <= mu).any():
            continue
        near = int((np.abs(d - mu) <= 3).sum())
        if best is None or near < best[0]:
            best = (near, v, mu)
    return best and (best[1], best[2])


class WordTree:
    """Vantage points over the values of a word of ``bits`` bits, cut at the
    weighted median distance until a leaf weighs ``most`` or is one value."""

    def __init__(self, weights: np.ndarray, most: float):
        self.nodes: dict[int, tuple[int, int, int, int]] = {}
        self.leaf = np.zeros(len(weights), dtype=np.int64)  # of each value
        todo, n = [(0, np.flatnonzero(weights))], 1
        while todo:
            at, values = todo.pop()
            self.leaf[values] = at
            if len(values) < 2 or weights[values].sum() <= most:
                continue
            best = None
            for v in values[:: max(1, len(values) // 4)][:4]:
                d = np.bitwise_count(values ^ v)
                held = np.cumsum(np.bincount(d, weights=weights[values]))[:int(d.max())]
                mu = int(np.abs(held / weights[values].sum() - 0.5).argmin())
                off = abs(held[mu] / weights[values].sum() - 0.5)
                if best is None or off < best[0]:
                    best = (off, int(v), mu)
            _, v, mu = best
            inner = np.bitwise_count(values ^ v) <= mu
            self.nodes[at] = (v, mu, n, n + 1)
            todo += [(n, values[inner]), (n + 1, values[~inner])]
            n += 2

    def visits(self, values: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, leaf and whether it is the value's own, for all leaves that a
        value within ``reach`` could lie in."""
        out = []
        todo = [(0, np.arange(len(values)), np.ones(len(values), dtype=bool))]
        while todo:
            at, rows, own = todo.pop()
            if not len(rows):
                continue
            if at not in self.nodes:
                out.append((rows, np.full(len(rows), at, dtype=np.int64), own))
                continue
            v, mu, near, far = self.nodes[at]
            d = np.bitwise_count(values[rows] ^ v).astype(np.int64)
            left, right = d - reach <= mu, d + reach > mu
            todo.append((near, rows[left], own[left] & (d[left] <= mu)))
            todo.append((far, rows[right], own[right] & (d[right] > mu)))
        return tuple(np.concatenate(x) for x in zip(*out))


class Router:
    """Shards of fingerprints by the values of their words, from exact counts
    ``weights`` [word, value] of the distinct fingerprints."""

    def __init__(self, weights: np.ndarray, reach: int, shard: int):
        self.words, size = weights.shape
        self.bits = size.bit_length() - 1
        self.reach = reach // (self.words - 1)  # in one of the other words, once a word agrees
        trees = [WordTree(w, shard) for w in weights]
        self.leaf = np.stack([t.leaf for t in trees])
        # Values too big for a shard, by how often they must be halved.
        self.halved = np.ceil(np.log2(np.maximum(weights / shard, 1))).astype(np.int64)
        self.again = {(v, int(c)): WordTree(w, w.sum() / 2.0 ** c)
                      for c in np.unique(self.halved[self.halved > 0]) for v, w in enumerate(weights)}

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, shard and whether the point is one of the shard's own."""
        mask = np.uint64((1 << self.bits) - 1)
        word = [((points >> np.uint64(self.bits * j)) & mask).astype(np.int64) for j in range(self.words)]
        out = []
        for j in range(self.words):
            halved = self.halved[j][word[j]]
            row = np.flatnonzero(halved == 0)
            out.append((row, (self.leaf[j][word[j][row]] << 2) + j, np.ones(len(row), dtype=bool)))
            for c in np.unique(halved[halved > 0]):
                heavy = np.flatnonzero(halved == c)
                for v in range(self.words):
                    if v != j:
                        at, leaf, own = self.again[v, int(c)].visits(word[v][heavy], self.reach)
                        shard = (1 << 62) + (((word[j][heavy[at]] << 20) + leaf) << 4) + (j << 2) + v
                        out.append((heavy[at], shard, own))
        return tuple(np.concatenate(x) for x in zip(*out))


class _Forest:
    """Union-find over array positions, least position as root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while True:
            n = self.up[r]
            if (n == r).all():
                self.up[at] = r
                return r
            r = n

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join a[i] and b[i] for all i."""
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            open_ = ra != rb
            if not open_.any():
                return
            a, b = np.minimum(ra[open_], rb[open_]), np.maximum(ra[open_], rb[open_])
            self.up[b] = a  # of several writes one stays; the others come again


def shard_forest(fps: np.ndarray, own: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) that join, within one shard, all pairs of an
    own point and a query at ``reach`` or less.

    A node's vantage point halves the points; queries follow into every half
    that the triangle bound doesn't exclude. Points within reach of the
    vantage point are linked at once, and a branch whose members already form
    one component is left: its pairs add nothing, which keeps dense groups of
    near copies from being compared pair by pair."""
    forest = _Forest(len(fps))
    todo = [(np.flatnonzero(own), np.arange(len(fps)))]
    while todo:
        points, queries = todo.pop()
        if not len(points) or not len(queries):
            continue
        roots = forest.roots(queries)
        if (roots == roots[0]).all() and (forest.roots(points) == roots[0]).all():
            continue
        if len(points) > LEAF:
            found = _vantage(fps[points])
            if found:
                v, mu = found
                at = points[np.argmin(_distance(fps[points], v))]
                dq, dp = _distance(fps[queries], v), _distance(fps[points], v)
                close = queries[dq <= reach]
                forest.link(close, np.full(len(close), at))
                todo.append((points[dp <= mu], queries[dq - reach <= mu]))
                todo.append((points[dp > mu], queries[dq + reach > mu]))
                continue
        step = max(1, 2_000_000 // len(points))
        for a in range(0, len(queries), step):
            q = queries[a:a + step]
            i, j = np.nonzero(np.bitwise_count(fps[q][:, None] ^ fps[points][None, :]) <= reach)
            forest.link(q[i], points[j])
    roots = forest.roots(np.arange(len(fps)))
    linked = roots != np.arange(len(fps))
    return fps[linked], fps[roots[linked]]


def links(fps: DataFrame, reach: int = 3) -> DataFrame:
    """``a, b``: a forest over the distinct fingerprints ``fp`` whose trees
    are the components of "differ in at most ``reach`` bits" (3 or less).

    The driver sees how many fingerprints have each value of each 16-bit word,
    at most 4 * 65,536 counts, and sends out the shard of each value."""
    spark = ready(fps)
    if reach > 3:
        raise ValueError("two fingerprints over 3 bits apart need not agree in one of four words")
    words = F.array(*[F.struct(F.lit(j).alias("j"), F.shiftrightunsigned("fp", 16 * j).bitwiseAND(0xFFFF).alias("w"))
                      for j in range(4)])
    weights = np.zeros((4, 1 << 16), dtype=np.int64)
    for r in fps.select(F.explode(words).alias("x")).groupBy("x.j", "x.w").count().collect():
        weights[r["j"], r["w"]] = r["count"]
    router = spark.sparkContext.broadcast(Router(weights, reach, SHARD))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            points = pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            rows, shard, own = router.value.route(points)
            yield pd.DataFrame({"shard": shard, "fp": points[rows].view(np.int64), "own": own})

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fp", kind="stable")
        a, b = shard_forest(pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64), pdf["own"].to_numpy(dtype=bool), reach)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    routed = fps.mapInPandas(route, "shard long, fp long, own boolean")
    return routed.groupBy("shard").applyInPandas(join, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (least node of its component, as signed longs) for all
    nodes of the edges ``a, b``: large-star and small-star rounds (each node's
    neighbours are hung on the least one) until nothing changes. No node's
    neighbours meet in one list: a round is aggregates and equi-joins."""
    def least(e: DataFrame, key: str, other: str) -> DataFrame:
        return e.groupBy(key).agg(F.min(other).alias("m"))

    edges = cut(edges.filter("a <> b").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: neighbours above a node go to its least neighbour.
        m = least(both, "a", "b").select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(m, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()  # a > b now
        # Small star: a node and its neighbours below go to the least of them.
        low = least(large, "a", "b")
        small = (
            large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        )
        edges = cut(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = 3, reach: int = 3) -> DataFrame:
    """``key, h, fp, root, component_id`` for each row of ``docs``: ``h`` hashes
    the text, ``root`` names the component and ``component_id`` is the
    smallest ``key`` among all documents that chains of fingerprints at
    ``reach`` bits or less lead to, its own included.

    Equal fingerprints count as one point, so a group of copies of any size is
    one row in the search. Null or wordless texts have fingerprint 0 and are
    linked like any other; null keys are passed over by the minimum (a group
    of nulls alone gets null). Repeated rows stay. An empty table gives an
    empty result. Texts are read once and not shuffled.
    """
    ready(docs)
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = cut(fingerprints(plain, "text", shingle).select("key", "h", "fp"))
    return rows.join(labelled(rows, "key", reach), "fp").select("key", "h", "fp", "root", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text",
             shingle: int = 3, reach: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the least key (nulls
    last), among its rows the one of the least text hash. All columns stay,
    whatever they are called; null and wordless texts are one component; an
    empty table stays empty."""
    rows = near_duplicates(docs, key, text, shingle, reach)
    h, bk, bh = private(docs, "h", "bk", "bh")
    order = F.struct(F.col("key").isNull().alias("n"), F.col("key").alias("k"), F.col("h").alias("h"))
    best = cut(rows.groupBy("root").agg(F.min(order).alias("b")).select(
        F.col("b.k").alias(bk), F.col("b.h").alias(bh)))
    its = docs.withColumn(h, F.xxhash64(text))
    its = its.join(best.hint("shuffle_hash"), its[key].eqNullSafe(best[bk]) & (its[h] == best[bh]))
    # Repeated rows of a survivor meet in its own partition.
    return its.dropDuplicates([key, h]).select(*docs.columns)


def labelled(rows: DataFrame, key: str, reach: int) -> DataFrame:
    """``fp, root, component_id`` for stored rows ``key, fp``."""
    per = cut(rows.groupBy("fp").agg(F.min(key).alias("least")))
    found = components(links(per.select("fp"), reach))
    per = per.join(found, per["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = per.groupBy("root").agg(F.min("least").alias("component_id"))
    return per.join(ids, "root").select("fp", "root", "component_id")
