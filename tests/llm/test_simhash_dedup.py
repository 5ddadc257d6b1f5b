import random

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import documents, edge_rows, prose, with_clashes
from vocalis.llm import simhash_dedup as S
from vocalis.llm.registry import QUERIES


def fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    words = low.split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(fps, reach=3):
    """fps: list; index of the first member of each one's component."""
    n, up = len(fps), list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    a = np.array(fps, dtype=np.uint64)
    for i in range(n):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= reach) + i + 1:
            x, y = sorted((root(i), root(int(j))))
            up[y] = x
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_all_pairs(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    fps = [fingerprint(t) for _, t in docs]
    want = {d: (f"{f:016x}", docs[k][0]) for (d, _), f, k in zip(docs, fps, components(fps))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op10_simhash"](spark, sf).collect()}
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_sharded_search_equals_all_pairs(spark, seed, monkeypatch):
    """Many shards, chains across them, and dense groups."""
    monkeypatch.setattr(S, "SHARD", 60)
    monkeypatch.setattr(S, "LEAF", 8)
    rng = random.Random(seed)
    fps = [rng.getrandbits(64) for _ in range(500)]
    for _ in range(700):
        x = rng.choice(fps)
        for _ in range(rng.randint(1, 4)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    x = rng.getrandbits(64)
    for _ in range(40):  # a chain
        x ^= 7 << rng.randrange(60)
        fps.append(x)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    found = {r["node"] & (2**64 - 1): r["root"] & (2**64 - 1) for r in S.components(S.links(df)).collect()}
    want = components(fps)
    groups, ours = {}, {}
    for f, k in zip(fps, want):
        groups.setdefault(k, set()).add(f)
    for f in fps:
        ours.setdefault(found.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))


@pytest.mark.parametrize("n", [50_000, 250_000, 1_000_000, 4_000_000])
def test_copies_do_not_grow(n):
    """Four copies of each fingerprint and bounded shards, at any size."""
    points = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64)
    weights = np.stack([np.bincount(((points >> np.uint64(16 * j)) & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)
                        for j in range(4)])
    rows, shard, own = S.Router(weights, 3, S.SHARD).route(points)
    assert len(rows) == 4 * n and own.all()
    assert np.unique(shard, return_counts=True)[1].max() <= S.SHARD


def test_values_too_big_for_a_shard_are_cut_again():
    """One value of a word holds a third of all: pairs still meet, in smaller shards."""
    rng = np.random.default_rng(2)
    points = rng.integers(0, 2**64, 6000, dtype=np.uint64)
    points[:2000] = (points[:2000] & ~np.uint64(0xFFFF)) | np.uint64(77)
    flips = np.uint64(1) << rng.integers(16, 64, (2000, 3)).astype(np.uint64)
    near = points[:2000] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]
    points = np.unique(np.concatenate([points, near]))
    weights = np.stack([np.bincount(((points >> np.uint64(16 * j)) & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)
                        for j in range(4)])
    rows, shard, own = S.Router(weights, 3, 200).route(points)
    assert len(rows) < 40 * len(points)
    at = {}
    for r, x, o in zip(rows.tolist(), shard.tolist(), own.tolist()):
        at.setdefault(int(points[r]), [set(), set()])[0].add(x)
        if o:
            at[int(points[r])][1].add(x)
    assert max(np.unique(shard, return_counts=True)[1]) < 2000
    for a in range(0, len(points), 500):
        i, j = np.nonzero(np.bitwise_count(points[a:a + 500, None] ^ points[None]) <= 3)
        for x, y in zip(points[a:a + 500][i].tolist(), points[j].tolist()):
            assert at[x][0] & at[y][1]  # x visits a shard of y's


def test_edges(spark):
    base = prose(3, 200)
    rows = edge_rows() + [(50, base, "a"), (51, base + " tail", "a"), (52, base.upper(), "a"), (49, "\n" + base, "b")]
    docs = with_clashes(documents(spark, rows), "fp", "root", "h", "component_id")
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    fps = [fingerprint(t) for _, t, _ in rows]
    least = {}
    for (d, _, _), k in zip(rows, components(fps)):
        if d is not None:
            least[k] = min(least.get(k, d), d)
    want = sorted((str(d), str(least.get(k))) for (d, _, _), k in zip(rows, components(fps)))
    assert sorted((str(r["key"]), str(r["component_id"])) for r in got) == want
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(components(fps)))
    assert S.near_duplicates(docs.limit(0)).count() == 0 and S.keep_one(docs.limit(0)).count() == 0


def test_long_texts_are_hashed_whole(monkeypatch):
    text = prose(8, 3000)
    monkeypatch.setattr(S, "AT_ONCE", 100)
    assert S.fingerprint(text) == fingerprint(text)
    assert S.fingerprint("x " * 5000 + "y" * 900 + "  \n") == fingerprint("x " * 5000 + "y" * 900 + "  \n")
    assert S.fingerprint("One two") == xxhash.xxh64_intdigest(b"one two", 42)


def test_internal_names_do_not_clash(spark):
    names = ["_h", "_bk", "_bh", "h", "bk", "bh", "key", "fp", "root", "shard", "own"]
    docs = documents(spark, edge_rows())
    got = S.keep_one(with_clashes(docs, *names))
    assert got.columns == docs.columns + names
    assert all(r[n] == "clash" for r in got.collect() for n in names)
