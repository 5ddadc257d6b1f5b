import hashlib
import math

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import with_clashes
from vocalis.llm import vector_codes as V
from vocalis.llm.registry import ORACLES, QUERIES

ROWS = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    """(sorted (vec_id, codes, error, label_error), codebooks) in plain integers."""
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], g) for i, v, g in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            its = {}
            for c in cut:
                its.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(its[k]) for x in zip(*its[k])] if k in its else e for k, e in enumerate(books[p])]
    out, total = [], {}
    for (i, _, g), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append([i, [k for _, k in found], sum(d for d, _ in found), g])
        total[g] = total.get(g, 0) + out[-1][2]
    return sorted(((i, k, e, total[g]) for i, k, e, g in out), key=str), books


def run(spark, rows, **kw):
    df = with_clashes(spark.createDataFrame(rows, ROWS), "key", "v", "codes", "its", "error", "n", "s0")
    coded, books = V.compress(df, **kw)
    return sorted(((r["key"], r["codes"], r["error"], r["label_error"]) for r in coded.collect()), key=str), books.tolist()


def vectors(seed, n, dims, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return [(int(i), [float(np.float32(x)) for x in centres[i % 12] + spread * rng.normal(size=dims)], int(i % 5)) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_plain_integers(spark, spread):
    rows = vectors(3, 300, 16, spread)
    rows += [(1000 + k, rows[k][1], None) for k in range(30)] + [rows[7], rows[7]]  # equal vectors, repeated rows
    rows += [(2000, None, 1), (2001, [float("nan")] * 16, 1), (2002, [None] + [0.0] * 15, 1), (2003, [float("inf")] * 16, 2),
             (2004, [0.0] * 16, None), (2005, [-0.0] * 16, 3), (None, [0.5] * 16, 3), (None, [0.25] * 16, None)]
    want = plain(rows, entries=40)
    got = run(spark, rows, entries=40)
    assert got[0] == want[0] and got[1] == want[1]


def test_ties_take_the_lowest_index():
    book = V.Codebook(np.array([[2, 0], [0, 2], [2, 0], [0, 0], [0, 0]]))
    points = np.array([[1, 1], [2, 0], [0, 0], [1, 0], [-5, -5]])
    at, far = V.assign(points, book)
    assert at.tolist() == [0, 0, 3, 0, 3] and far.tolist() == [2, 0, 0, 1, 50]


def test_masks_are_the_box(spark):
    rng = np.random.default_rng(1)
    entries, points = rng.integers(-50, 50, (100, 5)), rng.integers(-60, 60, (80, 5))
    book, radius = V.Codebook(entries), rng.integers(0, 60, 80)
    held = np.unpackbits(book.within(points, radius).view(np.uint8), axis=1, bitorder="little")[:, :100]
    want = (np.abs(points[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
    assert (held == want).all()


@pytest.mark.parametrize("top", [300, (1 << 25) - 1])  # floats, and beyond them 64-bit integers
def test_search_equals_all_pairs(top):
    rng = np.random.default_rng(top)
    entries, points = rng.integers(-top, top, (200, 16)), rng.integers(-top, top, (500, 16))
    d = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    at, far = V.assign(points, V.Codebook(entries))
    assert (at == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all()


def test_few_none_and_other_lengths(spark):
    rows = vectors(5, 9, 8)
    assert run(spark, rows)[0] == plain(rows)[0]  # fewer vectors than entries
    assert run(spark, [*rows, (50, [1.0] * 4, 1), (51, [], 2)])[0] == plain(rows)[0]
    assert run(spark, [])[0] == [] and run(spark, [(1, None, None)])[0] == []
    with pytest.raises(ValueError, match="equal parts"):
        run(spark, [(1, [1.0] * 6, 1)])
    with pytest.raises(Exception, match="component of"):
        run(spark, [(1, [1e30] * 8, 1)])


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '/root/testdata/sf{sf}/embeddings.parquet'")
    cols = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = con.sql(f"select {', '.join(cols)} from ({ORACLES['op13_vector_codes']})").fetchall()
    got = QUERIES["op13_vector_codes"](spark, f"/root/testdata/sf{sf}").select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert len(got[0]["codebooks_sha256"]) == len(hashlib.sha256(b"").hexdigest())
