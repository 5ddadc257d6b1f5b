import numpy as np
import pytest

from vocalis.llm import ann
from vocalis.llm.registry import QUERIES


def brute(rows, k=5, step=50):
    """rows: (id, vector); the contract's search, all pairs."""
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None
          and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out = {}
    for i, q in ok:
        if i % step:
            continue
        scored = sorted((-(q @ v) / np.sqrt((q @ q) * (v @ v)), j) for j, v in ok if j != i)[:k]
        out[i] = [(j, -s) for s, j in scored]
    return out


def collect(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_recall_and_scores_on_the_table(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute(rows), collect(QUERIES["op2_dimension_scan"](spark, sf))
    assert got.keys() == want.keys()
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    exact = {i: np.array(v, dtype=np.float64) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 5 and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        for j, s in found:
            a, b = exact[q], exact[j]
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_a_whole_scan_is_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=12)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collect(ann.nearest(df, df.filter("vec_id % 20 = 0"), probe_share=1.0))
    want = brute(rows, step=20)
    same = sum([j for j, _ in got[q]] == [j for j, _ in want[q]] for q in want)
    assert same >= 0.9 * len(want)


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(i, v) for i in range(40)] + [(50, [3.0, 2.0, 1.0]), (100, None), (150, [0.0, 0.0, 0.0]),
            (200, [float("nan"), 1.0, 1.0]), (250, [None, 1.0, 1.0]), (300, [float("inf"), 1.0, 1.0]),
            (350, [1.0]), (None, v), (400, [1e200, 0.0, 0.0]), (0, v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collect(ann.nearest(df, df.filter("vec_id % 50 = 0"), probe_share=1.0))
    assert set(got) == {0, 50, 400}
    assert [j for j, _ in got[0]] == [1, 2, 3, 4, 5]  # ties to the smaller id, not its own
    assert [j for j, _ in got[50]] == [0, 1, 2, 3, 4]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0
    two = spark.createDataFrame([(0, v), (1, [1.0, 0.0, 0.0])], df.schema)
    assert [j for j, _ in collect(ann.nearest(two, two.filter("vec_id = 0")))[0]] == [1]


def test_queries_have_the_length_of_the_table(spark):
    """Most vectors have 3 numbers, most of the queries 2."""
    rows = [(i, [1.0 + i, 2.0, 3.0]) for i in range(6)] + [(10, [1.0, 2.0]), (11, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collect(ann.nearest(df, df.filter("vec_id in (0, 10, 11)"), probe_share=1.0))
    assert set(got) == {0} and [j for j, _ in got[0]] == [1, 2, 3, 4, 5]


def test_the_test_abandons_far_candidates():
    rng = np.random.default_rng(0)
    near, far = rng.normal(0, 0.01, (10, 64)), rng.normal(0, 1, (500, 64)) + 3
    rows = ann.scan_list(np.concatenate([near, far]).astype(np.float32), np.zeros(64, np.float32), 0.1)
    assert rows.tolist() == list(range(10))
