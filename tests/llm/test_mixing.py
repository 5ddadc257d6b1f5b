import math
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, edge_rows, prose, with_clashes
from vocalis.llm import mixing
from vocalis.llm.common import cut, n_words_of, numbered
from vocalis.llm.registry import QUERIES


def targets_by_rounds(sizes: dict, weights=(5, 2, 1), cap=3.0) -> dict:
    """The contract's words: share, stop at the cap, share the excess again."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in done]
        left = total - sum(done.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return done | share
        done |= {s: cap * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(3))
def test_targets_equal_the_rounds(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice("abcdefghij") * k: int(10 ** rng.uniform(0, 5)) for k in range(1, 9)} | {None: 70}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    want = targets_by_rounds(sizes)
    assert got.keys() == want.keys()
    for k in want:
        assert math.isclose(got[k], want[k], rel_tol=1e-9), k


def test_sources_come_near_their_targets(spark):
    rng = random.Random(4)
    rows = [(i, "abc"[min(2, int(rng.expovariate(1.2)))], int(rng.lognormvariate(5, 1)) + 1) for i in range(3000)]
    df = cut(spark.createDataFrame(rows, "uid long, source string, size long"))
    out = mixing.mix(df).collect()
    assert sorted(r["uid"] for r in out) == list(range(3000))
    for s in "abc":
        its = [r for r in out if r["source"] == s]
        taken = sum(r["size"] * r["copies"] for r in its)
        assert abs(taken - its[0]["target"]) <= max(r["size"] for r in its) / 2 + 1
        p = its[0]["target"] / its[0]["source_size"]
        assert {r["copies"] for r in its} <= {math.floor(p), math.floor(p) + 1}
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_expectation_is_kept(spark):
    """Over seeds, a document's mean copies come near its probability."""
    df = cut(spark.createDataFrame([(i, "a" if i % 3 else "b", 10 + i % 7) for i in range(300)],
                                   "uid long, source string, size long"))
    per = [r["copies"] for seed in range(6) for r in mixing.mix(df, weights=(1, 1), seed=seed).collect() if r["source"] == "a"]
    target = [r for r in mixing.source_targets(df, (1, 1)).collect() if r["source"] == "a"][0]
    assert abs(sum(per) / len(per) - target["target"] / target["source_size"]) < 0.02


def test_edges(spark):
    docs = documents(spark, edge_rows())
    sizes = cut(numbered(docs.select("doc_id", "source", n_words_of(F.col("text")).alias("size")),
                         ["doc_id", "size", "source"]))
    out = mixing.mix(sizes).collect()
    assert len(out) == docs.count()
    assert all(r["copies"] * r["size"] <= 3 * r["size"] for r in out)
    kept = mixing.mix_documents(docs)
    assert kept.columns == docs.columns
    assert mixing.mix_documents(docs.limit(0)).count() == 0
    assert mixing.mix(sizes.limit(0)).count() == 0
    twice = [r["doc_id"] for r in mixing.mix_documents(docs).select("doc_id").collect()]
    assert twice.count(8) % 2 == 0  # repeated rows get the same number of copies


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op1_mixing"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(out) == len(texts)
    for r in out:
        assert r["size"] == len((texts[r["doc_id"]] or "").encode().split())
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
    sizes = {}
    for r in out:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = targets_by_rounds(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)


def test_prose_is_stable():
    assert prose(1, 3) == prose(1, 3)


def test_internal_names_do_not_clash(spark):
    names = ["_h", "_c", "_k", "_s", "_th", "h", "k", "src", "th", "copies", "uid", "size"]
    docs = documents(spark, [(i, prose(i, 20 + i), "ab"[i % 2]) for i in range(30)])
    got = mixing.mix_documents(with_clashes(docs, *names))
    assert got.columns == docs.columns + names
    rows = got.collect()
    assert rows and all(r[n] == "clash" for r in rows for n in names)
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in mixing.mix_documents(docs).collect())
