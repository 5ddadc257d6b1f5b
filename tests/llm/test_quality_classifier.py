import zlib

import numpy as np

from tests.llm.helpers import documents, edge_rows, with_clashes
from vocalis.llm import quality_classifier as C
from vocalis.llm.registry import QUERIES


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = QUERIES["op8_attention_bags"](spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    y = np.array([truth[r["doc_id"]] for r in held])
    p = np.array([r["predicted"] for r in held])
    assert (y == p).mean() > 0.97
    assert p[y == 1].mean() > 0.98 and p[y == 0].mean() < 0.1


def bag(n, bad):
    return " ".join(["plain words here"] * n + ["!!! ### $$$"] * bad)


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for i in range(200):
        bad = i % 2
        parts = [bag(22, 0) for _ in range(6)]
        if bad:
            parts[rng.integers(6)] = bag(2, 20)
        texts.append(" ".join(parts))
        labels.append(1 - bad)
    model = C.fit(texts, np.array(labels), steps=120)
    score, top = model.score(texts)
    assert ((score >= 0.5) == np.array(labels)).mean() > 0.97
    one = " ".join([bag(64, 0), bag(0, 64), bag(64, 0)])
    assert model.score([one])[0][0] < 0.5


def test_scores_ignore_the_batch(monkeypatch):
    texts = ["some words " * 400, "", None, "x", "!!! " * 300, "a b c"]
    model = C.fit(["good text here"] * 20 + ["!!! $$$"] * 20, np.array([1] * 20 + [0] * 20), steps=40)
    whole = model.score(texts)[0]
    each = [model.score([t])[0][0] for t in texts]
    assert np.allclose(whole, each)
    monkeypatch.setattr(C, "AT_ONCE", 640)
    assert np.allclose(model.score(texts)[0], whole)


def plain_features(text):
    """Passages of 64 words, their features one by one."""
    raw = (text or "").encode()
    kind = [next((k for k, g in enumerate(C._GROUPS) if b in g), C.KINDS - 1) for b in raw]
    starts = [i for i in range(len(raw)) if kind[i] > 1 and (i == 0 or kind[i - 1] <= 1)]
    out = []
    for a in range(0, max(1, len(starts)), 64):
        mine = starts[a:a + 64]
        x = np.zeros(C.WIDTH)
        if mine:
            stop = starts[a + 64] if a + 64 < len(starts) else len(raw)
            # A text's bytes end with a line's end of their own.
            k2, bytes_ = kind + [1], raw + b"\n"
            stop = stop if a + 64 < len(starts) else len(bytes_)
            for i in range(mine[0], stop):
                x[C.KINDS * (k2[i - 1] if i else 1) + k2[i]] += 1
            x[:C.KINDS ** 2] = np.sqrt(x[:C.KINDS ** 2] / x[:C.KINDS ** 2].sum())
            words = [bytes_[i:next(j for j in range(i, len(bytes_)) if k2[j] <= 1)] for i in mine]
            n = len(words)
            at = C.KINDS ** 2
            x[at] = sum(p == q for p, q in zip(words[1:], words)) / n
            x[at + 1] = sum(p == q for p, q in zip(words[2:], words)) / n
            x[at + 2] = len(set(words)) / n
            x[at + 3] = sum(min(len(w), 40) for w in words) / n / 10
            x[at + 4] = n / 64
            x[at + 5] = np.log1p(sum(len(w) > 20 for w in words))
        out.append(x)
    return out


def test_features_attention_and_score_one_by_one(monkeypatch):
    texts = [bag(70, 3), "", None, " lead " + bag(40, 0) + "\n\nÉé 漢 1,2;3", "x" * 90 + " y y y", bag(0, 200) + " end"]
    model = C.fit([bag(30, 0)] * 10 + [bag(3, 20)] * 10, np.array([1] * 10 + [0] * 10), steps=30)
    p = model.p
    for at_once in (C.AT_ONCE, 600):
        monkeypatch.setattr(C, "AT_ONCE", at_once)
        got, top = model.score(texts)
        for i, t in enumerate(texts):
            hs, logits = [], []
            for x in plain_features(t):
                h = np.tanh(x @ p["enc"] + p["enc0"])
                gate = np.tanh(h @ p["v"]) * (1 / (1 + np.exp(-(h @ p["u"]))))
                hs.append(h)
                logits.append(gate @ p["w"])
            a = np.exp(logits) / np.exp(logits).sum()
            z = sum(w * h for w, h in zip(a, hs))
            assert abs(got[i] - 1 / (1 + np.exp(-(z @ p["c"] + p["c0"][0])))) < 1e-4
            assert logits[top[i]] > max(logits) - 1e-4


def test_a_hot_key_leaves_the_sample(spark):
    """A labelled key of many rows neither crowds out others nor changes reruns."""
    rows = [(1, "!!! $$$ " * 20, "a")] * 300 + [(i, bag(5 + i, i % 2 * 20), "a") for i in range(2, 40)]
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(2, 40)] + [(1, 0)], "doc_id long, quality int")
    docs = documents(spark, rows)
    a, b = C.train(docs, labels, rows=40), C.train(docs.repartition(7), labels, rows=40)
    assert a.constant is None and all((a.p[k] == b.p[k]).all() for k in a.p)


def test_edges(spark):
    docs = with_clashes(documents(spark, edge_rows()), "score", "predicted", "o", "_o", "_k", "_key", "_t", "_y")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 1), (10, 0), (99, 1)], "doc_id long, quality int")
    model = C.train(docs, labels)
    out = C.classify(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    one = C.train(docs, labels.filter("quality = 1"))
    assert {r["score"] for r in C.classify(docs, one).collect()} == {1.0}
    assert {r["score"] for r in C.classify(docs, C.train(docs, labels.limit(0))).collect()} == {0.5}
    assert C.classify(docs.limit(0), model).count() == 0
