import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import documents, edge_rows, with_clashes
from vocalis.llm import packing as P
from vocalis.llm.registry import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def check(pieces, texts, reference, window=1024):
    """pieces: rows of the query; texts: (doc_id, text), unique ids."""
    by_doc, by_seq = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, t in texts:
        ids = np.array([*reference.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(by_doc.pop(d), key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids)
    assert not by_doc
    padded = 0
    for its in by_seq.values():
        at = 0
        for offset, length in sorted(its):
            assert offset == at
            at += length
        assert at <= window
        padded += window
    return sum(r["length"] for r in pieces) / padded


def test_query(spark, reference):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fill = check(QUERIES["op5_packing"](spark, sf).collect(), [tuple(r) for r in docs], reference)
    assert fill > 0.995


TEXTS = st.text(st.sampled_from(" \n\tabZ1'!.,é漢 \u0085 \x1c😀|<>"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=8))
def test_word_by_word_ids_equal_the_whole(texts):
    reference = Tokenizer.from_file(PATH)
    got = P.tokenizer(PATH).ids(texts)
    for t, raw in zip(texts, got):
        assert np.frombuffer(raw, dtype="<u2").tolist() == reference.encode(t, add_special_tokens=False).ids


def test_long_texts_in_windows(monkeypatch):
    monkeypatch.setattr(P, "WINDOW_CHARS", 50)
    reference = Tokenizer.from_file(PATH)
    for t in ("some words. and more\n" * 40, "x" * 300, "a  b " * 60, " lead " + "b c\n \nd " * 50):
        want = reference.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(P.tokenizer(PATH).long_ids(t), dtype="<u2").tolist() == want


def test_ids_of_the_table_equal_the_whole(spark, reference):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()][:3000]
    words = P.tokenizer(PATH)
    for t, raw in zip(texts, words.ids(texts)):
        assert np.frombuffer(raw, dtype="<u2").tolist() == reference.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("n,spike", [(1, 0), (300, 0), (300, 200), (5000, 3000)])
def test_plan_places_every_remainder_once(n, spike):
    rng = np.random.default_rng(n)
    h = np.bincount(rng.gamma(2, 300, n).astype(int) % 256, minlength=256)
    h[0], h[200] = 0, h[200] + spike
    plan = P.pack_plan(h, 256)
    fill = {}
    for v in range(1, 256):
        for r in range(h[v]):
            at = 0
            for s, m, q, o in sorted(plan.place(v, r).tolist()):
                assert s == at
                at += m
                fill.setdefault(q, []).append((o, m))
            assert at == v
    for its in fill.values():
        at = 0
        for o, m in sorted(its):
            assert o == at
            at += m
        assert at <= 256
    assert len(fill) == plan.sequences
    if n > 100:
        assert (np.arange(256) * h).sum() / plan.sequences / 256 > 0.99


def test_least_squares_fits_a_solvable_histogram():
    combos = P.combinations(64)
    assert (combos.sum(axis=1) == 64).all() and (np.diff(combos, axis=1) <= 0).all()
    h = np.zeros(64, dtype=np.int64)
    for row, times in ((combos[3], 500), (combos[40], 300), (combos[-1], 200)):
        for v in row[row > 0]:
            h[v] += times
    chosen, x = P.repeat_counts(h, combos)
    used = np.zeros(64)
    for c, v in zip(chosen, x):
        for k in combos[c][combos[c] > 0]:
            used[k] += v
    assert (x >= 0).all() and np.abs(used - h).max() < 5


def test_edges(spark, reference):
    rows = [(100 + i, t, s) for i, (_, t, s) in enumerate(edge_rows())] + [(200, " ".join(["a b  c"] * 900), "a")]
    docs = with_clashes(documents(spark, rows), "start", "offset", "rest")
    out = P.pack(docs, PATH).collect()
    assert {"lang", "source", "rest"} <= set(out[0].asDict())
    pieces = [r.asDict() | {"ids_crc32": zlib.crc32(r["ids"])} for r in out]
    check(pieces, [(d, t) for d, t, _ in rows], reference)
    assert P.pack(docs.limit(0), PATH).count() == 0
    twice = documents(spark, [(1, "same text", "a")] * 5 + [(None, None, None)] * 2)
    assert P.pack(twice.select("doc_id", "text"), PATH).count() == 7
