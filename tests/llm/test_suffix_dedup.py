import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import documents, edge_rows, prose, with_clashes
from vocalis.llm import suffix_array as A
from vocalis.llm import suffix_dedup as D
from vocalis.llm.registry import QUERIES


def kept_bytes(texts, length=200):
    """(kept bytes, removed runs) of each text, from all strings of the table."""
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((bytes(b for b, g in zip(t, gone) if not g), runs))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array(text):
    text = [*text, 0]
    assert A.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_arrays_in_step(monkeypatch):
    monkeypatch.setattr(A, "IN_STEP", 2)
    rng = np.random.default_rng(3)
    texts = [np.r_[rng.integers(1, 1 + rng.integers(1, 6), rng.integers(0, 150)), 0] for _ in range(400)]
    for t, sa in zip(texts, A.suffix_arrays(texts)):
        t = t.tolist()
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("sf", ["0.001"])
def test_query_equals_brute_force(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    raw = [(r["text"] or "").encode() for r in docs]
    got = {r["doc_id"]: r for r in QUERIES["op6_suffix_array"](spark, sf).collect()}
    assert len(got) == len(docs)
    for r, t, (kept, runs) in zip(docs, raw, kept_bytes(raw)):
        x = got[r["doc_id"]]
        assert (x["n_bytes"], x["n_removed"], x["n_spans"]) == (len(t), len(t) - len(kept), runs)
        assert x["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def planted():
    passage, other = prose(90, 60), prose(91, 50)
    rows = edge_rows() + [
        (20, prose(20, 50) + passage + prose(21, 50), "a"), (21, passage[:210], "a"), (22, "x" + passage[3:], "b"),
        (23, other + " " + prose(22, 9) + " " + other, "b"), (24, passage[100:250], "b"), (25, "ab" * 300, "b"),
        (26, "é" * 150 + "a" + "é" * 120, "b"), (27, "a" * 199, "b"), (28, "b" * 200, "b"), (29, "c" * 201, "b")]
    return rows


def test_edges_equal_brute_force(spark):
    rows = planted()
    docs = with_clashes(documents(spark, rows), "kept", "n_spans", "h", "ranges")
    got = D.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    raw = [(t or "").encode() for _, t, _ in rows]
    want = Counter((str(d), k, n) for (d, _, _), (k, n) in zip(rows, kept_bytes(raw)))
    assert Counter((str(r["doc_id"]), bytes(r["kept"]), r["n_spans"]) for r in got) == want
    assert all(r["h"] == "clash" for r in got)
    assert D.remove_repeats(docs.limit(0)).count() == 0


def test_texts_stay_valid(spark):
    rows = planted()
    docs = documents(spark, rows)
    got = D.without_repeats(docs)
    assert got.columns == docs.columns
    raw = [(t or "").encode() for _, t, _ in rows]
    want = Counter((str(d), None if t is None else k.decode("utf-8", "ignore"))
                   for (d, t, _), (k, _) in zip(rows, kept_bytes(raw)))
    assert Counter((str(r["doc_id"]), r["text"]) for r in got.collect()) == want


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(D, "AT_ONCE", 1000)
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 123, 5000, dtype=np.uint8))
    whole = D.text_segments([text], 200, 40)
    strings = sorted((s, e) for s, e in zip(whole[3].tolist(), whole[4].tolist()))
    assert strings[0][0] == 0 and strings[-1][1] == len(text) - 199
    assert all(a[1] == b[0] for a, b in zip(strings, strings[1:]))


def test_a_frequent_anchor_is_split(spark, monkeypatch):
    """A short phrase in 300 texts, longer passages around it in some."""
    most, whole = 4_000, D.repeated_strings

    def bounded(groups, length):
        assert all(sum(map(len, rows)) <= most for rows, _, _ in groups), "one group holds too many bytes"
        return whole(groups, length)

    monkeypatch.setattr(D, "SPLIT", most, raising=False)
    monkeypatch.setattr(D, "repeated_strings", bounded)
    phrase = "Licensed under the terms of the general public licence, version 2"
    rows = [(i, prose(3 * i, 30) + phrase + prose(3 * i + 1, 30), "a") for i in range(300)]
    for n in (60, 66, 67, 68, 75, 160):  # phrases of up to, at and above 200 bytes
        around = prose(7000, 20)[-n:] + phrase + prose(7001, 20)[:n]
        rows += [(400 + 10 * n + i, prose(9000 + n + 40 * i, 25) + around + prose(9500 + n + 40 * i, 25), "b") for i in range(5)]
    rows += [(5000 + i, rows[i][1], "c") for i in range(4)] + [(5010 + i, rows[-i][1][5:], "c") for i in range(1, 4)]
    got = D.remove_repeats(documents(spark, rows)).collect()
    raw = [t.encode() for _, t, _ in rows]
    want = Counter((d, k, n) for (d, _, _), (k, n) in zip(rows, kept_bytes(raw)))
    assert sum(n for _, _, n in want) > 30
    assert Counter((r["doc_id"], bytes(r["kept"]), r["n_spans"]) for r in got) == want


@pytest.mark.parametrize("clash", [False, True])
def test_a_sign_that_clashes_joins_no_strings(spark, monkeypatch, clash):
    """All subgroups of one sign: blocks are told apart by their bytes."""
    monkeypatch.setattr(D, "SPLIT", 1)
    if clash:
        class Same:
            @staticmethod
            def xxh64_intdigest(data, seed):
                return 7
        monkeypatch.setattr(D, "xxhash", Same)
    phrase = "Licensed under the terms of the general public licence, version 2"
    rows = [(i, prose(3 * i, 30) + phrase + prose(3 * i + 1, 30), "a") for i in range(12)]
    around = prose(7000, 20)[-90:] + phrase + prose(7001, 20)[:90]
    rows += [(40 + i, prose(9000 + i, 25) + around + prose(9500 + i, 25), "b") for i in range(4)]
    got = D.remove_repeats(documents(spark, rows)).collect()
    raw = [t.encode() for _, t, _ in rows]
    want = Counter((d, k, n) for (d, _, _), (k, n) in zip(rows, kept_bytes(raw)))
    assert Counter((r["doc_id"], bytes(r["kept"]), r["n_spans"]) for r in got) == want


def test_internal_names_do_not_clash(spark):
    names = ["kept", "n_spans", "k1", "k2", "_k1", "r", "_r", "n", "_n", "h", "sh", "g", "runs", "ranges", "many", "large"]
    rows = planted()
    got = D.without_repeats(with_clashes(documents(spark, rows), *names))
    plain = D.without_repeats(documents(spark, rows))
    assert got.columns == plain.columns + names
    assert all(r[n] == "clash" for r in got.collect() for n in names)
    assert Counter(map(tuple, got.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))
