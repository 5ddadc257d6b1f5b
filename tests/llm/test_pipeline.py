import re
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm.helpers import documents, edge_rows, prose
from tests.llm.test_mixing import targets_by_rounds
from tests.llm.test_quality_rules import base
from tests.llm.test_simhash_dedup import components, fingerprint
from tests.llm.test_suffix_dedup import kept_bytes

import __spark_entry__ as entry


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    stage = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "simhash_dedup", "suffix_dedup", "mixing", "packing"]
    first = stage["quality_rules"](spark, docs, "")
    assert first.columns == docs.columns
    left = {d: t for d, t in rows.items() if not base(t)[-1]}  # no template lines in so small a table
    assert {r["doc_id"]: r["text"] for r in first.collect()} == left
    keys = sorted(left)
    which = components([fingerprint(left[k]) for k in keys])
    left = {keys[k]: left[keys[k]] for k in set(which)}
    second = stage["simhash_dedup"](spark, first, "")
    assert {r["doc_id"]: r["text"] for r in second.collect()} == left
    third = stage["suffix_dedup"](spark, second, "")
    keys = sorted(left)
    bare = kept_bytes([left[k].encode() for k in keys])
    left = {k: b.decode("utf-8", "ignore") for k, (b, _) in zip(keys, bare)}
    got = third.collect()
    assert {r["doc_id"]: r["text"] for r in got} == left and all(r["n_chars"] == len(r["text"]) for r in got)
    fourth = stage["mixing"](spark, third, "")
    assert fourth.columns == docs.columns
    assert all(left[r["doc_id"]] == r["text"] for r in fourth.collect())
    copies, source = Counter(r["doc_id"] for r in fourth.collect()), {r["doc_id"]: r["source"] for r in docs.collect()}
    assert max(copies.values()) <= 3
    n_words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in left.items()}
    of, taken = Counter(), Counter()
    for d, n in n_words.items():
        of[source[d]] += n
        taken[source[d]] += n * copies[d]
    for s, want in targets_by_rounds(dict(of)).items():
        assert abs(taken[s] - want) <= max(n for d, n in n_words.items() if source[d] == s)
    last = stage["packing"](spark, fourth, "").collect()
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*tokens.encode(left[d], add_special_tokens=False).ids, 0] for d in copies}
    pieces, sequences = {}, {}
    for r in last:
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        pieces.setdefault(r["doc_id"], Counter()).update(range(r["start"], r["start"] + r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    # Every id of every copy lies in one piece; sequences are gapless and fit.
    assert all(pieces[d] == Counter({k: n for k in range(len(ids[d]))}) for d, n in copies.items())
    for its in sequences.values():
        ends = [0, *(o + n for o, n in sorted(its))]
        assert [o for o, _ in sorted(its)] == ends[:-1] and ends[-1] <= 1024


def test_run_and_registry(spark):
    out = entry.queries()["pipeline"](spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "pipeline" not in entry.oracle_sql()
    names = [n for n in entry.queries() if n.startswith("op")]
    assert len(names) == 13


def test_stages_on_edges(spark):
    rows = edge_rows() + [(100 + i, prose(40 + i, 80), "a") for i in range(5)]
    for start in (rows, []):
        docs = documents(spark, start)
        for _, f in cp.STAGES:
            docs = f(spark, docs, "")
        assert docs.count() >= (1 if start else 0)
