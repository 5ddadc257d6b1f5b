import random
import re
from collections import Counter

import duckdb
import pytest

from tests.llm.helpers import DOCS, edge_rows, prose, with_clashes
from vocalis.llm import collocations as C
from vocalis.llm.registry import ORACLES, QUERIES


def plain(rows, longest=5, least=100):
    """{(lang, phrase): (a, l, r, k, n, score)} by the definition."""
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i:i + m])] += 1
    frequent = {p: c for p, c in f.items() if c >= least and len(p[1]) > 1}
    out = {}
    for (lang, p), a in frequent.items():
        inside = any(lang == g and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q)))
                     for (g, q), b in frequent.items())
        if not inside:
            score, k = min((1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang, " ".join(p)] = (a, f[lang, p[:k]], f[lang, p[k:]], k, total[lang], score)
    return out


def found(spark, rows, **kw):
    docs = with_clashes(spark.createDataFrame([(i, t, g, "s", 1) for i, (t, g) in enumerate(rows)], DOCS),
                        "phrase", "m", "h", "c", "w1", "_part", "_at", "held", "x1")
    return {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["k"], r["n"], r["score"])
            for r in C.collocations(docs, **kw).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_equals_the_definition(spark, seed, monkeypatch):
    """Few words, so that phrases nest, repeat and overlap; texts cut inside."""
    monkeypatch.setattr(C, "AT_ONCE", 300)
    monkeypatch.setattr(C, "GATHERED_ROWS", 40)
    rng = random.Random(seed)
    words = ["a", "b", "a", "Cc", "d\x01", "a\x01", "\x02", "é", "漢", "x'y"]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n"]) for _ in range(rng.randint(0, 200)))
        rows.append((text + " one two three four five six" * rng.randint(0, 3), rng.choice(["en", "en", "fr", None])))
    want = plain(rows, least=9)
    assert len(want) > 40 and found(spark, rows, least=9) == want
    assert found(spark, rows, longest=3, least=9) == plain(rows, longest=3, least=9)


def test_edges(spark):
    rows = [(t, s) for _, t, s in edge_rows()] + [("a a a a a a a a a", "en"), ("A\tA", None), ("a a", "und")] * 3
    assert found(spark, rows, least=2) == plain(rows, least=2)
    assert found(spark, rows, least=10 ** 9) == {}
    assert C.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert C.collocations(spark.createDataFrame([(1, None, None, None, None)], DOCS)).count() == 0


def test_streams_across_range_partitions(spark, monkeypatch):
    """Phrases of one first word fill many partitions: parts still found."""
    from vocalis.llm import common
    monkeypatch.setattr(common, "ROWS_PER_RANGE", 7)
    rows = [(f"the w{i % 23} x{i % 5} end", "en") for i in range(300)]
    assert found(spark, rows, least=2) == plain(rows, least=2)


def test_a_full_filter_prunes_less_and_counts_the_same(spark, monkeypatch):
    rows = [(prose(i % 9, 40) + " and so on", "en") for i in range(60)]
    want = plain(rows, least=5)
    monkeypatch.setattr(C.Possible, "has", lambda self, signs: signs == signs)
    assert found(spark, rows, least=5) == want


def test_large_products_are_exact(spark):
    counts = spark.sql("SELECT 'en' AS lang, w AS phrase, m, f FROM VALUES ('a', 1, 40000000007L), ('b', 1, 40000000009L), "
                       "('a b', 2, 39999999998L) AS t(w, m, f)")
    first, last = C.stream(counts, 5, False), C.stream(counts, 5, True)
    assert [r["x1"] for r in first.filter("m = 2").collect()] == [40000000007]
    assert [r["x1"] for r in last.filter("m = 2").collect()] == [40000000009]


def test_top_ranks_ties_by_bytes(spark):
    rows = spark.createDataFrame([("en", p, 5, s) for p, s in [("b é", 9), ("b z", 9), ("a a", 7), ("c c", 8)]],
                                 "lang string, phrase string, a long, score long")
    assert [(r["rank"], r["phrase"]) for r in C.top(rows, 3).orderBy("rank").collect()] == [(1, "b z"), (2, "b é"), (3, "c c")]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '/root/testdata/sf{sf}/documents.parquet'")
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = con.sql(f"select {', '.join(cols)} from ({ORACLES['op11_count_streams']})").fetchall()
    got = QUERIES["op11_count_streams"](spark, f"/root/testdata/sf{sf}").select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want)
