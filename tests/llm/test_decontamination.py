import hashlib
import random
import re

import duckdb
import pytest

from tests.llm.helpers import documents, edge_rows, prose, with_clashes
from vocalis.llm import decontamination as D
from vocalis.llm.registry import ORACLES, QUERIES

ITEMS = "item_id long, text string, n_words string, items string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text, items, window=10):
    """(n_words, hit word numbers, ids) by the definition."""
    w, hit, ids = words(text), set(), set()
    for i, t in items:
        x = words(t)
        n = min(window, len(x))
        runs = {tuple(x[k:k + n]) for k in range(len(x) - n + 1)} if x else set()
        for k in range(len(w) - n + 1 if n else 0):
            if tuple(w[k:k + n]) in runs:
                hit.update(range(k, k + n))
                ids |= {str(i)} if i is not None else set()
    return len(w), hit, sorted(ids)


def check(spark, rows, items, **kw):
    docs = with_clashes(documents(spark, rows), "n_words", "spans", "items", "found", "run", "id")
    its = spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)
    got = D.decontaminate(docs, its, **kw).collect()
    assert len(got) == len(rows)
    want = {}
    for d, t, _ in rows:
        n, hit, ids = plain(t, items, kw.get("window", 10))
        want.setdefault((d, t), []).append((n, sorted(hit), ids))
    for r in got:
        n, hit, ids = want[r["doc_id"], r["text"]][0]
        spanned = [k for s in r["spans"] for k in range(s["first_word"], s["last_word"] + 1)]
        assert (r["n_words"], spanned, r["item_ids"], r["n_hit"], r["n_items"], r["contaminated"]) == (
            n, hit, ids, len(hit), len(ids), bool(hit))
        w = words(r["text"])
        for s in r["spans"]:  # offsets are those of the original text
            assert words(r["text"][s["start"]:s["end"]]) == w[s["first_word"]:s["last_word"] + 1]
            assert r["text"][s["start"]] not in " .,\n" and r["text"][s["end"] - 1] not in " .,\n"
        assert r["found"] == "clash" and r["run"] == "clash"
    return got


def cases():
    rng = random.Random(4)
    items = [(i, prose(100 + i, 35)) for i in range(6)] + [
        (10, "Short one, here."), (11, None), (12, " ,. "), (None, prose(300, 20)), (13, "漢字 é À"), (13, prose(301, 12)),
        (14, "a a a a a a a a a a a a"), (15, prose(100, 35)), (16, "one")]
    rows = edge_rows()
    for d in range(30, 70):
        i, t = items[rng.randrange(6)]
        w = t.split()
        a = rng.randrange(0, 20)
        part = rng.choice([" ", ", ", "\n", " -- "]).join(w[a:a + rng.choice([8, 9, 10, 11, 15])])
        rows.append((d, f"É漢 {prose(d, 30)}. {part.upper()}! {prose(d + 1, 9)}", "s"))
    rows += [(80, "here short one here. SHORT-ONE here", "s"), (81, "a " * 40 + "b", "s"), (82, prose(300, 20), "s"),
             (83, "ééé 漢字 (É) 漢字 é À.", "s"), (84, prose(101, 35) + "x", "s"), (85, prose(301, 12) + " " + prose(102, 35), None)]
    return rows, items


def test_equals_the_definition(spark):
    rows, items = cases()
    got = {r["doc_id"]: r for r in check(spark, rows, items)}
    assert sum(r["contaminated"] for r in got.values()) > 20
    assert got[82]["contaminated"] and got[82]["n_items"] == 0  # an item without an id
    check(spark, rows, items, window=3)


def test_blocks_and_pieces(spark, monkeypatch):
    """Several automata, texts scanned in pieces."""
    monkeypatch.setattr(D, "BLOCK", 3000)
    rows, items = cases()
    check(spark, rows, items)
    patterns = D.Patterns([(r, [str(i)]) for i, t in items for r in D.windows_of(t)])
    monkeypatch.setattr(D, "AT_ONCE", 37)
    for _, t, _ in rows:
        n, runs, ids = patterns.find(D.normal(t or ""))
        want = plain(t, [(str(i), x) for i, x in items])
        assert n == want[0] and [k for a, b in runs for k in range(a, b + 1)] == sorted(want[1])


def test_empty_tables(spark):
    rows, items = cases()
    assert all(r["n_hit"] == 0 for r in check(spark, rows[:5], []))
    assert check(spark, [], items) == []


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '/root/testdata/sf{sf}/{t}.parquet'")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = con.sql(f"select {', '.join(cols)} from ({ORACLES['op12_aho_corasick']})").fetchall()
    got = QUERIES["op12_aho_corasick"](spark, f"/root/testdata/sf{sf}").select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r["contaminated"] for r in got)
    none = hashlib.sha256(b"").hexdigest()
    assert all((r["items_sha256"] == none) == (r["n_items"] == 0) for r in got)
