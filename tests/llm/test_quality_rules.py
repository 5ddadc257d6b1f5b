import re
from collections import Counter

import duckdb
import pytest

from tests.llm.helpers import documents, edge_rows, prose, with_clashes
from vocalis.llm import quality_rules as Q
from vocalis.llm.registry import ORACLES, QUERIES

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered.update(range(i, i + 8))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), n < 20 or 100 * len(covered) > 30 * n)


def test_base_features(spark):
    rows = edge_rows() + [
        (20, "a b c d e f g h " * 40, "a"), (21, prose(9, 30) + "\n" + prose(9, 30), "a"),
        (22, "x\ny\nx\n\n \nx", "a"), (23, "#a *b $c %d &e |f <g >h", "b"), (24, "ab " * 3000, "b"),
        (25, prose(7, 100) + " " + prose(8, 3) + " " + prose(7, 100), "b")]
    docs = with_clashes(documents(spark, rows), "n_words", "kept", "host", "line")
    got = Q.quality_rules(docs).collect()
    assert len(got) == len(rows)
    want = Counter((d, *base(t)) for d, t, _ in rows)
    assert Counter((r["doc_id"], *[r[c] for c in COLUMNS]) for r in got) == want
    assert all(r["host"] == "clash" for r in got)
    assert Q.quality_rules(docs.limit(0)).count() == 0


def test_template_lines_go_and_copies_stay(spark):
    rows = [(i, f"Sign up to our letter {i} now\n{prose(i, 30)}", "a") for i in range(60)]
    rows += [(100 + i, "\n".join(["Sign up to our letter 7 now"] * 8 + [f"w{i} x y"] * 8), "a") for i in range(3)]
    rows += [(200 + i, prose(77, 40) + "\n" + prose(78, 40) + "\n" + prose(79, 40), "a") for i in range(50)]
    same = "\n".join(prose(500 + k, 12) for k in range(12))
    rows += [(300 + i, same + "\n" + prose(900 + i, 12), "a") for i in range(50)]
    rows += [(400, f"Sign up to our letter 1 now\n{prose(3000, 30)}", "b")]
    got = {r["doc_id"]: r for r in Q.quality_rules(documents(spark, rows)).collect()}
    assert all(got[i]["n_removed_words"] == 7 and got[i]["kept"] for i in range(60))
    # A text that was copied is one text; 50 that differ in a line are 50.
    assert all(got[i]["n_removed_words"] == 0 and got[i]["kept"] for i in range(200, 250))
    assert all(got[i]["n_removed_words"] == 144 and not got[i]["kept"] for i in range(300, 350))
    assert got[400]["n_removed_words"] == 0  # counted per host
    poor = [(i, "\n".join(f"Sign up to our letter {k} now" for k in "abc") + f"\n{prose(i, 12)}", "z") for i in range(60)]
    assert not any(r["kept"] for r in Q.quality_rules(documents(spark, poor)).collect())


@pytest.mark.parametrize("shared", [5, 10, 20, 40])
def test_boilerplate_of_many_lines(spark, shared):
    """Shared lines and one own line: all shared ones go, the documents with them."""
    lines = "\n".join(prose(5000 + k, 12) for k in range(shared))
    rows = [(i, f"{lines}\n{prose(i, 12)}", "a") for i in range(100)]
    got = Q.quality_rules(documents(spark, rows)).collect()
    assert all(r["n_removed_words"] == 12 * shared and r["depleted"] and not r["kept"] for r in got)


def test_internal_names_do_not_clash(spark):
    names = ["w", "l", "h", "p", "r", "_h", "_k", "k", "its_host", "its_key", "gone", "first", "key", "words", "copies", "host_docs", "_th"]
    docs = documents(spark, [(i, prose(i, 30), "a") for i in range(3)])
    got = Q.quality_rules(with_clashes(docs, *names))
    assert got.columns[:len(docs.columns) + len(names)] == docs.columns + names
    assert all(r["kept"] and all(r[n] == "clash" for n in names) for r in got.collect())


def test_native_plan(spark):
    plan = QUERIES["op3_line_frequency"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '/root/testdata/sf{sf}/documents.parquet'")
    cols = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words, depleted, kept"
    want = con.sql(f"select {cols} from ({ORACLES['op3_line_frequency']}) order by all").fetchall()
    got = QUERIES["op3_line_frequency"](spark, f"/root/testdata/sf{sf}").select(*cols.split(", ")).collect()
    assert sorted(map(tuple, got)) == sorted(want)
