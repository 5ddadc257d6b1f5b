import fnmatch
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vocalis.llm import url_filters as U
from vocalis.llm.registry import ORACLES, QUERIES, URL_RULES


def plain(glob: str) -> re.Pattern:
    out = ""
    for part in re.findall(r"\*\*|\*|\?|.", glob, re.S):
        out += {"**": r"[\s\S]*", "*": "[^/]*", "?": "[^/]"}.get(part, re.escape(part))
    return re.compile(out)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab/*?", min_size=0, max_size=7), min_size=1, max_size=30),
       st.lists(st.text("ab/", max_size=9), min_size=1, max_size=20))
def test_automaton_equals_regular_expressions(globs, urls):
    rules = [U.Rule(g, "block", g, len(g)) for g in globs]
    got = U.Automaton(rules).best([u.encode() for u in urls])
    order = sorted(range(len(rules)), key=lambda i: (-rules[i].weight, i))
    for u, k in zip(urls, got):
        want = next((i for i in order if plain(globs[i]).fullmatch(u)), -1)
        assert k == want


def test_long_urls_and_several_words():
    rules = [U.Rule(f"**{c}{'x' * 40}{c}**", "block", c, 1) for c in "abcdef"]
    machine = U.Automaton(rules)
    assert machine.words > 3
    url = ("y" * 3000 + "e" + "x" * 40 + "e" + "y" * 100).encode()
    assert machine.best([url, b"", url[:100], url[2990:]]).tolist() == [4, -1, -1, 4]


def by_contract(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda x: len(x[0])) if fits else None


def test_edges(spark):
    urls = [None, "", "no host", "http://", "http://Example.COM/en/a?b#c", "https://www.example.com/en/x",
            "http://xexample.com/en/", "http://a.net/es/b", "http://net/fr/", "ftp://u:p@x.net:80/es/",
            "http://com", "http://com/", "http://a.com?x=/", "http://evil.org/x.com/y", "http://é.com/ü",
            "http://a.com/" + "x" * 5000, "x://y://z.com/", "http://a.com/\nnew"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    rules = [U.host_rule(*r) for r in URL_RULES]
    for r in U.judge(df, rules).collect():
        host, path, best = by_contract(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0]), r
        assert r["verdict"] == (best[1] if best else "block" if not host else "allow")
    assert U.judge(df.limit(0), rules).count() == 0
    assert U.judge(df, []).filter("rule is null").count() == len(urls)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '/root/testdata/sf{sf}/pages.parquet'")
    cols = "page_id, host, path, rule, verdict"
    want = con.sql(f"select {cols} from ({ORACLES['op4_url_automaton']}) order by page_id").fetchall()
    got = [tuple(r) for r in QUERIES["op4_url_automaton"](spark, f"/root/testdata/sf{sf}").select(*cols.split(", ")).orderBy("page_id").collect()]
    assert got == want


def test_fnmatch_agrees_on_plain_globs():
    assert fnmatch.fnmatch("abc", "a?c") == bool(plain("a?c").fullmatch("abc"))
