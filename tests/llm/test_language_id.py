import zlib

import numpy as np

from tests.llm.helpers import documents, edge_rows, with_clashes
from vocalis.llm import language_id as L
from vocalis.llm.registry import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    out = QUERIES["op9_language_id"](spark, sf).collect()
    assert len(out) == len(truth)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in out if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.98


def test_kneser_ney_by_hand():
    """Bigram-like case worked out with dictionaries."""
    rng = np.random.default_rng(1)
    sym = rng.integers(0, 5, 400)
    codes = np.array([sum(int(sym[i - k]) << (6 * k) for k in range(4)) for i in range(3, len(sym))])
    kinds, n = np.unique(codes, return_counts=True)
    got = np.exp(L.KneserNey(kinds, n).log_probability(codes))
    tables = [dict(zip(kinds.tolist(), n.tolist()))]
    for order in (3, 2, 1):
        low = {}
        for c in tables[-1]:
            k = c & ((1 << 6 * order) - 1)
            low[k] = low.get(k, 0) + 1
        tables.append(low)

    def p(code, order):
        if not order:
            return 1 / 64
        table = tables[4 - order]
        d = L._discount(np.array(list(table.values())))
        c = code & ((1 << 6 * order) - 1)
        its = {k: v for k, v in table.items() if k >> 6 == c >> 6}
        if not its:
            return p(code, order - 1)
        total = sum(its.values())
        return max(its.get(c, 0) - d, 0) / total + d * len(its) / total * p(code, order - 1)

    want = [p(int(c), 4) for c in codes[:60]]
    assert np.allclose(got[:60], want)
    model = L.KneserNey(kinds, n)
    for context in codes[:5]:  # a distribution over the next symbol
        each = np.array([(int(context) >> 6 << 6) + k for k in range(64)])
        assert abs(np.exp(model.log_probability(each)).sum() - 1) < 1e-9


def test_edges(spark):
    docs = documents(spark, edge_rows() + [(30, "123 !!", "a"), (31, "Grüße aus Köln", "a")]).withColumn("lang", __import__(
        "pyspark.sql.functions", fromlist=["when"]).expr("if(doc_id % 2 = 0, 'aa', if(doc_id = 9, null, 'bb'))"))
    model = L.train(docs)
    assert model.langs == ["aa", "bb"]
    out = L.identify(with_clashes(docs, "score", "rejected"), model).collect()
    assert len(out) == docs.count()
    for r in out:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] in ("aa", "bb")) == letters and (letters or r["lang_pred"] == "und")
        assert 0 <= r["score"] <= 1
    nothing = L.train(docs.limit(0))
    assert {r["lang_pred"] for r in L.identify(docs, nothing).collect()} == {"und"}
    assert L.identify(docs.limit(0), model).count() == 0


def test_long_texts_are_read_whole():
    alphabet = L.Alphabet([ord(c) for c in "abcdefgh"])
    codes, owner = alphabet.codes(["abc" * 50_000, "", "a"])
    assert (np.bincount(owner, minlength=3) > [149_000, 0, 1]).all()


def test_rare_scripts_stay_apart(spark):
    """Latin texts with more letters than 62 are 98 of 100; two scripts share the rest."""
    rng = np.random.default_rng(2)
    latin = [chr(c) for c in [*range(97, 123), *range(0xE0, 0xF7), *range(0x101, 0x131, 2)]]
    han, cyrillic = [chr(c) for c in range(0x4E00, 0x4E50)], [chr(c) for c in range(0x430, 0x450)]

    def text(letters):
        return " ".join("".join(rng.choice(letters, 5)) for _ in range(30))

    rows = [(i, text(latin), "la") for i in range(980)]
    rows += [(1000 + i, text(han), "zh") for i in range(10)] + [(2000 + i, text(cyrillic), "ru") for i in range(10)]
    assert len(set(latin)) > 62
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    fresh = [(i, text(letters), lang) for i, (letters, lang) in enumerate([(latin, "la"), (han, "zh"), (cyrillic, "ru")] * 10)]
    out = L.identify(spark.createDataFrame(fresh, "doc_id long, text string, lang string"), model).collect()
    assert len(out) == 30 and all(r["lang_pred"] == r["lang"] for r in out)


def test_any_number_of_letters_has_codes_of_its_own():
    letters = list(range(0x20000, 0x20000 + 40_000)) + [ord(c) for c in "ab"]
    alphabet = L.Alphabet(letters)
    texts = ["ab", "a" + chr(letters[39_998]) + "b", "a" + chr(letters[39_999]) + "b", chr(letters[0]) * 2]
    codes, owner = alphabet.codes(texts)
    each = [tuple(codes[owner == i].tolist()) for i in range(4)]
    assert len(set(each)) == 4
    # "a" and "b" are past the single symbols here: a lead and a trail each.
    assert [len(x) for x in each] == [5, 7, 7, 3]
    kinds, n = np.unique(codes, return_counts=True)
    p = np.exp(L.KneserNey(kinds, n, alphabet.bits).log_probability(codes))
    assert ((p > 0) & (p <= 1)).all()


def test_quantile_is_that_of_all_rows(spark):
    rng = np.random.default_rng(5)
    for scores in (rng.beta(20, 1, 3000), np.array([0.25]), np.r_[np.full(30, 0.5), np.ones(970)], 1 - rng.uniform(0, 1e-13, 400)):
        df = spark.createDataFrame([(float(s),) for s in scores], "score double")
        for share in (0.01, 0.03):
            assert L._quantile(df, share) == np.quantile(scores, share)
    assert L._quantile(spark.createDataFrame([], "score double"), 0.01) == 0.0


def test_calibration_counts_every_text(spark):
    """3,000 texts: the level found by hand over all of them."""
    rng = np.random.default_rng(11)
    words = {"en": ["the", "cat", "house", "runs", "over", "mat"], "de": ["die", "katze", "haus", "matte", "uber", "der"]}
    rows = [(i, " ".join(rng.choice(words["en"] + words["de"] if i % 50 < 3 else words[lang], 1 + i % 6)), lang)
            for i in range(3000) for lang in [("en", "de")[i % 2]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs)
    alphabet = L.Alphabet(model.letters)
    entropy = L._entropies([r[1] for r in rows], alphabet, model.models)
    truth = np.array([model.langs.index(r[2]) for r in rows])
    at = np.arange(len(rows))
    losses = {x: -np.log(L._softmax(entropy, x)[at, truth] + 1e-9).mean() for x in (2.0 ** k for k in range(7))}
    assert losses[model.sharpness] <= min(losses.values()) + 1e-6
    right = L._softmax(entropy, model.sharpness).max(1)[entropy.argmin(1) == truth]
    assert abs(model.reject_below - np.quantile(right, 0.01)) < 1e-9
