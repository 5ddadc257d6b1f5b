"""Quality rules: cross-document line frequency, in DataFrame operations only.

Normalised lines are hashed, and each host's distinct documents that hold a
line are counted. A line above the limits is template text and counts as
removed; a document that loses too much of its words with it is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, private, ready, words_of

#: A line is template text of a host if more than this many of its distinct
#: documents hold it, and more than this share of them.
MIN_DOCS, MIN_SHARE = 20, 0.001
#: A document is depleted if more than this share of its words goes.
MAX_REMOVED = 0.5
#: Words of a window whose repeats are counted.
WINDOW = 8


def _covered(words: Column, window: int) -> Column:
    """Words that lie in windows found twice or more in an array of words."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - window + 1),
                         lambda i: F.xxhash64(F.slice(words, i, window)))
    return F.when(F.size(words) >= window, hashes).otherwise(F.array().cast("array<long>"))


def base_features(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words`` (long) and ``base_failed`` of each whole text.

    A text's windows are hashed in its own row; only texts with a repeated
    hash sort them to find the positions, so the cost stays n log n in the
    longest text and nothing is shuffled. A null text has no words.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    w, l, h, p, r = private(docs, "w", "l", "h", "p", "r")
    df = (
        docs.drop(*names).withColumn(w, words_of(F.col(text))).withColumn(l, lines)
        .withColumn(h, _covered(F.col(w), window))
        .withColumn("n_words", F.size(w).cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join(w, "")).cast("long"))
        .withColumn("n_symbols", (F.char_length(t) - F.char_length(F.translate(t, "#*$%&|<>", ""))).cast("long"))
        .withColumn("n_dup_lines", (F.size(l) - F.size(F.array_distinct(l))).cast("long"))
    )
    pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn(p, F.when(F.size(F.array_distinct(h)) < F.size(h), pairs))
    same = lambda x, k: F.get(F.col(p), k)["h"] == x["h"]
    at = F.transform(F.filter(p, lambda x, k: F.coalesce(same(x, k - 1), F.lit(False))
                              | F.coalesce(same(x, k + 1), F.lit(False))), lambda x: x["i"])
    df = df.withColumn(r, F.array_sort(at))
    steps = F.transform(r, lambda x, k: F.least(
        F.coalesce(F.get(F.col(r), k + 1) - x, F.lit(window)), F.lit(window)).cast("long"))
    df = df.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    # A generator of one row: filters on the features stay above it, instead
    # of being rewritten into repeated evaluations of the arrays below.
    own = [c for c in docs.columns if c not in names]
    return df.select(*own, F.inline(F.array(F.struct(*names[:-1], failed.alias("base_failed")))))


#: White space inside a line.
_GAP = r"[\x20\x09\x0B-\x0D]+"


def normal_lines(text: Column) -> Column:
    """Array of a text's lines with A-Z in lower case, digits as 0, and single
    spaces; a space may be left at either end. The text is rewritten whole,
    which no rule carries over a line's end."""
    plain = F.regexp_replace(ascii_lower(text), "[0-9]+", "0")
    return F.split(F.regexp_replace(plain, _GAP, " "), "\n")


def text_key(text: Column) -> Column:
    """A sign of a whole text (null: that of an empty one)."""
    return F.xxhash64(F.md5(F.coalesce(text, F.lit(""))))


def line_table(docs: DataFrame, host: str, text: str) -> DataFrame:
    """``host, key, first, line, words``: a row for each line with a word of
    each row of ``docs``, its sign and its words. ``first`` marks one row of
    each document, which is there even if it has no such line (null then)."""
    per = docs.select(F.col(host).cast("string").alias("host"), text_key(F.col(text)).alias("key"),
                      F.posexplode(normal_lines(F.coalesce(F.col(text), F.lit("")))).alias("at", "raw"))
    per = per.select("host", "key", (F.col("at") == 0).alias("first"), F.trim("raw").alias("norm"))
    some = F.col("norm") != ""
    return per.filter(some | F.col("first")).select(
        "host", "key", "first", F.when(some, F.xxhash64(F.md5("norm"))).alias("line"),
        F.when(some, F.regexp_count("norm", F.lit(" ")) + 1).cast("long").alias("words"))


def template_lines(per_line: DataFrame, hosts: DataFrame, min_docs: int, min_share: float) -> DataFrame:
    """``_th, _tl`` (host, line) of the lines above the limits, from ``host,
    key, line`` rows that name each line of each distinct text once."""
    found = per_line.groupBy("host", "line").agg(F.count("*").alias("docs")).filter(F.col("docs") > min_docs)
    per = hosts.select(F.col("host").alias("_h"), "host_docs")
    return (
        found.join(per, F.col("host").eqNullSafe(F.col("_h")))
        .filter(F.col("docs") > min_share * F.col("host_docs"))
        .select(F.col("host").alias("_th"), F.col("line").alias("_tl"))
    )


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text",
                  min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE,
                  max_removed: float = MAX_REMOVED) -> DataFrame:
    """``docs`` with the base features, ``n_removed_words`` (in template lines
    of its host, long), ``depleted`` and ``kept``.

    A line is template text of a host if more than ``min_docs`` of its distinct
    texts, and more than ``min_share`` of them, hold it. Null hosts form one
    host. Equal (host, text) rows count as one text and share one verdict; texts
    that differ anywhere are different documents. Lines of a hot host spread by
    line, counts combine before each shuffle, and template lines meet the lines
    again in a join that Spark plans by size. Columns of these names are
    replaced, others kept, whatever they are called; an empty table stays
    empty; a null or empty text has no lines and fails the base rule.
    """
    ready(docs)
    names = ("n_removed_words", "depleted", "kept")
    stored = cut(line_table(docs, host, text))
    texts = stored.groupBy("host", "key").agg(F.count_if("first").alias("copies"))
    hosts = texts.groupBy("host").agg(F.count("*").alias("host_docs"))
    # Every copy has brought the text's lines once more.
    per_line = stored.filter(F.col("line").isNotNull()).groupBy("host", "key", "line").agg(F.sum("words").alias("words"))
    template = template_lines(per_line, hosts, min_docs, min_share)
    same = F.col("host").eqNullSafe(F.col("_th")) & (F.col("line") == F.col("_tl"))
    rows = base_features(docs.drop(*names), text)
    k, its_host, its_key, gone = private(rows, "k", "its_host", "its_key", "gone")
    hits = per_line.join(template, same).groupBy(F.col("host").alias("_host"), F.col("key").alias("_key")).agg(
        F.sum("words").alias("w"))
    both = F.col("_host").eqNullSafe(F.col("host")) & (F.col("_key") == F.col("key"))
    removed = hits.join(texts, both).select(
        F.col("_host").alias(its_host), F.col("_key").alias(its_key), (F.col("w") / F.col("copies")).cast("long").alias(gone))
    rows = rows.withColumn(k, text_key(F.col(text)))
    its = F.col(host).cast("string").eqNullSafe(F.col(its_host)) & (F.col(k) == F.col(its_key))
    return (
        rows.join(removed.hint("shuffle_hash"), its, "left")
        .withColumn("n_removed_words", F.coalesce(gone, F.lit(0)).cast("long"))
        .withColumn("depleted", F.col("n_removed_words") > max_removed * F.col("n_words"))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .drop(k, its_host, its_key, gone)
    )
