"""Phrase collocations from count streams in prefix and suffix order.

Every phrase that is frequent enough becomes one row of a count stream. Sorted
by its words from the first on (prefix order), a phrase directly follows its
own first part, so one pass over the stream carries the counts of all first
parts along; sorted from the last word back (suffix order) the same pass
carries the counts of all last parts. The two passes are merged again in
phrase order. No count is looked up in a hash table.

Counting goes from short to long. Words are counted as they are. Counts of
pairs and triples, kept under 64-bit signs, only tell what can't be frequent: a
text is broken there. What is left leaves each task as blocks of windows in
prefix order, and blocks are merged into exact counts of all their first parts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ordered, ready

#: Words of the longest phrase, and occurrences that a phrase needs.
LONGEST, LEAST = 5, 100
#: Words of the longest phrase that is filtered by its sign.
FILTERED = 3
#: Bytes of text looked at together; a word and its gap have two or more, so
#: word codes within stay below 2^20.
AT_ONCE = 2_000_000
#: Entries (sign, count) that a task gathers before it sends them on.
GATHERED = 1_000_000
#: ... and rows of words or windows, which are strings.
GATHERED_ROWS = 300_000
#: Words of the corpus for each bucket in which blocks of windows are merged.
WORDS_PER_BUCKET = 5_000_000
#: Bits of the filter of possible words or pairs: about 32 for each frequent
#: one, up to 16 MB in all. Past that it lets more through; counts stay exact.
FILTER_BITS = 27
_BLOCK = 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: 0: part of a word, 1: ends a word, 2: ends a piece.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_GAP = rb"\x20\x09-\x0D.,;:!?"
_END_OF_WORD = re.compile(rb"[" + _GAP + rb"]").search


def _ahead(words: int):
    return re.compile(rb"(?:[" + _GAP + rb"]+[^" + _GAP + rb"]+){0,%d}" % words).match


class Tokens:
    """Words of some texts of one language: ``codes`` into ``words`` (Arrow
    strings, A-Z in lower case), ``piece`` numbers, and how many words from the
    start are ``own`` (the rest only ends phrases that start before)."""

    def __init__(self, raw: np.ndarray, breaks: np.ndarray, own_bytes: int | None = None):
        low = _LOWER[raw]
        kind = _KIND[low]
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        ends = kind == 2
        breaks = breaks[breaks < len(raw)]
        first[breaks] = inside[breaks]
        ends[breaks] = True
        starts = np.flatnonzero(first)
        self.piece = np.cumsum(ends, dtype=np.int32)[starts]
        offsets = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, np.int32(inside.sum())).astype(np.int32)
        flat = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(low[inside])])
        coded = flat.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = coded.dictionary
        self.own = len(starts) if own_bytes is None else int(np.searchsorted(starts, own_bytes))

    def signs(self, lang: str) -> np.ndarray:
        seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
        return np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words.to_pylist()], dtype=np.uint64)


def _sign(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0x7F4A7C15F39CC060))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def tokens(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[str, Tokens]]:
    """Language and words, for about AT_ONCE bytes of texts at a time. A text
    above that is cut between words, with the words that follow the cut."""
    ahead = _ahead(longest - 1)
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        at = langs.indices.to_numpy(zero_copy_only=False)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column(1).take(pa.array(np.flatnonzero(at == k))).cast(pa.large_string())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
            held = texts.buffers()[2]
            data = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8)
            i = 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + AT_ONCE, "right")) - 1)
                raw = data[offsets[i]:offsets[j]]
                if len(raw) <= AT_ONCE:
                    yield lang, Tokens(raw, offsets[i:j] - offsets[i])
                else:
                    whole, a = raw.tobytes(), 0
                    while a < len(whole):
                        gap = _END_OF_WORD(whole, a + AT_ONCE)
                        e = gap.start() if gap else len(whole)
                        yield lang, Tokens(raw[a:ahead(whole, e).end()], np.zeros(1, dtype=np.int64), e - a)
                        a = e
                i = j


class _Gathered:
    """Counts of signs over many chunks of one language."""

    def __init__(self):
        self.signs, self.counts, self.held = [], [], 0

    def add(self, signs: np.ndarray, counts: np.ndarray) -> bool:
        self.signs.append(signs)
        self.counts.append(counts)
        self.held += len(signs)
        if self.held <= GATHERED:
            return False
        self.signs, self.counts = ([x] for x in self.merged())
        self.held = len(self.signs[0])
        return 2 * self.held > GATHERED

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        signs, at = np.unique(np.concatenate(self.signs), return_inverse=True)
        return signs, np.bincount(at, weights=np.concatenate(self.counts), minlength=len(signs)).astype(np.int64)


def _sign_counts(texts: DataFrame, count, words: int) -> DataFrame:
    """``h, c`` from ``count(lang, Tokens) -> (signs, counts)`` of phrases of
    so many words."""
    def sent(found):
        signs, counts = found.merged()
        return pa.RecordBatch.from_arrays([pa.array(signs.view(np.int64)), pa.array(counts)], ["h", "c"])

    def run(batches):
        found: dict[str, _Gathered] = {}
        for lang, some in tokens(batches, words):
            signs, counts = count(lang, some)
            if len(signs) and found.setdefault(lang, _Gathered()).add(signs, counts):
                yield sent(found.pop(lang))
        for left in found.values():
            yield sent(left)

    return texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _added(tables: Iterator[pa.Table], keys: list[str]) -> Iterator[pa.Table]:
    """Rows ``keys, c`` of many chunks, equal keys added up over as many rows
    as GATHERED_ROWS hold."""
    found, rows = [], 0
    for t in tables:
        found.append(t)
        rows += len(t)
        if rows > GATHERED_ROWS:
            found = [pa.concat_tables(found).group_by(keys).aggregate([("c", "sum")]).rename_columns({"c_sum": "c"})]
            rows = len(found[0])
            if 2 * rows > GATHERED_ROWS:
                yield found.pop()
                rows = 0
    if found:
        yield pa.concat_tables(found).group_by(keys).aggregate([("c", "sum")]).rename_columns({"c_sum": "c"})


def _word_counts(texts: DataFrame) -> DataFrame:
    """``lang, w, c`` of all words."""
    def run(batches):
        def chunks():
            for lang, some in tokens(batches, 1):
                c = np.bincount(some.codes[:some.own], minlength=len(some.words))
                seen = pa.array(np.flatnonzero(c))
                yield pa.table([pa.array([lang] * len(seen), pa.string()), some.words.take(seen).cast(pa.string()),
                                pa.array(c[c > 0])], ["lang", "w", "c"])
        for t in _added(chunks(), ["lang", "w"]):
            yield from t.select(["lang", "w", "c"]).to_batches()

    return texts.mapInArrow(run, "lang string, w string, c long").groupBy("lang", "w").agg(F.sum("c").alias("c"))


def _word_signs(words: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            signs = [xxhash.xxh64_intdigest(w.encode(), xxhash.xxh64_intdigest(g.encode()))
                     for g, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(signs, dtype=np.uint64).view(np.int64))], ["h"])

    return words.select("lang", "w").mapInArrow(run, "h long")


class Possible:
    """A filter of fixed greatest size over signs: False means certainly not
    among them. Built as blocks of 2^20 bits in tasks."""

    def __init__(self, signs: DataFrame):
        bits = min(FILTER_BITS, max(_BLOCK, math.ceil(math.log2(32 * max(1, signs.count())))))
        self.mask = np.uint64((1 << bits) - 1)
        self.bits = np.zeros(1 << (bits - 3), dtype=np.uint8)
        size = 1 << _BLOCK

        def block(pdf):
            import pandas as pd
            on = np.zeros(size, dtype=np.uint8)
            on[pdf["at"].to_numpy() & (size - 1)] = 1
            return pd.DataFrame({"k": [int(pdf["at"].iloc[0]) >> _BLOCK], "b": [np.packbits(on, bitorder="little").tobytes()]})

        at = signs.select(F.col("h").bitwiseAND(int(self.mask)).alias("at")).distinct()
        blocks = at.groupBy(F.shiftright("at", _BLOCK).alias("k")).applyInPandas(block, "k long, b binary")
        for k, b in blocks.collect():  # at most 2^7 rows of 128 KB
            self.bits[k << (_BLOCK - 3):(k + 1) << (_BLOCK - 3)] = np.frombuffer(b, dtype=np.uint8)

    def has(self, signs: np.ndarray) -> np.ndarray:
        at = signs & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _possible(some: Tokens, h: np.ndarray, filters: list, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For phrases of 1, 2, ... ``order`` words that start at each word: may
    they be frequent, by their parts and the filters there are; and the signs
    of those of ``order`` words."""
    word = h[some.codes] if len(some.codes) else np.zeros(0, dtype=np.uint64)
    keep = filters[0].has(h)[some.codes] if filters and len(some.codes) else np.ones(len(word), dtype=bool)
    signs, masks = word, [keep]
    for k in range(2, order + 1):
        on = np.zeros(len(word), dtype=bool)
        on[:-1] = keep[:-1] & keep[1:]
        if k == 2:
            on[:-1] &= some.piece[:-1] == some.piece[1:]
        at = np.flatnonzero(on)
        longer = np.zeros(len(word), dtype=np.uint64)
        longer[at] = _sign(signs[at], word[at + k - 1])
        if k <= len(filters):
            on[at] = filters[k - 1].has(longer[at])
        signs, keep = longer, on
        masks.append(keep)
    return masks, signs


def _windows(some: Tokens, masks: list[np.ndarray], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of two and more words (codes, -1 where shorter) and
    counts: from each own word that may begin a frequent pair as far as the
    masks allow, ``longest`` words at most."""
    start = np.flatnonzero(masks[1][:some.own])
    held = np.full((len(start), longest), -1, dtype=np.int64)
    held[:, 0] = some.codes[start]
    on = np.ones(len(start), dtype=bool)
    for k in range(2, longest + 1):
        m = min(k, len(masks))
        on[on] = masks[m - 1][start[on] + k - m]  # so far the parts reach on, so this place is there
        held[on, k - 1] = some.codes[start[on] + k - 1]
    order = np.lexsort(held.T[::-1])
    held = held[order]
    new = np.ones(len(held), dtype=bool)
    new[1:] = (held[1:] != held[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return held[at], np.diff(np.append(at, len(held)))


def _block(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def merged_counts(blocks: list[bytes], names: list[str], least: int) -> pa.Table:
    """``lang, phrase, m, f`` of the windows' first parts of two and more words
    that occur ``least`` times: the blocks are merged in prefix order, where a
    part's windows follow each other."""
    rows = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blocks])
    rows = rows.sort_by([(k, "ascending") for k in ("lang", *names)]).combine_chunks()
    count = rows["c"].to_numpy()
    new, out = np.zeros(len(rows), dtype=bool), []
    new[:1] = True
    for m, key in enumerate(("lang", *names)):
        codes = pc.fill_null(rows[key].combine_chunks().dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
        if m < 2:
            continue
        at = np.flatnonzero(new)
        f = np.add.reduceat(count, at) if len(at) else count[:0]
        keep = (f >= least) & (codes[at] >= 0)
        some = rows.take(pa.array(at[keep]))
        phrase = pc.binary_join_element_wise(*[some[k] for k in names[:m]], " ")
        out.append(pa.table([some["lang"], phrase, pa.array(np.full(int(keep.sum()), m, dtype=np.int32)), pa.array(f[keep])],
                            ["lang", "phrase", "m", "f"]))
    return pa.concat_tables(out)


def phrase_counts(texts: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, m, f`` of every phrase of up to ``longest`` words that
    occurs ``least`` times or more, and ``lang, n`` (all words), from ``lang,
    text`` rows without nulls. Every part of a frequent phrase is frequent, so
    windows that end where a part is not lose none; the windows' first parts
    then add up to exact counts of all orders. Windows of one first pair meet
    in one bucket; there are as many as the words need."""
    spark = ready(texts)
    texts = texts.select("lang", "text")
    counted = cut(_word_counts(texts))
    totals = counted.groupBy("lang").agg(F.sum("c").alias("n"))
    words = counted.filter(F.col("c") >= least)
    filters = [spark.sparkContext.broadcast(Possible(_word_signs(words)))]
    for order in range(2, min(FILTERED, longest) + 1):
        sent = list(filters)

        def count(lang, some, order=order, sent=sent):
            masks, signs = _possible(some, some.signs(lang), [f.value for f in sent], order)
            return np.unique(signs[:some.own][masks[-1][:some.own]], return_counts=True)

        frequent = cut(_sign_counts(texts, count, order).filter(F.col("c") >= least).select("h"))
        filters.append(spark.sparkContext.broadcast(Possible(frequent)))
    names = [f"w{k}" for k in range(1, longest + 1)]
    n = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / WORDS_PER_BUCKET))

    def windows(batches):
        def chunks():
            for lang, some in tokens(batches, longest):
                h = some.signs(lang)
                masks, _ = _possible(some, h, [f.value for f in filters], len(filters))
                held, c = _windows(some, masks, longest)
                bucket = (_sign(h[held[:, 0]], h[held[:, 1]]) % np.uint64(buckets)).astype(np.int64)
                cols = [some.words.take(pa.array(held[:, k], mask=held[:, k] < 0)).cast(pa.string()) for k in range(longest)]
                yield pa.table([pa.array(bucket), pa.array([lang] * len(c), pa.string()), *cols, pa.array(c)],
                               ["bucket", "lang", *names, "c"])

        for t in _added(chunks(), ["bucket", "lang", *names]):
            t = t.sort_by([(k, "ascending") for k in ("bucket", "lang", *names)]).combine_chunks()
            bucket = t["bucket"].to_numpy()
            at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else bucket
            some = [_block(t.slice(a, b - a).select(["lang", *names, "c"])) for a, b in zip(at, np.r_[at[1:], len(bucket)])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array(some, pa.binary())], ["bucket", "block"])

    def merge(group: pa.Table) -> pa.Table:
        return merged_counts(group["block"].to_pylist(), names, least)

    phrases = texts.mapInArrow(windows, "bucket long, block binary").groupBy("bucket").applyInArrow(
        merge, "lang string, phrase string, m int, f long")
    single = words.select("lang", F.col("w").alias("phrase"), F.lit(1).alias("m"), F.col("c").alias("f"))
    return cut(phrases.unionByName(single)), totals


def stream(counts: DataFrame, longest: int, reverse: bool) -> DataFrame:
    """``counts`` with ``x1, x2, ...``: the counts of the phrase's first
    (``reverse``: last) 1, 2, ... words, null from its own length on.

    The rows lie in prefix (suffix) order. Whatever stands between a phrase
    and its first k words starts with those words too, so the last row of k
    words so far is the one: a running value in each range partition, opened
    with the values that the partitions before it leave behind."""
    words = F.split("phrase", " ", -1)
    words = F.reverse(words) if reverse else words
    keys = [f"v{k}" for k in range(1, longest + 1)]
    rows = counts.select("*", words.alias("held")).select(
        *counts.columns, *[F.get("held", F.lit(k)).alias(v) for k, v in enumerate(keys)])
    stored = ordered(rows, ["lang", *keys])
    orders = range(1, longest)
    left = stored.groupBy("_part").agg(*[
        F.max_by("f", F.when(F.col("m") == k, F.col("_at"))).alias(f"e{k}") for k in orders])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    opened = left.select(  # one row for each range partition
        F.col("_part").alias("_of"), *[F.last(f"e{k}", ignorenulls=True).over(before).alias(f"o{k}") for k in orders])
    so_far = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    run = stored.select("*", *[
        F.last(F.when(F.col("m") == k, F.col("f")), ignorenulls=True).over(so_far).alias(f"s{k}") for k in orders])
    met = run.join(F.broadcast(opened), F.col("_part") == F.col("_of"))
    return met.select(*counts.columns, *[
        F.when(F.col("m") > k, F.coalesce(f"s{k}", f"o{k}")).alias(f"x{k}") for k in orders])


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang",
                 longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang, phrase, m, a, l, r, k, n, score`` of the phrases of 2 to
    ``longest`` words that occur ``least`` times or more in a language and lie
    in no longer one that occurs as often.

    ``a`` counts the phrase, ``n`` all words of the language; cut after its
    first ``k`` words, the parts occur ``l`` and ``r`` times and the score is
    floor(1000*a*n/(l*r)), at the cut where that is least (ties: smallest k).
    A phrase in a longer frequent one that is as frequent also lies in one of
    a single word more that is, so each stream names what its rows cover.

    Null texts have no words; a null language is ``und``; repeated rows count
    as often as they occur; texts of any length are counted whole; an empty
    table gives no rows. Only the two named columns are read, so others may
    have any names. ``longest`` is 2 or more. Products are 38-digit decimals.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts, totals = phrase_counts(texts, longest, least)
    orders = range(1, longest)
    first, last = cut(stream(counts, longest, False)), cut(stream(counts, longest, True))
    words = F.split("phrase", " ", -1)

    def covered(rows: DataFrame, part) -> DataFrame:
        inner = F.coalesce(*[F.when(F.col("m") == k + 1, F.col(f"x{k}")) for k in orders])
        return rows.filter((F.col("m") > 2) & (F.col("f") == inner)).select("lang", F.array_join(part, " ").alias("phrase"))

    gone = covered(first, F.slice(words, 1, F.col("m") - 1)).unionByName(
        covered(last, F.slice(words, 2, F.col("m") - 1))).distinct()
    right = last.select("lang", "phrase", *[F.col(f"x{k}").alias(f"y{k}") for k in orders])
    both = first.filter("m > 1").hint("merge").join(right, ["lang", "phrase"]).join(
        gone.hint("merge"), ["lang", "phrase"], "left_anti")
    rows = both.join(totals, "lang").withColumnRenamed("f", "a")
    y = F.array(*[F.col(f"y{j}") for j in orders])
    cuts = [F.when(F.col("m") > k, F.struct(F.lit(k).alias("k"), F.col(f"x{k}").alias("l"),
                                            F.get(y, F.col("m") - k - 1).alias("r"))) for k in orders]
    rows = rows.withColumn("cuts", F.filter(F.array(*cuts), lambda c: c.isNotNull()))
    scored = F.expr("""array_min(transform(cuts, c -> struct(
        CAST(a AS DECIMAL(19,0)) * 1000BD * CAST(n AS DECIMAL(15,0))
          div (CAST(c.l AS DECIMAL(19,0)) * CAST(c.r AS DECIMAL(19,0))) AS score, c.k AS k, c.l AS l, c.r AS r)))""")
    return rows.withColumn("b", scored).select("lang", "phrase", "m", "a", "b.l", "b.r", "b.k", "n", "b.score")


def top(found: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` of each language with ``rank`` from 1: by score and
    count descending, then phrase in byte order."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= most)
