"""Benchmark decontamination with an Aho-Corasick automaton.

The test items' words, normalised, give windows of ten consecutive words;
all of them are the patterns of one automaton over the normalised text. Each
document is scanned once, and what matches is mapped back to its words and to
character offsets in the original text.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ready

#: Words of a window.
WINDOW = 10
#: Characters of patterns (and 16 for each item's mention) in one automaton,
#: which takes up to 50 bytes for each. A larger set is scanned in blocks.
BLOCK = 4_000_000
#: Bytes of a text that are scanned at once.
AT_ONCE = 4_000_000

#: Bytes as they count: a-z, 0-9 and all that is not ASCII stay, A-Z become
#: lower case, the rest separates words.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_SPACE = re.compile(rb" ").search


def normal(text: str) -> bytes:
    """The text in UTF-8, byte for byte in place, with spaces between words."""
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL)


def windows_of(text: str | None, window: int = WINDOW) -> list[str]:
    """Distinct windows of an item: its runs of ``window`` words, or all its
    words if they are fewer; none without words."""
    words = normal(text or "").split()
    runs = {b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))} if words else set()
    return sorted(r.decode("latin-1") for r in runs)


class Patterns:
    """An automaton over windows, each with the items that hold it. Patterns
    are bounded by a space on both sides, so they match whole words only."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self.automaton, self.most = ahocorasick.Automaton(), 1
        for run, items in rows:
            n = run.count(" ") + 1
            self.most = max(self.most, n)
            self.automaton.add_word(f" {run} ", (n, tuple(items)))
        self.automaton.make_automaton()

    def find(self, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, runs of hit words (first, last; overlapping and
        adjoining ones joined) and the items met in a normalised text."""
        hits, items, before, at, held = set(), set(), 0, 0, []
        while at < len(raw):
            gap = _SPACE(raw, at + AT_ONCE) if at + AT_ONCE < len(raw) else None
            end = gap.start() if gap else len(raw)
            words = raw[at:end].split()
            seen = held + words
            ends = None
            for e, (n, ids) in self.automaton.iter(f" {b' '.join(seen).decode('latin-1')} ") if len(self.automaton) else ():
                if ends is None:
                    ends = np.cumsum([len(w) + 1 for w in seen])
                last = before - len(held) + int(np.searchsorted(ends, e))
                hits.add((last - n + 1, last))
                items.update(ids)
            before += len(words)
            held = seen[max(0, len(seen) - self.most + 1):]
            at = end
        return before, joined(hits), items


def joined(runs) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def offsets(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets (start, end) in the original text of runs of words of
    its normalised form."""
    b = np.frombuffer(raw, dtype=np.uint8)
    word = b != 32
    start = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    end = np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1
    chars = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
    return [(int(chars[start[i]]), int(chars[end[j]])) for i, j in runs]


_BUILT: dict[str, Patterns] = {}


def _patterns(key: str, rows) -> Patterns:
    """One automaton per worker process at a time."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Patterns(rows.value)
    return _BUILT[key]


_SPANS = "array<struct<first_word:long,last_word:long,start:long,end:long>>"
_FOUND = f"struct<n_words:long,spans:{_SPANS},items:array<string>>"


def _blocks(items: DataFrame, item: str, text: str, window: int) -> Iterator[list[tuple[str, list[str]]]]:
    """Windows with their items' ids, in lists of about BLOCK characters."""
    runs = F.pandas_udf(lambda texts: pd.Series([windows_of(t, window) for t in texts]), "array<string>")
    mentions = cut(items.select(F.col(item).cast("string").alias("id"), F.explode(runs(F.col(text))).alias("run")).distinct())
    size = mentions.agg(F.sum(F.length("run") + 16)).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK))
    for k in range(n):
        its = mentions.filter(F.pmod(F.xxhash64("run", "id"), F.lit(n)) == k)
        # Without ids that are null: such an item is matched but not named.
        yield [(r["run"], r["ids"]) for r in its.groupBy("run").agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()]


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside any occurrence of a
    window), ``n_items`` and ``item_ids`` (sorted as strings) of the items
    whose windows occur, ``spans`` (runs of hit words: first and last word from
    0, start and end characters of the original text) and ``contaminated``.

    Columns of these names are replaced, all others stay. A null or wordless
    text has no words; a null or wordless item has no windows. Repeated items
    count once by id; one with a null id hits words but isn't counted or named.
    Texts of any length are scanned whole, in pieces that overlap by a window.
    Without items nothing is hit; without documents nothing is returned. No
    document is shuffled: the automaton goes to them, as one block of at most
    BLOCK characters of patterns at a time, with the rows stored in between
    where there are several.
    """
    spark = ready(docs)
    mine = f"found_{uuid.uuid4().hex}"
    found = None
    for rows in _blocks(items, item, item_text, window):
        sent, key = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

        @F.pandas_udf(_FOUND)
        def scan(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            patterns = _patterns(key, sent)
            for texts, spans, ids in batches:
                out = []
                for t, had, known in zip(texts, spans, ids):
                    raw = normal(t or "")
                    n, runs, its = patterns.find(raw)
                    old = [(r["first_word"], r["last_word"]) for r in had]
                    runs = joined(old + runs) if runs else old
                    at = offsets(raw, runs) if runs else []
                    out.append((n, [{"first_word": a, "last_word": b, "start": s, "end": e} for (a, b), (s, e) in zip(runs, at)],
                                sorted(its | set(known))))
                yield pd.DataFrame(out, columns=["n_words", "spans", "items"])

        none = F.array().cast(_SPANS), F.array().cast("array<string>")
        if found is None:
            found = docs.withColumn(mine, scan(F.col(text), *none))
        else:
            found = cut(found)
            found = found.withColumn(mine, scan(F.col(text), F.col(f"{mine}.spans"), F.col(f"{mine}.items")))
    spans = F.col(f"{mine}.spans")
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last_word"] - s["first_word"] + 1)
    ids = F.col(f"{mine}.items")
    new = {"n_words": F.col(f"{mine}.n_words"), "n_hit": n_hit, "n_items": F.size(ids).cast("long"), "item_ids": ids,
           "spans": spans, "contaminated": F.size(spans) > 0}
    return found.select(*[c for c in docs.columns if c not in new], *[v.alias(k) for k, v in new.items()])
