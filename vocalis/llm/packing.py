"""Packing: non-negative least squares over shallow length combinations.

Documents are tokenized and cut into full windows and one remainder. The
histogram of remainders is all that the solver sees: combinations of up to
three lengths that fill a window exactly, their repeat counts by non-negative
least squares, rounded, and a greedy packing of what is left. Ranks per length
then tell every remainder its sequence and offset.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ready

#: Distinct words whose ids a Python worker keeps.
CACHE = 800_000
#: Fixed value: the byte-level vocabulary's own pattern for pieces.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters that every library puts in the same class, and long runs of them.
PLAIN = re.compile("[\t\n\r -~\u00a1-\u024f]*").fullmatch
#: A single space inside more white space: no place to cut.
SPACES = re.compile(r"\s \s").search
BETWEEN = re.compile(r"(?<=\S) (?=\S)").search
#: Characters of one text that are encoded at once.
WINDOW_CHARS = 1_000_000
LONG_RUN = re.compile(r"\S{2000}").search
#: Strategies taken into the solution at once.
BLOCK = 64


class WordTokenizer:
    """Byte-level BPE ids of whole texts, word by word from a bounded cache.

    The vocabulary's pre-tokenizer starts a new piece at every single space
    between two non-space characters, so a text may be cut there; texts with
    other white space around spaces are encoded whole. Where the vocabulary
    also lies beside its JSON file as ranks, plain Latin texts are encoded
    whole from those (the same ids, tested, several times as fast)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.ranks = None
        ranks = path.removesuffix(".json") + ".tiktoken"
        if path.endswith(".json") and os.path.exists(ranks):
            import tiktoken
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=table, special_tokens={})

    def _plain(self, text: str) -> bool:
        """Whether the ranks give the vocabulary's ids for this text."""
        return self.ranks is not None and bool(PLAIN(text)) and not LONG_RUN(text) and "<|" not in text

    def _encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        rest = []
        for i, t in enumerate(texts):
            if self._plain(t):
                out[i] = array("H", self.ranks.encode_ordinary(t)).tobytes()
            else:
                rest.append(i)
        if rest:
            for i, e in zip(rest, self.tokenizer.encode_batch([texts[i] for i in rest], add_special_tokens=False)):
                out[i] = array("H", e.ids).tobytes()
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of each text: plain ones in one call each,
        others word by word from the cache."""
        split, whole, out = {}, [], {}
        for i, t in enumerate(texts):
            if self._plain(t):
                out[i] = array("H", self.ranks.encode_ordinary(t)).tobytes()
                continue
            parts = t.split(" ")
            first = 1 if len(parts) > 1 and not parts[0] else 0  # it opens with a space
            if "" in parts[first:] or SPACES(t):
                whole.append(i)
            else:
                split[i] = [*parts[:1 - first], *[" " + p for p in parts[1:]]]
        known = self.known
        new = list({p for parts in split.values() for p in parts if p not in known})
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list({p for parts in split.values() for p in parts})
        known.update(zip(new, self._encode(new)))
        out.update(zip(whole, self._encode([texts[i] for i in whole])))
        for i, parts in split.items():
            out[i] = b"".join([known[p] for p in parts])
        return [out[i] for i in range(len(texts))]

    def long_ids(self, text: str) -> bytes:
        """The same for one text of any length, window after window, each cut
        at a single space between two others."""
        out = []
        while len(text) > WINDOW_CHARS and (space := BETWEEN(text, WINDOW_CHARS)):
            out += self.ids([text[:space.start()]])
            text = text[space.start():]
        return b"".join([*out, *self.ids([text])])


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker. Where the machine has no such file, it is that
    of the same name among its own public vocabularies."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if not os.path.exists(path):
            import public_tokenizers
            _TOKENIZERS[path] = WordTokenizer(public_tokenizers.path(os.path.basename(path)))
        else:
            _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenize(docs: DataFrame, vocabulary: str, text: str = "text", end: int = 0,
             window: int = 1024) -> DataFrame:
    """``docs`` without the text, with ``_ids`` (16-bit little-endian, ``end``
    last; a null text is empty), ``_n_ids``, ``_rest`` (length after the full
    windows), ``_part`` (task) and ``_nth`` (rank among the task's rows of the
    same rest). Store it before use: ranks hold for one run of the tasks."""
    kept = [c for c in docs.columns if c not in (text, "_ids", "_n_ids", "_rest", "_part", "_nth")]
    closing = np.array([end], dtype="<u2").tobytes()
    schema = docs.select(*kept, F.col(text).cast("string").alias(text)).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, part = tokenizer(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(window, dtype=np.int64)
        for pdf in batches:
            for a in range(0, len(pdf), 256):
                some = pdf.iloc[a:a + 256]
                texts = ["" if t is None else t for t in some[text]]
                ids = words.ids([t if len(t) <= WINDOW_CHARS else "" for t in texts])
                ids = [(x if len(t) <= WINDOW_CHARS else words.long_ids(t)) + closing for t, x in zip(texts, ids)]
                n = np.array([len(x) // 2 for x in ids], dtype=np.int64)
                rest = n % window
                nth = pd.Series(rest).groupby(rest).cumcount().to_numpy() + seen[rest]
                seen += np.bincount(rest, minlength=window)
                out = some[kept].copy()
                out["_ids"], out["_n_ids"], out["_rest"], out["_part"], out["_nth"] = ids, n, rest, part, nth
                yield out

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != text)
    out_schema = (columns + ", " if columns else "") + "_ids binary, _n_ids long, _rest long, _part int, _nth long"
    return docs.select(*kept, F.col(text).cast("string").alias(text)).mapInPandas(run, out_schema)


def combinations(window: int) -> np.ndarray:
    """All a >= b >= c >= 0 with a + b + c = window and a < window, as rows."""
    rows = []
    for a in range((window + 2) // 3, window):
        b = np.arange((window - a + 1) // 2, min(a, window - a) + 1)
        rows.append(np.stack([np.full(len(b), a), b, window - a - b], axis=1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), dtype=np.int64)


def repeat_counts(histogram: np.ndarray, combos: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative least squares: how often each combination is used so that
    the lengths used come near the histogram. Returns the indices of the
    combinations in the solution and their (real) counts.

    An active-set method: the combinations with the steepest gradient enter in
    blocks, a least-squares solution of the passive set follows, and negative
    counts leave it (Lawson and Hanson's step)."""
    size = len(histogram)
    h = histogram.astype(np.float64)
    h[0] = 0
    weight = np.ones(size)
    weight[0] = 0  # slot 0 stands for "no third piece"

    def dense(cols: np.ndarray) -> np.ndarray:
        a = np.zeros((size, len(cols)))
        for k in range(3):
            np.add.at(a, (combos[cols, k], np.arange(len(cols))), 1.0)
        a[0] = 0
        return a

    passive = np.zeros(0, dtype=np.int64)
    x = np.zeros(0)
    tolerance = max(1.0, 1e-3 * h.mean())  # counts are rounded afterwards
    for _ in range(rounds):
        residual = h.copy()
        if len(passive):
            residual -= dense(passive) @ x
        gradient = (residual * weight)[combos].sum(1)
        gradient[passive] = -np.inf
        best = np.argpartition(-gradient, min(4 * BLOCK, len(gradient) - 1))[:4 * BLOCK]
        best = best[np.argsort(-gradient[best], kind="stable")]
        used, enter = set(), []
        for c in best:  # different lengths, so that the columns are independent
            own = {int(v) for v in combos[c] if v}
            if gradient[c] > tolerance and not own & used:
                used |= own
                enter.append(c)
            if len(enter) == BLOCK:
                break
        if not enter:
            break
        passive, x = np.r_[passive, enter], np.r_[x, np.zeros(len(enter))]
        while len(passive):
            a = dense(passive)
            z = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(passive)), a.T @ h)
            if z.min() > 0:
                x = z
                break
            out = z <= 0
            step = np.min(x[out] / np.maximum(x[out] - z[out], 1e-12))
            x = x + min(1.0, step) * (z - x)
            keep = x > 1e-9
            if keep.all():
                keep[np.argmin(np.where(out, x, np.inf))] = False
            passive, x = passive[keep], x[keep]
    return passive, x


class Plan:
    """Where the remainders go. A remainder is known by its length and its
    rank among those of that length; ``pieces[length]`` holds rows (first
    rank, last rank + 1, start, piece length, first sequence, offset): rank
    r's piece lies in sequence first + r - first rank."""

    def __init__(self, histogram: np.ndarray, window: int):
        self.window, self.sequences = window, 0
        self.pieces: list[list[tuple[int, ...]]] = [[] for _ in range(window)]
        #: By piece length, what isn't placed: (length, start, ranks from, to).
        self._pool: list[list[tuple[int, int, int, int]]] = [
            [(v, 0, 0, int(n))] if v and n else [] for v, n in enumerate(histogram)]
        self.left = histogram.astype(np.int64).copy()
        self.left[0] = 0

    def take(self, lengths: list[int], times: int, cut_last: int = 0) -> None:
        """Fill ``times`` sequences with one piece of each length. With
        ``cut_last`` only that much of the last one, whose end stays open."""
        offset = 0
        for k, v in enumerate(lengths):
            size = cut_last if cut_last and k == len(lengths) - 1 else v
            need, first = times, self.sequences
            while need:
                rest, start, a, b = self._pool[v].pop()
                n = min(need, b - a)
                if b - a > n:
                    self._pool[v].append((rest, start, a + n, b))
                self.pieces[rest].append((a, a + n, start, size, first, offset))
                if size < v:
                    self._pool[v - size].append((rest, start + size, a, a + n))
                    self.left[v - size] += n
                need, first = need - n, first + n
            self.left[v] -= times
            offset += size
        self.sequences += times

    def room(self, lengths: list[int]) -> int:
        need = np.bincount(lengths, minlength=self.window)
        at = np.flatnonzero(need)
        return int((self.left[at] // need[at]).min())

    def done(self) -> "Plan":
        self.tables = [np.array(x, dtype=np.int64).reshape(-1, 6) for x in self.pieces]
        del self._pool, self.pieces
        return self

    def place(self, rest: int, rank: int) -> np.ndarray:
        """Rows (start, piece length, sequence, offset) of one remainder."""
        t = self.tables[rest]
        t = t[(t[:, 0] <= rank) & (rank < t[:, 1])]
        return np.stack([t[:, 2], t[:, 3], t[:, 4] + rank - t[:, 0], t[:, 5]], axis=1)


def pack_plan(histogram: np.ndarray, window: int, least_cut: int = 8) -> Plan:
    """Sequences for all remainders: the solution's counts rounded and held to
    what there is, then the residuals greedily, longest first, each filled
    with the longest that still fits; a gap of ``least_cut`` tokens or more
    gets the front of a longer remainder, whose end is packed on."""
    plan = Plan(histogram, window)
    if plan.left.any():
        combos = combinations(window)
        chosen, x = repeat_counts(plan.left, combos)
        for k in np.argsort(-x, kind="stable"):
            lengths = [int(v) for v in combos[chosen[k]] if v]
            times = min(round(float(x[k])), plan.room(lengths))
            if times > 0:
                plan.take(lengths, times)
    while plan.left.any():
        lengths, free, have = [], window, plan.left.copy()
        while free > 0:
            fits = np.flatnonzero(have[1:free + 1])
            if not len(fits):
                break
            lengths.append(int(fits[-1]) + 1)
            have[lengths[-1]] -= 1
            free -= lengths[-1]
        longer = np.flatnonzero(have[free + 1:])
        if free >= least_cut and len(longer):
            lengths.append(free + 1 + int(np.argmax(have[free + 1:])))  # from the commonest
            plan.take(lengths, plan.room(lengths), free)
        else:
            plan.take(lengths, plan.room(lengths))
    return plan.done()


def pack(docs: DataFrame, vocabulary: str, text: str = "text", end: int = 0,
         window: int = 1024) -> DataFrame:
    """Pieces of all documents: the columns of ``docs`` without the text, and
    ``start, length, ids`` (32-bit little-endian), ``doc_tokens, sequence_id,
    offset``.

    Full windows are sequences of their own; a remainder lies whole in one
    sequence, with the others of its combination, gapless from offset 0 (a few
    residuals are cut to fill a gap). A
    null or empty text is the end token alone. Repeated rows are packed each;
    an empty table gives an empty result. The driver sees only the histogram
    of remainder lengths (``window`` numbers) and the plan made of it.
    """
    spark = ready(docs)
    own = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    docs = docs.drop(*own)
    kept = [c for c in docs.columns if c != text]
    stored = cut(tokenize(docs, vocabulary, text, end, window))
    per = cut(stored.groupBy("_part", "_rest").agg(F.count("*").alias("n")))
    histogram = np.zeros(window, dtype=np.int64)
    for r in per.groupBy("_rest").agg(F.sum("n").alias("n")).collect():
        histogram[r["_rest"]] = r["n"]
    held = spark.sparkContext.broadcast(pack_plan(histogram, window))  # bounded by the window
    before = Window.partitionBy("_rest").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_part", "_rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n0"))
    rows = stored.join(offsets, ["_part", "_rest"])

    def cut_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = held.value.place
        # Full windows need no order: numbers from the task's own range, below 0.
        number = -((TaskContext.get().partitionId() + 1) << 36)
        for pdf in batches:
            for a in range(0, len(pdf), 256):
                some = pdf.iloc[a:a + 256]
                at, start, length, ids, sequence, offset = [], [], [], [], [], []
                for i, (raw, rest, rank) in enumerate(zip(some["_ids"], some["_rest"], some["_n0"] + some["_nth"])):
                    doc = np.frombuffer(raw, dtype="<u2").astype("<u4")
                    full = len(doc) - rest
                    for s in range(0, full, window):
                        at.append(i), start.append(s), length.append(window)
                        ids.append(doc[s:s + window].tobytes())
                        sequence.append(number), offset.append(0)
                        number += 1
                    for s, n, q, o in place(rest, rank).tolist() if rest else ():
                        at.append(i), start.append(full + s), length.append(n)
                        ids.append(doc[full + s:full + s + n].tobytes())
                        sequence.append(q), offset.append(o)
                out = some[kept].iloc[at].copy()
                out["start"], out["length"], out["ids"] = start, length, ids
                out["doc_tokens"] = some["_n_ids"].to_numpy()[at]
                out["sequence_id"], out["offset"] = sequence, offset
                yield out

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text]
    schema = ", ".join([*columns, "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"])
    return rows.select(*kept, "_ids", "_n_ids", "_rest", "_nth", "_n0").mapInPandas(cut_pieces, schema)
