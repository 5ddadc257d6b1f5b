"""Language ID: interpolated Kneser-Ney character models, one per language.

Texts become symbols of a learned alphabet (every lower-case letter of the
training texts, a space, one for all else). Four-symbol counts of every training text
add up in Spark; continuation counts and discounts follow from them. A model
is a sorted array of four-symbol codes with one log probability per language,
so a text's cross-entropy is a sum of lookups, and the lowest one per symbol
wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, private, ready

#: 0 a space, 1 any other character, letters from 2 on. Symbols are 6 bits
#: wide if all letters fit, else 16.
BITS, WIDE_BITS, SPACE_SYMBOL, OTHER = 6, 16, 0, 1
#: Of the wide symbols, those from here on come in pairs, for the rarest
#: letters: a lead with the number's upper bits, then a trail with 14 bits.
LEAD, TRAIL = 0x8000, 0xC000
ORDER = 4
MAX_LANGUAGES = 200
#: Bytes of text handled at once inside a task.
AT_ONCE = 2_000_000


def _points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")


class Alphabet:
    """Code point to symbol; letters that no training text holds become OTHER,
    and so does everything that is no letter."""

    def __init__(self, letters: list[int]):
        self.bits = BITS if len(letters) + 2 <= 1 << BITS else WIDE_BITS
        self.table = np.full(0x110000, OTHER, dtype=np.uint32)
        self.table[[9, 10, 11, 12, 13, 32, 0xA0]] = SPACE_SYMBOL
        self.table[np.array(letters, dtype=np.int64)] = np.arange(2, 2 + len(letters), dtype=np.uint32)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Four-symbol codes of all texts, one per symbol but no runs of
        spaces or others (each text opens with spaces), and each text's number."""
        low = [" " * ORDER + t.lower() for t in texts]
        sym = self.table[_points(low)]
        ends = np.cumsum([len(t) for t in low])
        owner = np.repeat(np.arange(len(low)), np.diff(np.r_[0, ends]))
        # A run of one blank symbol counts once; the opening stays.
        keep = np.ones(len(sym), dtype=bool)
        keep[1:] = (sym[1:] != sym[:-1]) | (sym[1:] > OTHER) | (owner[1:] != owner[:-1])
        starts = np.r_[0, ends[:-1]]
        for k in range(1, ORDER):
            keep[starts + k] = True
        sym, owner = sym[keep].astype(np.uint64), owner[keep]
        pairs = np.flatnonzero(sym >= LEAD)
        if len(pairs):
            over = sym[pairs] - np.uint64(LEAD)
            sym[pairs] = np.uint64(LEAD) + (over >> np.uint64(14))
            sym = np.insert(sym, pairs + 1, np.uint64(TRAIL) + (over & np.uint64(0x3FFF)))
            owner = np.insert(owner, pairs + 1, owner[pairs])
        code = sym.copy()
        for k in range(1, ORDER):
            code[k:] |= sym[:-k] << np.uint64(self.bits * k)
        first = np.searchsorted(owner, np.arange(len(low)))
        use = np.ones(len(sym), dtype=bool)
        for k in range(ORDER - 1):
            use[first + k] = False  # no code reaches into the text before
        return code[use], owner[use]


def letter_counts(docs: DataFrame, text: str) -> DataFrame:
    """``cp, n``: how often each lower-case letter occurs in all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0x110000, dtype=np.int64)
        for pdf in batches:
            texts = [t.lower() for t in _pieces(pdf["t"].tolist())[0]]
            for a, b in chunks(texts, [len(t) for t in texts], AT_ONCE):
                found = np.bincount(_points(texts[a:b]))
                total[:len(found)] += found
        cps = [int(c) for c in np.flatnonzero(total) if chr(c).isalpha()]
        yield pd.DataFrame({"cp": np.array(cps, dtype=np.int32), "n": total[cps] if cps else np.array([], dtype=np.int64)})

    rows = docs.select(F.col(text).alias("t")).filter("t is not null").mapInPandas(count, "cp int, n long")
    return rows.groupBy("cp").agg(F.sum("n").alias("n"))


def code_counts(docs: DataFrame, text: str, lang: str, letters: list[int]) -> DataFrame:
    """``lang, code, n`` over all texts: each task adds up its own share."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        alphabet, held = Alphabet(letters), {}
        for pdf in batches:
            for name, part in pdf.groupby("lang", sort=False):
                texts = _pieces(part["t"].tolist())[0]
                for a, b in chunks(texts, [len(t) for t in texts], AT_ONCE):
                    codes, n = np.unique(alphabet.codes(texts[a:b])[0], return_counts=True)
                    old = held.get(name)
                    if old is not None:
                        codes, at = np.unique(np.r_[old[0], codes], return_inverse=True)
                        n = np.bincount(at, np.r_[old[1], n]).astype(np.int64)
                    held[name] = (codes, n)
        for name, (codes, n) in held.items():
            yield pd.DataFrame({"lang": name, "code": codes.view(np.int64), "n": n})

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("t"))
    return (
        rows.filter("lang is not null and t is not null").mapInPandas(count, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
    )


def _discount(n: np.ndarray) -> float:
    """Kneser-Ney's estimate from the counts of ones and twos."""
    ones, twos = int((n == 1).sum()), int((n == 2).sum())
    return ones / (ones + 2 * twos) if ones and twos else 0.5


class KneserNey:
    """One language: interpolated probabilities of four-symbol codes.

    The longest order uses counts, the lower ones continuation counts (how
    many distinct symbols precede); each order is a sorted code array."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, bits: int = BITS):
        self.levels, self.bits, mask = [], bits, (1 << bits * ORDER) - 1
        codes, n = codes.astype(np.uint64), counts.astype(np.float64)
        at = np.argsort(codes)
        codes, n = codes[at], n[at]
        for order in range(ORDER, 0, -1):
            context, inverse = np.unique(codes >> np.uint64(bits), return_inverse=True)
            d = _discount(n)
            total = np.bincount(inverse, n)
            kinds = np.bincount(inverse)
            self.levels.append((codes, np.maximum(n - d, 0), context, total, d * kinds / np.maximum(total, 1)))
            mask >>= bits
            codes, n = np.unique(codes & np.uint64(mask), return_counts=True)
            n = n.astype(np.float64)

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        p, codes = np.full(len(codes), 1.0 / (1 << self.bits)), codes.astype(np.uint64)
        for order in range(1, ORDER + 1):
            keys, top, contexts, total, backoff = self.levels[ORDER - order]
            c = codes & np.uint64((1 << self.bits * order) - 1)
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, c), len(keys) - 1)
            mass = np.where(keys[at] == c, top[at], 0.0)
            context = c >> np.uint64(self.bits)
            to = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            known = contexts[to] == context
            p = np.where(known, mass / np.maximum(total[to], 1) + backoff[to] * p, p)
        return np.log(p)


@dataclass(frozen=True)
class LanguageModel:
    """``letters`` of the alphabet, ``langs`` in order, and one sorted model
    per language. ``sharpness`` turns cross-entropy gaps into a score and
    ``reject_below`` is the calibrated rejection."""

    letters: list[int]
    langs: list[str]
    models: list[KneserNey]
    sharpness: float
    reject_below: float


def _pieces(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Texts in pieces of at most AT_ONCE characters, and each piece's text."""
    each = [[t[a:a + AT_ONCE] for a in range(0, max(1, len(t)), AT_ONCE)] for t in texts]
    return [p for x in each for p in x], np.repeat(np.arange(len(texts)), [len(x) for x in each])


def _entropies(texts: list[str], alphabet: Alphabet, models: list[KneserNey]) -> np.ndarray:
    """Cross-entropy per symbol, a row per text and a column per language."""
    out, n = np.zeros((len(texts), len(models))), np.zeros(len(texts))
    pieces, of = _pieces(texts)
    for a, b in chunks(pieces, [len(p) for p in pieces], AT_ONCE):
        codes, owner = alphabet.codes(pieces[a:b])
        owner = of[a:b][owner]
        kinds, inverse = np.unique(codes, return_inverse=True)
        n += np.bincount(owner, minlength=len(texts))
        for k, model in enumerate(models):
            out[:, k] -= np.bincount(owner, model.log_probability(kinds)[inverse], minlength=len(texts))
    return out / np.maximum(n, 1)[:, None]


def _softmax(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    e = np.exp(-(entropy - entropy.min(1, keepdims=True)) * sharpness)
    return e / e.sum(1, keepdims=True)


def train(docs: DataFrame, text: str = "text", lang: str = "lang",
          target_error: float = 0.01) -> LanguageModel:
    """Learn from every row with a non-null text and language.

    Counts cover all rows and all letters. What reaches the driver are the
    letters and each language's distinct codes: at most 2**24 with up to 62
    letters, and as many as the texts hold beyond. The score's sharpness and the rejection
    level are calibrated on all of these texts: scores below the level hold
    at most ``target_error`` of the right ones.
    """
    ready(docs)
    docs = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    # Code points at most; the commonest have the shortest codes.
    letters = [r["cp"] for r in letter_counts(docs, text).orderBy(F.desc("n"), "cp").collect()]
    bits = Alphabet(letters).bits
    counted = cut(code_counts(docs, text, lang, letters))
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    models = []
    for name in langs:
        table = counted.filter(F.col("lang") == name).select("code", "n").toArrow()
        models.append(KneserNey(table["code"].to_numpy(), table["n"].to_numpy(), bits))
    plain = LanguageModel(letters, langs, models, 1.0, 0.0)
    if not models:
        return plain
    # Calibration: every text's entropies, from the executors, stored once.
    scored = docs.select(F.col(lang).cast("string").alias("lang"), _scorer(docs, plain)(F.col(text))["entropy"].alias("e"))
    truth = (F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1).cast("int")
    rows = cut(scored.filter("e is not null").select("e", truth.alias("truth")))
    sharps = [2.0 ** k for k in range(0, 7)]

    @F.pandas_udf("array<double>")
    def losses(e: pd.Series, truth: pd.Series) -> pd.Series:
        entropy, at = np.stack(e.to_list()), np.arange(len(e))
        return pd.Series(list(np.stack([-np.log(_softmax(entropy, x)[at, truth.to_numpy()] + 1e-9) for x in sharps], 1)))

    each = rows.select(losses("e", "truth").alias("loss"))
    # Decimals add up to the same total in any order.
    total = each.agg(*[F.sum(F.col("loss")[k].cast("decimal(28,15)")) for k in range(len(sharps))]).first()
    if total[0] is None:
        return plain
    sharpness = min(zip(total, sharps))[1]

    @F.pandas_udf("double")
    def top(e: pd.Series) -> pd.Series:
        return pd.Series(_softmax(np.stack(e.to_list()), sharpness).max(1))

    right = rows.filter(F.array_position("e", F.array_min("e")) - 1 == F.col("truth"))
    level = _quantile(cut(right.select(top("e").alias("score"))), target_error)
    return LanguageModel(letters, langs, models, sharpness, level)


def _quantile(scores: DataFrame, share: float) -> float:
    """The quantile of all rows' ``score``, between the two next in order
    (0 without rows)."""
    place = share * (scores.count() - 1)
    if place < 0:
        return 0.0
    lower = _ranked(scores, int(place))
    return float(np.quantile([lower, _ranked(scores, int(place) + 1)], place - int(place))) if place > int(place) else lower


def _ranked(scores: DataFrame, rank: int) -> float:
    """The ``score`` of a rank from 0, exactly: counts by thousandths of a
    range tell in which of them it lies, which is the next range."""
    ends = scores.agg(F.min("score"), F.max("score")).first()
    low, high = ends[0], ends[1]
    while low < high:
        k = F.floor((F.col("score") - low) / (high - low) * 1000).alias("k")
        inside = scores.filter(F.col("score").between(low, high))
        for _, n, low, high in inside.groupBy(k).agg(F.count(F.lit(1)), F.min("score"), F.max("score")).orderBy("k").collect():
            if rank < n:  # of at most 1001 rows
                break
            rank -= n
    return low


def _scorer(docs: DataFrame, model: LanguageModel):
    """UDF text -> (lang_pred, score, entropy per language or null)."""
    # The distinct codes of each language, a few MB here.
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        alphabet = Alphabet(m.letters)
        for series in batches:
            texts = ["" if t is None else t for t in series]
            lang, best, each = ["und"] * len(texts), np.zeros(len(texts)), [None] * len(texts)
            for a, b in chunks(texts, [len(t) for t in texts], AT_ONCE):
                part = [i for i in range(a, b) if any(map(str.isalpha, texts[i]))]
                if not part or not m.langs:
                    continue
                entropy = _entropies([texts[i] for i in part], alphabet, m.models)
                p, top = _softmax(entropy, m.sharpness), entropy.argmin(1)
                for k, i in enumerate(part):
                    lang[i], best[i], each[i] = m.langs[top[k]], min(1.0, float(p[k, top[k]])), entropy[k]
            yield pd.DataFrame({"lang_pred": lang, "score": best, "entropy": each})

    return F.pandas_udf(score, "lang_pred string, score double, entropy array<double>")


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    ``lang_pred`` is the language of the lowest cross-entropy per symbol, the
    first by name among equals; ``und`` with score 0 where the text is null,
    has no letter, or nothing was learned. ``rejected`` marks scores below the
    calibrated level. Whole texts are scored, in pieces of bounded memory.
    Columns of these names are replaced; an empty table stays empty.
    """
    ready(docs)
    out = _scorer(docs, model)
    names = ("lang_pred", "score", "rejected")
    o = private(docs, "o")[0]
    return (
        docs.drop(*names).withColumn(o, out(F.col(text)))
        .withColumn("lang_pred", F.col(f"{o}.lang_pred")).withColumn("score", F.col(f"{o}.score"))
        .withColumn("rejected", (F.col("lang_pred") == "und") | (F.col("score") < model.reject_below))
        .drop(o)
    )
