"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from its whole text,
gated attention weighs the passages, and the label of the document alone
teaches encoder, gates and scorer together. Scoring is a weighted mean over
passages, so texts of any length run in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, private, ready

#: Words of a passage; bytes of text encoded at once (longer texts are read in
#: windows of about that size, cut where a passage begins).
PASSAGE, AT_ONCE = 64, 500_000
#: Labelled rows that a model is fitted on at most, half of each label.
FIT_ROWS = 2_000
#: Byte classes: space, newline, a-z, A-Z, digits, each kind of sign, the rest.
_GROUPS = (b" \t\r\x0b\x0c", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
           b".", b",;:", b"!?", b"|", b"#*", b"$%&", b"'\"()", b"-_/\\", b"<>@=+~^{}[]", bytes(range(128, 256)))
KINDS = len(_GROUPS) + 1
_CLASS = np.full(256, KINDS - 1, dtype=np.int64)
for _k, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _k
WIDTH = KINDS * KINDS + 6


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.uint64, np.ndarray, np.ndarray]:
    """An odd number, its powers and those of its inverse, modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    power = np.cumprod(np.full(n, np.uint64(base)))
    return np.uint64(base), power, np.cumprod(np.full(n, np.uint64(pow(base, -1, 1 << 64))))


def passage_features(texts: list[bytes], gaps: list[bytes] | None = None, before: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """A row per passage of all texts, and each row's text number. A text
    without words is one passage of zeros. ``gaps`` are the bytes after each
    text, line ends unless a text goes on in the next; ``before`` is the one
    before them all."""
    gaps = gaps or [b"\n"] * len(texts)
    flat = np.frombuffer(b"".join([x for t, g in zip(texts, gaps) for x in (t, g)]), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    kind = _CLASS[flat]
    solid = kind > 1
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    first = np.flatnonzero(starts)
    last = np.flatnonzero(solid[:-1] & ~solid[1:]) + 1  # the last byte is a gap
    owner = np.searchsorted(ends, first, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    of_text = np.maximum(1, -(-n_words // PASSAGE))  # passages of each text
    base = np.r_[0, np.cumsum(of_text)]
    order = np.arange(len(first)) - np.r_[0, np.cumsum(n_words)][owner]
    passage = base[owner] + order // PASSAGE  # of each word
    rows = int(base[-1])
    x = np.zeros((rows, WIDTH), dtype=np.float32)
    if len(first):
        # Each byte belongs to the word that it follows, so to its passage.
        to_word = np.cumsum(starts, dtype=np.int32)
        text_of = np.repeat(np.arange(len(texts)), np.diff(np.r_[0, ends]))
        to_word[np.r_[-1, owner][to_word] != text_of] = 0  # before a text's first word: to none
        pair = kind.copy()
        pair[1:] += KINDS * kind[:-1]
        pair[0] += KINDS * _CLASS[before[0]]
        spot = np.r_[rows, passage][to_word] * (KINDS * KINDS) + pair
        counts = np.bincount(spot, minlength=(rows + 1) * KINDS * KINDS)[:rows * KINDS * KINDS]
        counts = counts.reshape(rows, KINDS * KINDS).astype(np.float32)
        x[:, :KINDS * KINDS] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
        # Words as numbers: sums of bytes times powers, wrapped at 64 bits.
        mult, power, back_power = _powers(max(len(flat), 2 * AT_ONCE))
        length = last - first
        total = np.zeros(len(flat) + 1, dtype=np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[:len(flat)], out=total[1:])
        word = (total[last] - total[first]) * back_power[first] + length.astype(np.uint64)
        n = np.bincount(passage, minlength=rows).astype(np.float32)
        n1 = np.maximum(n, 1)
        for k, back in enumerate((1, 2)):
            same = np.zeros(len(word), dtype=bool)
            same[back:] = (word[back:] == word[:-back]) & (passage[back:] == passage[:-back])
            x[:, KINDS * KINDS + k] = np.bincount(passage, same, minlength=rows) / n1
        kinds = np.unique(word ^ (passage.astype(np.uint64) * mult), return_index=True)[1]
        x[:, KINDS * KINDS + 2] = np.bincount(passage[kinds], minlength=rows) / n1
        x[:, KINDS * KINDS + 3] = np.bincount(passage, np.minimum(length, 40), minlength=rows) / n1 / 10
        x[:, KINDS * KINDS + 4] = n / PASSAGE
        x[:, KINDS * KINDS + 5] = np.log1p(np.bincount(passage, length > 20, minlength=rows))
    return x, np.repeat(np.arange(len(texts)), of_text)


def windows(text: bytes) -> list[tuple[bytes, bytes]]:
    """A text in windows of about AT_ONCE bytes and the byte after each, cut
    before the first word of a passage, so that the passages are those of the
    whole text. A window that holds no whole passage is read on until it does."""
    out, most = [], AT_ONCE
    while len(text) > most:
        solid = _CLASS[np.frombuffer(text, dtype=np.uint8, count=most)] > 1
        starts = np.flatnonzero(solid & ~np.r_[False, solid[:-1]])
        whole = (len(starts) - 1) // PASSAGE * PASSAGE
        if whole <= 0:
            most *= 2
            continue
        out.append((text[:starts[whole] - 1], text[starts[whole] - 1:starts[whole]]))
        text, most = text[starts[whole]:], AT_ONCE
    return [*out, (text, b"\n")]


@dataclass
class Model:
    """Encoder ``enc``, gates ``v`` and ``u``, attention ``w``, scorer ``c``;
    ``constant`` where there was nothing to learn from."""

    p: dict[str, np.ndarray]
    constant: float | None = None

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passage representations and attention logits (bounded by |w|)."""
        p = self.p
        h = np.tanh(x @ p["enc"] + p["enc0"])
        return h, (np.tanh(h @ p["v"]) / (1 + np.exp(-(h @ p["u"])))) @ p["w"]

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of whole texts, and the passage with the most attention."""
        if self.constant is not None:
            return np.full(len(texts), self.constant), np.zeros(len(texts), dtype=np.int32)
        units, gaps, owner = [], [], []
        for i, t in enumerate(texts):
            for part, gap in windows((t or "").encode("utf-8", "surrogatepass")):
                units.append(part)
                gaps.append(gap)
                owner.append(i)
        size = self.p["v"].shape[0]
        mass, sums = np.zeros(len(texts)), np.zeros((len(texts), size))
        top, top_at, seen = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int32), np.zeros(len(texts), np.int64)
        for a, b in chunks(units, [len(u) for u in units], AT_ONCE):
            x, of = passage_features(units[a:b], gaps[a:b], gaps[a - 1] if a else b"\n")
            doc = np.array(owner[a:b])[of]
            h, logit = self.encode(x)
            e = np.exp(logit)
            mass += np.bincount(doc, e, minlength=len(texts))
            np.add.at(sums, doc, e[:, None] * h)
            for d in np.unique(doc):
                rows = np.flatnonzero(doc == d) if d in (doc[0], doc[-1]) else slice(*np.searchsorted(doc, [d, d + 1]))
                k = int(np.argmax(logit[rows]))
                if logit[rows][k] > top[d]:
                    top[d], top_at[d] = logit[rows][k], seen[d] + k
                seen[d] += len(logit[rows])
        z = sums / np.maximum(mass, 1e-300)[:, None]
        return 1 / (1 + np.exp(-(z @ self.p["c"] + self.p["c0"][0]))), top_at


def fit(texts: list[str], labels: np.ndarray, hidden: int = 24, gate: int = 12, steps: int = 240,
        seed: int = 1) -> Model:
    """Gradient descent (Adam) on the document log loss, classes weighed
    equally; the passage gradients flow through the attention weights."""
    if not len(texts) or labels.min() == labels.max():
        return Model({}, float(labels.mean()) if len(texts) else 0.5)
    raw, parts, owners = [t.encode("utf-8", "surrogatepass") for t in texts], [], []
    for a, b in chunks(raw, [len(t) for t in raw], AT_ONCE):  # the work arrays are many times the text
        part, of = passage_features(raw[a:b])
        parts.append(part)
        owners.append(of + a)
    x, of = np.concatenate(parts), np.concatenate(owners)
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    y = labels.astype(np.float64)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y).mean()) / len(y)
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 0.05
    x = ((x - mean) / scale).astype(np.float32)
    p = {"enc": rng.normal(0, WIDTH ** -0.5, (WIDTH, hidden)), "enc0": np.zeros(hidden),
         "v": rng.normal(0, hidden ** -0.5, (hidden, gate)), "u": rng.normal(0, hidden ** -0.5, (hidden, gate)),
         "w": rng.normal(0, 0.3, gate), "c": rng.normal(0, hidden ** -0.5, hidden), "c0": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    weight, y = weight.astype(np.float32), y.astype(np.float32)
    m1, m2 = {k: np.float32(0) for k in p}, {k: np.float32(0) for k in p}
    for t in range(1, steps + 1):
        h = np.tanh(x @ p["enc"] + p["enc0"])
        tv, su = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = np.exp((tv * su) @ p["w"])
        a = e / np.add.reduceat(e, starts)[of]
        z = np.add.reduceat(a[:, None] * h, starts)
        s = 1 / (1 + np.exp(-(z @ p["c"] + p["c0"])))
        ds = (s - y) * weight
        dz = ds[:, None] * p["c"]
        da = (dz[of] * h).sum(axis=1)
        dl = a * (da - np.add.reduceat(a * da, starts)[of])
        dg = dl[:, None] * p["w"]
        dtv, dsu = dg * su * (1 - tv ** 2), dg * tv * su * (1 - su)
        dh = a[:, None] * dz[of] + dtv @ p["v"].T + dsu @ p["u"].T
        dpre = dh * (1 - h ** 2)
        g = {"enc": x.T @ dpre, "enc0": dpre.sum(axis=0), "v": h.T @ dtv, "u": h.T @ dsu,
             "w": (tv * su).T @ dl, "c": z.T @ ds, "c0": np.array([ds.sum()])}
        for k in p:
            grad = g[k] + (1e-4 * p[k] if k not in ("enc0", "c0") else 0)
            m1[k], m2[k] = 0.9 * m1[k] + 0.1 * grad, 0.999 * m2[k] + 0.001 * grad ** 2
            p[k] = p[k] - np.float32(0.01) * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.999 ** t)) + 1e-8)
    # The scaling becomes part of the encoder.
    p = {k: v.astype(np.float64) for k, v in p.items()}
    p["enc0"] = p["enc0"] - (mean / scale) @ p["enc"]
    p["enc"] = p["enc"] / scale[:, None]
    return Model({k: np.asarray(v, dtype=np.float64) for k, v in p.items()})


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
          text: str = "text", rows: int = FIT_ROWS) -> Model:
    """Fit on a bounded sample of labelled documents: about ``rows / 2`` of
    either label (1 or 0) at most, by hash of the key; of a key's repeated
    texts each counts once. Null keys and labels are passed over."""
    ready(docs)
    some = labels.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y")).filter("_k is not null and _y in (0, 1)")
    some = some.dropDuplicates()
    # Both labels thinned out by hash to the same number of rows.
    counts = {r["_y"]: r["count"] for r in some.groupBy("_y").count().collect()}
    keep = F.lit(False)
    for y, n in counts.items():
        share = -(-n // (rows // 2))
        keep = keep | ((F.col("_y") == y) & (F.pmod(F.xxhash64("_k"), F.lit(share)) == 0))
    some = some.filter(keep).orderBy(F.xxhash64("_k"), "_k", "_y").limit(2 * rows)
    found = (
        docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
        .join(F.broadcast(some), F.col("_key") == F.col("_k"))  # at most 2 * rows
        .select("_k", "_t", "_y").withColumn("_h", F.xxhash64("_k", "_t")).dropDuplicates(["_h", "_y"])
        .orderBy("_h", "_y").limit(2 * rows).select("_k", "_t", "_y").toPandas()
    ).sort_values(["_k", "_t"], kind="stable")
    return fit(found["_t"].tolist(), found["_y"].to_numpy())


def classify(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier), ``predicted``
    (1 from ``threshold`` on) and ``top_passage`` (number of the passage with
    the most attention).

    Only the text is read. A null or empty text is a bag of one empty passage.
    Narrow: no shuffle. Columns of these names are replaced, others kept; an
    empty table stays empty.
    """
    ready(docs)
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            s, at = held.value.score(texts.tolist())
            yield pd.DataFrame({"s": s, "p": at})

    out = F.pandas_udf(score, "s double, p int")
    o = private(docs, "o")[0]
    return (
        docs.drop("score", "predicted", "top_passage").withColumn(o, out(F.col(text)))
        .withColumn("score", F.col(f"{o}.s")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
        .withColumn("top_passage", F.col(f"{o}.p")).drop(o)
    )
