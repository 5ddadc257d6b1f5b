"""URL filters: a bit-parallel automaton runs all glob rules at once.

Every rule is a row of states, one bit each, packed into 64-bit words. One
step per byte of the URL moves all rules together (Shift-And with self loops
for the wildcards), for all URLs of a batch together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, ready

#: URLs up to this many bytes are stepped together; longer ones one by one.
TOGETHER = 512


@dataclass(frozen=True)
class Rule:
    """A glob over ``.host/path``: ``*`` is a run without ``/``, ``**`` any
    run, ``?`` one character other than ``/`` (of one byte). ``weight``: the
    heaviest matching rule wins, then the first given."""

    glob: str
    verdict: str
    name: str
    weight: int


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host, its subdomains and the paths that start so."""
    return Rule(f"*.{host}{path}**", verdict, host + path, len(host + path))


class Automaton:
    """The rules' masks: ``step[c]`` (states entered by byte c), ``stay[c]``
    (wildcard states that byte c keeps), ``start`` and ``final``."""

    def __init__(self, rules: list[Rule]):
        self.order = sorted(range(len(rules)), key=lambda i: (-rules[i].weight, i))
        step, stay = [0] * 256, [0] * 256
        self.start, self.finals, at = 0, [], 0
        for i in self.order:
            self.start |= 1 << at
            glob, k = rules[i].glob.encode(), 0
            while k < len(glob):
                c = glob[k]
                if c == ord("*"):
                    wide = glob[k:k + 2] == b"**"
                    for b in range(256):
                        if wide or b != ord("/"):
                            stay[b] |= 1 << at
                    k += 2 if wide else 1
                    continue
                at += 1
                for b in range(256) if c == ord("?") else (c,):
                    if c != ord("?") or b != ord("/"):
                        step[b] |= 1 << at
                k += 1
            self.finals.append(at)
            at += 1
        self.words = max(1, -(-at // 64))
        self.step, self.stay = step, stay
        pack = lambda x: [(x >> (64 * w)) & (2**64 - 1) for w in range(self.words)]
        self.step_words = np.array([pack(x) for x in step], dtype=np.uint64)
        self.stay_words = np.array([pack(x) for x in stay], dtype=np.uint64)
        self.start_words = np.array(pack(self.start), dtype=np.uint64)

    def _one(self, url: bytes) -> int:
        state = self.start
        for c in url:
            state = ((state << 1) & self.step[c]) | (state & self.stay[c])
        return next((k for k, bit in enumerate(self.finals) if state >> bit & 1), -1)

    def best(self, urls: list[bytes]) -> np.ndarray:
        """For each URL the index of its winning rule, or -1."""
        out = np.full(len(urls), -1, dtype=np.int32)
        sizes = np.array([len(u) for u in urls], dtype=np.int64)
        for i in np.flatnonzero(sizes > TOGETHER):
            out[i] = self._one(urls[i])
        rows = np.flatnonzero(sizes <= TOGETHER)
        rows = rows[np.argsort(-sizes[rows], kind="stable")]
        if len(rows):
            lengths, longest = sizes[rows], int(sizes[rows[0]])
            text = np.zeros((len(rows), max(longest, 1)), dtype=np.uint8)
            flat = np.frombuffer(b"".join(urls[i] for i in rows), dtype=np.uint8)
            text[np.arange(text.shape[1]) < lengths[:, None]] = flat
            state = np.repeat(self.start_words[None, :], len(rows), axis=0)
            live = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
            for at in range(longest):
                n = live[at]
                c, now = text[:n, at], state[:n]
                moved = now << np.uint64(1)
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
                state[:n] = (moved & self.step_words[c]) | (now & self.stay_words[c])
            found = np.full(len(rows), -1, dtype=np.int32)
            for k in range(len(self.finals) - 1, -1, -1):
                word, bit = divmod(self.finals[k], 64)
                found[(state[:, word] >> np.uint64(bit)) & np.uint64(1) == 1] = k
            out[rows] = found
        hit = out >= 0
        out[hit] = np.array(self.order, dtype=np.int32)[out[hit]] if len(self.order) else -1
        return out


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty where there is no ``://`` or the url is null."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty like the host."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url",
          no_rule: str = "allow", no_host: str = "block") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (name of the winning rule or
    null) and ``verdict``: the winning rule's, else ``no_rule``, else
    ``no_host`` where the url is null or names no host.

    Narrow: no shuffle. Urls of any length are run in full. Columns of these
    four names are replaced, all others kept; an empty table stays empty.
    """
    ready(pages)
    machine = Automaton(rules)

    @F.pandas_udf("int")
    def winner(urls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in urls:
            yield pd.Series(machine.best([u.encode("utf-8", "surrogatepass") for u in batch]))

    names = F.array(*[F.lit(r.name) for r in rules]) if rules else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]) if rules else F.array().cast("array<string>")
    host, path = host_of(F.col(url)), path_of(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return (
        pages.select(*[F.col(c) for c in kept if c != url], *([F.col(url)] if url in kept else []),
                     host.alias("host"), path.alias("path"))
        .withColumn("_rule", winner(F.concat(F.lit("."), "host", "path")))
        .withColumn("rule", F.when(F.col("_rule") >= 0, F.get(names, F.col("_rule"))))
        .withColumn("verdict", F.when(F.col("_rule") >= 0, F.get(verdicts, F.col("_rule")))
                    .when(F.col("host") == "", F.lit(no_host)).otherwise(F.lit(no_rule)))
        .drop("_rule")
    )
