"""Suffix-array dedup: remove byte strings that occur more than once.

A string of LENGTH bytes that occurs twice picks the same anchor in both
places: the GRAM-byte string of least hash inside it. So neighbouring strings
with one anchor form a segment, segments meet by anchor, and each anchor's
distinct segments get a suffix array (``suffix_array``), in which equal
strings are neighbours. Texts with anchors of their own never move. An anchor
with more than SPLIT bytes of distinct segments is sorted in subgroups: equal
strings have their anchor in the same place, so segments are cut into blocks of
strings by ranges of that place, and blocks meet by range and by the bytes that
all their strings share. Ranges are narrowed until a subgroup is small enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, private, ready
from .suffix_array import suffix_arrays

LENGTH, GRAM = 200, 32
#: Bytes hashed at once inside a task, and bytes of segments sorted in one.
AT_ONCE, SORTED = 1_000_000, 4_000_000
#: Bytes of one anchor's distinct segments that are sorted together.
SPLIT = 500_000
#: Places of the anchor in strings that are looked at together, to leave out
#: segments that share no string with any other.
COMPANY = 32
#: Places of the anchor in one block's strings, narrowed from first to last.
WIDTHS = (64, 16, 4, 1)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    return (np.cumprod(np.full(n, np.uint64(base))),
            np.cumprod(np.full(n, np.uint64(pow(base, -1, 1 << 64)))))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def text_segments(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """For all texts: text number, anchor hash, segment hash, first string,
    last string + 1 and the anchor's place after the first, of each run of
    strings with one anchor.

    Hashes are sums of bytes times powers, wrapped at 64 bits, so every hash
    is a difference of two prefix sums; the least hash of a string's grams
    (the leftmost of equals) comes from doubling minima."""
    # Long texts go in pieces that share length - 1 bytes: each string once.
    pieces, owner, shift = [], [], []
    for i, t in enumerate(texts):
        for a in range(0, len(t) - length + 1, AT_ONCE):
            pieces.append((t, a))
            owner.append(i)
            shift.append(a)
    found = []
    for a, b in chunks(pieces, [min(AT_ONCE, len(t) - at) for t, at in pieces], AT_ONCE):
        some = [t[at:at + AT_ONCE + length - 1] for t, at in pieces[a:b]]
        piece, h, sh, first, stop, place = _piece_segments(some, length, gram)
        move = np.array(shift[a:b])[piece]
        found.append((np.array(owner[a:b])[piece], h, sh, first + move, stop + move, place))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 6
    return tuple(np.concatenate(x) for x in zip(*found))


def _piece_segments(pieces: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``text_segments`` of a few megabytes: pieces of ``length`` bytes or more."""
    flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    power, back = _powers(max(len(flat), 2 * AT_ONCE + 4 * length))
    total = np.zeros(len(flat) + 1, dtype=np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[:len(flat)], out=total[1:])
    grams = _mix((total[gram:] - total[:-gram]) * back[:len(flat) - gram + 1])
    wide = length - gram + 1
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    n = len(grams) - wide + 1
    least = np.minimum(least[:n], least[wide - span:wide - span + n])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes) - sizes
    # Strings that run from one piece into the next don't count.
    use = np.zeros(len(flat), dtype=bool)
    edge = np.zeros(len(flat) + 1, dtype=bool)
    for s, m in zip(starts, sizes):
        use[s:s + m - length + 1] = True
        edge[s] = True
    use, edge = use[:n], edge[:n]
    edge[1:] |= anchor[1:] != anchor[:-1]
    first = np.flatnonzero(use & edge)
    stop = np.flatnonzero(use & np.r_[~use[1:] | edge[1:], True]) + 1
    whole = _mix((total[stop + length - 1] - total[first]) * back[first] + (stop - first).astype(np.uint64))
    piece = np.searchsorted(starts, first, side="right") - 1
    return (piece, grams[anchor[first]].view(np.int64), whole.view(np.int64),
            first - starts[piece], stop - starts[piece], anchor[first] - first)


def segments(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``h, sh, k1, k2, s, e, o``: anchor, segment, text, string range, place of
    the anchor, of all texts ``k1, k2, text``. A task passes on a text it has
    seen twice no further: two are enough to know that all of it repeats."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int], int] = {}
        for pdf in batches:
            k1, k2, raw = pdf["k1"].to_numpy(), pdf["k2"].to_numpy(), pdf["text"].tolist()
            a = 0
            while a < len(raw):
                rows, size = [], 0
                while a < len(raw) and size < AT_ONCE:
                    key = (int(k1[a]), int(k2[a]))
                    seen[key] = seen.get(key, 0) + 1
                    if seen[key] <= 2:
                        rows.append(a)
                        size += len(raw[a])
                    a += 1
                of, h, sh, s, e, o = text_segments([bytes(raw[r]) for r in rows], length, gram)
                at = np.array(rows, dtype=np.int64)[of] if len(of) else of
                yield pd.DataFrame({"h": h, "sh": sh, "k1": k1[at], "k2": k2[at],
                                    "s": s.astype(np.int64), "e": e.astype(np.int64), "o": o.astype(np.int32)})

    return texts.mapInPandas(run, "h long, sh long, k1 long, k2 int, s long, e long, o int")


def _joined(rows: list[bytes], at: list[int], length: int) -> tuple[np.ndarray, int]:
    """An anchor's segments as one text, and the symbols of a string in it:
    bytes from 2 on, 1 between segments, 0 at the end. What every string of
    every segment holds (the anchor and more) is one symbol from 300 on."""
    low = max(len(r) - length - o for r, o in zip(rows, at))  # last string's start
    high = min(length - o for o in at)  # first string's end
    parts, names = [], {}
    for r, o in zip(rows, at):
        block = names.setdefault(r[o + low:o + high], 300 + len(names))
        parts += [np.frombuffer(r, dtype=np.uint8, count=o + low).astype(np.int64) + 2, [block],
                  np.frombuffer(r, dtype=np.uint8, offset=o + high).astype(np.int64) + 2, [1]]
    parts[-1] = [0]
    return np.concatenate(parts).astype(np.int64), length - (high - low) + 1


def with_company(rows: list[bytes], at: list[int], length: int) -> list[int]:
    """Which of an anchor's segments may share a string with another: in both,
    its anchor's place lies in one range of COMPANY, and what all strings of
    that range hold is the same."""
    wide = min(COMPANY, length)
    first: dict[tuple[int, bytes], int] = {}
    found = set()
    for i, (row, o) in enumerate(zip(rows, at)):
        for b in range((o - len(row) + length) // wide, o // wide + 1):
            s = o - b * wide
            other = first.setdefault((b, row[s:s - wide + 1 + length]), i)
            if other != i:
                found.update((other, i))
    return sorted(found)


def repeated_strings(groups: list[tuple[list[bytes], list[bool], list[int]]], length: int) -> list[list[np.ndarray]]:
    """For each anchor's distinct segments, whether a segment occurs more than
    once, and the anchor's places: a mask over each segment's strings that
    occur anywhere else.

    All strings of a segment that occurs twice do. The others are found in the
    suffix array of all the anchor's segments that can share a string, where
    suffixes that begin with the same string are neighbours."""
    masks = [[np.full(len(r) - length + 1, m) for r, m in zip(rows, many)] for rows, many, _ in groups]
    todo = []
    for g, (rows, many, at) in enumerate(groups):
        if len(rows) > 1 and not all(many):
            some = with_company(rows, at, length)
            if not all(many[i] for i in some):
                todo.append((g, some))
    texts = [_joined([groups[g][0][i] for i in some], [groups[g][2][i] for i in some], length) for g, some in todo]
    for (g, some), (text, wide), sa in zip(todo, texts, suffix_arrays([t for t, _ in texts])):
        mine = [masks[g][i] for i in some]
        sizes = np.array([len(m) + wide for m in mine])
        starts = np.cumsum(sizes) - sizes
        valid = np.zeros(len(text), dtype=bool)
        for s, m in zip(starts, mine):
            valid[s:s + len(m)] = True
        order = sa[valid[sa]]
        if len(order) < 2:
            continue
        a, b = order[:-1], order[1:]
        near = np.flatnonzero((text[a + wide - 1] == text[b + wide - 1]) & (text[a] == text[b]))
        view = np.lib.stride_tricks.sliding_window_view(text, wide)
        hit = np.zeros(len(text), dtype=bool)
        for k in range(0, len(near), 4096):
            x, y = a[near[k:k + 4096]], b[near[k:k + 4096]]
            same = (view[x] == view[y]).all(axis=1)
            hit[x[same]] = True
            hit[y[same]] = True
        for i, s, mask in zip(some, starts, mine):
            masks[g][i] = mask | hit[s:s + len(mask)]
    return masks


def blocks_of(row: bytes, o: int, length: int, width: int) -> list[tuple[int, int, int, bytes]]:
    """Blocks of a segment's strings whose anchor (at ``o`` in the segment) has
    its place in one range of ``width``: first string, last string + 1, number
    of the range, and the bytes that strings of that range all hold."""
    n = len(row) - length + 1
    number = (o - np.arange(n)) // width
    first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    return [(i, j, b, row[o - b * width:o - b * width - width + 1 + length])
            for i, j, b in zip(first.tolist(), np.r_[first[1:], n].tolist(), number[first].tolist())]


def _sorted_groups(pdf: pd.DataFrame, key: str, length: int) -> list[np.ndarray]:
    """Masks over the strings of each row's bytes, ``key`` by ``key`` in the
    order of the rows."""
    h = pdf[key].to_numpy()
    raw, many, at = pdf["bytes"].tolist(), pdf["many"].tolist(), pdf["o"].tolist()
    edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]).tolist() + [len(h)]
    groups = [(raw[a:b], many[a:b], at[a:b]) for a, b in zip(edge, edge[1:])]
    return [m for group in repeated_strings(groups, length) for m in group]


def split_anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``h, sh, runs`` of the distinct segments ``h, sh, many, o, bytes`` of
    large anchors: the runs of strings that occur anywhere else.

    Each round has a row for each block. Equal blocks are one row of their
    subgroup (their bytes are compared); subgroups of up to SPLIT distinct bytes
    are sorted, larger ones are cut into narrower blocks. At a width of one
    place a block is a string and a subgroup's strings are all alike."""
    spark = rows.sparkSession

    def runs_of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["g", "o"], kind="stable")
        masks = _sorted_groups(pdf, "g", length)
        return pd.DataFrame({"g": pdf["g"], "o": pdf["o"], "bytes": pdf["bytes"], "runs": [_runs(m) for m in masks]})

    pending = rows.select("h", "sh", F.lit(0).alias("i"), "o", "bytes")
    found = None
    for width in [w for w in WIDTHS if w <= length - gram + 1]:

        def narrowed(batches: Iterator[pd.DataFrame], width=width) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for h, sh, i, o, row in zip(*[pdf[c].tolist() for c in ("h", "sh", "i", "o", "bytes")]):
                    for a, z, b, core in blocks_of(row, o, length, width):
                        sign = xxhash.xxh64_intdigest(core, (h ^ (b * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF)
                        out.append((h, sh, i + a, o - a, sign - (sign >> 63 << 64), row[a:z - 1 + length]))
                yield pd.DataFrame(out, columns=["h", "sh", "i", "o", "g", "bytes"])

        blocks = cut(pending.mapInPandas(narrowed, "h long, sh long, i int, o int, g long, bytes binary"))
        distinct = cut(blocks.groupBy("g", "o", "bytes").agg(F.count("*").alias("n")))
        sizes = distinct.groupBy("g").agg(F.sum("n").alias("all"), F.sum(F.octet_length("bytes")).alias("size"))
        sizes = cut(sizes.filter("all > 1").select("g", (F.col("size") > SPLIT).alias("large") if width > 1 else F.lit(False).alias("large")))
        total = distinct.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SORTED))
        small = distinct.join(sizes.filter("not large"), "g").select("g", "o", "bytes", (F.col("n") > 1).alias("many"))
        hits = (
            small.withColumn("part", F.pmod(F.hash("g"), F.lit(parts))).repartition(parts, "part")
            .groupBy("part").applyInPandas(runs_of, "g long, o int, bytes binary, runs array<int>").filter(F.size("runs") > 0)
        )
        its = blocks.join(cut(hits), ["g", "o", "bytes"]).select(
            "h", "sh", F.transform("runs", lambda r: r + F.col("i")).alias("runs"))
        found = its if found is None else found.unionByName(its)
        large = sizes.filter("large")
        if large.isEmpty():
            break
        pending = blocks.join(large, "g").select("h", "sh", "i", "o", "bytes")
    # All strings of a segment that occurs twice do.
    whole = rows.filter("many").select("h", "sh", F.array(F.lit(0), (F.octet_length("bytes") - length + 1)).alias("runs"))
    return found.join(whole.select("h", "sh"), ["h", "sh"], "left_anti").unionByName(whole)


def _runs(mask: np.ndarray) -> list[int]:
    d = np.diff(np.r_[0, mask.astype(np.int8), 0])
    return np.stack([np.flatnonzero(d == 1), np.flatnonzero(d == -1)], axis=1).ravel().tolist()


def repeated_ranges(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``k1, k2, ranges, n_spans``: for each text (by its two hashes) with
    removed bytes, the byte ranges to keep (start, length) and the number of
    removed runs."""
    spark = ready(docs)
    keyed = (
        docs.select(F.col(text).cast("binary").alias("text"))
        .filter(F.octet_length("text") >= length)
        .select(F.xxhash64("text").alias("k1"), F.hash("text").alias("k2"), "text")
    )
    # Anchors that occur once go. Counts combine before they are shuffled, and
    # Spark splits a frequent anchor's rows in the join.
    every = cut(segments(keyed, length, gram))
    often = cut(every.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"))
    found = cut(every.join(often, "h"))
    # Each distinct segment is read in one text.
    distinct = cut(
        found.groupBy("h", "sh").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "s", "e", "o")).alias("r"))
        .select("h", "sh", (F.col("n") > 1).alias("many"), "r.*")
    )
    size = distinct.agg(F.sum(F.col("e") - F.col("s") + length)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SORTED))
    large = cut(
        distinct.groupBy("h").agg(F.sum(F.col("e") - F.col("s") + length).alias("n")).filter(F.col("n") > SPLIT)
        .select("h", F.lit(True).alias("_l"))
    )
    distinct = distinct.join(large, "h", "left").withColumn("large", F.coalesce("_l", F.lit(False)))
    fields = ("h", "sh", "many", "large", "s", "e", "o")
    wanted = distinct.groupBy("k1", "k2").agg(F.collect_list(F.struct(*fields)).alias("list"))
    texts = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            columns = {f: np.concatenate(pdf[f].tolist()) for f in fields}
            raw, a = [], 0
            for text, n in zip(pdf["text"], pdf["h"].map(len)):
                raw += [text[s:e + length - 1] for s, e in zip(columns["s"][a:a + n].tolist(), columns["e"][a:a + n].tolist())]
                a += n
            yield pd.DataFrame({f: columns[f] for f in ("h", "sh", "many", "large", "o")} | {"bytes": raw})

    cut_out = cut(texts.join(wanted, ["k1", "k2"]).select("text", *[F.col(f"list.{f}").alias(f) for f in fields]).mapInPandas(
        read, "h long, sh long, many boolean, large boolean, o int, bytes binary"))

    def sort(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "sh"], kind="stable")
        masks = _sorted_groups(pdf, "h", length)
        return pd.DataFrame({"h": pdf["h"], "sh": pdf["sh"], "runs": [_runs(m) for m in masks]})

    hits = (
        cut_out.filter("not large").withColumn("part", F.pmod(F.hash("h"), F.lit(parts))).repartition(parts, "part")
        .groupBy("part").applyInPandas(sort, "h long, sh long, runs array<int>").filter(F.size("runs") > 0)
    ).unionByName(split_anchors(cut_out.filter("large"), length, gram))
    # A text's own spans; those of its copies are equal.
    spans = found.select("h", "sh", "k1", "k2", "s").join(cut(hits), ["h", "sh"]).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("s", "runs")).alias("list"))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ranges, counts = [], []
            for rows in pdf["list"]:
                pairs = sorted((int(r["s"]) + int(a), int(r["s"]) + int(b) + length - 1)
                               for r in rows for a, b in zip(r["runs"][::2], r["runs"][1::2]))
                keep, end, n = [], 0, 0
                for a, b in pairs:
                    if a > end or not n:
                        n += 1
                        if a > end:
                            keep.append({"start": end, "size": a - end})
                    end = max(end, b)
                keep.append({"start": end, "size": 2**31 - 1})
                ranges.append(keep)
                counts.append(n)
            yield pd.DataFrame({"k1": pdf["k1"], "k2": pdf["k2"], "ranges": ranges, "n_spans": counts})

    return spans.mapInPandas(merge, "k1 long, k2 int, ranges array<struct<start:long,size:long>>, n_spans long")


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with ``kept`` (binary: the text's bytes without those covered
    by a ``length``-byte string that also starts anywhere else) and
    ``n_spans`` (removed runs).

    Strings are judged on the input and never cross texts; overlaps and
    repeats inside one text count. Null texts count as empty; texts shorter
    than ``length`` stay whole. Copies of a text are read once and share their
    result. Columns of these names are replaced, others kept; an empty table
    stays empty.
    """
    return _marked(docs.drop("kept", "n_spans"), text, length, gram, "kept", "n_spans")


def _marked(docs: DataFrame, text: str, length: int, gram: int, kept: str, n_spans: str) -> DataFrame:
    k1, k2, r, n = private(docs, "k1", "k2", "r", "n")
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    its = docs.withColumns({k1: F.xxhash64(raw), k2: F.hash(raw)})
    ranges = cut(repeated_ranges(docs, text, length, gram)).select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("ranges").alias(r), F.col("n_spans").alias(n))
    # Slices of bytes, joined at once.
    slices = F.transform(r, lambda x: F.substring(raw, (x["start"] + 1).cast("int"), x["size"].cast("int")).cast("string"))
    joined = F.array_join(slices, "").cast("binary")
    return (
        its.join(ranges.hint("shuffle_hash"), [k1, k2], "left")
        .select(*docs.columns, F.when(F.col(r).isNull(), raw).otherwise(joined).alias(kept),
                F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n_spans))
    )


#: Whole UTF-8 characters in a run, bytes written as code points 0 to 255.
_WHOLE = (r"(?s)((?:[\x00-\x7F]|[\xC2-\xDF][\x80-\xBF]|[\xE0-\xEF][\x80-\xBF]{2}"
          r"|[\xF0-\xF4][\x80-\xBF]{3})++)|.")


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; a character that
    lost some of its bytes goes. Every row and column stays, whatever they are
    called, an emptied text and a null one too; copies of a text lose the same;
    an empty table stays empty."""
    kept, n_spans = private(docs, "kept", "n_spans")
    out = _marked(docs, text, length, gram, kept, n_spans)
    plain = F.regexp_replace(F.decode(kept, "ISO-8859-1"), _WHOLE, "$1")
    mended = F.encode(plain, "ISO-8859-1").cast("string")
    return out.withColumn(text, F.when(F.col(n_spans) > 0, mended).otherwise(F.col(text))).select(*docs.columns)
