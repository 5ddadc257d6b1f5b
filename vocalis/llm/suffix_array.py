"""Suffix arrays by linear grouping construction.

Suffixes start in groups of their first symbol. Groups are taken in descending
order: every member points to the previous suffix of a lower group, and the
suffixes pointed to move up into new groups right behind their own, by how
many pointers they got. What remains are the groups of equal Lyndon prefixes
in order. A second pass over the growing suffix array places, for each suffix,
the chain of those before it, which orders every group without renaming.

``suffix_arrays`` runs many short texts in step, one group of each text at a
time; ``suffix_array`` runs one text.
"""

from __future__ import annotations

import numpy as np

#: Fewer texts than this of a size class are run one by one.
IN_STEP = 48
#: Symbols of the texts that run in step together: what caches hold.
AT_ONCE = 400_000


def suffix_array(text: list[int]) -> list[int]:
    """The suffix array of one text whose last symbol is its unique least."""
    n = len(text)
    sa = sorted(range(n), key=text.__getitem__)
    at, group, size = [0] * n, [0] * n, [0] * n
    first = 0
    for i, s in enumerate(sa):
        at[s] = i
        if i and text[s] != text[sa[i - 1]]:
            first = i
        group[s] = first
        size[first] += 1
    prev = [-1] * n
    last = n - 1
    while last >= 0:
        g = group[sa[last]]
        pointed: dict[int, int] = {}
        members = sa[g:last + 1]
        members.sort()  # a member's predecessor in the group comes before it
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        last = g - 1
        by_group: dict[int, list[int]] = {}
        for p in pointed:
            by_group.setdefault(group[p], []).append(p)
        for h, moved in by_group.items():
            moved.sort(key=pointed.__getitem__)
            tail = h + size[h] - len(moved)
            chosen = set(moved)
            holes = [at[p] for p in moved if at[p] < tail]
            for slot in range(tail, h + size[h]):
                s = sa[slot]
                if s not in chosen:
                    hole = holes.pop()
                    sa[hole], at[s] = s, hole
            size[h] -= len(moved)
            start, count = tail, 0
            for k, p in enumerate(moved):
                sa[tail + k], at[p] = p, tail + k
                if k and pointed[p] != count:
                    size[start] = tail + k - start
                    start = tail + k
                count = pointed[p]
                group[p] = start
            size[start] = tail + len(moved) - start
    out, done = [-1] * n, [False] * n
    free = list(range(n))
    out[0], done[n - 1] = n - 1, True
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[free[g]], done[s] = s, True
            free[g] += 1
            s = prev[s]
    return out


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... count[0] numbers, then from first[1] on."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _in_step(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffix arrays of texts laid end to end, as positions in ``flat``; each
    text ends in its own least symbol."""
    n = len(flat)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    of = np.repeat(np.arange(len(sizes)), sizes)
    key = of * (int(flat.max()) + 1) + flat
    sa = np.argsort(key, kind="stable")
    at = np.empty(n, dtype=np.int64)
    at[sa] = np.arange(n)
    heads = np.flatnonzero(np.r_[True, key[sa][1:] != key[sa][:-1]])
    count = np.diff(np.r_[heads, n])
    size = np.zeros(n, dtype=np.int64)
    size[heads] = count
    group = np.empty(n, dtype=np.int64)
    group[sa] = np.repeat(heads, count)
    prev = np.full(n, -1, dtype=np.int64)
    chosen = np.zeros(n, dtype=bool)
    last = ends - 1
    live = np.arange(len(sizes))
    while len(live):
        g = group[sa[last[live]]]
        cnt = last[live] - g + 1
        last[live] = g - 1
        s = sa[_spread(g, cnt)]
        low, g = np.repeat(starts[live], cnt), np.repeat(g, cnt)
        live = live[last[live] >= starts[live]]
        p = s - 1
        p[p < low] = -1
        prev[s] = p
        open_ = np.flatnonzero((p >= 0) & (group[p] >= g))
        while len(open_):
            q = prev[p[open_]]
            p[open_] = q
            prev[s[open_]] = q
            open_ = open_[(q >= 0) & (group[q] >= g[open_])]
        p = p[p >= 0]
        if not len(p):
            continue
        p.sort()
        edge = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        moved, points = p[edge], np.diff(np.r_[edge, len(p)])
        own = group[moved]
        order = np.argsort(own * (int(points.max()) + 1) + points, kind="stable")
        moved, points, own = moved[order], points[order], own[order]
        head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        m = np.diff(np.r_[head, len(own)])
        tail = own[head] + size[own[head]] - m
        target = _spread(tail, m)
        chosen[moved] = True
        holes = at[moved]
        holes = np.sort(holes[holes < np.repeat(tail, m)])
        here = sa[target]
        out = ~chosen[here]
        chosen[moved] = False
        sa[holes], at[here[out]] = here[out], holes
        sa[target], at[moved] = moved, target
        size[own[head]] -= m
        new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (points[1:] != points[:-1])])
        length = np.diff(np.r_[new, len(own)])
        size[target[new]] = length
        group[moved] = np.repeat(target[new], length)
    out, done = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=bool)
    out[starts], done[ends - 1] = ends - 1, True
    free, i = np.arange(n), starts.copy()
    chain = ends - 2  # what each text looks at now
    chain[sizes < 2] = -1
    live = np.arange(len(sizes))
    low = starts.copy()
    while len(live):
        s = chain[live]
        go = (s >= low[live]) & ~done[np.maximum(s, 0)]
        t = s[go]
        g = group[t]
        out[free[g]] = t
        free[g] += 1
        done[t] = True
        chain[live[go]] = prev[t]
        rest = live[~go]
        i[rest] += 1
        over = i[rest] < ends[rest]
        chain[rest[over]] = out[i[rest[over]]] - 1
        live = np.sort(np.r_[live[go], rest[over]]) if not over.all() else live
    return out


def suffix_arrays(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The suffix array of each text, an integer array whose last symbol is
    its unique least. Texts of like size (within two fifths) run in step."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    kind = np.ceil(np.log(np.maximum(sizes, 1)) / np.log(1.4)).astype(np.int64)
    for k in np.unique(kind):
        rows = np.flatnonzero(kind == k)
        if len(rows) < IN_STEP:
            for r in rows:
                out[r] = np.array(suffix_array(texts[r].tolist()), dtype=np.int64)
            continue
        step = max(IN_STEP, AT_ONCE // int(sizes[rows].max()))
        for a in range(0, len(rows), step):
            some = rows[a:a + step]
            flat = np.concatenate([texts[r] for r in some]).astype(np.int64)
            sa = _in_step(flat, sizes[some])
            starts = np.cumsum(sizes[some]) - sizes[some]
            for r, s in zip(some, starts):
                out[r] = sa[s:s + sizes[r]] - s
    return out
