"""Runs: stretches of a text that repeat with a period, found over a suffix automaton.

The states of the automaton that a prefix of the text reaches by suffix links are its suffixes, from
long to short.  Words are appended one after the other.  Each state remembers the end of its last
occurrence; those on the way from the new prefix to the root now end here.  The way falls into
segments of one earlier end each.  If an earlier end lies ``p`` words back and the longest suffix
of its segment has ``p`` words or more, these words are a square of period ``p``; the length of that
suffix tells how far it goes back, and it grows for as long as following words find it again.  As the
segment holds the latest occurrence, ``p`` is the smallest period.

The ways are kept as a link-cut forest: ``access`` joins the segments from the new prefix to the
root into one path of one colour, and n words change no more than O(n log n) segments.

Most words are in no run and need no automaton.  A run of 12 words or more, twice its period at
least, is covered by sequences of six words that occur in it twice.  Words that no such sequence
covers are cut out by sorting, again and again, until every piece is covered from within.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shortest run.
LEAST = 12
#: A run of ``LEAST`` words is covered by sequences of half as many words that occur in it twice.
GRAM = LEAST // 2

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Numbers(dict):
    """A number for every different word."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [a, b) of the texts that lie end to end in ``words``, outside of which no run is."""
    n = len(words) - GRAM + 1
    if n <= 0:
        return []
    gram = np.zeros(n, np.uint64)
    for i in range(GRAM):
        gram = _mixed(gram + words[i : i + n].astype(np.uint64) + _ODD)
    group = np.repeat(np.arange(1, len(ends) + 1), np.diff(ends, prepend=0))  # 0: in no piece
    border = np.diff(group, prepend=0) != 0
    size = np.inf
    at = np.flatnonzero(group[:n] == group[GRAM - 1 :])
    while len(at):
        key = _mixed(gram[at] ^ _mixed(group[at].astype(np.uint64) * _ODD))
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = at[twice]
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + GRAM, -1)
        covered = np.cumsum(steps)[:-1] > 0
        fresh = covered & (border | ~np.concatenate([[False], covered[:-1]]))
        group = np.where(covered, np.cumsum(fresh), 0)
        border = fresh
        long = np.bincount(group) >= LEAST
        long[0] = False
        group[~long[group]] = 0
        at = at[group[at] > 0]
        if (now := int((group > 0).sum())) == size:
            break
        size = now
        at = np.flatnonzero((group[:n] > 0) & (group[:n] == group[GRAM - 1 :]))
    inside = np.flatnonzero(group > 0)
    if not len(inside):
        return []
    own = group[inside]
    first = np.flatnonzero(np.diff(own, prepend=0))
    return list(zip(inside[first].tolist(), (inside[np.append(first[1:], len(own)) - 1] + 1).tolist()))


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links and lengths of the states, and the state of every prefix.  State 0 is the root."""
    moves, link, length, prefix = [{}], [-1], [0], []
    last = 0
    for word in words:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in moves[p]:
            moves[p][word] = state
            p = link[p]
        if p >= 0:
            q = moves[p][word]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                twin = len(moves)
                moves.append(moves[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[state] = twin
                while p >= 0 and moves[p].get(word) == q:
                    moves[p][word] = twin
                    p = link[p]
        prefix.append(state)
        last = state
    return link, length, prefix


class Paths:
    """A link-cut forest whose paths carry a colour each; nodes start as paths of their own.

    A path is a splay tree ordered by depth, and its colour is kept at the root.  ``up`` of a root
    is the node above the path.  0 is no node.
    """

    def __init__(self, parents: list[int]) -> None:
        self.up = parents
        self.left = [0] * len(parents)
        self.right = [0] * len(parents)
        self.colour = [-1] * len(parents)

    def splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree."""
        up, left, right = self.up, self.left, self.right
        root = 0
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            nested = g and (left[g] == p or right[g] == p)
            # Zig-zig turns the upper edge first, zig-zag the lower one twice.
            turns = (x,) if not nested else (p, x) if (left[g] == p) == (left[p] == x) else (x, x)
            for node in turns:
                over = up[node]
                above = up[over]
                if left[above] == over:
                    left[above] = node
                elif right[above] == over:
                    right[above] = node
                elif not root:
                    root = over
                if left[over] == node:
                    child = left[over] = right[node]
                    right[node] = over
                else:
                    child = right[over] = left[node]
                    left[node] = over
                if child:
                    up[child] = over
                up[over] = node
                up[node] = above
        if root:
            self.colour[x] = self.colour[root]

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Give the way from ``x`` to its root a new colour.

        Returns the old colours on it, each with the lowest node that had it.
        """
        up, right, colours = self.up, self.right, self.colour
        seen, below = [], 0
        while x:
            if (p := up[x]) and (self.left[p] == x or right[p] == x):
                self.splay(x)
            old = colours[x]
            if deeper := right[x]:
                colours[deeper] = old
            right[x] = below
            if old >= 0:
                seen.append((old, x))
            below, x = x, up[x]
        colours[below] = colour
        return seen


def runs_in(words: list[int]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence, by start, then period."""
    link, length, prefix = automaton(words)
    # Squares and short periods need suffixes of GRAM words or more; the states above are cut off.
    paths = Paths([p if p > 0 and length[p] >= GRAM else 0 for p in link])
    growing: dict[int, list[int]] = {}
    found = []
    for i, state in enumerate(prefix):
        if i + 1 < GRAM:
            continue
        for before, node in paths.access(state, i):
            period, common = i - before, length[node]
            if common >= period and common + period >= LEAST:
                run = growing.get(period)
                if run is not None and run[1] == i - 1:
                    run[1] = i
                else:
                    growing[period] = run = [i - period - common + 1, i]
                    found.append((run, period))
    return sorted((run[0], run[1] - run[0] + 1, period) for run, period in found)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those of a run behind its first period."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return b" ".join([w for w, over in zip(words, np.cumsum(steps).tolist()) if not over])


FOUND = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def found_in(texts: pa.Array) -> pa.Array:
    """The column ``found`` for a batch of texts."""
    numbers = Numbers()
    split = [x.as_py().split() for x in texts]
    ends = np.cumsum([len(x) for x in split], dtype=np.int64)
    words = np.fromiter((numbers[w] for x in split for w in x), np.int64, int(ends[-1]) if len(ends) else 0)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for a, b in pieces(words, ends):
        doc = int(np.searchsorted(ends, a, side="right"))
        offset = a - (int(ends[doc - 1]) if doc else 0)
        runs[doc] += [(start + offset, length, period) for start, length, period in runs_in(words[a:b].tolist())]
    flat = [dict(zip(("start", "length", "period"), r)) for own in runs for r in own]
    offsets = pa.array(np.cumsum([0, *map(len, runs)], dtype=np.int32))
    lists = pa.ListArray.from_arrays(offsets, pa.array(flat, _RUN))
    short = [collapsed(x, own) for x, own in zip(split, runs)]
    return pa.StructArray.from_arrays([lists, pa.array(short, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def found(text: Column) -> Column:
    """``runs`` of a text and the text ``collapsed``, as a struct."""
    return F.arrow_udf(found_in, FOUND)(F.coalesce(text, F.lit("")).cast("binary"))


def with_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (text) with its ``runs`` (start, length, period) and its text ``collapsed``.

    Words are what ASCII white space separates.  A run is a stretch of at least 12 words and twice
    its smallest period that neither neighbour extends.  ``runs`` go by start, then period; the
    collapsed text keeps the first period of each.  Works row by row without a shuffle; empty and
    missing texts have no runs and collapse to nothing, repeated rows are treated alike, and other
    columns stay (columns named runs or collapsed are replaced).  A worker holds one batch of texts
    and the automaton of one piece, whose size grows with the piece.
    """
    names = [F.col(f"`{c}`") for c in docs.columns if c not in ("runs", "collapsed")]
    kept = docs.select(F.struct(*names).alias("kept"))
    return kept.select("kept", found(F.col("kept.text")).alias("f")).select("kept.*", "f.runs", "f.collapsed")


def longest(runs: Column) -> Column:
    """The run of greatest length, of these the first, of these the one of smallest period."""
    key = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))
    return key["run"]
