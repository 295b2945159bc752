"""Byte-level BPE as a reduction over the monoid of encoded texts.

A text is cut in halves down to short leaves.  Two encoded neighbours are joined by re-encoding a
window around their boundary.  The window grows until the tokens outside of it are known to stay
what they are, for one of two reasons:

* Its edge lies between a character that is no white space and a space or line feed.  Every
  match of the pattern ends there, whatever stands around, so both sides are encoded apart.
* Inside one long match: a sequence of tokens is *the* encoding of its bytes exactly if every two
  neighbours are the encoding of their own joined bytes, as the first merge across a token
  boundary of the whole would also happen between the two tokens that meet there.  So it is
  enough that the window's outer tokens fit their neighbours outside.

Decoding concatenates the bytes of the tokens up a tree of the same kind.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters below one leaf of the encoding tree, tokens below one leaf of the decoding tree.
LEAF, LEAF_TOKENS = 1024, 4096
#: First reach of a window to either side of a boundary, in characters.
REACH = 16
#: Windows of more characters than this hold long matches, which get a tree of their own.
LONG = 8192

cut_before = re.compile(r"[^\s\x1c-\x1f][ \n]").search


class Coder:
    """Encoder and decoder for one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.split = regex.compile(pattern).findall
        library = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.leaf = library.encode_ordinary

    # -- texts ----------------------------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        return self._half(text, 0, len(text)) if text else []

    def _half(self, text: str, start: int, end: int) -> list[int]:
        """The encoding of text[start:end] by itself."""
        if end - start <= LEAF:
            return self.leaf(text[start:end])
        middle = (start + end) // 2
        left, right = self._half(text, start, middle), self._half(text, middle, end)
        return self._joined(text, start, middle, end, left, right)

    def _joined(
        self, text: str, start: int, middle: int, end: int, left: list[int], right: list[int]
    ) -> list[int]:
        """The encoding of text[start:end] from those of its halves."""
        a, b = self._edge_before(text, start, middle), self._edge_after(text, middle, end)
        window = text[a:b]
        kept = self._tokens_before(left, len(text[a:middle].encode()))
        passed = self._tokens_after(right, len(text[middle:b].encode()))
        tokens = self.leaf(window) if len(window) <= LONG else self._long(window)
        return left[:kept] + tokens + right[passed:]

    @staticmethod
    def _edge_before(text: str, start: int, middle: int) -> int:
        """A place in the left half that splits the text for certain, else its start."""
        reach = REACH
        while middle - reach > start:
            place = None
            for found in re.finditer(r"[^\s\x1c-\x1f](?=[ \n])", text[middle - reach : middle]):
                place = middle - reach + found.end()
            if place is not None:
                return place
            reach *= 2
        return start

    @staticmethod
    def _edge_after(text: str, middle: int, end: int) -> int:
        """A place in the right half that splits the text for certain, else its end."""
        reach = REACH
        while middle + reach < end:
            if found := cut_before(text[middle : middle + reach]):
                return middle + found.end() - 1
            reach *= 2
        return end

    def _tokens_before(self, tokens: list[int], size: int) -> int:
        """How many tokens stay before the last ``size`` bytes."""
        at = len(tokens)
        while size > 0:
            at -= 1
            size -= len(self.bytes_of[tokens[at]])
        return at

    def _tokens_after(self, tokens: list[int], size: int) -> int:
        """How many tokens make up the first ``size`` bytes."""
        at = 0
        while size > 0:
            size -= len(self.bytes_of[tokens[at]])
            at += 1
        return at

    # -- long matches -----------------------------------------------------------------------

    def _long(self, text: str) -> list[int]:
        """A text with very long matches, each of them by halves."""
        matches = self.split(text)
        return list(chain.from_iterable(self.match(x.encode()) for x in matches))

    def match(self, raw: bytes) -> list[int]:
        """One match of the pattern; a match that is a token by itself is that token."""
        whole = self.ranks.get(raw)
        return self._bytes(raw) if whole is None else [whole]

    def _bytes(self, raw: bytes) -> list[int]:
        if len(raw) <= REACH:
            return self.merged(raw)
        half = len(raw) // 2
        return self._fitted(self._bytes(raw[:half]), self._bytes(raw[half:]))

    def _fitted(self, left: list[int], right: list[int]) -> list[int]:
        """Two neighbouring parts of one match, joined."""
        reach = 1
        while True:
            i, j = max(0, len(left) - reach), min(len(right), reach)
            middle = self.merged(self.decode(left[i:] + right[:j]))
            if (not i or self._fits(left[i - 1], middle[0])) and (
                j == len(right) or self._fits(middle[-1], right[j])
            ):
                return left[:i] + middle + right[j:]
            reach *= 2

    def _fits(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay as they are."""
        return self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def merged(self, raw: bytes) -> list[int]:
        """Tokens of a window: always merge the pair of lowest rank, the leftmost first."""
        n, ranks = len(raw), self.ranks
        ends = list(range(1, n + 1))  # of the part that starts here; 0: no part starts here
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(start: int) -> None:
            middle = ends[start]
            if middle < n and (rank := ranks.get(raw[start : ends[middle]])) is not None:
                heapq.heappush(heap, (rank, start, ends[middle]))

        for start in range(n - 1):
            offer(start)
        while heap:
            _, start, end = heapq.heappop(heap)
            middle = ends[start]
            if not middle or middle >= n or ends[middle] != end:
                continue  # one of the two parts has changed meanwhile
            ends[start], ends[middle] = end, 0
            if end < n:
                before[end] = start
            offer(start)
            if before[start] >= 0:
                offer(before[start])
        out, start = [], 0
        while start < n:
            out.append(ranks[raw[start : ends[start]]])
            start = ends[start]
        return out

    # -- decoding -----------------------------------------------------------------------------

    def decode(self, tokens: Sequence[int]) -> bytes:
        if len(tokens) <= LEAF_TOKENS:
            return b"".join(map(self.bytes_of.__getitem__, tokens))
        half = len(tokens) // 2
        return self.decode(tokens[:half]) + self.decode(tokens[half:])


@lru_cache(maxsize=4)
def coder(path: str, pattern: str) -> Coder:
    """The coder for a file of ranks, built once per worker."""
    with open(path, "rb") as file:
        lines = (line.split() for line in file if line.strip())
        return Coder({base64.b64decode(a): int(b) for a, b in lines}, pattern)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Token ids of a text column; a missing text counts as empty.

    ``path`` names a file of ranks that every machine has at the same place, as it has the
    installed libraries.
    """

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        own = coder(path, pattern)
        lists = [own.encode(x) if x else [] for x in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return ids(text)


def decoded(tokens: Column, path: str, pattern: str) -> Column:
    """The bytes that token ids stand for; a missing list counts as empty."""

    @F.arrow_udf("binary")
    def raw(lists: pa.Array) -> pa.Array:
        own = coder(path, pattern)
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        valid = lists.is_valid().to_pylist()
        rows = zip(ends, ends[1:], valid)
        return pa.array(
            [own.decode(flat[a:b].tolist()) if ok else b"" for a, b, ok in rows], pa.binary()
        )

    return raw(tokens)


def tokenized(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with their token ids and the bytes these decode to.

    Works row by row without a shuffle.  Empty and missing texts have no tokens and decode to
    nothing; repeated rows are encoded alike; all other columns stay (existing columns of the
    names ``token_ids`` and ``decoded`` are replaced).
    """
    out = docs.withColumn("token_ids", encoded(F.col("text"), path, pattern))
    return out.withColumn("decoded", decoded(F.col("token_ids"), path, pattern))
