"""Fill-in-the-middle: texts cut into prefix, middle and suffix at unit borders, and put in order.

A unit is a word with the white space before it, or the white space that ends a text.  Where units
end is found without looking at single bytes: the UTF-8 bytes of a whole batch are read as words
of 64 bits, and arithmetic on a word sets the top bit of each of its bytes that ends a unit.  The
bits of each word are counted, and their running sum leads a search to the word that holds the k-th
end; the byte is then selected inside that word.  A second such index counts code points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT = "n long, first long, second long, prefix_chars long, middle_chars long"

_TOP = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_EACH = np.uint64(0x0101010101010101)
_BYTE = np.uint64(8)


def white(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is 0x20 or one of 0x09 to 0x0D."""
    low = words & _LOW
    other = words ^ (_EACH * np.uint64(0x20))
    blank = ~(((other & _LOW) + _LOW) | other)
    control = (low + _EACH * np.uint64(0x80 - 0x09)) & ~(low + _EACH * np.uint64(0x80 - 0x0E)) & ~words
    return (blank | control) & _TOP


def unit_ends(words: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The top bit of every byte that ends a unit; ``last`` holds the last byte of each text."""
    blank = white(words)
    behind = blank >> _BYTE
    behind[:-1] |= blank[1:] << np.uint64(56)
    marks = ~blank & behind & _TOP
    np.bitwise_or.at(marks, last >> 3, np.uint64(0x80) << (last.astype(np.uint64) % _BYTE * _BYTE))
    return marks


def point_starts(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that starts a code point."""
    return ~(words & ~(words << np.uint64(1))) & _TOP


class Index:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray) -> None:
        self.marks = marks
        self.sums = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many marked bytes lie before byte ``at``."""
        word, bits = at >> 3, at.astype(np.uint64) % _BYTE * _BYTE
        return self.sums[word] + np.bitwise_count(self.marks[word] & ((np.uint64(1) << bits) - np.uint64(1)))

    def select(self, nth: np.ndarray) -> np.ndarray:
        """The byte with the ``nth`` mark, counted from 1."""
        word = np.searchsorted(self.sums, nth, side="left") - 1
        left, rest = nth - self.sums[word] - 1, self.marks[word]
        for i in range(7):
            rest = np.where(left > i, rest & (rest - np.uint64(1)), rest)
        lowest = rest & (~rest + np.uint64(1))
        return (word << 3) + (np.bitwise_count(lowest - np.uint64(1)) >> 3)


def cuts(texts: pa.Array, one: np.ndarray, two: np.ndarray) -> dict[str, np.ndarray]:
    """Units of each text and where its two cuts fall, in bytes and in code points."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    base, size = int(ends[0]), int(ends[-1] - ends[0])
    start, end = ends[:-1] - base, ends[1:] - base
    raw = np.zeros((size // 8 + 2) * 8, np.uint8)
    if size:
        raw[:size] = np.frombuffer(texts.buffers()[2], np.uint8)[base : base + size]
    words = raw.view(np.uint64)
    units = Index(unit_ends(words, (end - 1)[end > start]))
    points = Index(point_starts(words))
    before = units.rank(start)
    n = units.rank(end) - before
    one, two = one % (n + 1), two % (n + 1)

    def behind(k: np.ndarray) -> np.ndarray:
        """The byte behind the first ``k`` units of each text."""
        at = start.copy()
        some = k > 0
        at[some] = units.select((before + k)[some]) + 1
        return at

    first, second = behind(np.minimum(one, two)), behind(np.maximum(one, two))
    at = points.rank(first)
    return {
        "n": n, "first": first - start, "second": second - start,
        "prefix_chars": at - points.rank(start), "middle_chars": points.rank(second) - at,
    }


def cut_in(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """The numbers of ``cuts`` for a batch of texts, as a struct."""
    found = cuts(texts, one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False))
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found.values()], list(found))


def draw(of: Column, seed: int, nth: int) -> Column:
    """The ``nth`` group of 8 hexadecimal digits of sha256(``seed:of``), as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(of.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * nth - 7, 8), 16, 10).cast("long")


def transformed(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """``docs`` (doc_id, text) with n, form, prefix_chars, middle_chars and output.

    ``rate`` percent of the texts are cut, ``spm`` percent of these are written suffix first.  An
    empty or missing text, and one that holds a marker already, stays plain, with null for both
    numbers of code points.  Draws depend on doc_id alone: repeated rows are cut alike, a missing
    id counts as the empty text.  Existing columns of these five names are replaced, all others
    stay.  Only offsets come back from the workers; texts of any length are cut whole.
    """
    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in names]).alias("kept")
    text = F.coalesce(F.col("kept.text"), F.lit(""))
    h = [draw(F.col("kept.doc_id"), seed, i) for i in range(1, 5)]
    plain = (text == "") | (h[2] % 100 >= rate)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(text, F.lit(marker))
    form = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    cut = docs.select(kept).select("kept", form.alias("form"), F.arrow_udf(cut_in, CUT)(text.cast("binary"), h[0], h[1]).alias("c"))
    raw = text.cast("binary")
    part = lambda at, length: F.substring(raw, at.cast("int") + 1, length.cast("int")).cast("string")
    prefix = part(F.lit(0), F.col("c.first"))
    middle = part(F.col("c.first"), F.col("c.second") - F.col("c.first"))
    suffix = part(F.col("c.second"), F.octet_length(text) - F.col("c.second"))
    spm_text = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    psm_text = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    cut_only = lambda name: F.when(F.col("form") != "plain", F.col(f"c.{name}")).alias(name)
    return cut.select(
        "kept.*", "c.n", "form", cut_only("prefix_chars"), cut_only("middle_chars"),
        F.when(F.col("form") == "plain", text).when(F.col("form") == "spm", spm_text).otherwise(psm_text).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``transformed`` has made ``output`` from."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    spm, psm = F.concat(parts[2], parts[3], parts[1]), F.concat(parts[1], parts[3], parts[2])
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)
