"""Language identification by words first, then by ever shorter character n-grams.

A known word adds the logarithm of its frequency in each language.  An unseen word adds the mean
over those of its 4-grams that are known; if none is, over its 3-grams, and so on down to single
letters.  The model is fitted on a bounded sample of the labelled documents (``per_language``
documents of each language); it predicts every document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk.llm.common import frequent

LONGEST = 4
UNKNOWN = "und"
SMOOTHING = 0.5
#: Longer words are scored by n-grams only, so that no single word weighs on the model's size.
WORD_CHARS = 64

letters = re.compile(r"[^\W\d_]+").findall


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word between two marks; single letters without them."""
    if n == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def counted(sample: DataFrame) -> DataFrame:
    """(n, lang, item, times): words (n = 0) and n-grams of the sampled texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                found.setdefault(lang, Counter()).update(letters(text.lower()))
            for lang, words in found.items():
                rows: Counter = Counter()
                for word, times in words.items():
                    if len(word) <= WORD_CHARS:
                        rows[0, word] += times
                    for n in range(1, LONGEST + 1):
                        for gram in grams(word, n):
                            rows[n, gram] += times
                yield pa.RecordBatch.from_pydict(
                    {
                        "n": pa.array([k for k, _ in rows], pa.int32()),
                        "lang": pa.array([lang] * len(rows), pa.string()),
                        "item": pa.array([x for _, x in rows], pa.string()),
                        "times": pa.array(list(rows.values()), pa.int64()),
                    }
                )

    return (
        sample.select("lang", "text")
        .mapInArrow(count, "n int, lang string, item string, times long")
        .groupBy("n", "lang", "item")
        .agg(F.sum("times").alias("times"))
    )


class Known(dict):
    """Row numbers of known items, -1 for all others."""

    def __missing__(self, item: str) -> int:
        return -1


class Model:
    """Log frequencies: a row for each known word and n-gram, a column for each language."""

    def __init__(self, langs: list[str], rows: list[tuple[int, str, str, int]]):
        self.langs = langs
        at = {lang: i for i, lang in enumerate(langs)}
        self.rows: list[Known] = []
        logs = []
        for n in range(LONGEST + 1):
            own = [r for r in rows if r[0] == n]
            first = sum(map(len, self.rows))
            index = Known()
            for _, _, item, _ in own:
                index.setdefault(item, first + len(index))
            counts = np.zeros((len(index), len(langs)))
            for _, lang, item, times in own:
                counts[index[item] - first, at[lang]] += times
            total = counts.sum(axis=0) + SMOOTHING * (len(index) + 1)
            logs.append(np.log((counts + SMOOTHING) / total))
            self.rows.append(index)
        self.logs = np.concatenate(logs)

    def backoff(self, word: str) -> list[int]:
        """Rows of an unseen word's longest n-grams of which any is known."""
        for n in range(LONGEST, 0, -1):
            index = self.rows[n]
            if known := [row for gram in grams(word, n) if (row := index[gram]) >= 0]:
                return known
        return []

    def score(self, words: list[str]) -> np.ndarray:
        """Sum over the words of what each adds for every language."""
        rows = np.fromiter(map(self.rows[0].__getitem__, words), np.int64, len(words))
        total = self.logs[rows[rows >= 0]].sum(axis=0)
        flat: list[int] = []
        weights: list[float] = []
        for i in np.flatnonzero(rows < 0).tolist():
            if known := self.backoff(words[i]):
                flat += known
                weights += [1 / len(known)] * len(known)
        return total + np.array(weights) @ self.logs[flat] if flat else total


def fit(labelled: DataFrame, per_language: int = 1000, most_items: int = 50_000) -> Model:
    """Fit on documents with columns doc_id, text and lang; rows without text or lang are left out.

    ``per_language`` bounds the different documents taken of each language (chosen by a hash of id
    and text, so rows that are repeated or have no id are no case of their own), ``most_items`` the
    words and the n-grams of each length that are kept, the most frequent ones.  Both bound what
    reaches the driver.
    """
    labelled = labelled.where("lang is not null and text is not null").select(
        "doc_id", "text", "lang", F.xxhash64("doc_id", "text", F.lit("language sample")).alias("draw")
    )
    sizes = {r["lang"]: r["count"] for r in labelled.select("lang", "draw").distinct().groupBy("lang").count().collect()}
    if not sizes:
        return Model([], [])
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, per_language / n)])
    drawn = labelled.where(F.col("draw") / F.lit(2.0**64) + 0.5 < share[F.col("lang")])
    counts = counted(drawn.dropDuplicates(["lang", "draw"]).drop("draw")).persist()
    try:
        rows = []
        for n in range(LONGEST + 1):
            totals = counts.where(F.col("n") == n).groupBy("item").agg(F.sum("times").alias("times"))
            kept, _ = frequent(totals, "times", most_items)
            kept = kept.where("times > 1").select("item")
            found = counts.where(F.col("n") == n).join(kept, "item", "left_semi")
            rows += [(n, r["lang"], r["item"], r["times"]) for r in found.collect()]
    finally:
        counts.unpersist()
    return Model(sorted(sizes), sorted(rows))


def predicted(docs: DataFrame, model: Model) -> Column:
    """Struct (lang, score) for the column ``text``: see :func:`identified`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    @F.arrow_udf("lang string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        own, langs, scores = shared.value, [], []
        for value in texts:
            text = value.as_py()
            words = letters(text.lower()) if text else []
            if not own.langs or not any(c.isalpha() for word in words for c in word):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = own.score(words) / len(words) ** 0.5
            odds = np.exp(total - total.max())
            best = int(odds.argmax())
            langs.append(own.langs[best])
            scores.append(float(odds[best] / odds.sum()))
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
        )

    return predict(F.col("text"))


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    ``score`` is the share of the best language when the evidence is divided by the square root
    of the number of words.  Texts that are missing, empty or without a letter, and all texts if
    nothing was learned, get ``und`` and 0.  Ties go to the language that comes first.  Rows are
    independent of each other: repeated rows get the same answer, other columns stay as they are
    (columns named lang_pred or score are replaced).
    """
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    kept = docs.select(F.struct(*columns).alias("kept"), "text")
    out = kept.select("kept", predicted(kept, model).alias("said"))
    return out.select("kept.*", F.col("said.lang").alias("lang_pred"), F.col("said.score").alias("score"))
