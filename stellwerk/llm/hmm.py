"""A hidden Markov language model over word classes.

Every word belongs to one class: the most frequent words form classes of their own, all others
share a class with the words of the same ending.  A text is a chain of hidden states; a state
emits a class, a class emits a word by its share of the class's count:

    P(word | state) = P(class | state) * P(word | class)

The last factor does not depend on the state, so the scaled forward recursion over the classes
times these factors is the exact likelihood of the text.  The states are trained by Baum-Welch:
tasks add up expected counts of their texts, Spark sums them, the driver sees one row per class.

All counts cover the whole training corpus.  What is bounded: the classes (``heads`` and
``endings``), and the table of frequent words that every worker holds (``known``); the counts of
all other words are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from stellwerk.llm.common import extended, frequent, stored

ADDED = 0.1  # to every count, fixed by the contract
END = b""  # the token behind the last word; no word is empty


@dataclass(frozen=True)
class Settings:
    states: int = 8
    rounds: int = 5
    heads: int = 2048
    endings: int = 2048
    #: Frequent words that every worker holds, and their longest length in bytes.
    known: int = 131_072
    known_bytes: int = 64
    #: For training only, texts are laid out in segments of so many tokens.
    segment: int = 256
    seed: int = 7

    @property
    def classes(self) -> int:
        return 1 + self.heads + self.endings

    def ending(self, word: bytes) -> int:
        """The class that a word shares with others."""
        return 1 + self.heads + zlib.crc32(word[-4:]) % self.endings


def words_of(raw: bytes | None) -> list[bytes]:
    """A-Z in lower case, then everything between ASCII white space."""
    return raw.lower().split() if raw else []


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, with the end of each text as the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = {"word": pa.array(list(found), pa.binary()), "n": pa.array(list(found.values()), pa.int64())}
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            for raw in batch["raw"]:
                found.update(words_of(raw.as_py()))
                found[END] += 1
                if len(found) > 300_000:
                    yield rows()
                    found.clear()
        yield rows()

    raw = docs.select(F.col("text").cast("binary").alias("raw"))
    return raw.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """Corpus totals, the frequent words and the classes."""

    def __init__(self, counts: DataFrame, settings: Settings):
        self.settings = settings
        total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
        self.tokens, self.words = int(total["n"] or 0), int(total["v"])
        short = counts.where(F.length("word") <= settings.known_bytes)
        kept, self.least = frequent(short, "n", settings.known)
        rows = sorted(((-r["n"], bytes(r["word"])) for r in kept.collect()))
        words = [word for _, word in rows if word != END][: settings.heads]
        own = {word: 1 + i for i, word in enumerate(words)} | {END: 0}
        ends = counts.where(F.col("word") == F.lit(END)).first()
        known = [(word, -n) for n, word in rows if word != END] + [(END, ends["n"] if ends else 0)]
        self.row = {word: i for i, (word, _) in enumerate(known)}
        self.log = np.log10(np.array([n for _, n in known], float) + ADDED)
        self.cls = np.array([own.get(w, settings.ending(w)) for w, _ in known], np.int32)
        self.shared = self.cls > settings.heads
        self.own = own

    def totals(self, counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and different words of every class."""
        own, settings = self.own, self.settings

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, v = np.zeros(settings.classes, np.int64), np.zeros(settings.classes, np.int64)
            for batch in batches:
                words = batch["word"].to_pylist()
                at = [own[w] if w in own else settings.ending(w) for w in words]
                np.add.at(n, at, batch["n"].to_numpy())
                np.add.at(v, at, 1)
            used = np.flatnonzero(v)
            yield pa.RecordBatch.from_pydict({"cls": used.astype(np.int32), "n": n[used], "v": v[used]})

        rows = counts.mapInArrow(add, "cls int, n long, v long").groupBy("cls")
        n, v = np.zeros(settings.classes), np.zeros(settings.classes)
        for r in rows.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
            n[r["cls"]], v[r["cls"]] = r["n"], r["v"]
        return n, v


class Coded(dict):
    """Row of a frequent word; for any other word minus its class, less one."""

    def __init__(self, lexicon: Lexicon):
        super().__init__(lexicon.row)
        self.ending = lexicon.settings.ending

    def __missing__(self, word: bytes) -> int:
        return -self.ending(word) - 1


CHAIN = (
    "n_tokens bigint, classes binary, n_known bigint, log_all double, log_shared double, "
    "words array<binary>, times array<int>"
)


def chains_of(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """For (row, learn, kept, text): the classes of each text, sums over its frequent words, and
    its other words with their number."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kept = docs.drop("text").schema
    schema = extended(kept, CHAIN)
    types = to_arrow_schema(schema)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        table = Coded(own)
        for batch in batches:
            out = {name: [] for name in types.names if name not in kept.names}
            for raw in batch["text"]:
                words = words_of(raw.as_py())
                words.append(END)
                codes = np.fromiter(map(table.__getitem__, words), np.int32, len(words))
                known = codes[codes >= 0]
                rest = Counter(words[i] for i in np.flatnonzero(codes < 0).tolist())
                out["n_tokens"].append(len(words))
                cls = np.where(codes >= 0, own.cls[np.maximum(codes, 0)], -codes - 1)
                out["classes"].append(cls.astype(np.uint16).tobytes())
                out["n_known"].append(int((own.log[known] > 0).sum()))
                out["log_all"].append(float(own.log[known].sum()))
                out["log_shared"].append(float(own.log[known[own.shared[known]]].sum()))
                out["words"].append(list(rest))
                out["times"].append(list(rest.values()))
            columns = [batch[name] for name in kept.names]
            columns += [pa.array(x, types.field(name).type) for name, x in out.items()]
            yield pa.RecordBatch.from_arrays(columns, schema=types)

    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(code, schema)


@dataclass
class Parameters:
    start: np.ndarray  # [state]
    move: np.ndarray  # [state, next state]
    emit: np.ndarray  # [class, state]
    share: np.ndarray  # [state], of all tokens


def first_guess(n: np.ndarray, settings: Settings) -> Parameters:
    """Sticky states that emit all classes by their share, slightly disturbed."""
    k, noise = settings.states, np.random.default_rng(settings.seed)
    emit = (n + 1)[:, None] * noise.gamma(4.0, 0.25, (len(n), k))
    move = np.full((k, k), 0.1 / k) + 0.9 * np.eye(k)
    even = np.full(k, 1.0 / k)
    return Parameters(even, move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0), even)


def expected(classes: list[bytes], p: Parameters, segment: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Expected counts (emissions, moves, starts) of some texts by the forward-backward recursion."""
    flat = np.frombuffer(b"".join(classes), np.uint16).astype(np.int64)
    sizes = np.array([len(c) // 2 for c in classes], np.int64)
    pieces = -(-sizes // segment)
    ends = np.cumsum(sizes)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    offset = np.repeat(ends - sizes, pieces) + nth * segment
    length = np.minimum(segment, np.repeat(ends, pieces) - offset)
    order = np.argsort(-length, kind="stable")
    offset, length, first = offset[order], length[order], nth[order] == 0
    for at in range(0, len(offset), 1024):
        yield block(flat, offset[at : at + 1024], length[at : at + 1024], first[at : at + 1024], p)


def block(
    flat: np.ndarray, offset: np.ndarray, length: np.ndarray, first: np.ndarray, p: Parameters
) -> tuple[np.ndarray, ...]:
    """The same for segments in order of falling length, all of them step by step."""
    steps, k = int(length[0]), len(p.start)
    going = np.searchsorted(-length, -np.arange(steps), side="left")  # segments longer than t
    ids = [flat[offset[:m] + t] for t, m in enumerate(going)]
    seen = [p.emit[i] for i in ids]
    forward, scale = [], []
    now = np.where(first[:, None], p.start, p.share) * seen[0]
    for t in range(steps):
        if t:
            now = (now[: going[t]] @ p.move) * seen[t]
        total = now.sum(axis=1, keepdims=True)
        now = now / total
        forward.append(now)
        scale.append(total)
    moves, later = np.zeros((k, k)), np.ones((going[-1], k))
    state = [None] * steps
    state[-1] = forward[-1]
    for t in range(steps - 2, -1, -1):
        m = going[t + 1]
        ahead = seen[t + 1] * later / scale[t + 1]
        moves += forward[t][:m].T @ ahead
        later = np.ones((going[t], k))
        later[:m] = ahead @ p.move.T
        state[t] = forward[t] * later
    ids, state = np.concatenate(ids), np.concatenate(state)
    emissions = np.stack([np.bincount(ids, state[:, j], len(p.emit)) for j in range(k)], axis=1)
    return emissions, moves * p.move, state[: len(first)][first].sum(axis=0)


def reestimated(training: DataFrame, p: Parameters, n: np.ndarray, settings: Settings) -> Parameters:
    """One round of Baum-Welch over all training texts."""
    k, c = settings.states, settings.classes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((c + k + 1, k))
        for batch in batches:
            for emissions, moves, starts in expected(batch["classes"].to_pylist(), p, settings.segment):
                sums[:c] += emissions
                sums[c : c + k] += moves
                sums[-1] += starts
        used = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_pydict({"i": used.astype(np.int32)} | {f"s{j}": sums[used, j] for j in range(k)})

    schema = "i int, " + ", ".join(f"s{j} double" for j in range(k))
    sums = np.zeros((c + k + 1, k))
    parts = training.select("classes").mapInArrow(count, schema).groupBy("i")
    for r in parts.agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(k)]).collect():
        sums[r["i"]] = [r[f"s{j}"] for j in range(k)]
    emit = sums[:c] + ADDED * ((n + 1) / (n + 1).sum() * c)[:, None]
    move, start = sums[c : c + k] + 1.0, sums[-1] + 1.0
    share = sums[:c].sum(axis=0) + 1.0
    return Parameters(
        start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0), share / share.sum()
    )


def likelihoods(classes: list[bytes], p: Parameters) -> np.ndarray:
    """log10 of the exact likelihood of whole class sequences by the scaled forward recursion."""
    flat = np.frombuffer(b"".join(classes), np.uint16).astype(np.int64)
    sizes = np.array([len(c) // 2 for c in classes], np.int64)
    order = np.argsort(-sizes, kind="stable")
    offset, length = (np.cumsum(sizes) - sizes)[order], sizes[order]
    going = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left")
    logs = np.zeros(len(sizes))
    now = None
    for t, m in enumerate(going):
        seen = p.emit[flat[offset[:m] + t]]
        now = p.start * seen if now is None else (now[:m] @ p.move) * seen
        total = now.sum(axis=1)
        logs[:m] += np.log10(total)
        now = now / total[:, None]
    out = np.empty(len(sizes))
    out[order] = logs
    return out


def scored(docs: DataFrame, training: str, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the model's and the base model's log10 probability of every whole text.

    ``training`` is a SQL condition that picks the rows to learn from.  Adds n_tokens (words and
    the end), n_known (tokens seen in training), train_tokens, base_score and score; all columns
    of ``docs`` stay, those of the same names are replaced.  A missing text counts as empty: it
    is the end alone.  Repeated rows are scored each.  Without any training text all counts are
    0 and all states are alike.
    """
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "text" and c not in added]
    docs = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.expr(training), F.lit(False)).alias("learn"),
        F.struct(*kept).alias("kept"),
        "text",
    )
    counts = stored(word_counts(docs.where("learn")), "words")
    lexicon = Lexicon(counts, settings)
    n, v = lexicon.totals(counts)
    chains = stored(chains_of(docs, lexicon), "chains")
    p = first_guess(n, settings)
    for _ in range(settings.rounds):
        p = reestimated(chains.where("learn"), p, n, settings)
    # A class of several words passes its probability on by their counts.
    passed = np.where(np.arange(settings.classes) > settings.heads, n + ADDED * (v + 1), 1.0)
    p = Parameters(p.start, p.move, p.emit / passed[:, None], p.share)

    logs = chains.drop("learn", "words", "times")
    schema = extended(logs.drop("classes").schema, "log double")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[name] for name in names[:-1]]
            columns.append(pa.array(likelihoods(batch["classes"].to_pylist(), p)))
            yield pa.RecordBatch.from_arrays(columns, names)

    logs = logs.mapInArrow(run, schema)
    rare = chains.select("row", F.explode(F.arrays_zip("words", "times")).alias("e"))
    rare = rare.select("row", F.col("e.words").alias("word"), "e.times").join(counts, "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADDED))).alias("rare_log"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
    )
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    base = float(np.log10(lexicon.tokens + ADDED * (lexicon.words + 1)))
    return logs.join(rare, "row", "left").select(
        "kept.*",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("log_all") + rare_log - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("log") + F.col("log_shared") + rare_log).alias("score"),
    )
