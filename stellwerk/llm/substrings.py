"""Passages that repeat across documents, by suffix trees over prefix partitions.

Every word of a document starts a suffix.  The suffixes are dealt into groups that fit into the
memory of a worker, by prefixes of variable length: prefixes of two words are counted, neighbouring
rare ones share a group, and one that is more frequent than a group is large is lengthened
to all ``width`` words, whose hash spreads its suffixes over several groups.  Suffixes that have
``width`` words in common always meet.

A group builds its subtree by sorting: first word, second word, the first ``width`` words.  Below
that depth it is cut off, as every internal node of this depth or more is a repeat.  A node keeps the
smallest document below it; its leaves in other documents are the repeats to take out.  Repeats
that are longer than ``width`` words are chains of such nodes, one suffix link after the other; they
come together again when the leaves of a document are put back into order.

Only suffix names travel: 64 bits for all ``width`` words besides 20 bits for the first two, and
where they start.  A passage in very many documents makes no large group: of the suffixes of one
name that a worker deals, only those of the smallest document enter the group, and a group that still
gets more than it should is reduced in the same way while it comes in.  What is to be taken out goes
to buckets of documents, which are as many as there are groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellwerk.llm.common import stored
from stellwerk.llm.jaccard import Hashed, mixed

WIDTH = 13
#: Bits of the first and of the second word of a suffix.
FIRST, SECOND = 12, 8
CODES = 1 << (FIRST + SECOND)
#: Suffixes of a group, at the most and at the least.
GROUP, SMALL = 3_000_000, 100_000
#: Suffixes that a worker deals at a time.
CHUNK = 500_000
#: Pieces in which the counts of all prefixes are added up.
SLICES = 64
#: Rows of a batch that leaves a worker.
ROWS = 20_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def hashes_of(text: bytes | None, hashes: Hashed) -> np.ndarray:
    words = text.split() if text else []
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def prefixes(ids: np.ndarray, n: int) -> np.ndarray:
    """The code of the first two words of the first ``n`` suffixes."""
    first = ids[:n] >> np.uint64(64 - FIRST)
    second = ids[1 : n + 1] >> np.uint64(64 - SECOND)
    return ((first << np.uint64(SECOND)) | second).astype(np.uint32)


def named(ids: np.ndarray, n: int, width: int) -> np.ndarray:
    """The name of the first ``width`` words of the first ``n`` suffixes."""
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = out * _ODD + mixed(ids[i : i + n])
    return mixed(out)


def prefix_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How many suffixes of ``width`` words or more start with each prefix code.

    The table has a fixed size; workers count for themselves, slices of it are added up by Spark.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = Hashed(), np.zeros(CODES, np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            for text in batch["text"]:
                ids = hashes_of(text.as_py(), hashes)
                if len(ids) >= width:
                    held.append(prefixes(ids, len(ids) - width + 1))
            if held:
                counts += np.bincount(np.concatenate(held), minlength=CODES)
                held.clear()
        for i, part in enumerate(np.split(counts, SLICES)):
            if part.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "counts": [part.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, part in zip(batch["slice"].to_pylist(), batch["counts"]):
                own = np.frombuffer(part.as_buffer(), np.int64)
                sums[at] = sums[at] + own if at in sums else own.copy()
        for at, own in sums.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "counts": [own.tobytes()]})

    types = "slice int, counts binary"
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    out = np.zeros((SLICES, CODES // SLICES), np.int64)
    for row in texts.mapInArrow(count, types).repartition("slice").mapInArrow(add, types).collect():
        out[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def partition(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first group of each prefix code and over how many groups its suffixes are spread."""
    heavy = counts > most
    light = np.cumsum(np.where(heavy, 0, counts))
    first = np.maximum(light - 1, 0) // most
    parts = np.where(heavy, -(-counts // most), 1)
    base = int(first[-1]) + 1
    first[heavy] = base + np.cumsum(parts[heavy]) - parts[heavy]
    return first.astype(np.int32), parts.astype(np.int32)


def planes(x: np.ndarray) -> bytes:
    """The bytes of numbers, all lowest ones first: small numbers leave long runs of zeros."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def from_planes(raw: pa.Scalar, kind: type) -> np.ndarray:
    flat = np.frombuffer(raw.as_buffer(), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


PACK = "ids binary, marks binary, many binary, starts binary"
DEALT = f"bin int, {PACK}, codes binary, names binary"


def packed(bins: np.ndarray, ids: np.ndarray, marks: np.ndarray, doc: np.ndarray, start: np.ndarray, **more: np.ndarray) -> dict[str, list]:
    """One row per bin: the documents in it, and where suffixes start in each.

    ``doc`` counts in ``ids`` and ``marks``; entries come by document and start.
    """
    order = np.argsort(bins, kind="stable")
    bins, doc, start = bins[order], doc[order], start[order]
    more = {name: x[order] for name, x in more.items()}
    cuts = np.flatnonzero(np.diff(bins, prepend=np.iinfo(np.int32).min))
    rows: dict[str, list] = {k: [] for k in ("bin", "ids", "marks", "many", "starts", *more)}
    for a, b in zip(cuts, np.append(cuts[1:], len(bins))):
        new = np.flatnonzero(np.diff(doc[a:b], prepend=-1))
        own = doc[a:b][new]
        step = np.diff(start[a:b], prepend=0)
        step[new] = start[a:b][new]
        rows["bin"].append(int(bins[a]))
        rows["ids"].append(planes(np.diff(ids[own], prepend=0)))
        rows["marks"].append(planes(marks[own]) if marks[own].any() else b"")
        rows["many"].append(planes(np.diff(np.append(new, b - a)).astype(np.uint32)))
        rows["starts"].append(planes(step.astype(np.uint32)))
        for name, x in more.items():
            rows[name].append(planes(x[a:b]))
    return rows


def unpacked(row: dict[str, pa.Scalar]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, marks and starts of a packed row, one entry per suffix."""
    many = from_planes(row["many"], np.uint32)
    ids = np.cumsum(from_planes(row["ids"], np.int64))
    marks = from_planes(row["marks"], np.int64) if len(row["marks"].as_buffer()) else np.zeros(len(ids), np.int64)
    steps = from_planes(row["starts"], np.uint32).astype(np.int64)
    sums = np.cumsum(steps)
    new = np.cumsum(many) - many
    start = sums - np.repeat(sums[new] - steps[new], many)
    return np.repeat(ids, many), np.repeat(marks, many), start.astype(np.int32)


def as_batch(rows: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k in ("bin", "bucket") else pa.binary()) for k, v in rows.items()})


def bucket_of(ids: np.ndarray, marks: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(ids.view(np.uint64) ^ mixed(marks.view(np.uint64) + _ODD)) % np.uint64(buckets)).astype(np.int32)


def suffixes(docs: DataFrame, width: int, first: np.ndarray, parts: np.ndarray, buckets: int) -> DataFrame:
    """Packed suffixes of the documents, by group: names, documents and where they start.

    A suffix with a smaller document already among those that the worker deals needs no group: it
    comes under the negative number of its document's bucket.
    """

    def rows_of(held: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        held.sort(key=lambda d: d[:2])
        sizes = np.array([len(ids) - width + 1 for _, _, ids in held])
        code = np.concatenate([prefixes(ids, n) for (_, _, ids), n in zip(held, sizes)])
        name = np.concatenate([named(ids, n, width) for (_, _, ids), n in zip(held, sizes)])
        doc = np.repeat(np.arange(len(held)), sizes)
        start = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = np.array([d[0] for d in held], np.int64)
        marks = np.array([d[1] for d in held], np.int64)
        # Documents ascend, so the first suffix of a name has the smallest.
        order = np.argsort(name, kind="stable")
        parting = np.concatenate([[True], (np.diff(name[order]) != 0) | (np.diff(code[order]) != 0)])
        owner = ids[doc[order]]
        over = np.zeros(len(doc), bool)
        over[order] = owner > owner[parting][np.cumsum(parting) - 1]
        left = ~over
        group = first[code] + (name % parts[code].astype(np.uint64)).astype(np.int32)
        out = packed(group[left], ids, marks, doc[left], start[left], codes=code[left], names=name[left])
        done = packed(-1 - bucket_of(ids, marks, buckets)[doc[over]], ids, marks, doc[over], start[over])
        for column, values in out.items():
            values += done.get(column) or [b""] * len(done["bin"])
        return as_batch(out)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, size = Hashed(), 0
        held: list[tuple[int, int, np.ndarray]] = []
        for batch in batches:
            for doc, mark, text in zip(batch["doc_id"].to_pylist(), batch["mark"].to_pylist(), batch["text"]):
                ids = hashes_of(text.as_py(), hashes)
                if len(ids) < width:
                    continue
                held.append((doc, mark, ids))
                size += len(ids)
                if size >= CHUNK:
                    yield rows_of(held)
                    held, size = [], 0
        if held:
            yield rows_of(held)

    texts = docs.select("doc_id", "mark", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(deal, DEALT)


class Subtree:
    """The leaves of one group, sorted as far as they are needed."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, row: dict[str, pa.Scalar]) -> None:
        code, name = from_planes(row["codes"], np.uint32), from_planes(row["names"], np.uint64)
        self.parts.append((code, name, *unpacked(row)))
        self.size += len(name)

    def repeats(self) -> tuple[np.ndarray, ...]:
        """Documents, marks and starts of leaves with a smaller document below the same deep node.

        All other leaves stay, each once: one of them may be the smallest of its node.
        """
        code, name, doc, mark, start = (np.concatenate(x) for x in zip(*self.parts))
        self.parts.clear()
        order = np.lexsort((name, code))
        code, name, doc, mark, start = code[order], name[order], doc[order], mark[order], start[order]
        # Neighbours that part above the depth of all words are leaves of different deep nodes.
        parting = np.concatenate([[True], (code[1:] != code[:-1]) | (name[1:] != name[:-1])])
        node = np.cumsum(parting) - 1
        least = np.minimum.reduceat(doc, np.flatnonzero(parting))
        over = doc > least[node]
        stay = np.flatnonzero(~over)
        twice = stay[np.lexsort((start[stay], mark[stay], node[stay]))]
        same = (np.diff(node[twice]) == 0) & (np.diff(mark[twice]) == 0) & (np.diff(start[twice]) == 0)
        stay = twice[np.concatenate([[True], ~same])] if len(twice) else twice
        self.parts.append((code[stay], name[stay], doc[stay], mark[stay], start[stay]))
        self.size = len(stay)
        return doc[over], mark[over], start[over]


def repeated(dealt: DataFrame, most: int, buckets: int) -> DataFrame:
    """Packed suffixes to take out, by bucket of their document; groups are built one by one."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, room = None, Subtree(), 2 * most

        def done() -> Iterator[pa.RecordBatch]:
            doc, mark, start = tree.repeats()
            if len(doc):
                order = np.lexsort((start, mark, doc))
                doc, mark, start = doc[order], mark[order], start[order]
                new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(mark) != 0)])
                ids, marks, at = doc[new], mark[new], np.cumsum(new) - 1
                rows = packed(bucket_of(ids, marks, buckets)[at], ids, marks, at, start)
                yield as_batch({"bucket": rows.pop("bin"), **rows})

        for batch in batches:
            columns = {name: batch[name] for name in ("ids", "marks", "many", "starts", "codes", "names")}
            for i, at in enumerate(batch["bin"].to_pylist()):
                row = {name: column[i] for name, column in columns.items()}
                if at < 0:
                    yield as_batch({"bucket": [-1 - at], **{k: [row[k].as_py()] for k in ("ids", "marks", "many", "starts")}})
                    continue
                if at != now:
                    if tree.size:
                        yield from done()
                    now, tree, room = at, Subtree(), 2 * most
                tree.add(row)
                if tree.size >= room:
                    yield from done()
                    room = max(2 * most, 2 * tree.size)
        if tree.size:
            yield from done()

    grouped = dealt.repartition("bin").sortWithinPartitions("bin")
    return grouped.mapInArrow(build, f"bucket int, {PACK}")


def by_document(found: DataFrame) -> DataFrame:
    """(doc_id, mark, starts): where the suffixes to take out start, one row per document."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held: list[tuple[np.ndarray, ...]] = []

        def done() -> Iterator[pa.RecordBatch]:
            doc, mark, start = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((start, mark, doc))
            doc, mark, start = doc[order], mark[order], start[order]
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(mark) != 0)]))
            ends = np.append(cuts[1:], len(doc))
            for i in range(0, len(cuts), ROWS):
                a, b = cuts[i : i + ROWS], ends[i : i + ROWS]
                lists = [start[x:y].tobytes() for x, y in zip(a, b)]
                yield pa.RecordBatch.from_pydict({"doc_id": doc[a], "mark": mark[a], "starts": pa.array(lists, pa.binary())})

        for batch in batches:
            columns = {name: batch[name] for name in ("ids", "marks", "many", "starts")}
            for i, at in enumerate(batch["bucket"].to_pylist()):
                if at != now and held:
                    yield from done()
                now = at
                held.append(unpacked({name: column[i] for name, column in columns.items()}))
        if held:
            yield from done()

    grouped = found.repartition("bucket").sortWithinPartitions("bucket")
    return grouped.mapInArrow(gather, "doc_id long, mark long, starts binary")


CLEANED = "kept binary, n_words bigint, n_removed bigint, spans array<struct<start:bigint,words:bigint>>"


def taken_out(texts: pa.Array, starts: pa.Array, width: int) -> pa.Array:
    """What is left of a batch of texts without the words of the windows that start at ``starts``."""
    out: dict[str, list] = {"kept": [], "n_words": [], "n_removed": [], "spans": []}
    for text, windows in zip(texts, starts):
        words = (text.as_py() or b"").split()
        windows = windows.as_py()
        spans = []
        if windows:
            at = np.unique(np.frombuffer(windows, np.int32))
            breaks = np.flatnonzero(np.diff(at) > width)
            begin, end = at[np.concatenate([[0], breaks + 1])], at[np.append(breaks, len(at) - 1)] + width
            spans = [{"start": a, "words": b - a} for a, b in zip(begin.tolist(), end.tolist())]
        left, done = [], 0
        for span in spans:
            left += words[done : span["start"]]
            done = span["start"] + span["words"]
        left += words[done:]
        out["kept"].append(b" ".join(left))
        out["n_words"].append(len(words))
        out["n_removed"].append(len(words) - len(left))
        out["spans"].append(spans)
    span = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))
    arrays = [pa.array(out["kept"], pa.binary()), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["spans"], span)]
    return pa.StructArray.from_arrays(arrays, list(out))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` (doc_id, text) with ``text`` replaced, and with n_words, n_removed and spans.

    Words are what ASCII white space separates.  A word goes if ``width`` consecutive words that
    hold it also stand in a document of a smaller doc_id; ``spans`` (start, words) are the parts
    taken out, and the text keeps the other words, joined by a space.  All windows are judged on the
    texts as they come in.  Missing, empty and short texts lose nothing.  Rows without a doc_id
    are no smaller and no larger than others: they lose nothing and take nothing.  Rows of
    one doc_id are documents of their own that do not compare with each other; repeated rows
    end alike.  Other columns stay (columns named n_words, n_removed or spans are replaced).

    A worker holds a group of suffixes, and of a frequent node only the leaves that no smaller
    document has been found for.
    """
    spark = docs.sparkSession
    names = ("n_words", "n_removed", "spans")
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("text", *names)]).alias("kept"), "text")
    docs = docs.withColumn("doc_id", F.col("kept.doc_id").cast("long"))
    placed = docs.where("doc_id is not null")
    # The text tells apart the rows of a repeated id; all others need no such mark.
    twice = stored(placed.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("twice")), "repeated-ids")
    placed = placed.join(twice, "doc_id", "left")
    placed = placed.withColumn("mark", F.when(F.col("twice"), F.xxhash64("text")).otherwise(F.lit(0))).drop("twice")

    counts = prefix_counts(docs.where("doc_id is not null"), width)
    groups = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = int(np.clip(counts.sum() // groups, SMALL, GROUP))
    first, parts = partition(counts, most)
    buckets = int((first + parts).max())
    found = stored(repeated(suffixes(placed, width, first, parts, buckets), most, buckets), "repeats")
    both = placed.join(by_document(found), ["doc_id", "mark"], "left").select("kept", "text", "starts")
    rest = docs.where("doc_id is null").select("kept", "text", F.lit(None).cast("binary").alias("starts"))
    clean = F.arrow_udf(lambda texts, starts: taken_out(texts, starts, width), CLEANED)
    out = both.unionByName(rest).select("kept", clean(F.col("text").cast("binary"), "starts").alias("c"))
    return out.select("kept.*", F.col("c.kept").cast("string").alias("text"), "c.n_words", "c.n_removed", "c.spans")
