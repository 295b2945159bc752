"""Exact Jaccard join of documents by word shingles: a blocked sparse matrix product.

The matrix has a row for each different shingle set and a column for each shingle.  The product
of the matrix with its transpose counts the shingles that two sets share.  Columns are dealt into
blocks by their hash.  A block finds its columns with two entries or more; all others cannot add
to any count.  From then on only these few entries are carried.

Most pairs are never formed.  In any fixed order of the columns, two sets of Jaccard similarity t
share a column among the first ``size - ceil(t * size) + 1`` columns of each.  The order is:
columns with one entry (which form no pair), columns with up to ``COMMON`` entries, all others.  So
a set with enough shingles of its own forms no pair at all.  Counts over these first columns and
the sizes bound the overlap; pairs below what t asks for are discarded, the others are counted in
full.

Sets whose first columns reach into the common ones (large groups of near copies) are first
compared with one leader of each column, and with further ones as long as a column holds several
components.  What is left meets by column and by bands of both sizes: the sizes of a pair tell how
many columns it has to share, and thus how few of them can come first.  So a group of n near copies
takes about n comparisons, and members that differ from each other in too many places never
meet; no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellwerk.llm.common import components, extended, stored

WORDS = 5
PERCENT = 80
#: A column with more entries is common.
COMMON = 64
#: Words whose hash a worker remembers; sets that it knows to have sent.
MEMO = 200_000
#: Entries that a worker packs at a time.
PACKED = 200_000
#: Times that open columns are compared with one leader before the bands of sizes are.
LEADERS = 2
#: Sizes of one band differ by less than this factor.
BAND = 1.03
#: Words of 64 bits of a set's sketch, which bounds overlaps from above.
SKETCH = 32
#: Bits of a shingle's hash that are kept besides its block.
KEPT = np.uint64((1 << 48) - 1)

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class Hashed(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes | None, hashes: Hashed, width: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles of a text.

    A-Z count as lower case, words are what ASCII white space separates.  A text of fewer than
    ``width`` words has one shingle, all of it; a text without words has none.
    """
    words = raw.lower().split() if raw else []
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(ids) - width + 1)
    out = np.full(n, min(width, len(ids)), np.uint64)
    for i in range(min(width, len(ids))):
        out = mixed(out + ids[i : i + n] * _ODD[i % 5] + np.uint64(i // 5))
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def signature(own: np.ndarray) -> int:
    """A signed 64-bit name of a shingle set; equal sets have equal names."""
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def sized(docs: DataFrame, width: int) -> DataFrame:
    """(kept, n, sig): every document with its set's size and name (null if empty)."""
    schema = extended(docs.select("kept").schema, "n bigint, sig bigint")
    names = schema.names

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashed()
        for batch in batches:
            n, sig = [], []
            for raw in batch["text"]:
                own = shingles(raw.as_py(), hashes, width)
                n.append(len(own))
                sig.append(signature(own) if len(own) else None)
            columns = [batch["kept"], pa.array(n, pa.int64()), pa.array(sig, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(measure, schema)


def entries(docs: DataFrame, width: int, blocks: int) -> DataFrame:
    """(block, sigs, many, hashes): packed entries of the matrix, each set once per worker and batch."""

    def rows_of(sigs: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])
        block = (flat % np.uint64(blocks)).astype(np.int32)
        flat = (mixed(flat) & KEPT) | (block.astype(np.uint64) << np.uint64(48))
        # A column that is common here already needs no more than a witness of that in its block;
        # its entries go straight to the rows of their sets.
        order = np.argsort(flat, kind="stable")
        run = flat[order]
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        length = np.diff(np.append(starts, len(run)))
        nth = np.arange(len(run)) - np.repeat(starts, length)
        common = np.repeat(length > COMMON, length)
        direct, kept = np.sort(order[common]), np.sort(order[~common | (nth <= COMMON)])
        at = np.concatenate([kept, direct])
        names = np.array(sigs, np.int64)
        spread = (names[owner[direct]] % blocks).astype(np.int32)
        block = np.concatenate([block[kept], -1 - spread])
        # Sets come one after the other, so a stable sort by block keeps the entries of a set together.
        order = np.argsort(block, kind="stable")
        flat, owner, block = flat[at[order]], owner[at[order]], block[order]
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        rows: dict[str, list] = {"block": [], "sigs": [], "many": [], "hashes": []}
        for a, b in zip(starts, [*starts[1:], len(block)]):
            own, many = np.unique(owner[a:b], return_counts=True)
            rows["block"].append(int(block[a]))
            rows["sigs"].append(names[own].tobytes())
            rows["many"].append(many.astype(np.int32).tobytes())
            rows["hashes"].append(flat[a:b].view(np.uint8).reshape(-1, 8)[:, : 6 if block[a] >= 0 else 8].tobytes())
        types = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(rows.items(), types)})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sent = Hashed(), set()
        sigs: list[int] = []
        sets: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for raw in batch["text"]:
                own = shingles(raw.as_py(), hashes, width)
                if not len(own) or (sig := signature(own)) in sent:
                    continue
                if len(sent) >= MEMO:
                    sent.clear()
                sent.add(sig)
                sigs.append(sig)
                sets.append(own)
                held += len(own)
                if held >= PACKED:
                    yield rows_of(sigs, sets)
                    sigs, sets, held = [], [], 0
        if sets:
            yield rows_of(sigs, sets)

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(pack, "block int, sigs binary, many binary, hashes binary")


def shared_entries(packed: DataFrame) -> DataFrame:
    """(sig, rare, common): per set and block, its columns with up to ``COMMON`` entries, and more.

    The rows of a block come one after the other.  A negative block holds entries of common columns.
    """

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sigs, hashes = None, [], []

        def done() -> pa.RecordBatch:
            sig, own = np.concatenate(sigs), np.concatenate(hashes)
            sigs.clear()
            hashes.clear()
            order = np.lexsort((sig, own))
            sig, own = sig[order], own[order]
            new = np.concatenate([[True], (own[1:] != own[:-1]) | (sig[1:] != sig[:-1])])
            sig, own = sig[new], own[new]
            first = np.concatenate([[True], own[1:] != own[:-1]])
            many = np.diff(np.append(np.flatnonzero(first), len(own)))[np.cumsum(first) - 1]
            if now < 0:  # known to be common
                many = np.full(len(own), COMMON + 1)
            keep = many > 1
            sig, own, many = sig[keep], own[keep], many[keep]
            order = np.lexsort((own, sig))
            sig, own, many = sig[order], own[order], many[order]
            starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else []
            rows: dict[str, list] = {"sig": [], "rare": [], "common": []}
            for a, b in zip(starts, [*starts[1:], len(sig)] if len(sig) else []):
                lots = many[a:b] > COMMON
                rows["sig"].append(int(sig[a]))
                rows["rare"].append(own[a:b][~lots].tobytes())
                rows["common"].append(own[a:b][lots].tobytes())
            types = (pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(rows.items(), types)})

        for batch in batches:
            packed_columns = (batch[name] for name in ("block", "sigs", "many", "hashes"))
            for block, names, number, packed_hashes in zip(*packed_columns):
                if block.as_py() != now and sigs:
                    yield done()
                    sigs, hashes = [], []
                now = block.as_py()
                many = np.frombuffer(number.as_buffer(), np.int32)
                sigs.append(np.repeat(np.frombuffer(names.as_buffer(), np.int64), many))
                if now < 0:
                    hashes.append(np.frombuffer(packed_hashes.as_buffer(), np.uint64).copy())
                else:  # the upper two bytes are those of the block
                    own = np.full((int(many.sum()), 4), now & 0xFFFF, np.uint16)
                    own[:, :3] = np.frombuffer(packed_hashes.as_buffer(), np.uint16).reshape(-1, 3)
                    hashes.append(own.view(np.uint64).ravel())
        if sigs:
            yield done()

    return packed.mapInArrow(sift, "sig long, rare binary, common binary")


ROW = "sig long, n long, rare binary, common binary, first array<bigint>, beyond array<bigint>, sketch array<bigint>"


def sketch(hashes: np.ndarray) -> np.ndarray:
    """A bitmap with one bit for each hash; several hashes may share a bit."""
    bits = np.zeros(SKETCH * 64, np.uint8)
    bits[hashes % np.uint64(SKETCH * 64)] = 1
    return np.packbits(bits).view(np.int64)


def bounded(a: str, b: str, percent: int) -> Column:
    """Whether the overlap of two sets may reach what their sizes ask for.

    Every bit that only one of the two sketches has stands for a shingle that is not shared.
    """
    need = F.ceil((F.col(f"{a}.n") + F.col(f"{b}.n")) * percent / (100 + percent))
    bit = lambda x, i: F.col(f"{x}.sketch")[i]
    only = lambda x, y: sum((F.bit_count(bit(x, i).bitwiseAND(F.bitwise_not(bit(y, i)))) for i in range(SKETCH)), F.lit(0))
    return (
        comparable(F.col(f"{a}.n"), F.col(f"{b}.n"), percent)
        & (F.col(f"{a}.s") - only(a, b) >= need)
        & (F.col(f"{b}.s") - only(b, a) >= need)
    )


def matrix_rows(parts: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Its shared columns in order, and which of them are among its first columns, for every set
    that has some of these."""

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in ("sig", "n", "rare", "common", "first", "beyond", "sketch")}
            for r in batch.to_pylist():
                rare = np.sort(np.frombuffer(b"".join(r["rare"]), np.uint64))
                common = np.unique(np.frombuffer(b"".join(r["common"]), np.uint64))
                n = r["n"]
                left = n - -(-percent * n // 100) + 1 - (n - len(rare) - len(common))
                if left <= 0:
                    continue  # enough shingles of its own: similar to no other set
                first = rare[:left]
                beyond = common[: max(0, left - len(rare))]
                rows["sig"].append(r["sig"])
                rows["n"].append(n)
                rows["rare"].append(rare.tobytes())
                rows["common"].append(common.tobytes())
                rows["first"].append(first.view(np.int64))
                rows["beyond"].append(beyond.view(np.int64))
                rows["sketch"].append(sketch(np.concatenate([rare, common])) if len(beyond) else None)
            lists = pa.list_(pa.int64())
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), lists, lists, lists)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(rows.items(), types)})

    gathered = parts.groupBy("sig").agg(F.collect_list("rare").alias("rare"), F.collect_list("common").alias("common"))
    return gathered.join(sizes, "sig").select("sig", "n", "rare", "common").mapInArrow(lay_out, ROW)


def comparable(a: Column, b: Column, percent: int) -> Column:
    """Whether two sizes allow for the similarity at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def rare_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs that the counts over first, rare columns do not rule out.

    Every group has ``COMMON`` members at the most, as a column with more is no rare one.
    """
    own = rows.select("sig", "n", F.explode("first").alias("column"))
    groups = own.groupBy("column").agg(F.sort_array(F.collect_list(F.struct("sig", "n"))).alias("m")).where(F.size("m") > 1)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["m"]
            ends, flat = lists.offsets.to_numpy(), lists.values
            sig, n = flat.field("sig").to_numpy(), flat.field("n").to_numpy()
            out = []
            for a, b in zip(ends, ends[1:]):
                i, j = np.triu_indices(b - a, 1)
                i, j = i + a, j + a
                fits = np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent
                out.append((i[fits], j[fits]))
            i = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
            j = np.concatenate([y for _, y in out]) if out else i
            for at in range(0, len(i), 500_000):
                p, q = i[at : at + 500_000], j[at : at + 500_000]
                yield pa.RecordBatch.from_pydict({"a": sig[p], "b": sig[q]})

    pairs = groups.select("m").mapInArrow(pair, "a long, b long")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("met"))


def counted(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full overlap reaches the similarity."""
    left = rows.select(F.col("sig").alias("a"), F.col("n").alias("n_a"), F.concat("rare", "common").alias("x"))
    right = rows.select(F.col("sig").alias("b"), F.col("n").alias("n_b"), F.concat("rare", "common").alias("y"))

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
            both = np.array(
                [
                    np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True).size
                    for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist())
                ],
                np.int64,
            )
            good = both * 100 >= (n_a + n_b - both) * percent
            yield pa.RecordBatch.from_pydict({"a": batch["a"].filter(pa.array(good)), "b": batch["b"].filter(pa.array(good))})

    met = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "x", "y")
    return met.mapInArrow(overlap, "a long, b long")


def meetings(crowd: DataFrame, percent: int) -> DataFrame:
    """(sig, root, n, s, column, low, high, lower, upper): where sets of a crowd may meet others.

    Partners are told apart by bands of their size.  The larger a partner, the more shingles it
    has to share, so the fewer of a set's first columns can be the first shared one: a set with many
    shingles of its own has none at all for partners as large as itself.  ``low`` and ``high`` are
    the bands of both, ``lower`` and ``upper`` tell on which sides the set may stand.
    """

    def band(n: int) -> int:
        return int(np.log(n) / np.log(BAND))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("sig", "root", "n", "s", "column", "low", "high")}
            for r in batch.to_pylist():
                n, rare = r["n"], len(r["rare"]) // 8
                common = np.frombuffer(r["common"], np.uint64).view(np.int64)
                own = n - rare - len(common)
                mine = band(n)
                for other in range(band(-(-percent * n // 100)), band(100 * n // percent) + 1):
                    least = max(1, int(BAND**other))
                    need = -(-percent * (n + least) // (100 + percent))
                    first = common[: max(0, n - need + 1 - own - rare)]
                    out["column"].append(first)
                    for name, x in (("sig", r["sig"]), ("root", r["root"]), ("n", n), ("s", n - own), ("low", min(mine, other)), ("high", max(mine, other))):
                        out[name].append(np.full(len(first), x, np.int64))
            if out["sig"]:
                flat = {k: np.concatenate(v) for k, v in out.items()}
                same = flat["low"] == flat["high"]
                size = np.array([band(n) for n in flat["n"]], np.int64)
                flat |= {"lower": same | (size == flat["low"]), "upper": same | (size == flat["high"])}
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in flat.items()})

    types = "sig long, root long, n long, s long, column long, low long, high long, lower boolean, upper boolean"
    return crowd.select("sig", "root", "n", "rare", "common").mapInArrow(meet, types)


def crowded_pairs(crowd: DataFrame, root_of: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets of different components that sizes, shared columns and sketches allow."""
    met = meetings(crowd.join(root_of.select("sig", "root"), "sig"), percent)
    keys = ["column", "low", "high"]
    sides = met.groupBy(*keys).agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.max("lower").alias("lower"), F.max("upper").alias("upper")
    )
    met = met.join(sides.where("least < most and lower and upper").select(*keys), keys, "left_semi")
    both = met.where("lower").alias("a").join(met.where("upper").alias("b"), keys)
    need = F.ceil((F.col("a.n") + F.col("b.n")) * percent / (100 + percent))
    both = both.where((F.col("a.root") != F.col("b.root")) & ((F.col("low") < F.col("high")) | (F.col("a.sig") < F.col("b.sig"))))
    both = both.where((F.col("a.s") >= need) & (F.col("b.s") >= need) & comparable(F.col("a.n"), F.col("b.n"), percent))
    pairs = both.select(F.least("a.sig", "b.sig").alias("x"), F.greatest("a.sig", "b.sig").alias("y")).distinct()
    of = root_of.select("sig", "n", "s", "sketch")
    pairs = pairs.join(of.alias("a"), F.col("x") == F.col("a.sig")).join(of.alias("b"), F.col("y") == F.col("b.sig"))
    return pairs.where(bounded("a", "b", percent)).select(F.col("x").alias("a"), F.col("y").alias("b"))


def open_members(columns: DataFrame, root_of: DataFrame) -> DataFrame:
    """The entries (sig, column) of columns in which several components meet."""
    members = columns.join(root_of.select("sig", "n", "s", "root"), "sig")
    open_ = members.groupBy("column").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return members.join(open_.select("column"), "column", "left_semi")


def links_of(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all sets that a chain of similar pairs connects."""
    shared = ((F.length("rare") + F.length("common")) / 8).alias("s")
    size = rows.select("sig", "n", shared, (shared - F.size("first")).alias("rest"))
    pairs = rare_pairs(rows, percent)
    pairs = pairs.join(size.toDF("a", "n_a", "s_a", "rest_a"), "a").join(size.toDF("b", "n_b", "s_b", "rest_b"), "b")
    # An overlap of need or more is asked for.  Up to the end of the shorter first part all common
    # columns have been met; behind it are no more than that set's other shared columns.
    need = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))
    bound = F.least("s_a", "s_b", F.col("met") + F.greatest("rest_a", "rest_b"))
    pairs = pairs.where(bound >= need).select("a", "b")
    links = stored(counted(pairs, rows, percent), "links")

    crowd = stored(rows.where(F.size("beyond") > 0), "crowd")
    if crowd.isEmpty():
        return links
    columns = stored(crowd.select("sig", F.explode("beyond").alias("column")), "columns")
    roots = components(links, "links").withColumnRenamed("node", "sig")
    entry = ((F.length("rare") + F.length("common")) / 8).cast("long").alias("s")
    root_of = crowd.select("sig", "n", entry, "sketch").join(roots, "sig", "left")
    root_of = stored(root_of.select("sig", "n", "s", "sketch", F.coalesce("root", "sig").alias("root")), "roots")
    for turn in range(LEADERS):
        members = stored(open_members(columns, root_of), "open")
        if members.isEmpty():
            return links
        # The first leaders are the sets with the fewest shingles of their own: what the
        # others are copies of.
        order = F.struct((F.col("n") - F.col("s") if turn == 0 else F.lit(0)).alias("own"), F.xxhash64("sig", F.lit(turn)).alias("draw"))
        leader = members.groupBy("column").agg(F.min_by(F.struct("sig", "n", "root"), order).alias("leader"))
        pairs = members.join(leader, "column").where(F.col("root") != F.col("leader.root"))
        pairs = pairs.where(comparable(F.col("n"), F.col("leader.n"), percent)).select("sig", F.col("leader.sig").alias("other"))
        pairs = pairs.select(F.least("sig", "other").alias("a"), F.greatest("sig", "other").alias("b")).distinct()
        good = stored(counted(pairs, crowd, percent), "good")
        links = links.unionByName(good)
        ends = good.join(root_of.select(F.col("sig").alias("a"), F.col("root").alias("x")), "a")
        ends = ends.join(root_of.select(F.col("sig").alias("b"), F.col("root").alias("y")), "b")
        new = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")), "roots").toDF("root", "new")
        root_of = root_of.join(new, "root", "left").select("sig", "n", "s", "sketch", F.coalesce("new", "root").alias("root"))
        root_of = stored(root_of, "roots")
    left = stored(open_members(columns, root_of).select("sig").distinct(), "left")
    if left.isEmpty():
        return links
    pairs = stored(crowded_pairs(crowd.join(left, "sig"), root_of, percent), "pairs")
    return links.unionByName(stored(counted(pairs, crowd, percent), "good"))


def grouped(docs: DataFrame, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text) with n_shingles and component_id; ``text`` is left out.

    Two documents are linked if their sets of shingles have a Jaccard similarity of at least
    ``percent`` / 100; ``component_id`` is the smallest doc_id that links reach, itself included.
    Documents without words (missing or empty texts) have no shingles and are linked with nothing.
    Documents of equal sets are one row of the matrix; rows of one doc_id are documents of
    their own; other columns stay, one of the names n_shingles or component_id is replaced.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_shingles", "component_id")]
    docs = docs.select(F.struct(*columns).alias("kept"), "text")
    measured = stored(sized(docs, width), "sizes")
    sizes = measured.where("sig is not null").groupBy("sig").agg(F.min("kept.doc_id").alias("id"), F.first("n").alias("n"))
    blocks = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = entries(docs, width, blocks).repartition("block").sortWithinPartitions("block")
    rows = stored(matrix_rows(shared_entries(packed), sizes.select("sig", "n"), percent), "rows")
    roots = components(links_of(rows, percent), "links")
    named = sizes.select("sig", "id").join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    named = named.select("sig", "id", F.coalesce("root", "sig").alias("root"))
    smallest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = named.join(smallest, "root").select("sig", "component_id")
    return measured.join(named, "sig", "left").select(
        "kept.*", F.col("n").alias("n_shingles"), F.coalesce("component_id", "kept.doc_id").alias("component_id")
    )
