"""Exact top-k search with a bit-sliced index.

Attributes are whole numbers.  A block of rows keeps, for every attribute, one bitmap per binary
digit (two's complement).  The scores of all rows of a block for one query are added up digit by
digit: every non-zero digit of a query component adds the shifted slices of its attribute, with
carry-save additions on whole bitmaps.  The best rows are then selected from the most significant
slice of the score downward; rows that tie at the boundary are taken in order of their ids, and
the scores of the few selected rows are computed exactly.

Blocks and query groups meet in a join on block and part, so memory is bounded by one block and
one group, and every task answers some groups for one block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellwerk.llm.common import stored

SCALE = 1024
#: Rows of a block and queries of a group, on average; groups that one task answers.
BLOCK, GROUP, GROUPS = 16_384, 128, 4
#: Largest number of digits of a quantised component that scores in 64 bits allow for.
DIGITS = 40


def quantised(vector: Column) -> Column:
    """floor(1024 * x) of every component, null for vectors that take no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def slices(values: np.ndarray) -> np.ndarray:
    """Bitmaps [attribute, digit, word] of a table [row, attribute]; the last digit is the sign."""
    rows, width = values.shape
    top = int(np.abs(values).max(initial=0))
    digits = top.bit_length() + 1
    padded = -(-max(rows, 1) // 64) * 64
    bits = np.zeros((width, digits, padded), np.uint8)
    for digit in range(digits):
        bits[:, digit, :rows] = ((values >> digit) & 1).T
    return np.packbits(bits, axis=2, bitorder="little").view(np.uint64)


def signed_digits(number: int) -> list[tuple[int, int]]:
    """(place, +1 or -1) with as few places as can be."""
    out, place = [], 0
    while number:
        if number & 1:
            sign = 2 - (number & 3)
            out.append((place, sign))
            number -= sign
        number >>= 1
        place += 1
    return out


def scores(index: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Slices [digit, word] of all rows' inner products with one query, in two's complement."""
    width, digits, words = index.shape
    bound = sum(abs(int(x)) for x in query[:width]) << (digits - 1)
    size = bound.bit_length() + 2
    total, carry = np.zeros((size, words), np.uint64), np.zeros((size, words), np.uint64)
    added, both = np.empty_like(total), np.empty_like(total)
    ones = 0
    for attribute in range(width):
        for place, sign in signed_digits(int(query[attribute])):
            own = index[attribute]
            added[:place] = 0
            top = min(size, place + digits)
            added[place:top] = own[: top - place]
            added[top:] = own[-1]
            if sign < 0:  # -x is ~x + 1
                np.bitwise_not(added, out=added)
                ones += 1
            np.bitwise_and(total, carry, out=both)
            np.bitwise_xor(total, carry, out=total)
            np.bitwise_and(total, added, out=carry)
            np.bitwise_xor(total, added, out=total)
            np.bitwise_or(carry, both, out=carry)
            carry[1:] = carry[:-1].copy()
            carry[0] = 0
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    # Two last additions with the carry handed from digit to digit: the carries, then the ones.
    for other in (carry, [full if ones >> i & 1 else np.uint64(0) for i in range(size)]):
        over = np.zeros(words, np.uint64)
        for i in range(size):
            half = total[i] ^ other[i]
            over, total[i] = (total[i] & other[i]) | (half & over), half ^ over
    return total


def best(total: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Bits of the k rows with the highest scores; the lowest bits first where scores tie."""
    certain, open_ = np.zeros_like(allowed), allowed.copy()
    for digit in range(len(total) - 1, -1, -1):
        ones = ~total[digit] if digit == len(total) - 1 else total[digit]  # the sign counts down
        upper = open_ & ones
        count = int(np.bitwise_count(certain).sum() + np.bitwise_count(upper).sum())
        if count > k:
            open_ = upper
        else:
            certain, open_ = certain | upper, open_ & ~ones
            if count == k:
                break
    places = lambda bits: np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))
    sure = places(certain)
    return np.concatenate([sure, places(open_)[: k - len(sure)]])


def top_k(vectors: DataFrame, queries: str, k: int) -> DataFrame:
    """For every row that fulfils the SQL condition ``queries``: its ``k`` best other rows.

    Needs ``vec_id`` (whole number) and ``embedding`` (array of numbers).  Returns query_id, rank
    (from 1), vec_id and score, the inner product of the quantised vectors; ties go to the smaller
    vec_id.  Vectors that are null or hold null or non-finite components, and rows without an id,
    take no part; an empty vector scores 0 with all.  Of vectors of different length the common
    components count.  A row's own id is no answer to it; equal query rows are answered once, equal
    other rows are answers each.  Quantised components must fit in 40 binary digits, else the job
    ends with an error.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", quantised(F.col("embedding")).alias("q"), F.monotonically_increasing_id().alias("turn"), F.coalesce(F.expr(queries), F.lit(False)).alias("asks"))
    rows = stored(rows.where("vec_id is not null and q is not null"), "quantised")
    asked = rows.where("asks").select(F.col("vec_id").alias("query_id"), "q").distinct()
    n = rows.agg(F.count("*"), F.sum(F.col("asks").cast("int"))).first()
    blocks, groups = max(1, math.ceil(n[0] / BLOCK)), max(1, math.ceil((n[1] or 0) / GROUP))
    parts = max(1, math.ceil(groups / GROUPS))

    def packed(key: str, name: str):
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """All rows of each key, which the batches bring one after the other."""
            ids: list[int] = []
            values: list[np.ndarray] = []
            now = None

            def done() -> pa.RecordBatch:
                width = max(map(len, values))
                table = np.zeros((len(values), width), np.int64)
                for at, x in enumerate(values):
                    table[at, : len(x)] = x
                if len(table) and np.abs(table).max(initial=0) >= 1 << DIGITS:
                    raise OverflowError(f"a component needs more than {DIGITS} binary digits")
                order = np.argsort(ids, kind="stable")
                own = np.array(ids, np.int64)[order]
                return pa.RecordBatch.from_pydict(
                    {key: pa.array([now], pa.int32()), "width": pa.array([width], pa.int32()), "ids": [own.tobytes()], "table": [table[order].tobytes()]}
                )

            for batch in batches:
                flat, ends = batch["q"].values.to_numpy(), batch["q"].offsets.to_numpy()
                for at, own, a, b in zip(batch[key].to_pylist(), batch[name].to_pylist(), ends, ends[1:]):
                    if at != now and values:
                        yield done()
                        ids, values = [], []
                    now = at
                    ids.append(own)
                    values.append(flat[a:b].copy())
            if values:
                yield done()

        return pack, f"{key} int, width int, ids binary, table binary"

    bucket = lambda column, many: F.pmod(F.xxhash64(column), F.lit(many)).cast("int")
    left = rows.withColumn("block", bucket("turn", blocks)).select("block", "vec_id", "q")
    left = left.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(*packed("block", "vec_id"))
    left = stored(left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))), "blocks")
    right = asked.withColumn("group", bucket("query_id", groups)).select("group", "query_id", "q")
    right = right.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(*packed("group", "query_id"))
    right = right.select(
        (F.col("group") % parts).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.col("width").alias("query_width"), F.col("ids").alias("query_ids"), F.col("table").alias("query_table"),
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                table = np.frombuffer(row["table"], np.int64).reshape(len(ids), row["width"])
                asking = np.frombuffer(row["query_ids"], np.int64)
                query = np.frombuffer(row["query_table"], np.int64).reshape(len(asking), row["query_width"])
                index = slices(table)
                common = min(table.shape[1], query.shape[1])
                out: tuple[list, list, list] = ([], [], [])
                for own, values in zip(asking.tolist(), query):
                    allowed = np.zeros(index.shape[2] * 64, np.uint8)
                    allowed[: len(ids)] = ids != own
                    bits = np.packbits(allowed, bitorder="little").view(np.uint64)
                    total = scores(index[:common], values[:common])
                    picked = best(total, bits, k)
                    exact = table[picked][:, :common].astype(object) @ values[:common].astype(object) if common else [0] * len(picked)
                    for kept, new in zip(out, ([own] * len(picked), ids[picked].tolist(), list(exact))):
                        kept += new
                names = ("query_id", "vec_id", "score")
                yield pa.RecordBatch.from_pydict({m: pa.array(v, pa.int64()) for m, v in zip(names, out)})

    met = left.join(right, ["block", "part"]).repartition(blocks * parts, "block", "part")
    found = met.drop("part").mapInArrow(answer, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
