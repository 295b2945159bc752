"""Fixity audit of WARC replicas with Merkle trees.

Every record of a WARC file has a digest over its head and body.  Records of one id are in one
slot, as a set of digests with the number of copies of each.  Digests are hashed into nodes of
``FAN`` children, level by level, up to one root for each file: first by ever shorter prefixes of
the digests of a slot, then by slots.  Two replicas are compared from the roots down, and below a
node only if it differs, so equal branches are never looked at again.  What differs at the lowest
level are the corrupt, missing or surplus records.

Only DataFrame functions are used.  The prefixes are as long as the fullest slot asks for, so a
lowest node holds ``LEAST`` different records on average, however many share an id, and any other
node ``FAN`` nodes at the most.  Running sums are taken in these nodes, on top of the sums of
nodes before; equal records are one row with their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellwerk.llm.common import stored

#: Children of a node (one hexadecimal digit), and ids of one file.
FAN, FILE = 16, 4096
#: Different records below a node of the lowest level, at the most on average.
LEAST = 4
#: Records that one array numbers.
BLOCK = 4096


def record(url: Column, body: Column) -> Column:
    """The bytes of a WARC response record; missing parts count as empty."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.encode(F.concat(head, body, F.lit("\r\n\r\n")), "utf-8")


def depth_of(*replicas: DataFrame) -> int:
    """Hexadecimal digits that split the slot with the most different records into lowest nodes."""
    depth = 0
    for replica in replicas:
        most = replica.groupBy("file", "slot").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        while most > LEAST * FAN**depth:
            depth += 1
    return depth


def node_of(depth: int) -> Column:
    """The lowest node of a record: its slot and the first digits of its digest."""
    if not depth:
        return F.col("slot")
    return F.col("slot") * FAN**depth + F.conv(F.substring("digest", 1, depth), 16, 10).cast("long")


def up(node: Column) -> Column:
    return F.shiftright(node, FAN.bit_length() - 1)


def numbered(runs: DataFrame, depth: int) -> DataFrame:
    """``copy``, the records of the slot before, and ``offset``, the bytes of the file before, for
    rows (file, slot, digest, length, copies)."""
    runs = runs.withColumn("node", node_of(depth))
    size = F.col("copies") * F.col("length")
    nodes = runs.groupBy("file", "slot", "node").agg(F.sum("copies").alias("copies"), F.sum(size).alias("bytes"))
    sum_of = lambda c, window: F.coalesce(F.sum(c).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nodes = nodes.select(
        "file", "node",
        sum_of("copies", Window.partitionBy("file", "slot").orderBy("node")).alias("copies_before"),
        sum_of("bytes", Window.partitionBy("file").orderBy("node")).alias("bytes_before"),
    )
    inside = Window.partitionBy("file", "node").orderBy("digest")
    runs = runs.select("*", sum_of("copies", inside).alias("copies_inside"), sum_of(size, inside).alias("bytes_inside"))
    return runs.join(nodes, ["file", "node"]).select(
        *[c for c in runs.columns if c not in ("node", "copies_inside", "bytes_inside")],
        (F.col("copies_before") + F.col("copies_inside")).alias("copy"), (F.col("bytes_before") + F.col("bytes_inside")).alias("offset"),
    )


def records(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(file, slot, copy, copies, id, offset, length, digest) of pages laid out in WARC files.

    A file holds the pages of ``FILE`` consecutive ids, so replicas agree on the place of a page
    whatever has happened to the pages before it.  Rows without an id are in files of their own, in
    file (below 0) and slot by a hash; rows of equal id follow each other, ordered by their digests.
    Equal records of an id are one row: ``copies`` records that follow each other, of which copy
    and offset are those of the first.
    """
    id_ = F.col(key).cast("long")
    raw = record(F.col(url), F.col(body))
    hashed = F.xxhash64(raw)
    rows = pages.select(
        F.coalesce(F.floor(id_ / FILE), -1 - F.pmod(hashed, F.lit(1024))).alias("file"),
        F.coalesce(F.pmod(id_, F.lit(FILE)), F.pmod(F.shiftright(hashed, 10), F.lit(FILE))).alias("slot"),
        id_.alias("id"), F.octet_length(raw).cast("long").alias("length"), F.sha2(raw, 256).alias("digest"),
    )
    runs = stored(rows.groupBy("file", "slot", "id", "length", "digest").agg(F.count("*").alias("copies")), "runs")
    return numbered(runs, depth_of(runs)).select("file", "slot", "copy", "copies", "id", "offset", "length", "digest")


def levels(replica: DataFrame, depth: int = 0) -> list[DataFrame]:
    """Nodes (file, node, digest) of a replica, from the lowest up to the file roots.

    A leaf is what one digest stands for: the digest, the length and the number of its records.
    Offsets are no part of it.  They follow from the lengths before, and a lost record moves all
    behind it, which are untouched.
    """
    leaves = F.array_sort(F.collect_list(F.concat_ws(":", "digest", "length", "copies")))
    node = replica.groupBy("file", node_of(depth).alias("node")).agg(F.sha2(F.concat_ws(",", leaves), 256).alias("digest"))
    out, width = [node], FILE * FAN**depth
    while width > 1:
        width = -(-width // FAN)
        children = F.array_sort(F.collect_list(F.struct("node", "digest")))
        named = F.transform(children, lambda x: F.concat(x["node"].cast("string"), F.lit(":"), x["digest"]))
        node = out[-1].select("file", up(F.col("node")).alias("up"), "node", "digest")
        node = node.groupBy("file", F.col("up").alias("node_")).agg(F.sha2(F.concat_ws(",", named), 256).alias("digest"))
        out.append(node.withColumnRenamed("node_", "node"))
    return out


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, node) of one level that are not alike in both replicas."""
    both = left.select("file", "node", F.col("digest").alias("l")).join(
        right.select("file", "node", F.col("digest").alias("r")), ["file", "node"], "full_outer"
    )
    return both.where(~F.col("l").eqNullSafe(F.col("r"))).select("file", "node")


def unmatched(own: DataFrame, other: DataFrame, depth: int) -> DataFrame:
    """(file, slot, nth, copy, offset, length, digest) of the records that the other replica has
    not, or not as often; nth counts them in their slot."""
    there = other.select("file", "slot", "digest", F.col("copies").alias("there"))
    more = own.join(there, ["file", "slot", "digest"], "left").withColumn("there", F.coalesce("there", F.lit(0)))
    more = more.where("copies > there").select(
        "file", "slot", "length", "digest", (F.col("copies") - F.col("there")).alias("copies"),
        (F.col("copy") + F.col("there")).alias("first"), (F.col("offset") + F.col("there") * F.col("length")).alias("at"),
    )
    more = numbered(stored(more, "more"), depth).drop("offset")
    # Many equal records are counted in blocks.
    last = F.col("copies") - 1
    more = more.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / BLOCK))))
    start = F.col("block") * BLOCK
    more = more.withColumn("i", F.explode(F.sequence(start, F.least(start + (BLOCK - 1), last))))
    return more.select(
        "file", "slot", (F.col("copy") + F.col("i")).alias("nth"), (F.col("first") + F.col("i")).cast("int").alias("copy"),
        (F.col("at") + F.col("i") * F.col("length")).alias("offset"), "length", "digest",
    )


def audited(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """The records of two replicas (see :func:`records`) that are not alike.

    The records of an id are compared as they are, not by their order: each digest has a number of
    copies on both sides.  Of what is left on both sides the first records are taken for one
    corrupt one, and so on.  Returns file, slot, copy, offset and length (in the primary, else in
    the replica), expected and found digest, and status: ``corrupt``, ``missing`` (in the replica)
    or ``surplus``.  Equal or empty replicas give no rows.
    """
    sides = [stored(x, "replica") for x in (primary, replica)]
    depth = depth_of(*sides)
    trees = [[stored(level, "level") for level in levels(x, depth)] for x in sides]
    open_: DataFrame | None = None
    for left, right in zip(reversed(trees[0]), reversed(trees[1])):
        if open_ is not None:
            above = open_.select("file", F.col("node").alias("up"))
            left, right = (x.withColumn("up", up(F.col("node"))).join(above, ["file", "up"], "left_semi") for x in (left, right))
        open_ = differing(left, right)
    # Records of differing nodes only.
    open_ = stored(open_, "open")
    own, other = (x.withColumn("node", node_of(depth)).join(open_, ["file", "node"], "left_semi").drop("node", "id") for x in sides)
    lost, more = unmatched(own, other, depth), unmatched(other, own, depth)
    key = ["file", "slot", "nth"]
    more = more.toDF(*[c if c in key else f"{c}_found" for c in more.columns])
    status = F.when(F.col("digest").isNull(), "surplus").when(F.col("digest_found").isNull(), "missing").otherwise("corrupt")
    return lost.join(more, key, "full_outer").select(
        "file", "slot", F.coalesce("copy", "copy_found").alias("copy"),
        F.coalesce("offset", "offset_found").alias("offset"), F.coalesce("length", "length_found").alias("length"),
        F.col("digest").alias("expected"), F.col("digest_found").alias("found"), status.alias("status"),
    )
