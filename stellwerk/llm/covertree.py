"""Exact pairs of near vectors by a dual traversal of cover trees.

Vectors are compared as points on the unit sphere: a cosine of at least c is a distance of at
most sqrt(2 - 2c).  Equal vectors are taken together first.  The upper level of the tree are
pivots of each label: a point belongs to the cell of its nearest pivot, and visits another cell
only if it may have a neighbour there, which the bisector of the two pivots bounds.  A cell with
many points is dealt over a grid of tasks.  In every task both sides are arranged in nested levels
with halving radii; pairs of nodes further apart than the threshold and both covering radii are
dropped level by level, what is left is compared in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellwerk.llm.common import components, extended, stored

#: Points of a cell, on average; pivots of all labels together; points of a task on either side.
CELL, PIVOTS, RESIDENTS, VISITORS = 2048, 16_384, 1024, 4096
LEVELS = (1.0, 0.5, 0.25)
SLACK = 1e-6  # well above what rounding can do to a distance


class Level:
    """Centres of one level, the parent of each, and how far below it reaches."""

    def __init__(self, centre: np.ndarray, parent: np.ndarray, radius: np.ndarray):
        self.centre, self.parent, self.radius = centre, parent, radius


def levels(points: np.ndarray) -> list[Level]:
    """Nested centres: every point is within 1, 1/2, 1/4 of a centre; the last level is all points."""
    n = len(points)
    above = np.zeros(n, np.int64)  # centre number of every point on the level above
    out: list[Level] = []
    earlier = np.zeros(0, np.int64)  # points that are centres already; they stay centres
    for radius in LEVELS:
        chosen, own = list(earlier), np.full(n, -1)
        order = np.concatenate([earlier, np.setdiff1d(np.arange(n), earlier)])
        for at in range(0, n, 256):
            some = order[at : at + 256]
            near = points[some] @ points[some].T >= 1 - radius * radius / 2
            some_above = above[some]
            for i, point in enumerate(some):
                # A centre covers only points below its own parent, so levels stay nested.
                if own[point] < 0 or (at + i < len(earlier)):
                    nth = len(chosen) if at + i >= len(earlier) else at + i
                    if at + i >= len(earlier):
                        chosen.append(point)
                    fits = near[i] & (some_above == some_above[i]) & (own[some] < 0)
                    own[some[fits]] = nth
                    own[point] = nth
            rest = order[at + 256 :]
            rest = rest[own[rest] < 0]
            fresh = np.unique(own[some])
            if len(rest) and len(fresh):
                centres = np.array(chosen)[fresh]
                close = points[rest] @ points[centres].T
                close[above[rest][:, None] != above[centres][None, :]] = -2
                best = close.argmax(axis=1)
                good = close[np.arange(len(rest)), best] >= 1 - radius * radius / 2
                own[rest[good]] = fresh[best[good]]
        centre = np.array(chosen, np.int64)
        gap = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", points, points[centre[own]])))
        reach = np.zeros(len(centre))
        np.maximum.at(reach, own, gap)
        out.append(Level(centre, above[centre], reach))
        above, earlier = own, centre
    out.append(Level(np.arange(n), above, np.zeros(n)))
    return out


def linked(left: np.ndarray, right: np.ndarray, cosine: float) -> np.ndarray:
    """Matrix of the pairs with at least this cosine: both trees are walked down together."""
    far = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    alive: np.ndarray | None = None
    for a, b in zip(levels(left), levels(right)):
        gap = np.sqrt(np.maximum(0, 2 - 2 * (left[a.centre] @ right[b.centre].T)))
        near = gap <= far + a.radius[:, None] + b.radius[None, :]
        alive = near if alive is None else near & alive[a.parent[:, None], b.parent[None, :]]
        if not alive.any():
            return np.zeros((len(left), len(right)), bool)
    i, j = np.nonzero(alive)
    out = np.zeros(alive.shape, bool)
    for at in range(0, len(i), 65_536):
        x, y = left[i[at : at + 65_536]], right[j[at : at + 65_536]]
        out[i[at : at + 65_536], j[at : at + 65_536]] = np.einsum("ij,ij->i", x, y) >= cosine
    return out


def roots_of(pairs: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """Component number of every row and column of a matrix of links."""
    far = rows + columns
    left, right = np.arange(rows), rows + np.arange(columns)
    while True:
        a = np.minimum(left, np.where(pairs, right, far).min(axis=1, initial=far))
        b = np.minimum(right, np.where(pairs, a[:, None], far).min(axis=0, initial=far))
        if (a == left).all() and (b == right).all():
            return np.concatenate([a, b])
        left, right = a, b


def unit(column: pa.Array) -> np.ndarray:
    """Rows of doubles of length 1; all rows of one call have the same number of components."""
    raw = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    ends = column.offsets.to_numpy()
    table = raw[ends[0] : ends[-1]].reshape(len(column), -1)
    table = table / np.abs(table).max(axis=1, keepdims=True)
    return table / np.sqrt(np.einsum("ij,ij->i", table, table))[:, None]


def near_duplicates(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) with n_links, component_id and kept.

    Vectors of equal label and equal length are linked if their cosine is at least ``cosine``.
    ``n_links`` counts the other rows a row is linked with, ``component_id`` is the smallest vec_id
    that links reach, ``kept`` says whether this is the row's own.  Rows without a label or
    whose vector is null, empty, zero or holds null or non-finite components are linked with nothing.  Rows of the
    same vec_id are rows of their own; other columns stay (columns named n_links, component_id or kept
    are replaced).
    """
    columns = [F.col(f"`{c}`") for c in vectors.columns if c not in ("n_links", "component_id", "kept")]
    vectors = vectors.select(F.struct(*columns).alias("row"), "vec_id", "embedding", "label")
    x = F.col("embedding")
    usable = (
        F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0)
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(x, lambda v: v != 0)
    )
    rows = vectors.withColumn("_usable", F.coalesce(usable, F.lit(False)))
    key = ["_label", "_x"]
    good = rows.where("_usable").withColumns({"_label": F.struct("label", F.size(x)), "_x": F.transform(x, lambda v: v + F.lit(0).cast("float"))})
    classes = good.groupBy(*key).agg(F.min("vec_id").alias("_id"), F.count("*").alias("_many"))
    classes = classes.withColumn("_class", F.monotonically_increasing_id())
    classes = stored(classes, "vectors")
    links = stored(links_of(classes.select(F.col("_class").alias("node"), F.col("_label").alias("label"), F.col("_x").alias("x"), F.col("_many").alias("many")), cosine), "links")
    degree = links.where("visits").groupBy(F.col("node").alias("_class")).agg(F.sum("n").alias("_n"))
    roots = components(links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), "links")
    joined = classes.join(degree, "_class", "left").join(roots.select(F.col("node").alias("_class"), F.col("root").alias("_root")), "_class", "left")
    joined = joined.select(*key, "_id", "_many", F.coalesce("_n", F.lit(0)).alias("_n"), F.coalesce("_root", "_class").alias("_root"))
    smallest = joined.groupBy("_root").agg(F.min("_id").alias("_smallest"))
    info = joined.join(smallest, "_root").select(*key, "_many", "_n", "_smallest")
    done = good.join(info, key).select(
        "row", "vec_id", (F.col("_n") + F.col("_many") - 1).cast("long").alias("n_links"), F.col("_smallest").alias("component_id")
    )
    alone = rows.where("not _usable").select("row", "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    return done.unionByName(alone).select("row.*", "n_links", "component_id", kept)


def links_of(points: DataFrame, cosine: float) -> DataFrame:
    """(node, root, n, visits): a node's links in one task, and one node of its component there.

    ``points`` are (node, label, x, many), no two of them equal.  ``n`` sums ``many`` of the
    linked nodes; only rows with ``visits`` count for it.
    """
    far = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    sizes = points.groupBy("label").agg(F.count("*").alias("points"))
    wanted = F.when(F.col("points") > CELL, F.ceil(F.col("points") / CELL)).otherwise(F.lit(0))
    total = sizes.agg(F.sum(wanted).alias("n")).first()["n"] or 0
    # All pivots together are bounded, so that every worker can hold them.
    sizes = sizes.withColumn("pivots", F.floor(wanted * min(1.0, PIVOTS / max(1, total))))
    sizes = sizes.where("pivots > 1")
    chance = (F.xxhash64("node") / F.lit(2.0**64)) + 0.5
    drawn = points.join(sizes, "label").where(chance < F.col("pivots") / F.col("points"))
    pivots: dict[tuple, np.ndarray] = {}
    for r in drawn.select("label", "x").limit(2 * PIVOTS).collect():
        pivots.setdefault(tuple(r["label"]), []).append(r["x"])
    pivots = {k: np.array(v, np.float64) for k, v in pivots.items()}
    pivots = {k: v / np.linalg.norm(v, axis=1, keepdims=True) for k, v in pivots.items()}
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, visited = [], []
            labels = [tuple(x.values()) for x in batch["label"].to_pylist()]
            for label, row in zip(labels, batch["x"]):
                centres = shared.value.get(label)
                if centres is None:
                    own.append(0)
                    visited.append([0])
                    continue
                x = np.array(row.as_py(), np.float64)
                dots = centres @ (x / np.linalg.norm(x))
                best = int(dots.argmax())
                # |x - q|^2 - |x - p|^2 = 2 (x.p - x.q); over 2 |p - q| it is the way to the bisector.
                gap = np.sqrt(np.maximum(0, 2 - 2 * (centres @ centres[best])))
                own.append(best)
                visited.append(np.flatnonzero(dots[best] - dots <= far * gap + SLACK).tolist())
            columns = {name: batch[name] for name in batch.schema.names}
            columns |= {"own": pa.array(own, pa.int32()), "visited": pa.array(visited, pa.list_(pa.int32()))}
            yield pa.RecordBatch.from_pydict(columns)

    schema = extended(points.schema, "own int, visited array<int>")
    placed = stored(points.mapInArrow(cells, schema), "cells")
    visits = placed.select("node", "label", "x", "many", F.explode("visited").alias("cell"))
    home = placed.select("node", "label", "x", "many", F.col("own").alias("cell"))
    grid = (
        home.groupBy("label", "cell").agg(F.ceil(F.count("*") / RESIDENTS).alias("across"))
        .join(visits.groupBy("label", "cell").agg(F.ceil(F.count("*") / VISITORS).alias("down")), ["label", "cell"])
    )
    deal = lambda many: F.pmod(F.xxhash64("node"), F.col(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.col(many).cast("int") - 1))
    keys = ("label", "cell", "column", "line")
    residents = home.join(grid, ["label", "cell"]).select(
        "label", "cell", deal("across").alias("column"), every("down").alias("line"), F.lit(False).alias("visits"), "node", "many", "x"
    )
    visitors = visits.join(grid, ["label", "cell"]).select(
        "label", "cell", every("across").alias("column"), deal("down").alias("line"), F.lit(True).alias("visits"), "node", "many", "x"
    )

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        visiting = table["visits"].to_numpy(zero_copy_only=False)
        nodes, many = table["node"].to_numpy(), table["many"].to_numpy()
        x = unit(table["x"].combine_chunks() if isinstance(table["x"], pa.ChunkedArray) else table["x"])
        a, b = np.flatnonzero(visiting), np.flatnonzero(~visiting)
        pairs = linked(x[a], x[b], cosine)
        pairs &= nodes[a][:, None] != nodes[b][None, :]
        roots = roots_of(pairs, len(a), len(b))
        both = np.concatenate([a, b])
        n = np.concatenate([pairs @ many[b], np.zeros(len(b), np.int64)])
        root = nodes[both][roots]
        useful = (n > 0) | (root != nodes[both])
        return pa.table({"node": nodes[both][useful], "root": root[useful], "n": n[useful].astype(np.int64), "visits": visiting[both][useful]})

    met = visitors.unionByName(residents).groupBy(*keys)
    return met.applyInArrow(compare, "node long, root long, n long, visits boolean")
