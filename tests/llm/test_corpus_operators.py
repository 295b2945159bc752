"""Operators that see the whole corpus: language model, mix, vectors, fixity, groups, top k."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellwerk.llm import bitslice, covertree, fixity, hmm, jaccard, mixing
from stellwerk.llm.common import at_workers, components
from stellwerk.llm.queries import op5_mixing


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(1, 1), (3, 2), (2, 3)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert all(out[i] == 100 for i in range(100, 141)) and all(out[i] == 7 for i in range(7, 30)) and out[3] == 2
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# -- language model ---------------------------------------------------------------------------


def paths_sum(p: hmm.Parameters, classes: list[int]) -> float:
    """Likelihood as the sum over all state paths."""
    total = 0.0
    for path in itertools.product(range(len(p.start)), repeat=len(classes)):
        x = p.start[path[0]] * p.emit[classes[0], path[0]]
        for i in range(1, len(classes)):
            x *= p.move[path[i - 1], path[i]] * p.emit[classes[i], path[i]]
        total += x
    return total


def some_parameters(k: int, c: int) -> hmm.Parameters:
    draw = np.random.default_rng(3)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hmm.Parameters(norm(draw.random(k), 0), norm(draw.random((k, k)), 1), norm(draw.random((c, k)), 0), np.full(k, 1 / k))


def test_likelihood_equals_the_sum_over_all_paths():
    p = some_parameters(3, 5)
    texts = [[0], [1, 2, 0], [4, 4, 3, 1, 0], [2, 0]]
    got = hmm.likelihoods([np.array(t, np.uint16).tobytes() for t in texts], p)
    assert got == pytest.approx([math.log10(paths_sum(p, t)) for t in texts])
    assert len(hmm.likelihoods([], p)) == 0


def test_expected_counts_equal_those_over_all_paths():
    p, texts = some_parameters(2, 4), [[1, 2, 0], [3, 0], [1, 1, 3, 2, 0]]
    emissions, moves, starts = np.zeros((4, 2)), np.zeros((2, 2)), np.zeros(2)
    for t in texts:
        total = paths_sum(p, t)
        for path in itertools.product(range(2), repeat=len(t)):
            x = p.start[path[0]] * p.emit[t[0], path[0]]
            for i in range(1, len(t)):
                x *= p.move[path[i - 1], path[i]] * p.emit[t[i], path[i]]
            starts[path[0]] += x / total
            for i, (c, s) in enumerate(zip(t, path)):
                emissions[c, s] += x / total
                if i:
                    moves[path[i - 1], s] += x / total
    parts = list(hmm.expected([np.array(t, np.uint16).tobytes() for t in texts], p, 256))
    got = [sum(x) for x in zip(*parts)]
    for a, b in zip(got, (emissions, moves, starts)):
        assert a == pytest.approx(b)


def test_model_scores(spark):
    draw = random.Random(1)
    words = {"a": ["la", "le", "de", "que"], "b": ["the", "of", "and", "to"]}
    rows = [(i, " ".join(draw.choice(words["ab"[i % 2]]) for _ in range(30)), i) for i in range(200)]
    rows += [(300, None, 0), (301, "", 0), (302, "THE unseen-word", 0), (302, "THE unseen-word", 0), (None, "of " * 30_000, 0)]
    docs = at_workers(spark).createDataFrame(rows, "doc_id long, text string, words int").withColumn("row", F.lit(1))
    out = hmm.scored(docs, "doc_id % 10 <> 0", hmm.Settings(states=2, rounds=4, heads=5, endings=4, known=6)).collect()
    assert len(out) == len(rows) and {"words", "row"} <= set(out[0].asDict())
    training = [t for i, t, _ in rows if i is not None and i % 10]
    tokens = [w.lower() for t in training for w in (t or "").split()] + ["\0"] * len(training)
    n, v = len(tokens), len(set(tokens))
    for r in out:
        text = next(t for i, t, _ in rows if i == r["doc_id"])
        own = [w.lower() for w in (text or "").split()] + ["\0"]
        if len(own) > 100:
            assert math.isfinite(r["score"]) and r["n_tokens"] == 30_001
            continue
        c = [tokens.count(w) for w in own]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(x > 0 for x in c), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in c))
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 300 and r["doc_id"] % 10 == 0]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_model_without_training_texts(spark):
    docs = at_workers(spark).createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out = hmm.scored(docs, "doc_id > 5", hmm.Settings(states=2, rounds=1, heads=3, endings=2)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in out)
    assert hmm.scored(docs.limit(0), "doc_id > 5", hmm.Settings(states=2, rounds=1, heads=3, endings=2)).count() == 0


# -- mixing -------------------------------------------------------------------------------------


def filled(sizes: dict, share: float = 1.5, most: float = 2.0) -> dict:
    """Targets by dealing the rest again and again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), share * sum(sizes.values())
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit >= most * sizes[s]}
        if not full:
            return target | {s: weight[s] * unit for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", range(3))
def test_mix_meets_its_targets(spark, seed):
    draw = random.Random(seed)
    sources = ["b", "a", None, "é", "Z"][: 3 + seed]
    rows = [(i, draw.choice(sources), " ".join(["w"] * draw.randint(0, 40)), 1) for i in range(150)]
    rows += [(900, "a", None, 1), (901, "b", "", 1), (7, "a", "x y", 1), (7, "a", "x y", 1), (None, "b", "w " * 5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, bucket int")
    out = mixing.mixed(docs).collect()
    assert len(out) == len(rows)
    sizes: dict = {}
    for _, s, t, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = filled(sizes)
    for s in sizes:
        own = [r for r in out if r["source"] == s]
        assert own[0]["target"] == pytest.approx(want[s]) and own[0]["source_size"] == sizes[s]
        assert sum(r["taken"] for r in own) == math.floor(own[0]["target"])
        assert all(r["taken"] <= 2 * r["size"] for r in own)
    again = mixing.mixed(docs.repartition(5)).collect()
    key = lambda r: str((r["doc_id"], r["size"], r["taken"], r["takes"]))
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mix_follows_the_schedule(spark):
    rows = [(i, s, "w " * 10) for s in ("a", "b", "c") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    takes = mixing.in_order(mixing.mixed(docs)).collect()
    assert [r["position"] for r in takes] == sorted(r["position"] for r in takes)
    early = {s: sum(r["words"] for r in takes if r["source"] == s and r["position"] < 0.5) for s in "abc"}
    total = {s: sum(r["words"] for r in takes if r["source"] == s) for s in "abc"}
    for s, slope in zip("abc", mixing.SLOPES):  # the integral of the weight up to 1/2
        assert early[s] / total[s] == pytest.approx(0.5 - slope / 4, abs=0.01)
    empty = mixing.mixed(docs.limit(0))
    assert empty.count() == 0 and mixing.in_order(empty).count() == 0


def test_the_query_reads_the_mix_in_its_order(spark, monkeypatch, tmp_path):
    rows = [(i % 50, s, "w " * (i % 7)) for s in ("a", "b", None) for i in range(60)] + [(None, "a", "x y"), (None, "a", "x y"), (3, "b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    made, in_order = [], mixing.in_order
    monkeypatch.setattr(mixing, "in_order", lambda mix: made.append(in_order(mix)) or made[-1])
    out = [tuple(r) for r in op5_mixing(spark, str(tmp_path)).collect()]
    takes = made[0].collect()  # the mix itself, put into order
    assert [r["position"] for r in takes] == sorted(r["position"] for r in takes)
    assert sum(r[4] for r in out) == sum(r["words"] for r in takes) and sum(r[5] for r in out) == len(takes)
    plain = [
        (r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"], len(r["takes"]), min((x["position"] for x in r["takes"]), default=None))
        for r in mixing.mixed(docs).collect()
    ]
    assert sorted(out, key=str) == sorted(plain, key=str) and any(r[5] == 0 for r in out)


# -- vectors ------------------------------------------------------------------------------------


def vectors_of(seed: int, groups: int, size: int, width: int = 8) -> list:
    draw = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = draw.normal(size=width)
        for _ in range(size):
            rows.append((len(rows), [float(x) for x in (centre + draw.normal(size=width) * 0.15).astype(np.float32)], g % 2))
    return rows


def linked_plainly(rows: list, cosine: float) -> dict:
    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [i for i, (_, v, label) in enumerate(rows) if usable(v, label)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    n = [0] * len(rows)
    for a, b in itertools.combinations(good, 2):
        x, y = np.array(rows[a][1]), np.array(rows[b][1])
        if rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
            n[a], n[b] = n[a] + 1, n[b] + 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    low: dict = {}
    for i, r in enumerate(rows):
        low.setdefault(find(i), []).append(r[0])
    return sorted((r[0], n[i], min(low[find(i)])) for i, r in enumerate(rows))


@pytest.mark.parametrize("cell, residents", [(2048, 1024), (40, 16)])
def test_near_vectors_equal_all_pairs(spark, monkeypatch, cell, residents):
    monkeypatch.setattr(covertree, "CELL", cell)
    monkeypatch.setattr(covertree, "RESIDENTS", residents)
    monkeypatch.setattr(covertree, "VISITORS", 4 * residents)
    rows = vectors_of(5, 12, 20)
    n = len(rows)
    rows += [(n + i, rows[3][1], rows[3][2]) for i in range(5)]  # copies
    rows += [(n + 5, [2 * x for x in rows[3][1]], rows[3][2])]
    rows += [(n + 6, None, 0), (n + 7, [0.0] * 8, 0), (n + 8, [float("nan")] + [1.0] * 7, 0), (n + 9, rows[0][1], None)]
    rows += [(n + 10, [1.0, None], 0), (n + 11, [], 0), (n + 12, [1.0, 2.0], 0), (n + 13, [1.0, 2.0], 0), (n + 14, [float("inf")] * 8, 0)]
    frame = at_workers(spark).createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int, many int")
    out = covertree.near_duplicates(frame, 0.98).collect()
    exact = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None, k) for i, v, k in rows]
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out) == linked_plainly(exact, 0.98)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) and r["many"] == 3 for r in out)
    assert covertree.near_duplicates(frame.limit(0)).count() == 0
    clashing = covertree.near_duplicates(frame.selectExpr("*", "'a' as _label", "2 as _x", "'b' as _usable", "1 as n_links"), 0.98)
    assert clashing.columns == [*frame.columns, "_label", "_x", "_usable", "n_links", "component_id", "kept"]
    assert {(r["vec_id"], r["component_id"], r["_label"]) for r in clashing.collect()} == {(r["vec_id"], r["component_id"], "a") for r in out}


def test_cover_tree_levels_are_nested():
    points = np.random.default_rng(2).normal(size=(700, 6))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tree = covertree.levels(points)
    for above, below in zip(tree, tree[1:]):
        assert set(above.centre) <= set(below.centre)
        gap = np.linalg.norm(points[below.centre] - points[above.centre[below.parent]], axis=1)
        assert (gap <= above.radius[below.parent] + 1e-9).all()


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK", 70)
    monkeypatch.setattr(bitslice, "GROUP", 3)
    draw = random.Random(4)
    rows = [(i, [draw.choice((-0.5, 0.25, 0.3, 1.7, -3.0)) for _ in range(6)]) for i in range(250)]
    rows += [(300, None), (400, [float("nan")] * 6), (500, [1.0, None]), (600, [0.5, 0.5]), (601, [0.5, 0.5]), (601, [0.5, 0.5]), (700, []), (None, [1.0] * 6)]
    frame = at_workers(spark).createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    q = {i: [math.floor(1024 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and x == x for x in v)}
    every = [(i, q[i]) for i, v in rows if i in q]
    want = []
    for a in (i for i in q if i % 100 == 0):
        found = sorted((-sum(x * y for x, y in zip(q[a], v)), b) for b, v in every if b != a)[:10]
        want += [(a, n + 1, b, -s) for n, (s, b) in enumerate(found)]
    out = bitslice.top_k(frame, "vec_id % 100 = 0", 10).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out) == sorted(want)
    assert bitslice.top_k(frame.limit(0), "vec_id % 100 = 0", 10).count() == 0


# -- fixity -------------------------------------------------------------------------------------


def test_audit_finds_exactly_the_damage(spark):
    rows = [(i, f"http://a/{i}", "x" * (i % 50)) for i in range(0, 9000, 3)] + [(None, "u", None), (3, "http://a/3", "xxx")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = fixity.records(pages)
    assert fixity.audited(whole, whole).count() == 0
    bad = [(i, u, h if i not in (300, 6000) else h + "!") for i, u, h in rows if i not in (33, 8997)] + [(1, "new", "y")]
    out = fixity.audited(whole, fixity.records(spark.createDataFrame(bad, pages.schema))).collect()
    assert {(r["file"] * fixity.FILE + r["slot"], r["status"]) for r in out} == {
        (300, "corrupt"), (6000, "corrupt"), (33, "missing"), (8997, "missing"), (1, "surplus"),
    }
    nothing = fixity.records(pages.limit(0))
    assert fixity.audited(nothing, nothing).count() == 0
    assert fixity.audited(whole, nothing).where("status = 'missing'").count() == len(rows)


def test_audit_of_many_records_of_one_id(spark):
    hot = [(7, "u", f"page {i}") for i in range(400)]
    unnamed = [(None, "u", f"text {i}") for i in range(60)]
    many = [(9, "u", "same")] * 9000
    rows = hot + unnamed + many + [(8, "u", "a"), (8, "u", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    # The first record in the order of digests is lost: the others of the id are untouched.
    digests = {h: hashlib.sha256(f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: u\r\nContent-Length: {len(h)}\r\n\r\n{h}\r\n\r\n".encode()).hexdigest() for _, _, h in rows}
    first = min((h for _, _, h in hot), key=digests.__getitem__)
    bad = [r for r in hot if r[2] != first] + unnamed[1:] + many[:-5000] + [(8, "u", "a"), (8, "u", "c"), (8, "u", "b"), (8, "u", "b")]
    out = fixity.audited(fixity.records(pages), fixity.records(spark.createDataFrame(bad, pages.schema))).collect()
    names = {d: h for h, d in digests.items()}
    found = Counter((names.get(r["expected"]), names.get(r["found"], r["found"] and "c"), r["status"]) for r in out)
    assert found == {
        (first, None, "missing"): 1, ("text 0", None, "missing"): 1, ("same", None, "missing"): 5000,
        (None, "b", "surplus"): 1, (None, "c", "surplus"): 1,
    }
    lost = sorted((r["copy"], r["offset"]) for r in out if names.get(r["expected"]) == "same")
    assert [c for c, _ in lost] == list(range(4000, 9000)) and {b[1] - a[1] for a, b in zip(lost, lost[1:])} == {len(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: u\r\nContent-Length: 4\r\n\r\nsame\r\n\r\n")}


def test_offsets_add_up(spark):
    pages = spark.createDataFrame([(i, "u", "ä" * i) for i in range(50)], "page_id long, url string, html string")
    rows = fixity.records(pages).orderBy("slot").collect()
    assert [r["offset"] for r in rows] == [sum(x["length"] for x in rows[:i]) for i in range(50)]


# -- groups of documents ------------------------------------------------------------------------


def grouped_plainly(rows: list) -> list:
    sets = []
    for _, text in rows:
        w = (text or "").split()
        w = ["".join(c.lower() if c.isascii() else c for c in x) for x in w]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[max(find(a), find(b))] = min(find(a), find(b))
    low: dict = {}
    for i, (doc, _) in enumerate(rows):
        low.setdefault(find(i), []).append(doc)
    return sorted((doc, len(sets[i]), min(low[find(i)])) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("common, packed", [(64, 400_000), (3, 400_000), (3, 50)])
def test_groups_equal_all_pairs(spark, monkeypatch, common, packed):
    monkeypatch.setattr(jaccard, "COMMON", common)
    monkeypatch.setattr(jaccard, "PACKED", packed)
    draw = random.Random(9)
    passage = [f"p{i}" for i in range(30)]
    rows: list = []
    for family in range(8):
        base = [draw.choice("abcdefgh") + str(draw.randint(0, 30)) for _ in range(60 + 10 * family)]
        for _ in range(25 if family < 2 else 6):
            words = list(base)
            for _ in range(draw.choice((0, 1, 1, 2, 3, 4))):
                words[draw.randrange(len(words))] = f"new{draw.randint(0, 999)}"
            if draw.random() < 0.4:
                words = words[:20] + passage + words[20:]
            rows.append((len(rows), " ".join(words)))
    rows += [(500 + i, " ".join(passage)) for i in range(6)]
    rows += [(600, None), (601, ""), (602, "one two"), (603, "One TWO"), (604, "one two three"), (605, " \n "), (606, "w " * 20_000), (607, "w w w w w")]
    frame = at_workers(spark).createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    out = jaccard.grouped(frame).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == grouped_plainly(rows)
    assert {r["n"] for r in out} == {1}


def test_members_far_from_each_other_form_few_pairs(spark, monkeypatch):
    """Hundreds of copies of one text, most of them too much changed to be linked with any other."""
    draw = random.Random(3)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(400):
        words = list(base)
        for _ in range(draw.choice((0, 2, 4, 5, 6))):
            words[draw.randrange(len(words))] = f"new{i}x{draw.randint(0, 9999)}"
        rows.append((i, " ".join(words[: draw.choice((150, 150, 140))])))
    formed = []
    plain = jaccard.crowded_pairs
    monkeypatch.setattr(jaccard, "crowded_pairs", lambda *a: formed.append(plain(*a)) or formed[-1])
    frame = at_workers(spark).createDataFrame(rows, "doc_id long, text string")
    out = jaccard.grouped(frame).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == grouped_plainly(rows)
    alone = sum(r["doc_id"] == r["component_id"] for r in out)
    assert alone > 100 and sum(f.count() for f in formed) < 3 * len(rows)


def test_groups_of_nothing(spark):
    frame = at_workers(spark).createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted((r[0], r[1], r[2]) for r in jaccard.grouped(frame).collect()) == [(1, 0, 1), (2, 0, 2)]
    assert jaccard.grouped(frame.limit(0)).count() == 0
