"""Operators on spans of words: runs, fill-in-the-middle, repeated passages."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stellwerk.llm import infill, periodic, queries, substrings
from stellwerk.llm.common import at_workers

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def stored_docs(spark, tmp_path, rows, ddl="doc_id long, text string"):
    at_workers(spark).createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# -- runs -------------------------------------------------------------------------------------


def all_runs(words: list) -> list[tuple[int, int, int]]:
    """Runs by comparing each distance word by word."""
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        j = 0
        while j + q < n:
            start = j
            while j + q < n and words[j] == words[j + q]:
                j += 1
            end = j + q
            if j > start and end - start >= max(12, 2 * q):
                inside = words[start:end]
                if not any(inside[r:] == inside[:-r] for r in range(1, q)):
                    out.append((start, end - start, q))
            if j == start:
                j += 1
    return sorted(out)


def some_words(draw: random.Random) -> list[int]:
    letters, out = draw.choice([1, 2, 3, 5, 50]), []
    while len(out) < draw.randint(1, 90):
        if draw.random() < 0.4:
            cycle = [draw.randrange(letters) for _ in range(draw.randint(1, 14))]
            out += (cycle * draw.randint(1, 5))[: len(cycle) * 5 - draw.randint(0, len(cycle))]
        else:
            out += [draw.randrange(letters) for _ in range(draw.randint(1, 6))]
    return out


def test_runs_equal_all_comparisons():
    draw, seen = random.Random(5), 0
    for _ in range(600):
        words = some_words(draw)
        want = all_runs(words)
        assert periodic.runs_in(words) == want
        seen += len(want)
        # The pieces hold every run.
        inside = periodic.pieces(np.array(words, np.int64), np.array([len(words)]))
        assert sorted((a + s, n, p) for a, b in inside for s, n, p in periodic.runs_in(words[a:b])) == want
    assert seen > 400


def test_pieces_do_not_cross_texts():
    words = np.array([1, 2, 3, 4, 5, 6] * 4, np.int64)
    assert periodic.pieces(words, np.array([24])) == [(0, 24)]
    assert periodic.pieces(words, np.array([6, 12, 18, 24])) == []
    assert periodic.pieces(words, np.array([0, 12, 12, 24])) == [(0, 12), (12, 24)]
    assert periodic.pieces(np.zeros(0, np.int64), np.array([0, 0])) == []


def test_automaton_has_linear_size_and_way_changes_few_segments():
    words = [1] * 5000
    link, length, prefix = periodic.automaton(words)
    assert len(link) <= 2 * len(words) and [length[s] for s in prefix] == list(range(1, 5001))
    paths = periodic.Paths([p if p > 0 and length[p] >= 6 else 0 for p in link])
    assert sum(len(paths.access(s, i)) for i, s in enumerate(prefix) if i >= 5) < 2 * len(words)
    assert periodic.runs_in(words) == [(0, 5000, 1)]


def test_with_runs_odd_rows(spark):
    long_text = " ".join(str(i) for i in range(30_000)) + " x y z" * 5000
    rows = [(1, None, 7), (2, "", 7), (3, "a b " * 6, 7), (3, "a b " * 6, 8), (None, "a " * 11, 7), (4, long_text, 7), (5, " \t\n", 7), (6, "a b " * 12, 7)]
    docs = at_workers(spark).createDataFrame(rows, "doc_id long, text string, runs int").withColumn("f", F.lit(1)).withColumn("kept", F.lit("k"))
    out = [r.asDict(True) for r in periodic.with_runs(docs).collect()]
    assert len(out) == len(rows) and all(r["f"] == 1 and r["kept"] == "k" for r in out)
    found = {(r["doc_id"], r["text"]): ([tuple(x.values()) for x in r["runs"]], r["collapsed"]) for r in out}
    assert found[1, None] == found[2, ""] == found[5, " \t\n"] == ([], "")
    assert found[3, "a b " * 6] == ([(0, 12, 2)], "a b") and sum(r["doc_id"] == 3 for r in out) == 2
    assert found[None, "a " * 11] == ([], " ".join("a" * 11))
    assert found[4, long_text] == ([(30_000, 15_000, 3)], " ".join(str(i) for i in range(30_000)) + " x y z")
    assert found[6, "a b " * 12] == ([(0, 12, 1)], "a b")
    assert periodic.with_runs(docs.limit(0)).count() == 0


def expected_periods(doc_id, text) -> dict:
    words = SPLIT.findall(text or "")
    n, h = len(words), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = all_runs([ids[w] for w in words])
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    drop = {i for s, n_, q in runs for i in range(s + q, s + n_)}
    return {
        "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": sha("".join(f"{s},{n_},{q}\n" for s, n_, q in runs)),
        "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in drop)),
    }


def test_op11_equals_brute_force(spark, tmp_path):
    draw = random.Random(8)
    rows = [(i, " \n".join(f"w{x}" for x in some_words(draw))) for i in range(400)]
    rows += [(i, " ".join(f"w{draw.randrange(400)}" for _ in range(draw.randint(0, 300)))) for i in range(400, 600)]
    rows += [(600, None), (601, ""), (602, " "), (None, "a b c d " * 9), (17, rows[17][1]), (17, "other text " * 8)]
    got = queries.op11_periodic_runs(spark, stored_docs(spark, tmp_path, rows)).collect()
    want = sorted((str(d), str(expected_periods(d, t))) for d, t in rows)
    assert sorted((str(r["doc_id"]), str({k: v for k, v in r.asDict().items() if k != "doc_id"})) for r in got) == want


# -- fill in the middle -----------------------------------------------------------------------


TEXTS = ["", "a", " ", "a b", "  a\tb\n", "äö 中文字  x y\r\n\x0b\x0c z ", "word " * 50, "\U0001f600 \U0001f601\U0001f602", "\x7f \x1f\x08\x0e x", "x" * 9 + " " * 9]


def units(text: str) -> list[str]:
    return re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)


def test_cuts_equal_a_regular_expression():
    draw = random.Random(2)
    letters = "ab \t\né中\U0001f600\x0e\x08\x1f!"
    texts = TEXTS + ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(500)]
    one, two = (np.array([draw.randrange(1 << 32) for _ in texts], np.int64) for _ in range(2))
    column = pa.array([t.encode() for t in ["sliced off", *texts]], pa.binary()).slice(1)
    found = infill.cuts(column, one, two)
    for i, t in enumerate(texts):
        own = units(t)
        a, b = sorted((int(one[i]) % (len(own) + 1), int(two[i]) % (len(own) + 1)))
        prefix, middle = "".join(own[:a]), "".join(own[a:b])
        want = (len(own), len(prefix.encode()), len((prefix + middle).encode()), len(prefix), len(middle))
        assert tuple(int(found[k][i]) for k in ("n", "first", "second", "prefix_chars", "middle_chars")) == want
    assert len(infill.cuts(pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, np.int64))["n"]) == 0


@pytest.mark.parametrize("word", [0x2009090A0B0C0D0E, 0xFFA089A08D8E8A20, 0x0000000000000000, 0x08200E1F20210D09])
def test_white_space_of_a_word(word):
    got = int(infill.white(np.array([word], np.uint64))[0])
    want = sum(0x80 << (8 * i) for i in range(8) if (word >> (8 * i)) & 255 in (0x20, *range(9, 14)))
    assert got == want


def test_transformed_odd_rows(spark):
    rows = [(i, t, 3) for i, t in enumerate(TEXTS * 12)] + [(None, None, 3), (500, None, 3), (501, "a <P> b", 3), (7, "x <S>", 3), (7, "x <S>", 3)]
    rows += [(502, "ä " * 200_000, 3)]
    docs = at_workers(spark).createDataFrame(rows, "doc_id long, text string, n int").withColumn("c", F.lit(9)).withColumn("kept", F.lit("k"))
    made = infill.transformed(docs, rate=100, spm=50)
    out = made.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(rows) and {r["form"] for r in out} == {"plain", "psm", "spm"}
    for r in out:
        text = r["text"] or ""
        assert r["back"] == text and r["c"] == 9 and r["kept"] == "k" and r["n"] == len(units(text))
        plain = text == "" or any(m in text for m in ("<P>", "<S>", "<M>"))
        assert (r["form"] == "plain") == plain == (r["prefix_chars"] is None)
        if not plain:
            # What stands between the cuts is units in full, in their place.
            middle = text[r["prefix_chars"] : r["prefix_chars"] + r["middle_chars"]]
            assert r["output"].endswith("<M>" + middle) and len(units(text[: r["prefix_chars"]])) <= r["n"]
    assert infill.transformed(docs.limit(0)).count() == 0


# -- repeated passages ------------------------------------------------------------------------


def left_over(rows: list[tuple], width: int) -> list[tuple]:
    """(doc_id, n_words, words kept) by looking every window up."""
    first: dict[tuple, int] = {}
    split = [(d, SPLIT.findall(t or "")) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - width + 1):
            if d is not None:
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in split:
        gone = {i + k for i in range(len(w) - width + 1) if d is not None and first[tuple(w[i : i + width])] < d for k in range(width)}
        out.append((d, len(w), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def passages(draw: random.Random, many: int) -> list[tuple]:
    shared = [" ".join(f"s{draw.randrange(30)}" for _ in range(draw.randint(10, 40))) for _ in range(12)]
    rows = []
    for i in range(many):
        parts = [" ".join(f"w{draw.randrange(2000)}" for _ in range(draw.randint(0, 20)))]
        parts += [draw.choice(shared) for _ in range(draw.randint(0, 3))]
        draw.shuffle(parts)
        rows.append((draw.choice([i, i, i, i // 3, -i]), " ".join(parts)))
    return rows


@pytest.mark.parametrize("group", [3_000_000, 40])
def test_left_over_words_equal_a_look_up(spark, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP", group)
    monkeypatch.setattr(substrings, "SMALL", min(group, substrings.SMALL))
    rows = passages(random.Random(4), 500)
    rows += [(900, None), (901, ""), (902, "too short"), (None, rows[3][1]), (None, None), rows[5], rows[5], (-1000, rows[6][1])]
    # One passage in a third of all rows.
    hot = " ".join(f"h{i}" for i in range(60))
    rows += [(2000 + i % 150, f"a{i} {hot} b{i}") for i in range(300)]
    docs = at_workers(spark).createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit(5)).withColumn("starts", F.lit(6))
    out = substrings.without_repeats(docs.withColumn("spans", F.lit("x")), 13).collect()
    assert all(r["mark"] == 5 and r["starts"] == 6 for r in out)
    assert sorted(((r["doc_id"], r["n_words"], r["text"]) for r in out), key=str) == left_over(rows, 13)
    assert all(r["n_removed"] == sum(s["words"] for s in r["spans"]) for r in out)
    assert all(r["n_words"] - r["n_removed"] == len(r["text"].split()) for r in out)


def test_partition_covers_every_prefix():
    counts = np.random.default_rng(1).poisson(3, substrings.CODES).astype(np.int64)
    counts[[0, 77, substrings.CODES - 1]] = [5_000_000, 200_001, 90_000]
    first, parts = substrings.partition(counts, 100_000)
    assert parts[0] == 50 and parts[77] == 3 and parts[-1] == 1
    sizes = np.zeros(int((first + parts).max()), np.int64)
    light = parts == 1
    np.add.at(sizes, first[light], counts[light])
    assert sizes.max() <= 200_000
    # The parts of frequent prefixes are groups of their own.
    own = [set(range(first[c], first[c] + parts[c])) for c in (0, 77)]
    assert not own[0] & own[1] and not (own[0] | own[1]) & set(first[light].tolist())
    assert substrings.partition(np.zeros(substrings.CODES, np.int64), 100)[0].max() == 0


def test_a_frequent_node_is_reduced_while_it_comes_in():
    tree = substrings.Subtree()
    for doc in range(50, 0, -1):
        tree.parts.append((np.zeros(40, np.uint32), np.full(40, 7, np.uint64), np.full(40, doc), np.zeros(40, np.int64), np.arange(40, dtype=np.int32)))
        tree.size += 40
    found = tree.repeats()
    assert len(found[0]) == 49 * 40 and found[0].min() == 2 and tree.size == 40


def test_without_repeats_of_empty_tables(spark):
    docs = at_workers(spark).createDataFrame([(1, "a b")], "doc_id long, text string")
    assert substrings.without_repeats(docs.limit(0)).count() == 0
    assert substrings.without_repeats(docs.where("doc_id > 1")).columns == ["doc_id", "text", "n_words", "n_removed", "spans"]
    nulls = at_workers(spark).createDataFrame([(None, None), (None, "x " * 20)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in substrings.without_repeats(nulls).collect()) == [0, 0]


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_substring_dedup"])
def test_query_equals_sql_on_odd_rows(spark, tmp_path, name):
    import duckdb

    rows = passages(random.Random(9), 200)
    rows = list({d: (d, t) for d, t in rows}.values())
    rows += [(9000 + i, t) for i, t in enumerate(TEXTS)] + [(9100, None), (9101, "a <M> b"), (None, "a b c " * 9), (None, None)]
    folder = stored_docs(spark, tmp_path, rows)
    out = queries.QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(str, (tuple(r) for r in out.select(*columns).collect()))) == sorted(map(str, want.fetchall()))
