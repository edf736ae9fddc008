"""The join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import key, near_copies
from velomart.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((key(doc), len(sets[i]), key(least.get(find(i)))) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 50), (2, 100)])
def test_components_are_those_of_all_pairs(make_docs, n, percent):
    docs = make_docs(near_copies(n, 120), repeat=9)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = J.JaccardJoin(docs, n, percent).components().collect()
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == brute(rows, n, percent)


def test_odd_rows_frequent_grams_and_empty_table(monkeypatch, odd_docs, no_docs):
    monkeypatch.setattr(J, "BLOCK_TIMES", 2)
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = J.JaccardJoin(odd_docs, 4, 85).components().collect()
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == brute(rows, 4, 85)
    assert J.JaccardJoin(no_docs).components().count() == 0


def test_frequent_grams_come_last(spark, monkeypatch):
    """A passage in every text must not put all texts together as candidates."""
    monkeypatch.setattr(J, "BLOCK_TIMES", 5)
    rnd = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(20))
    data = [(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(60)) + " " + passage) for i in range(80)]
    join = J.JaccardJoin(spark.createDataFrame(data, "doc_id long, text string"), 4, 85)
    assert len(join.frequent.value[0]) == 17
    assert join._shared().count() == 0


def test_near_copies_are_not_spelled_out(spark):
    """The second round has no pairs within a component of the first."""
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    data = []
    for i in range(150):
        text = list(base)
        text[rnd.randrange(200)] = f"x{i}"
        data.append((i, " ".join(text)))
    join = J.JaccardJoin(spark.createDataFrame(data, "doc_id long, text string"), 4, 85)
    assert join.links().count() < 3 * 150
    assert {r.component_id for r in join.components().collect()} == {0}


@pytest.mark.parametrize(("tile", "rounds"), [(8, 0), (2048, 2)])
def test_components_from_small_tiles(monkeypatch, make_docs, tile, rounds):
    monkeypatch.setattr(J, "COLD", 2)
    monkeypatch.setattr(J, "TILE", tile)
    monkeypatch.setattr(J, "BEST_ROUNDS", rounds)
    docs = make_docs(near_copies(7, 70), repeat=9)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = J.JaccardJoin(docs, 4, 70).components().collect()
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == brute(rows, 4, 70)


def test_many_near_copies_in_several_components(spark, monkeypatch):
    """1,200 near copies of 40 texts that share a passage: as many candidate pairs as
    documents, not their square, and no link lost."""
    rnd = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    data = []
    for i in range(1200):
        own = [f"t{i % 40}w{j}" for j in range(60)]
        for _ in range(rnd.randint(0, 3)):
            own[rnd.randrange(60)] = f"x{rnd.randrange(10**9)}"
        data.append((i, " ".join(own + passage)))
    counts = []
    linked = J.JaccardJoin._linked
    monkeypatch.setattr(J.JaccardJoin, "_linked", lambda self, pairs, name: counts.append(pairs.count()) or linked(self, pairs, name))
    monkeypatch.setattr(J, "BLOCK_TIMES", 10**9)  # no gram is recognised as frequent
    got = J.JaccardJoin(spark.createDataFrame(data, "doc_id long, text string"), 4, 80).components().collect()
    assert sum(counts) < 10 * 1200
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == brute(data, 4, 80)


def test_done_tiles_are_looked_at_once(spark, monkeypatch):
    """Texts that share a passage and hardly link: the grams that many of them hold go to
    the tiles one time."""
    rnd = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(40))
    data = [(i, passage + " " + " ".join(f"w{rnd.randrange(10**9)}" for _ in range(30))) for i in range(30)]
    data += [(i + 40, data[i][1] + f" x{i}") for i in range(3)]
    looks = []
    hot = J.JaccardJoin._hot_pairs
    monkeypatch.setattr(J.JaccardJoin, "_hot_pairs", lambda self, rows, best: looks.append(best) or hot(self, rows, best))
    monkeypatch.setattr(J, "BLOCK_TIMES", 10**9)  # no gram is recognised as frequent
    monkeypatch.setattr(J, "COLD", 4)
    got = J.JaccardJoin(spark.createDataFrame(data, "doc_id long, text string"), 4, 85).components().collect()
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == brute(data, 4, 85)
    assert looks == [True]


@pytest.mark.parametrize("tile", [7, 16, 2048])
def test_all_pairs_of_a_gram_meet_and_no_document_is_twice_in_a_tile(spark, monkeypatch, tile):
    def met(percent, best):
        def run(key, rows):
            rows = rows.select(["node", "root", "visits", "home"]).to_pylist()
            assert len({r["node"] for r in rows}) == len(rows)
            pairs = [sorted((x["node"], y["node"])) for x in rows for y in rows if x["visits"] and y["home"] and x["root"] != y["root"]]
            return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64()), "gram": pa.nulls(len(pairs), pa.int64())})

        return run

    monkeypatch.setattr(J, "_tile", met)
    monkeypatch.setattr(J, "TILE", tile)
    join = J.JaccardJoin(spark.createDataFrame([(i, f"t{i} u{i}") for i in range(40)], "doc_id long, text string"), 4, 85)
    nodes = sorted(r.node for r in join.nodes.collect())
    major, rest = nodes[:15], nodes[15:]
    rows = [(1, x, 1, 0, major[0] if x in major else x, 40, major[0], 25) for x in nodes]
    found = join._hot_pairs(spark.createDataFrame(rows, "gram long, node long, n int, pos int, root long, held long, major long, minor long"), best=False).collect()
    assert sorted((r.a, r.b) for r in found) == [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if a in rest or b in rest]


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (1, 5, 60, 700, 9000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        for change in (0, n // 10, n // 3):
            b = np.unique(np.concatenate([a[change:], rng.integers(0, 1 << 63, change + n // 7, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
            apart = len(np.setxor1d(a, b))
            assert J.least_difference(J.parts_of(a), J.parts_of(b)) <= apart
            assert n < 60 or n > 5000 or J.least_difference(J.parts_of(a), J.parts_of(b)) >= 0.6 * apart


def test_prefixes_are_long_enough():
    for percent in (50, 80, 85, 99, 100):
        for n in range(1, 200):
            assert J.probe_prefix(n, percent) == n - -(-percent * n // 100) + 1
            need = -(-2 * percent * n // (100 + percent))
            assert J.index_prefix(n, percent) == n - need + 1
    assert (np.diff(J.stratum(np.arange(1, 1000), 85)) >= 0).all()
