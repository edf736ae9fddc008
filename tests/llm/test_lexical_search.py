"""Ranked search against scoring every document, and the bounds on their own."""

import math
import random
import re

import numpy as np
import pytest
from conftest_llm import key, near_copies
from velomart.llm import lexical_search as L


def terms(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) of rows (id, text)."""
    docs = [(d, terms(t)) for d, t in docs]
    docs = [(d, t) for d, t in docs if t]
    total, length = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, t in docs:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for d, t in docs:
            m = 25 + 75 * len(t) * total // length
            score = 0
            for x in terms(text):
                if tf := t.count(x):
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[x] + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score:
                scores.append((-score, key(d), d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda s: s[:2])[:k])]
    return out


def items_of(texts):
    rnd = random.Random(5)
    out = []
    for i in range(12):
        words = (rnd.choice([t for t in texts if t]) or "").split()
        at = rnd.randrange(max(1, len(words) - 8))
        out.append((f"q{i % 10}", " ".join(words[at : at + rnd.randint(1, 12)])))
    return [*out, (None, "one Two one"), ("q1", None), ("none", "?!"), ("far", "zzzqqq nowhere"), ("many", "a " * 50 + "x b")]


@pytest.fixture(scope="module")
def asked(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = items_of([t for _, t in rows])
    return rows, items, spark.createDataFrame([(*i, 1, "x") for i in items], "item_id string, text string, terms int, item string")


def shown(rows):
    return sorted(((key(a), b, key(c), d) for a, b, c, d in rows), key=repr)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_odd_rows(odd_docs, asked, k):
    rows, items, df = asked
    got = [tuple(r) for r in L.search(odd_docs, df, k).select("item_id", "rank", "doc_id", "score").collect()]
    assert shown(got) == shown(brute(rows, items, k))


def test_small_blocks_and_buckets(odd_docs, asked, monkeypatch):
    rows, items, df = asked
    monkeypatch.setattr(L, "BLOCK_TERMS", 20)
    monkeypatch.setattr(L, "BUCKET_LOG2", 3)
    got = [tuple(r) for r in L.search(odd_docs, df, 3).select("item_id", "rank", "doc_id", "score").collect()]
    assert shown(got) == shown(brute(rows, items, 3))


def test_ties_go_to_the_least_id(spark, make_docs):
    docs = make_docs(["same words here"] * 40 + ["other words"] * 5, nulls=True)
    items = spark.createDataFrame([("i", "same")], "item_id string, text string")
    got = [(r.rank, r.doc_id) for r in L.search(docs, items, 7).orderBy("rank").collect()]
    assert got == [(i + 1, i) for i in range(7)]


def test_empty_tables(spark, no_docs, odd_docs):
    items = spark.createDataFrame([("i", "one text")], "item_id string, text string")
    assert L.search(no_docs, items).count() == 0
    assert L.search(odd_docs, items.where("false")).count() == 0


def test_coordinate_range_holds_all_near_vectors():
    rnd = np.random.default_rng(1)
    for _ in range(2000):
        p, q = np.abs(rnd.normal(size=(2, 4)) ** 3)
        p, q = p / np.linalg.norm(p), q / np.linalg.norm(q)
        for cosine in (0.2, 0.7, float(p @ q)):
            if p @ q >= cosine:
                for a, b in zip(p, q, strict=True):
                    low, high = L.coordinate_range(b, cosine)
                    assert low <= a <= high


def test_buckets_lose_no_row():
    rnd = np.random.default_rng(2)
    passed = 0
    for _ in range(200):
        sizes = rnd.integers(1, 9, 30)
        lists = [rnd.choice(40, s, replace=False) for s in sizes]
        impacts = rnd.integers(1, 900_000, sizes.sum())
        weights = rnd.integers(0, 9000, 40)
        root = np.sqrt(weights.astype(float))
        flat, rows = np.concatenate(lists), np.repeat(np.arange(30), sizes)
        norms = np.sqrt(np.bincount(rows, weights[flat] * impacts.astype(float) ** 2, 30)) + 1e-9
        bucket = L.Bucket(flat, impacts, sizes, norms, root)
        at = rnd.choice(40, 6, replace=False)
        times = rnd.integers(1, 3, 6)
        order = np.argsort(-times * root[at])
        at, times = at[order], times[order]
        vector = times * root[at]
        item = L.Item(0, at, times * weights[at], vector, float(np.sqrt((vector**2).sum())), 0)
        scores = bucket.scores(item)
        assert scores.tolist() == [sum(int(t * weights[a] * i) for t, a in zip(times, at, strict=True) for b, i in zip(flat[rows == r], impacts[rows == r], strict=True) if a == b) for r in range(30)]
        for least in np.sort(scores)[-4:].tolist():
            if least:
                item.least = least
                left = bucket.survivors(item)
                passed += 30 - len(left)
                assert set(np.flatnonzero(scores >= least)) <= set(left.tolist())
    assert passed > 200 * 30  # the bounds do pass over rows


def test_near_copies_rank_first(spark, make_docs):
    texts = near_copies(9, 50)
    docs = make_docs(texts, nulls=False)
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts[:10])], "item_id string, text string")
    got = [tuple(r) for r in L.search(docs, items, 10).select("item_id", "rank", "doc_id", "score").collect()]
    assert shown(got) == shown(brute(list(enumerate(texts)), [(str(i), t) for i, t in enumerate(texts[:10])], 10))
