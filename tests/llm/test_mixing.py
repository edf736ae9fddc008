"""Targets, schedule and shares against plain computations."""

import hashlib
import re
from collections import defaultdict

import pytest
from conftest_llm import key
from pyspark.sql import functions as F
from velomart.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Reshares the excess again and again until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, out, open_ = float(sum(sizes.values())), {}, set(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * unit > 3 * sizes[s]}
        if not above:
            out.update({s: weight[s] * unit for s in open_})
            break
        for s in above:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= above
    return out


def digest(doc, text):
    return hashlib.md5(f"{'' if doc is None else doc}:{text or ''}".encode()).hexdigest()


def taken(rows):
    """The shares of all rows (doc, source, size, text) of a mix: each source's line of
    documents up to its target, rounded."""
    sizes = defaultdict(int)
    for _, source, size, _ in rows:
        sizes[source] += size
    want = targets(sizes)
    out = []
    for s in sizes:
        line = sorted((r for r in rows if r[1] == s), key=lambda r: (digest(r[0], r[3]), key(r[0]), r[2]))
        quota, at = (max(1, int(want[s] + 0.5)) if want[s] else 0), 0
        for doc, _, size, _ in line:
            n = sum(max(0, min(at + lap * sizes[s] + size, quota) - (at + lap * sizes[s])) for lap in range(3)) if size else 0
            out.append((key(doc), size, sizes[s], n))
            at += size
    return sorted(out), want


@pytest.mark.parametrize("block", [1, 7, M.BLOCK_WORDS])
def test_shares_are_those_of_the_targets(odd_docs, block):
    rows = [(r.doc_id, r.source, len(WORD.findall(r.text or "")), r.text) for r in odd_docs.select("doc_id", "source", "text").collect()]
    got = M.mix_sources(odd_docs, block=block).collect()
    want, goals = taken(rows)
    assert sorted((key(r.doc_id), r["size"], r.source_size, r.taken) for r in got) == want
    assert all(r.target == pytest.approx(goals[r.source]) for r in got)
    assert all(r.taken <= 3 * r["size"] and (r.slot is None) == (r.taken == 0) for r in got)
    assert sorted(map(str, M.mix_sources(odd_docs.repartition(7), block=block).collect())) == sorted(map(str, got))


def test_small_sources_of_a_large_corpus_take_their_targets(spark):
    """More than 268M words, and sources of a thousand words or of one: no text is needed."""
    sizes = [("a", 20_000) for _ in range(20_000)] + [("b", 500)] * 2 + [("c", 1), (None, 700), (None, 3)]
    rows = [(i, s, n, hashlib.md5(str(i).encode()).hexdigest()) for i, (s, n) in enumerate(sizes)]
    found = M.mix_sized(spark.createDataFrame(rows, "doc_id long, source string, size long, key string"), [])
    got = {r.source: r for r in found.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size")).collect()}
    want = targets({"a": 400_000_000, "b": 1000, "c": 1, None: 703})
    for source, r in got.items():
        assert r.target == pytest.approx(want[source]) and abs(r.taken - want[source]) <= 1
    assert got["b"].taken == 3000 and got["c"].taken == 3


def test_each_block_has_one_slot(spark):
    docs = spark.createDataFrame([(i, "w " * (100 if i % 4 else 1), f"s{i % 4}") for i in range(203)], "doc_id long, text string, source string")
    sized = docs.select("doc_id", "source", M.word_count(F.col("text")).alias("size"))
    targets_ = M.source_targets(sized).withColumn("quota", F.round("target").cast("long"))
    total = targets_.first().total
    quotas = {r.source: r.quota for r in targets_.collect()}
    slots = M.full_schedule(targets_, total, 10).collect()
    assert len({r.slot for r in slots}) == len(slots)
    for source, quota in quotas.items():
        mine = sorted((r.slot, r.block_no) for r in slots if r.source == source)
        assert [b for _, b in mine] == list(range(-(-quota // 10)))


def test_targets_stop_at_three_times_the_size(spark):
    docs = spark.createDataFrame(
        [(1, "w " * 10, "a"), (2, "w " * 2000, "b"), (3, "w " * 20, "c"), (4, None, "d"), (5, "w " * 500, None), (6, " ", "e")], "doc_id long, text string, source string"
    )
    got = {r.doc_id: r for r in M.mix_sources(docs).collect()}
    want = targets({"a": 10, "b": 2000, "c": 20, "d": 0, None: 500, "e": 0})
    for doc, source in ((1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None), (6, "e")):
        assert got[doc].target == pytest.approx(want[source])
        assert got[doc].taken == pytest.approx(want[source], abs=4)
    assert got[1].taken == 30 and got[4].taken == 0


def test_empty_table_and_schedule(spark, no_docs):
    assert M.mix_sources(no_docs).count() == 0
    docs = spark.createDataFrame([(i, "w " * 100, f"s{i % 4}") for i in range(200)], "doc_id long, text string, source string")
    sized = docs.select("doc_id", "source", M.word_count(F.col("text")).alias("size"))
    slots = M.slot_schedule(M.source_targets(sized), 20000, 10).collect()
    assert sorted(r.slot for r in slots) == list(range(2000))
    by_source = defaultdict(list)
    for r in sorted(slots, key=lambda r: r.slot):
        by_source[r.source].append((r.slot, r.block_no))
    for source, taken_ in by_source.items():
        assert [b for _, b in taken_] == list(range(len(taken_)))
        share = len(taken_) / 2000
        # Every stretch of the mix holds the source's share, up to a few slots.
        assert all(abs(i - share * slot) < 6 for i, (slot, _) in enumerate(taken_)), source
