"""Groups of equal texts against a plain grouping, with runs over batches and ranges."""

import hashlib
import re

import pytest
from conftest_llm import key, near_copies
from velomart.llm import exact_dedup as D


def brute(rows):
    """Of rows (doc_id, text): a list of (doc_id, keep_id, group_size, kept, sha)."""
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), key(doc), doc))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:2])
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(doc, members[0][2], len(members), i == 0, sha) for i, (_, _, doc) in enumerate(members)]
    return out


def shown(rows):
    return sorted(((*map(key, r[:2]), *r[2:]) for r in rows), key=repr)


def plain(df):
    return [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()]


def test_odd_rows(odd_docs):
    got = plain(D.equal_texts(odd_docs))
    assert shown(got) == shown(brute([(r.doc_id, r.text) for r in odd_docs.collect()]))


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_hot_groups_over_batches_and_ranges(spark, make_docs, batch):
    hot = ["a  text\tthat many hold"] * 150 + ["a text that many hold"] * 30 + [None, "", " \n"] * 20 + near_copies(3, 60)
    docs = make_docs(hot, repeat=20)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = plain(D.equal_texts(docs))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert shown(got) == shown(brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_texts_of_one_digest_are_told_apart(spark, make_docs, monkeypatch):
    monkeypatch.setattr(D, "DIGEST_BYTES", 0)
    head = "the same sixteen bytes and then "
    docs = make_docs([head + str(i % 5) + "x" * (i % 3) for i in range(90)])
    got = plain(D.equal_texts(docs))
    assert shown(got) == shown(brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_hot_group_is_cut_into_ranges(spark, make_docs):
    docs = make_docs(["one text"] * 400 + [f"text {i}" for i in range(200)])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        found = D.equal_texts(docs).where("group_size = 400")
        assert found.count() == 400 and found.where("kept").count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_rows_that_stay(odd_docs):
    kept = D.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted({re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in odd_docs.collect()})


def test_empty_table(no_docs):
    assert D.equal_texts(no_docs).count() == 0
