"""Suffix arrays against sorting, and removal against a look at every string."""

import hashlib
import random

import numpy as np
import pytest
from conftest_llm import key
from hypothesis import given, settings
from hypothesis import strategies as st
from velomart.llm import suffix_array as S
from velomart.llm import suffix_dedup as D


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.integers(1, 5), st.booleans())
def test_suffix_array(symbols, times, small):
    before, S.SMALL_ALPHABET = S.SMALL_ALPHABET, 1024 if small else 0
    try:
        text = np.array(symbols * times + [0])
        order = S.suffix_array(text)
    finally:
        S.SMALL_ALPHABET = before
    plain = text.tolist()
    assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
    lcp = S.permuted_lcp(text.astype(np.uint16), order)
    for a, b in zip(order[:-1], order[1:], strict=True):
        size = 0
        while max(a, b) + size < len(plain) and plain[a + size] == plain[b + size]:
            size += 1
        assert lcp[b] == size


def brute(rows, length):
    """Rows (doc_id, text) as a dict from row to its result; equal rows are one."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, __import__("zlib").crc32((r[1] or "").encode())))
    seen, out = set(), {}
    for row in order:
        data = (row[1] or "").encode()
        gone, end = bytearray(len(data)), 0
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[max(i, end) : i + length] = b"\1" * (i + length - max(i, end))
                end = i + length
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[row] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize(("length", "shard", "group"), [(100, 2 << 20, 8 << 20), (20, 500, 8 << 20), (20, 500, 100), (7, 3000, 400)])
def test_removal(make_docs, odd_docs, length, shard, group):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    want = brute(rows, length)
    got = D.remove_repeats(odd_docs, length=length, shard_bytes=shard, group_bytes=group, with_text=True).collect()
    found = sorted((key(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got)
    assert found == sorted((key(r[0]), *want[r]) for r in rows)
    assert any(f[2] for f in found)


def test_copies_within_and_across_tasks(spark):
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdefgh") for _ in range(500))
    data = [(9, text), (3, text), (5, text), (3, text), (4, text[100:350]), (6, "z" + text), (7, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.n_removed, r.n_spans) for r in D.remove_repeats(docs).collect())
    assert got == [(3, 0, 0), (3, 0, 0), (4, 250, 1), (5, 500, 1), (6, 500, 1), (7, 0, 0), (9, 500, 1)]


def test_empty_table(no_docs):
    assert D.remove_repeats(no_docs).count() == 0


def test_texts_of_no_id_and_equal_checksum_are_two_documents(spark):
    shared = "".join(f"{k} of the words; " for k in range(40))
    texts = ["plumless" + shared, "buckeroo" + shared]  # a known pair of equal CRC-32
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    got = sorted(r.n_removed for r in D.remove_repeats(docs).collect())
    assert got == [0, len(shared)]
