"""Chunks of few words."""

import numpy as np
import pytest
from velomart.llm import words as W
from velomart.llm.decontamination import contamination
from velomart.llm.jaccard_join import JaccardJoin

LONG = " ".join(f"w{i}".ljust(200, "x") for i in range(11_000))  # 2 MB


@pytest.mark.parametrize("n", range(9))
@pytest.mark.parametrize("width", range(1, 15))
def test_short_arrays(n, width):
    values = np.arange(n, dtype=np.uint64)[::-1].copy()
    assert W.gram_hashes(values, width).shape == (n,)
    assert W.sliding_min(values, width).tolist() == [min(values[i : i + width]) for i in range(n)]
    assert W.sliding_max_back(values, width).tolist() == [max(values[max(0, i - width + 1) : i + 1]) for i in range(n)]


@pytest.mark.parametrize("texts", [["two words"], ["two words", LONG]])
def test_a_short_text_alone_in_its_chunk(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "two words"), (2, " ".join(LONG.split()[50:70]))], "item_id long, text string")
    hits = [r.n_hit for r in contamination(docs, items).orderBy("doc_id").collect()]
    assert hits == [2, 20][: len(texts)]
    got = [r.n_shingles for r in JaccardJoin(docs, n=4, percent=85).components().orderBy("doc_id").collect()]
    assert got == [1, 10_997][: len(texts)]
