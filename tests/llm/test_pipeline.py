"""The pipeline's stages on odd rows, and its result against the stages one by one."""

from collections import Counter

import corpus_pipeline as P
import pytest
from conftest_llm import key
from pyspark.sql import functions as F
from test_jaccard_join import brute as near_duplicates
from velomart.llm.common import materialize

SF = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in P.STAGES] == ["known_language", "one_of_near_copies", "clean_of_benchmarks", "mixed", "sharded"]


def test_odd_rows(spark, odd_docs):
    docs = odd_docs
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    docs = materialize(P.known_language(spark, docs, SF), "t")
    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert docs.columns == odd_docs.columns
    assert Counter(map(tuple, docs.select("doc_id", "text").collect())) == Counter(kept)
    docs = materialize(P.one_of_near_copies(spark, docs, SF), "t")
    assert docs.columns == odd_docs.columns
    groups = {g for _, _, g in near_duplicates(kept, 5, 80) if g[0]}
    assert sorted(key(r.doc_id) for r in docs.collect() if r.doc_id is not None) == sorted(groups)
    for stage in (P.clean_of_benchmarks, P.mixed):
        docs = materialize(stage(spark, docs, SF), "t")
        assert docs.columns == odd_docs.columns and docs.count()
    assert P.sharded(spark, docs, SF).count() == docs.count()


def test_unlabelled_documents_pass_the_first_stage(spark, odd_docs):
    docs = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    kept = P.known_language(spark, docs, SF)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in r.text or "") for r in docs.collect())


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES])
def test_empty_table(spark, no_docs, stage):
    assert stage(spark, no_docs, SF).count() == 0


def test_run(spark):
    got = P.run(spark, SF).collect()
    counts = Counter(r.shard for r in got)
    assert len(counts) == 24 and max(counts.values()) - min(counts.values()) <= 1
    assert sorted(map(str, P.run(spark, SF).collect())) == sorted(map(str, got))
