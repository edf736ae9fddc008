"""Prefix counts against the tokenizer's library."""

import pytest
from conftest_llm import key
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from velomart.llm import token_counts as T  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=60) | st.text("aAbe'sStr lL.,!1Ä\n\x1f<|endoftext|>Σς", max_size=60))
def test_counts_are_the_librarys(text):
    assert T.counter(PATH).count(text) == library(text)


@settings(max_examples=60, deadline=None)
@given(st.text("abcdehilnorstu ,.'1é", max_size=40))
def test_every_prefix(text):
    tokens = T.counter(PATH)
    text = tokens.normalize(text)
    assert tokens.every_prefix(text) == [library(text[:i]) for i in range(len(text) + 1)]


def test_bounded_caches_do_not_change_counts():
    tokens = T.PrefixCounter(PATH)
    tokens.words.most = tokens.counts.most = tokens.seams.most = 3
    text = "Tokenization of several different words, again several words."
    assert tokens.count(text) == tokens.count(text) == library(text)


def test_rows(spark, odd_docs, no_docs):
    got = T.token_counts(odd_docs, PATH, budget=10).collect()
    want = [(key(r.doc_id), len((r.text or "").encode()), library(r.text), library(r.text) > 10) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted((key(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(want)
    assert T.token_counts(no_docs, PATH).count() == 0


def test_stored_counts_answer_budgets(spark):
    text = "The quick brown fox, it jumps over unbelievably lazy dogs"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    counted = T.token_counts(docs, PATH, tables=True)
    rows = {r.doc_id: r for r in T.longest_within(T.tokens_within(counted, 20), 6).collect()}
    assert rows[1].tokens_within == library(text.lower()[:20].rsplit(",", 0)[0])
    assert library(text[: rows[1].characters_within]) <= 6 < library(text[: rows[1].characters_within] + " jumps over unbelievably")
    assert rows[2].tokens_within == rows[2].characters_within == 0
