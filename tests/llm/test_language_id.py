"""Cross-parsing against a search in the training text, and held-out accuracy."""

import math
import pickle
import random

import numpy as np
from conftest_llm import key
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from velomart.llm import language_id as L


def phrases(text, training):
    """Longest matches from left to right; a symbol that the training text lacks is one."""
    count = at = 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in training:
            size += 1
        at += max(1, size - 1)
        count += 1
    return count


def plain(text):
    out = []
    for c in text.lower():
        c = c if c.isalpha() else " "
        if c != " " or not out or out[-1] != " ":
            out.append(c)
    return "".join(out)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcÄß ,1xyz", max_size=50), min_size=1, max_size=6), st.integers(2, 9))
def test_phrases_of_segments(texts, segment):
    samples = {"a": ["abab ab, cab ba"], "b": ["äß xyz bca"]}
    model = L.Model(samples)
    before, L.SEGMENT = L.SEGMENT, segment
    try:
        codes = [L.codes_of(t + " ") for t in texts]
        bits, has = model.entropy(np.concatenate(codes), np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int64))
    finally:
        L.SEGMENT = before
    for i, text in enumerate(texts):
        symbols = plain(text + " ")
        assert has[i] == any(c.isalpha() for c in text)
        for lang, name in enumerate(model.langs):
            training = plain(samples[name][0])
            count = sum(phrases(symbols[a : a + segment], training) for a in range(0, len(symbols), segment))
            assert math.isclose(bits[lang, i], count * math.log2(len(training)) / len(symbols))


def test_automaton_knows_all_substrings():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 3, 60)
    states, edges = L.automaton(text)
    assert states <= 2 * len(text) and len(edges) <= 3 * len(text)
    table = L.Transitions(edges[:, 0] * 3 + edges[:, 1], edges[:, 2])
    known = {tuple(text[a:b]) for a in range(60) for b in range(a + 1, 61)}
    for _ in range(500):
        word = tuple(rng.integers(0, 3, rng.integers(1, 9)))
        state = 0
        for c in word:
            state = int(table.get(np.array([state * 3 + c]))[0]) if state >= 0 else -1
        assert (state >= 0) == (word in known)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10**6), unique=True, max_size=300))
def test_transitions(keys):
    keys = np.array(keys, np.int64)
    table = L.Transitions(keys, np.arange(len(keys)))
    assert table.get(keys).tolist() == list(range(len(keys)))
    others = np.setdiff1d(np.arange(0, 2000), keys)
    assert (table.get(others.reshape(-1, 1)) == -1).all()


def test_large_alphabets_stay_small():
    rnd = random.Random(3)
    alphabet = [chr(0x4E00 + i) for i in range(20000)]
    samples = {f"l{k}": ["".join(rnd.choice(alphabet[2000 * k % 17000 :][:3000]) for _ in range(L.SAMPLE_CHARS))] for k in range(10)}
    model = L.Model(samples)
    assert len(model.langs) == 10 and len(pickle.dumps(model)) < 100 << 20
    for k in (0, 4, 9):
        assert model.predict([samples[f"l{k}"][0][5000:5040]])[0] == [f"l{k}"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60_000), min_size=1, max_size=200))
def test_fair_share(sizes):
    share = L.fair_share(sizes)
    used = sum(min(s, share) + 1 for s in sizes)
    assert used <= L.SAMPLE_CHARS + len(sizes) or max(sizes) <= share
    assert used <= L.SAMPLE_CHARS or share == max(sizes) or share == 0
    # What is left could not lengthen every cut text by one more character.
    cut = sum(s > share for s in sizes)
    assert not cut or L.SAMPLE_CHARS - used < 2 * len(sizes)


def test_few_long_texts_are_sampled_whole_up_to_the_bound(spark):
    rnd = random.Random(5)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    data = [(i, text(50_000), "few") for i in range(5)] + [(100 + i, text(100), "short") for i in range(20)]
    model = L.train(spark.createDataFrame(data, "doc_id long, text string, lang string"), F.lit(True))
    sizes = dict(zip(model.langs, model.sizes, strict=True))
    assert sizes["few"] > 0.9 * L.SAMPLE_CHARS * 8 / 9 and 1500 < sizes["short"] <= 2020


def test_repeated_ids_and_many_labels_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_LANGS", 3)
    seen = []
    monkeypatch.setattr(L, "Model", lambda samples: seen.append(samples))
    rows = [(7, f"text {i} of one id", "en") for i in range(400)] + [(i, f"some text {i}", f"x{i}") for i in range(50)] + [(1000 + i, "ein text", "de") for i in range(3)] + [(2000 + i, "un texte", "fr") for i in range(2)]
    L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert set(seen[0]) == {"en", "de", "fr"} and seen[0]["en"] == ["text 0 of one id"]


def test_held_out_accuracy_and_odd_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    apart = L.held_out("doc_id")
    model = L.train(docs, ~apart)
    got = L.identify(docs, model, extra={"held_out": apart, "lang": F.col("lang")}).collect()
    judged = [r for r in got if r.held_out and r.lang]
    assert len(judged) > 150 and sum(r.lang == r.lang_pred for r in judged) / len(judged) > 0.99
    assert all(0 <= r.score <= 1 for r in got)
    odd = L.identify(odd_docs, model).collect()
    assert len(odd) == odd_docs.count()
    by_id = {r.doc_id: r for r in odd}
    assert [by_id[i].lang_pred for i in range(4)] == ["und"] * 4 and by_id[0].score == 0
    assert all(by_id[i].lang_pred in model.langs for i in range(4, 9))
    assert L.identify(no_docs, model).count() == 0
    untrained = L.train(no_docs, ~apart)
    assert {r.lang_pred for r in L.identify(odd_docs, untrained).collect()} == {"und"}


def test_training_is_bounded(spark):
    rnd = random.Random(1)
    data = [(i, " ".join("".join(rnd.choice("abcdef") for _ in range(5)) for _ in range(200)), "en") for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = L.train(docs, F.lit(True))
    assert model.langs == ["en"] and model.sizes[0] <= L.SAMPLE_CHARS
    assert L.train(docs, F.lit(False)).langs == []
    scored = L.identify(docs.limit(3), model).collect()
    assert [(r.lang_pred, r.score) for r in scored] == [("en", 1.0)] * 3
    assert key(None) < key(0)
