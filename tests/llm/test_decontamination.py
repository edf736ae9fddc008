"""Winnowing against a search of every window."""

import hashlib
import random
import re

from conftest_llm import key
from velomart.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i : i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in got if x is not None}
        out.append((len(w), len(hit), sorted(found)))
    return out


def run(spark, docs, items):
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, fp string")
    return D.contamination(docs, bench)


def test_every_window_is_found(spark, make_docs):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 5, 12, 13, 14, 30])))) for i in range(30)]
    items += [(100, items[0][1]), (101, None), (102, ""), (None, items[5][1]), (103, "W1, W2! w3"), (3, items[3][1])]
    texts = []
    for _ in range(60):
        parts = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 3)):
            item = words(rnd.choice(items)[1])
            if item:
                a = rnd.randrange(len(item))
                parts[len(parts) // 2 : len(parts) // 2] = item[a : a + rnd.randint(1, 25)]
        texts.append(" ".join(p.upper() if rnd.random() < 0.2 else p for p in parts))
    docs = make_docs([*texts, None, ""], repeat=7)
    got = run(spark, docs, items).collect()
    source = docs.select("doc_id", "text").collect()
    want = brute([r.text for r in source], items)
    expect = sorted((key(r.doc_id), n, h, tuple(f), bool(h) and 20 * h >= n) for r, (n, h, f) in zip(source, want, strict=True))
    assert sorted((key(r.doc_id), r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in got) == expect
    assert any(e[2] for e in expect)


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    items = [(1, "one"), (2, "ä ö"), (3, " ".join(str(i) for i in range(100, 130)))]
    got = run(spark, odd_docs, items).collect()
    assert len(got) == odd_docs.count()
    by_text = {(r.doc_id): r for r in got}
    assert by_text[0].n_words == 0 and not by_text[0].contaminated
    assert by_text[4].item_ids == ["1"] and by_text[4].contaminated
    assert by_text[11].n_hit == 30 and not by_text[11].contaminated
    assert run(spark, no_docs, items).count() == 0
    clean = run(spark, odd_docs, []).collect()
    assert len(clean) == odd_docs.count() and not any(r.n_hit for r in clean)


def test_query_digest(spark):
    from velomart.llm.queries import QUERIES

    rows = QUERIES["op1_decontaminate"](spark, "/root/testdata/sf0.001").collect()
    assert {r.items_sha256 for r in rows if not r.n_items} == {hashlib.sha256(b"").hexdigest()}
