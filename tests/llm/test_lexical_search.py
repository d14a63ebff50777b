import math
import random
import re

import numpy as np
import pytest

from tidemark.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [("a", "W1a w2b, w3c! W1A"), ("b", "one two three"), ("c", None), ("d", " .,"), ("e", "é 中文 x"), ("b", "tie A b"), (None, "w10a tail"), ("f", "nowhere to be found zzz"), ("g", "x " * 70_000 + "w5a")]


def words(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    texts = [(i, words(t)) for i, t in docs]
    texts = [(i, w) for i, w in texts if w]
    n_docs, n_terms = len(texts), sum(len(w) for _, w in texts)
    df = {}
    for _, w in texts:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        q, found = words(text), []
        for i, w in texts:
            m = 25 + 75 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) * q.count(t) for t in set(q) if t in w)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if x else i, -s) for r, (s, x, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,tiles,most", [(2_000_000, (512, 4096, 512), ls.MOST_WEIGHT), (5, (7, 3, 2), 4000)])
def test_against_brute_force(spark, docs, texts, monkeypatch, block, tiles, most):
    monkeypatch.setattr(ls, "BLOCK_TERMS", block)
    for name, value in zip(("DOC_TILE", "TERM_TILE", "ITEM_TILE", "MOST_WEIGHT"), (*tiles, most)):
        monkeypatch.setattr(ls, name, value)
    items = spark.createDataFrame([(*r, 1, 2, "z") for r in ITEMS], "item_id string, text string, row int, doc long, item string").repartition(2)
    got = sorted((tuple(r) for r in ls.search(docs, items, 10).collect()), key=repr)
    assert got == brute(texts, ITEMS, 10)


def test_ties_across_tiles_and_tasks(spark):
    rows = [(i, "alpha beta" if i % 3 else "alpha gamma") for i in range(200, 0, -1)] + [(500, "other")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    items = spark.createDataFrame([("q", "alpha"), ("r", "gamma alpha")], "item_id string, text string")
    assert sorted((tuple(r) for r in ls.search(docs, items).collect()), key=repr) == brute(rows, [("q", "alpha"), ("r", "gamma alpha")], 10)


def test_weights_near_the_bound_stay_exact():
    rng = random.Random(1)
    rows = [type("R", (), {"terms": [b"t%d" % t for t in range(40)], "counts": [rng.randrange(1, 5 * 10**8) for _ in range(40)]}) for _ in range(3)]
    q = ls.Items(rows, {b"t%d" % t: t for t in range(40)}).weigh(np.full(40, 97))
    terms, total = np.arange(0, 40, 3), np.zeros(3, np.int64)
    impact = np.array([rng.randrange(999_000, 10**6) for _ in terms], float)
    for used, low, dense in q.tiles(terms):
        assert dense.sum(axis=1).max() <= ls.MOST_WEIGHT
        total[low: low + len(dense)] += (dense @ impact[used]).astype(np.int64)
    assert total.tolist() == [sum(97 * r.counts[t] * int(x) for t, x in zip(terms, impact)) for r in rows]


def test_long_texts_come_in_pieces(monkeypatch):
    monkeypatch.setattr(ls, "PIECE", 10)
    text = "One twO, threeé fourfourfourfour.5 six  seven"
    assert [t.decode() for p in ls.terms_of(text) for t in p] == words(text)


def test_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame([("q", "w1a")], "item_id string, text string")
    assert ls.search(no_docs, items).collect() == []
    assert ls.search(docs, items.limit(0)).collect() == []
