import hashlib
import re

import pytest

from tidemark.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.fixture(scope="module")
def bench(spark, texts):
    w = texts[0][1].split()
    rows = [(1, " ".join(w[:25])), (10, "One, TWO three!"), (2, "one"), (3, None), (4, ""), (5, " ".join(w[100:110]).upper()), (5, "É́Σ"), (None, " ".join(w[60:75])), (2, "one"), (7, "x " * 12), (8, "nowhere to be seen")]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, doc long")


def brute(rows, items):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[k: k + 10]), set()).add(i)
    out = []
    for d, t in rows:
        w, hit, ids = words(t), set(), set()
        for key, own in wins.items():
            for k in range(len(w) - len(key) + 1):
                if tuple(w[k: k + len(key)]) == key:
                    hit.update(range(k, k + len(key)))
                    ids |= {str(x) for x in own if x is not None}
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_against_brute_force(docs, texts, bench, monkeypatch, broadcast):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", broadcast)
    got = sorted(map(tuple, dc.digest(dc.contamination(docs, bench[1])).collect()), key=repr)
    assert got == brute(texts, bench[0])


def test_stage_keeps_columns_and_clean_rows(docs, texts, bench):
    got = dc.keep_clean(docs, bench[1])
    assert got.columns == docs.columns
    clean = [r for r, b in zip(texts, [x for x in [brute([t], bench[0])[0] for t in texts]]) if not b[-1]]
    assert sorted(map(repr, [(r.doc_id, r.text) for r in got.collect()])) == sorted(map(repr, clean))


def test_empty_tables(docs, no_docs, bench):
    assert dc.contamination(no_docs, bench[1]).collect() == []
    assert {r.contaminated for r in dc.contamination(docs, bench[1].limit(0)).collect()} == {False}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b y c"), (2, "c b q q q q a"), (3, "b a c"), (4, "a b"), (5, "a a b b z c")], "doc_id long, text string")
    test = dc.phrases(spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
    terms = dc.number_terms(test)
    index = dc.build_index(docs, terms)
    plan, _ = dc.plan_phrases(test, terms, index)
    assert sorted((r.doc, r.start) for r in dc.proximity_matches(index, plan, 5).collect()) == [(1, 0), (3, 0), (5, 1)]
    assert sorted((r.doc, r.start) for r in dc.phrase_matches(index, plan).collect()) == []
