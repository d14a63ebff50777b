import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest

from tidemark.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    keys = [tuple(w[i: i + 8]) for i in range(len(w) - 7)]
    times = Counter(keys)
    twice = {j for i, k in enumerate(keys) if times[k] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(twice)


def test_base_counts(docs, texts, spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = qr.judge(docs, labels).collect()
    want = [(i, *(b := brute(t)), b[0] < 20 or 100 * b[4] > 30 * b[0]) for i, t in texts]
    assert sorted([tuple(r)[:7] for r in got], key=repr) == sorted(want, key=repr)
    assert all(r.kept is not r.base_failed for r in got)             # too few labels to certify a cutoff


def exact_cdf(k, n, p):
    f = Fraction(p).limit_denominator(10**6)
    return float(sum(comb(n, i) * f**i * (1 - f) ** (n - i) for i in range(k + 1)))


@pytest.mark.parametrize("n,p", [(10, 0.1), (200, 0.01), (3000, 0.004)])
def test_binomial_cdf(n, p):
    for k in sorted({0, 1, 2, n // 50, n // 10}):
        assert abs(qr.binomial_cdf(k, n, p) - exact_cdf(k, n, p)) < 1e-9
    assert qr.binomial_cdf(n, n, p) == 1.0
    assert 0 < qr.binomial_cdf(10**7, 10**9, 0.01) < 1


def labelled(spark, good_symbols):
    """4000 documents of stratum a (a tenth bad, with a symbol per word), 50 of b, some without labels."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(4050):
        bad = i % 10 == 0
        words = [f"w{rng.randrange(999)}q" for _ in range(30)]
        if bad or i % 1000 in good_symbols:
            words = [x + "##" for x in words]
        rows.append((i, " ".join(words), "a" if i < 4000 else "b"))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(9001, " ".join(["zz##%d" % j for j in range(30)]), "a"), (9002, " ".join(["zz##%d" % j for j in range(30)]), "c"), (9003, None, None)]
    labels += [(5, None, 1), (None, 0, 0), (10, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_cutoffs_are_certified_per_stratum(spark):
    docs, labels = labelled(spark, ())
    cutoffs = qr.select_cutoffs(docs, labels, "lang")
    assert set(cutoffs) == {"a"} and "symbols_per_word" in cutoffs["a"] and "word_length" not in cutoffs["a"]
    kept = {r.doc_id: r.kept for r in qr.judge(docs, labels).collect()}
    assert not kept[0] and not kept[9001] and kept[9002] and kept[1] and kept[4000] and not kept[9003]


def test_too_many_false_rejections_certify_nothing(spark):
    # 19 of 900 good documents a thousand have symbols: over the allowed 2 %.
    docs, labels = labelled(spark, [i for i in range(1, 22) if i % 10])
    assert qr.select_cutoffs(docs, labels, "lang") == {}


def test_copies_count_once(spark):
    """A few texts in many copies are no evidence: nothing is certified, however many rows there are."""
    rows = [(i, " ".join(["good%d" % (i % 20)] * 5 + ["w%d" % j for j in range(30)]) + (" ##" * 60 if i % 10 == 0 else ""), "a") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 10 != 0), 0) for i in range(3000)], "doc_id long, quality int, toxic int")
    assert qr.select_cutoffs(docs, labels, "lang") == {}


def test_steps_against_brute_force():
    """The chosen cutoffs are certified on the certification cells, and by no step more."""
    rng = random.Random(6)
    rules, sizes = list(qr.RULES), [len(c) for _, _, c in qr.RULES.values()]
    for _ in range(20):
        cells = [(rng.random() < 0.7, g, tuple(rng.randrange(m + 1) if rng.random() < (0.02 if g else 0.5) else 0 for m in sizes), rng.randrange(1, 60)) for g in (True, True, False) for _ in range(120)]
        cells += [(c, True, (0,) * 5, rng.randrange(500, 5000)) for c in (True, False)]
        got = qr._choose(cells, 0.02, 0.0125)
        level = {r: len(qr.RULES[r][2]) - qr.RULES[r][2].index(x) for r, x in got.items()}
        hit = lambda v: any(v[i] >= level[r] for i, r in enumerate(rules) if r in level)  # noqa: E731, B023
        good = sum(n for c, g, v, n in cells if c and g)
        wrong = sum(n for c, g, v, n in cells if c and g and hit(v))
        assert not got or exact_cdf(wrong, good, 0.02) <= 0.0125 + 1e-9


def test_certified_is_the_exact_bound():
    risk, error = 0.01, 0.05
    for n in (100, 298, 299, 500, 5000):
        for k in (0, 1, 2, 40):
            assert qr.certified(k, n, risk, error) == (exact_cdf(k, n, risk) <= error)
    assert not qr.certified(0, 0, risk, error)


def test_stage_keeps_columns(docs, texts, spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = qr.keep_good(docs, labels)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    want = [(i, t) for i, t in texts if not ((b := brute(t))[0] < 20 or 100 * b[4] > 30 * b[0])]
    assert sorted(map(repr, [(r.doc_id, r.text) for r in got.collect()])) == sorted(map(repr, want))
    assert qr.keep_good(no_docs, labels).collect() == []
