import numpy as np
import pytest

from tidemark.llm import bag_minhash as bm


def brute(rows):
    rows = [r for r in rows]
    bags = [bm._bag(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0] and bags[i] and bags[j]
            if same_id or bags[i] and bags[j] and bm.similar(bags[i], bags[j]):
                parent[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None and bags[k]:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted([(i, least.get(find(k)) if bags[k] else i, bags[k].total()) for k, (i, _) in enumerate(rows)], key=repr)


def got(df):
    return sorted(map(tuple, bm.classes(df).collect()), key=repr)


def test_against_brute_force(docs, texts):
    assert got(docs) == brute(texts)


def chain(n=26):
    """Texts of which each is similar to the next but the first isn't to the last; and dissimilar ones
    that share a long passage."""
    w = [f"c{i}" for i in range(400)]
    rows = [(500 - i, " ".join(w[: 200 + 8 * i])) for i in range(n)]
    shared = " ".join(f"s{i}" for i in range(120))
    rows += [(600 + k, shared + " " + " ".join(f"o{k}x{j}" for j in range(60))) for k in range(40)]
    return rows


@pytest.mark.parametrize("crowded,split,ids", [(200, 10_000_000, 1_000_000), (2, 10_000_000, 0), (2, 2, 0)])
def test_no_link_is_lost_in_crowded_buckets(spark, monkeypatch, crowded, split, ids):
    monkeypatch.setattr(bm, "CROWDED", crowded)
    monkeypatch.setattr(bm, "SPLIT", split)
    monkeypatch.setattr(bm, "BROADCAST_IDS", ids)
    rows = chain()
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def one_bucket(monkeypatch):
    """All documents share the first band's bucket, and no other."""
    signed = bm.signed
    own = [bm.F.xxhash64("content", bm.F.lit(i)) for i in range(1, 3)]
    monkeypatch.setattr(bm, "signed", lambda *a: signed(*a).withColumn("bands", bm.F.array(bm.F.lit(7).cast("long"), *own)))


def test_ids_with_several_texts_in_a_crowded_bucket(spark, monkeypatch):
    one_bucket(monkeypatch)
    monkeypatch.setattr(bm, "CROWDED", 2)
    rows = chain()
    rows += [(i, " ".join(f"z{i}x{j}" for j in range(150))) for i, _ in rows[:26:2]]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_pairs_of_one_common_band_in_a_split_bucket(spark, monkeypatch):
    one_bucket(monkeypatch)
    monkeypatch.setattr(bm, "CROWDED", 2)
    monkeypatch.setattr(bm, "SPLIT", 2)
    rows = chain()
    rows += [(700 + i, "again and again " * (40 + 8 * i)) for i in range(8)]
    rows += [(i, " ".join(f"z{i}x{j}" for j in range(150))) for i, _ in rows[:26:2]]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 40, 300)
    b = np.where(rng.random(300) < 0.6, a, rng.integers(0, 40, 300))
    element = bm.mix(np.arange(300).astype(np.uint64) + np.uint64(9))
    keep = b > 0
    s = bm.signatures(np.repeat([0, 1], [300, keep.sum()]), np.concatenate([element, element[keep]]), np.concatenate([a, b[keep]]), 3, 8000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / 8000)
    assert np.isinf(s[2]).all() and not np.isinf(s[:2]).any()


def test_similar_at_the_bound():
    a = bm.Counter({k: 1 for k in range(9)})
    assert bm.similar(a, bm.Counter({k: 1 for k in range(1, 10)})) and not bm.similar(a, bm.Counter({k: 1 for k in range(2, 10)}))   # 8/10 and 7/10
    assert bm.similar(bm.Counter({0: 4}), bm.Counter({0: 5})) and not bm.similar(bm.Counter({0: 3}), bm.Counter({0: 4}))
    assert not bm.similar(bm.Counter(), bm.Counter())


def test_stage_and_empty_table(docs, texts, no_docs):
    kept = bm.keep_first(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    want = sorted([i for i, c, _ in brute(texts) if i is None or i == c], key=repr)
    have = sorted([r.doc_id for r in kept.collect()], key=repr)
    assert have == want
    assert bm.classes(no_docs).collect() == [] and bm.keep_first(no_docs).collect() == []
