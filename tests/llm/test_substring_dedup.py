import hashlib

import numpy as np
import pyarrow as pa

from tidemark.llm import substring_dedup as sd


def brute(rows):
    words = [((1 << 63) - 1 if i is None else i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for d, w in words:
        for k in range(len(w) - 12):
            key = tuple(w[k: k + 13])
            least[key] = min(d, least.get(key, d))
    out = []
    for (i, _), (d, w) in zip(rows, words):
        gone = {j for k in range(len(w) - 12) if least[tuple(w[k: k + 13])] < d for j in range(k, k + 13)}
        kept = b" ".join([x for j, x in enumerate(w) if j not in gone])
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_brute_force(docs, texts):
    assert rows_of(sd.remove_repeats(docs, full=False)) == brute(texts)


def test_hot_cells_and_small_buckets(docs, texts, monkeypatch):
    monkeypatch.setattr(sd, "HOT_ROWS", 2)
    monkeypatch.setattr(sd, "BROADCAST_ROWS", 0)
    assert rows_of(sd.remove_repeats(docs, full=False)) == brute(texts)


def test_sorting_in_small_pieces(docs, texts, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_BYTES", 300)
    monkeypatch.setattr(sd, "CELL_ROWS", 1)
    assert rows_of(sd.remove_repeats(docs, full=False)) == brute(texts)


def test_empty_table_and_kept_text(spark, no_docs):
    assert sd.remove_repeats(no_docs).collect() == []
    text = " ".join(f"a{i}" for i in range(13))
    got = rows_of(sd.remove_repeats(spark.createDataFrame([(1, text), (2, f"x {text}\ny")], "doc_id long, text string")))
    assert got == [(1, 13, 0, text), (2, 15, 13, "x y")]


def test_hash_clashes_are_settled_by_words(spark, monkeypatch, texts):
    import numpy as np

    real = sd.window_hashes
    monkeypatch.setattr(sd, "window_hashes", lambda h, k: real(h, k) % np.uint64(3) if k == sd.WINDOW else real(h, k))
    words = [f"k{i}" for i in range(16)]
    rows = [(5, words), (3, words[1:]), (9, words[::-1]), (4, words[::-1])]
    packed = sd._packed(np.array([d for d, _ in rows]), np.zeros(4, np.int64), np.zeros(4, np.int64), [" ".join(w).encode() for _, w in rows])
    got = sorted(zip(*[c.to_pylist() for c in sd._bucket([sd._unpacked(packed)]).columns]))
    assert got == [(5, 0, 1, 16), (9, 0, 0, 16)]


def test_overlapping_windows_are_compared_as_one_passage(monkeypatch):
    words = b" ".join(b"w%d" % i for i in range(400))
    calls, text = [], sd.Windows.text
    monkeypatch.setattr(sd.Windows, "text", lambda w, i, j: calls.append((i, j)) or text(w, i, j))
    zero = np.zeros(2, np.int64)
    got = sd._bucket([(np.array([1, 2]), zero, zero, np.array([len(words)] * 2, np.int32), words * 2)])
    assert got.to_pydict() == {"doc": [2], "hash": [0], "start": [0], "stop": [400]}
    assert len(calls) < 10


def test_windows_of_a_passage_that_differs_are_compared_one_by_one():
    base = [f"w{i}" for i in range(40)]
    w = sd.Windows(pa.array([" ".join(base), " ".join([*base[:20], "other", *base[21:]])]))
    i, j = np.arange(40, 68)[::-1], np.arange(0, 28)[::-1]
    assert sd._same_windows(w, i, j).tolist() == [not x <= 20 < x + sd.WINDOW for x in range(28)][::-1]
    assert sd._same_windows(w, i[:0], j[:0]).tolist() == []
