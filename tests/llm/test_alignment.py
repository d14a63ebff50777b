import hashlib
import pickle
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment as al
from tidemark.llm.bpe import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "The", " ", "  ", "\n", "\n\n", "\t", "<|endoftext|>", "<s>", "'s", "é", "\x1c", "\x85", "　", "▁", "中文字", "\U0001f389", "99", "!!", "w" * 90, "yz" * 200, "don't ", " x", "<0x41>", "\x00", "ﬁ"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def groups(libraries, text):
    """The groups of a whole text, by plain loops."""
    a, b = libraries
    if not text:
        return []
    byte_of = {c: i for i, c in enumerate(byte_alphabet())}
    x, y = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    left = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(x.ids, x.tokens)]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in y]
    if any(b"".join(d for _, d in s) != (" " + text).encode() for s in (left, right)):
        return []
    out, i, j, at, bt, p, q = [], 0, 0, 0, 0, [], []
    while i < len(left) or j < len(right):
        if at <= bt:
            p.append(left[i][0])
            at += len(left[i][1])
            i += 1
        else:
            q.append(right[j][0])
            bt += len(right[j][1])
            j += 1
        if at == bt:
            out.append((p, q))
            p, q = [], []
    return out


def expected(libraries, rows):
    each = [(i, groups(libraries, t)) for i, t in rows]
    links = [Counter((a, b) for p, q in g for a in p for b in q) for _, g in each]
    docs = Counter(pair for c in links for pair in c)
    most = {}
    for (a, _), n in docs.items():
        most[a] = max(n, most.get(a, 0))
    return sorted([(i, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), sum(c.values()), hashlib.sha256(";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g).encode()).hexdigest() if g else "",
                    sum(n for pair, n in c.items() if docs[pair] == most[pair[0]]), sum(n * docs[pair] for pair, n in c.items())) for (i, g), c in zip(each, links)], key=repr)


@pytest.mark.parametrize("fan,records,frame", [(256, 2_000_000, 65_536), (2, 700, 50)])
def test_against_brute_force(spark, docs, texts, libraries, monkeypatch, fan, records, frame):
    for name, value in (("FAN", fan), ("SPILL_RECORDS", records), ("FRAME", frame)):
        monkeypatch.setattr(al, name, value)
    rng = random.Random(2)
    made = [(1000 + i, "".join(rng.choice(ODD) for _ in range(rng.randrange(12)))) for i in range(60)]
    more = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    src = docs.selectExpr("doc_id", "text", "1 as radix", "'x' as run").unionByName(more.selectExpr("doc_id", "text", "2 as radix", "'y' as run"))
    got = sorted((tuple(r) for r in al.align_tokens(src, A, B, ["doc_id"]).collect()), key=repr)
    assert got == expected(libraries, list(texts) + made)


def test_parts_against_whole_texts(libraries, monkeypatch):
    monkeypatch.setattr(al, "PIECE", 30)
    own, rng = al.Aligner(pickle.dumps((open(A, "rb").read(), open(B, "rb").read())), 50), random.Random(7)
    for _ in range(3000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randrange(14)))
        numbers, digest, keys, links = own.align(al._learning(own, text))
        (_, *want), = expected(libraries, [(0, text)])
        assert [*numbers.tolist(), digest] == want[:5] and links.sum() == want[3], text
        assert sorted(set(keys.tolist())) == keys.tolist()


def test_runs_are_merged_in_order(monkeypatch):
    monkeypatch.setattr(al, "FRAME", 7)
    rng = np.random.default_rng(1)
    runs = [np.unique(rng.integers(0, 500, n)) for n in (0, 1, 40, 200, 90)]
    want = Counter(k for r in runs for k in r.tolist())
    got = [x for k, c in al.merge_runs([al.pack_run(r, np.ones(len(r), np.int64)) for r in runs]) for x in zip(k.tolist(), c.tolist())]
    assert got == sorted(want.items())


def test_empty_table_and_clashing_names(spark, docs, no_docs):
    assert al.align_tokens(no_docs, A, B, ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        al.align_tokens(docs.withColumnRenamed("lang", "n_best"), A, B, ["doc_id", "n_best"])
