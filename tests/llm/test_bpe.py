import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(open(PATH, "rb").read(), 50)


def same(library, own, text):
    ids = library.encode(text, add_special_tokens=False).ids
    found, numbers, decoded = own.encode(text)
    assert (found.tolist(), numbers, decoded) == (ids, " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)), text


def test_documents(docs, texts, library):
    got = bpe.encode_texts(docs, PATH, ["doc_id", "hash"], full=False).collect()
    full = bpe.encode_texts(docs, PATH, ["doc_id"]).collect()

    def one(i, t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return i or -1, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    want = sorted(one(i, t) for i, t in texts)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert sorted((r.doc_id or -1, r.n_tokens, hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest()) for r in full) == want


def test_special_tokens_and_odd_text(library, own):
    rng = random.Random(3)
    bits = ["a", "The", " ", "  ", "\n", "<|endoftext|>", "<|startoftext|>", "<|end", "'s", "'LL", "é", "é", "Σ", "İ", "①", "9", "!!", "\x1c", "\x85", "中", "\U0001f389", "\U000105c0", "Ᲊ", "word" * 5]
    for _ in range(1500):
        same(library, own, "".join(rng.choice(bits) for _ in range(rng.randrange(12))))


def test_every_code_point(library, own):
    chars = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0xA000, 0x20000, 7) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 50):
        same(library, own, " ".join("a" + c + "B" for c in chars[at: at + 50]))


def test_merge_order(own):
    by_hand = bpe.Bpe.merge
    symbols = [own.inner[b] for b in b"abababab"] + [own.last[ord("c")]]
    naive = list(symbols)
    while True:
        ranked = [(own.rank[a * own.width + b], i) for i, (a, b) in enumerate(zip(naive, naive[1:])) if a * own.width + b in own.rank]
        if not ranked:
            break
        r, i = min(ranked)
        naive[i: i + 2] = [own.merged[r]]
    assert by_hand(own, symbols) == naive


def test_empty_table_and_clash(no_docs):
    assert bpe.encode_texts(no_docs, PATH, ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        bpe.encode_texts(no_docs.withColumnRenamed("kind", "n_tokens"), PATH, ["n_tokens"])
