import io
import json
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_files as tf
from tidemark.llm.common import utf8_rows
from tidemark.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def close(self):
        pass


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_files_against_the_library(spark, docs, texts, library):
    got = tf.read_documents(tf.write_files(docs, PATH, scratch_path(spark, "ids")), full=True).orderBy("start").collect()
    seen, at = [], 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids)) and r.ids[-1] == 0
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
        seen.append((r.doc_id, tuple(r.ids)))
        at += r.n_tokens
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(i for i, _ in texts if i is not None)
    want = [(i, tuple(library.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t in texts]
    assert sorted(seen, key=repr) == sorted(want, key=repr)


def test_empty_table(spark, no_docs):
    assert tf.read_documents(tf.write_files(no_docs, PATH, scratch_path(spark, "ids"))).collect() == []


def test_chunks_against_the_library(library):
    own, rng = tf.ChunkEncoder(open(PATH, "rb").read(), 100), random.Random(4)
    bits = ["a", "The", " ", "  ", "\n", "\n\n", "\t", "<|endoftext|>", "<|end", "'s", "é", "\x1c", "\x85", "\u3000", "中", "\U0001f389", "99", "!!", "w" * 90]
    some = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(3000)]
    for at in range(0, len(some), 100):
        part = some[at: at + 100]
        assert own.encode(part) == [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in library.encode_batch(part, add_special_tokens=False)]


def test_a_word_is_looked_up_once_whatever_it_stands_beside(library):
    own, rng = tf.ChunkEncoder(open(PATH, "rb").read()), random.Random(9)
    words = ["".join(rng.choice("abcdeéß") for _ in range(7)) for _ in range(200)]
    texts = [" ".join(w + end for w in words) for end in ("", ".", ",", "!", ")", '"', "?!", ";")]
    assert own.encode(texts) == [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert len(own.young) < 230


def test_rows_of_bytes_against_the_library(library):
    own, rng = tf.ChunkEncoder(open(PATH, "rb").read(), 300), random.Random(5)
    bits = ["a", "The", " ", "  ", "\n", "\r\n", "\t", "<|endoftext|>", "<|", "'", "'s", "'ll", "é", "×", "\u0241", "\x00", "\x1f", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028",
            "\u205f", "\u3000", "\u300c", "\u201c", "e\u0301", "1", "²", "٣", ".", "_", "слово", "w" * 90]
    for _ in range(40):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(150)]
        ids, counts = own.encode_rows(*utf8_rows(pa.array(["left out", *texts]).slice(1)))
        want = [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_added_tokens_that_regard_their_neighbours():
    spec = json.load(open(PATH))
    spec["added_tokens"] += [{**spec["added_tokens"][0], "id": 50257 + k, "content": c, "special": False, **more}
                             for k, (c, more) in enumerate((("<x>", {"lstrip": True}), ("abc", {"single_word": True})))]
    data = json.dumps(spec)
    texts = ["a  <x> b", "abc", "xabc abc", "abc-abc\n<x>", "1abc"]
    want = [x.ids for x in Tokenizer.from_str(data).encode_batch(texts, add_special_tokens=False)]
    assert tf.ChunkEncoder(data.encode()).encode(texts) == [struct.pack(f"<{len(x)}I", *x) for x in want]


@pytest.mark.parametrize("n", [0, 1, 2, tf.BLOCK - 1, tf.BLOCK, tf.BLOCK + 1, 3 * tf.BLOCK * tf.GROUP + 17])
def test_round_trip_of_blocks_and_ranges(n):
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.05, rng.integers(0, 2**32, n), rng.integers(40, 70, n)).astype(np.uint32)
    ids[: n // 4] = 7
    out = Memory()
    w = tf.Writer(out)
    cuts = [0, n // 3, n // 3, n // 2, n]
    for d, (a, b) in enumerate(zip(cuts, cuts[1:])):
        w.add(d if d != 2 else None, ids[a:b].tobytes())
    w.close()
    r = tf.Reader(out)
    assert np.array_equal(r.ids(0, n), ids) and r.known.tolist() == [True, True, False, True]
    for a, b in ((0, 1), (n // 5, n // 2), (max(0, n - 3), n)):
        assert np.array_equal(r.ids(a, min(b, n)), ids[a: min(b, n)])
    parts = [[] for _ in range(4)]
    for d, piece, _ in r.runs():
        parts[d].append(piece)
    assert [np.concatenate(p).tolist() for p in parts] == [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
    if n > 5000:
        assert len(out.getvalue()) < 2.5 * n          # packed well under four bytes an id
