import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tidemark.llm import unigram_counts as uc

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(vocab, fallback):
    t = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace()
    return lambda s: len(t.encode(s, add_special_tokens=False).ids)


def test_documents_against_the_library(docs, texts):
    vocab = uc.read_model(open(PATH, "rb").read())
    count = library(vocab, True)
    got = uc.count_tokens(docs, PATH, ["doc_id", "kind"]).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted((i or -1, count(t or "")) for i, t in texts)


@pytest.mark.parametrize("vocab,alphabet,fallback", [
    ([("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aa", -2.0), ("aba", -3.0), ("cc", -30.0), ("▁", -0.5)], "aabbcc d", False),
    (None, ["a", "b", " ", "  ", "<0xA1>", "▁", "\n", "é", "中文", "🎉", "the", "insu", "<unk>"], True),
])
def test_ties_and_unknowns(vocab, alphabet, fallback):
    vocab = vocab or uc.read_model(open(PATH, "rb").read())
    count, own, rng = library(vocab, fallback), uc.Counter(vocab, 50), random.Random(2)
    for _ in range(2000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randrange(16)))
        assert own.text(s)[1] == count(s), s


def test_empty_table_and_clash(no_docs):
    assert uc.count_tokens(no_docs, PATH, ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        uc.count_tokens(no_docs, PATH, ["n_words"])
