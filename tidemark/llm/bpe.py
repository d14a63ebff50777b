"""Operator 6: BPE encoding and decoding of whole texts.

A word is a doubly linked list of symbols and a priority queue of the merge ranks of its
neighbours; entries whose pair has changed since are skipped when they come up.  The
rules before the merges (normaliser, split pattern, added tokens, word ends) are read
from the tokenizer file; a file with other rules than those below is refused.

Text is cut at single spaces first.  No rule of these tokenizers reads across a space, so
the pieces are encoded on their own and remembered in a bounded memo.  Characters that
Python's tables don't know yet are lower-cased and classed by the tokenizers library's.

Defined results: a null text is the empty text; the empty text has no tokens, and its ids
and its decoded text are empty strings.  Repeated rows are encoded each on its own.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex
from tokenizers.normalizers import Lowercase
from tokenizers.pre_tokenizers import Split

from tidemark.llm.common import TwoGenerations, added, file_bytes, per_worker, slices

_POSITION = (1 << 32) - 1


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others follow from U+0100 on in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(others)) for b in range(256)]


class Bpe:
    """Encoder and decoder for one tokenizer file (BPE with word ends over bytes)."""

    def __init__(self, data: bytes, entries: int = 250_000):
        spec = json.loads(data)
        model = spec["model"]
        parts = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        normal = [p["type"] for p in spec["normalizer"]["normalizers"]]
        if (model["type"] != "BPE" or parts != ["Split", "ByteLevel"] or normal != ["NFC", "Replace", "Lowercase"] or spec["decoder"]
                or spec["post_processor"] or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
                or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])):
            raise ValueError("this tokenizer file has rules that the encoder does not know")
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: s for s, i in [*vocab.items(), *self.added.items()]}
        if any(" " in t for t in self.added):
            raise ValueError("an added token with a space can't be found in text that is cut at spaces")
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.opening = regex.compile("[" + "".join({regex.escape(t[0]) for t in self.added}) + "]") if self.added else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern)
        self.newer = Split(Regex(pattern), "removed", invert=True)
        self.width = max(self.text_of) + 1
        end = model["end_of_word_suffix"] or ""
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + end] for c in alphabet]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (a, b) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]):
            self.rank[vocab[a] * self.width + vocab[b]] = rank
            self.merged.append(vocab[a + b])
        self.texts = np.empty(self.width, object)
        self.numbers = np.empty(self.width, object)
        for i, t in self.text_of.items():
            self.texts[i], self.numbers[i] = t, str(i)
        #: Packed ids of chunks and of their pieces (a piece is a chunk of itself).
        self.chunks = TwoGenerations(self._chunk, entries)

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours by rank, the leftmost first among equal ranks, until no pair has one."""
        n = len(symbols)
        if n < 2:
            return symbols
        rank, width = self.rank, self.width
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        live = [rank.get(a * width + b, -1) for a, b in zip(symbols, symbols[1:])]
        live.append(-1)
        queue = [r << 32 | i for i, r in enumerate(live) if r >= 0]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i, r = entry & _POSITION, entry >> 32
            if live[i] != r:                     # the pair has changed: a stale entry
                continue
            gone = after[i]
            symbols[i] = new = self.merged[r]
            symbols[gone] = live[gone] = -1
            after[i] = j = after[gone]
            live[i] = -1
            if j < n:
                before[j] = i
                s = rank.get(new * width + symbols[j], -1)
                if s >= 0:
                    live[i] = s
                    heapq.heappush(queue, s << 32 | i)
            h = before[i]
            if h >= 0:
                live[h] = s = rank.get(symbols[h] * width + new, -1)
                if s >= 0:
                    heapq.heappush(queue, s << 32 | h)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> bytes:
        data = word.encode()
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        return array("I", self.merge(symbols)).tobytes()

    def _pieces(self, text: str) -> list[str]:
        """Normalised pieces between which no merge takes place."""
        if text.isascii():
            text = text.lower()
            return [text] if text.isalpha() else self.pieces.findall(text)
        text = unicodedata.normalize("NFC", text)
        if any(unicodedata.category(c) == "Cn" for c in text):        # newer than Python's tables
            return [p for p, _ in self.newer.pre_tokenize_str(Lowercase().normalize_str(text))]
        return self.pieces.findall(text.replace("\u03a3", "\u03c3").lower())   # no final sigma: each character on its own

    def _chunk(self, chunk: str) -> bytes:
        parts, at = [], 0
        if self.specials and self.opening.search(chunk):
            for m in self.specials.finditer(chunk):
                parts += map(self._piece, self._pieces(chunk[at: m.start()]))
                parts.append(array("I", [self.added[m.group()]]).tobytes())
                at = m.end()
        pieces = self._pieces(chunk[at:] if at else chunk)
        if pieces == [chunk]:
            return self._word(chunk)
        parts += map(self._piece, pieces)
        return b"".join(parts)

    def _piece(self, piece: str) -> bytes:
        return self.chunks[piece] if self._pieces(piece) == [piece] else self._word(piece)

    def decode(self, ids) -> str:
        """The vocabulary strings joined by one space, as the file (which names no decoder) asks."""
        return " ".join([self.text_of[i] for i in ids])

    def encode(self, text: str) -> tuple[np.ndarray, str, str]:
        """The ids, their decimal forms joined by one space, and the decoded text."""
        ids = np.frombuffer(b"".join(map(self.chunks.__getitem__, text.split(" "))), np.uint32)
        return ids, " ".join(self.numbers[ids].tolist()), " ".join(self.texts[ids].tolist())


def encode_texts(docs: DataFrame, tokenizer_path: str, keep: list[str], text: str = "text", full: bool = True) -> DataFrame:
    """Encode every whole text.  Returns the ``keep`` columns, then n_tokens and either the ids
    (array<int>) and the decoded text (``full``), or the SHA-256 digests of their decimal and
    UTF-8 forms.  ``keep`` may not hold the names of the made columns."""
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(tokenizer_path))
    src = docs.select(*keep, F.col(text).alias("_text"))
    text_type = T.StringType()
    schema = added(src, n_tokens=T.LongType(), **({"ids": T.ArrayType(T.IntegerType()), "decoded": text_type} if full else {"ids_sha256": text_type, "decoded_sha256": text_type}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = per_worker("bpe", data.value, Bpe)
        for b in slices(batches, len(keep)):
            n, x, y = [], [], []
            for t in b.column(len(keep)):
                found, ids, decoded = bpe.encode(t.as_py() or "")
                n.append(len(found))
                x.append(found.astype(np.int32) if full else hashlib.sha256(ids.encode()).hexdigest())
                y.append(decoded if full else hashlib.sha256(decoded.encode()).hexdigest())
            kinds = (pa.int64(), pa.list_(pa.int32()) if full else pa.string(), pa.string())
            cols = [*b.columns[:-1], *(pa.array(v, k) for v, k in zip((n, x, y), kinds))]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)
