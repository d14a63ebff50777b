"""Operator 4: token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each place of a word;
dynamic programming over the places carries the best score and the number of pieces on that
path.  The rules are those of the tokenizers library's Unigram model: a path replaces
another only if its score is larger, starts being tried from left to right (so the longest of
equally good last pieces stays); a character that is no piece of its own scores the smallest
score less ten; neighbouring unknowns (the unknown piece's own string among them) are one, which counts as a piece if
the vocabulary has it, else as its UTF-8 bytes if the vocabulary has all byte pieces, else as
one.

Vocabulary: the pieces and scores of a SentencePiece model file, taken as they are.  Words
are made as the library's Metaspace pre-tokenizer does: spaces become U+2581, one is put in
front unless there is one, and each word begins at such a mark.

Defined results: a null or empty text has no words and no tokens.  Repeated rows are counted
each on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import TwoGenerations, added, file_bytes, per_worker, slices

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def read_model(data: bytes) -> list[tuple[str, float]]:
    """The pieces and scores of a SentencePiece model file, in the order of their ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class Counter:
    """Counts the pieces of the best path of a text."""

    def __init__(self, vocab: list[tuple[str, float]], entries: int = 300_000, unk_id: int = 0):
        self.unk = vocab[unk_id][0]
        self.pieces = {p for p, _ in vocab}
        self.bytes = all(f"<0x{b:02X}>" in self.pieces for b in range(256))
        self.unknown = min(s for _, s in vocab) - UNKNOWN_PENALTY
        self.machine = ahocorasick.Automaton()
        for p, s in vocab:
            if p:
                self.machine.add_word(p, (len(p), s))
        self.machine.make_automaton()
        self.words = TwoGenerations(self.word, entries)

    def _unknowns(self, text: str) -> int:
        if text in self.pieces or not self.bytes:
            return 1
        return len(text.encode())

    def word(self, word: str) -> int:
        """Number of pieces of one word."""
        n = len(word)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.machine.iter(word):
            ending[end].append(match)
        score = [0.0] * (n + 1)
        count = [0] * (n + 1)                    # pieces before an open run of unknowns
        opened = [-1] * (n + 1)                  # where that run begins, or -1
        for e in range(1, n + 1):
            best, at, known = None, -1, False
            for size, s in sorted(ending[e - 1], reverse=True):
                known |= size == 1
                if best is None or score[e - size] + s > best:
                    best, at = score[e - size] + s, e - size
            if not known and (best is None or score[e - 1] + self.unknown > best):
                score[e] = score[e - 1] + self.unknown
                count[e] = count[e - 1]
                opened[e] = opened[e - 1] if opened[e - 1] >= 0 else e - 1
                continue
            score[e] = best
            if word[at:e] == self.unk:           # the unknown piece itself joins unknowns beside it
                count[e] = count[at]
                opened[e] = opened[at] if opened[at] >= 0 else at
                continue
            count[e] = count[at] + 1 + (self._unknowns(word[opened[at]: at]) if opened[at] >= 0 else 0)
        return count[n] + (self._unknowns(word[opened[n]:]) if opened[n] >= 0 else 0)

    def text(self, text: str) -> tuple[int, int]:
        """Number of words and of pieces of a whole text."""
        if not text:
            return 0, 0
        t = text.replace(" ", MARK)
        words = t.split(MARK)
        if t[0] == MARK:
            words = words[1:]
        return len(words), sum(map(self.words.__getitem__, [MARK + w for w in words]))


def count_tokens(docs: DataFrame, model_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns, then n_words and n_tokens of every whole text.  ``keep`` may not hold
    the names of the made columns."""
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(model_path))
    src = docs.select(*keep, F.col(text).alias("_text"))
    schema = added(src, n_words=T.LongType(), n_tokens=T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker("unigram", data.value, lambda d: Counter(read_model(d)))
        for b in slices(batches, len(keep)):
            got = [counter.text(t.as_py() or "") for t in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())],
                                             names=schema.names)

    return src.mapInArrow(run, schema)
