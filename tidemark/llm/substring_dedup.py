"""Operator 1: removal of repeated 13-word passages, by super-k-mer partitioning.

A window is 13 consecutive words.  Its minimiser is the smallest hash among its runs of
three words.  Consecutive windows of a document with one minimiser travel together, as one
packed string of words (a super-k-mer), to the minimiser's bucket (those of one bucket and
slice of the input as one compressed block); a bucket holds all occurrences of each of its
windows.  There the windows are sorted, equal ones meet, and
those that also start in a document with a smaller id are reported back as word intervals.
Equal hashes are settled by the words themselves, so the result is exact.

Minimisers are first counted in coarse cells.  Windows of the cells that hold very many
super-k-mers (passages that a large part of the corpus shares) go on their own, keyed by the
whole window: the smallest id per window is aggregated before the shuffle, then joined.

Defined results: a null or empty text has no words; nothing is removed and the digest is that
of the empty string.  Windows are judged on the input.  Rows with one id are documents of
equal rank: none is removed for another's sake.  A null id ranks behind all ids; rows
without an id don't cause removals among each other.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashes_of, materialise, mix, slices, utf8_rows, window_hashes, word_bytes, words_of

WINDOW, SEED = 13, 3
#: Most windows of one super-k-mer (longer runs of one minimiser are cut).
LONGEST = 64
#: Super-k-mers per coarse cell on average, and the number from which a cell is hot (at least;
#: and at least a 50,000th of all, so that there are few hot cells at any size).
CELL_ROWS, HOT_ROWS, HOT_SHARE = 4_000, 20_000, 50_000
#: Bytes of super-k-mers in a bucket on average: what a task sorts at once.
BUCKET_BYTES = 6 << 20
#: Word intervals are sent to all executors below this number, joined by a shuffle above it.
BROADCAST_ROWS = 500_000
LAST = (1 << 63) - 1


class Windows:
    """Words and 13-word windows of a text column, as arrays over all rows."""

    def __init__(self, col: pa.Array):
        raw, offsets = utf8_rows(col)
        a, b, self.row, self.counts = words_of(raw, offsets)
        self.first = np.cumsum(self.counts) - self.counts
        size = b - a
        self.start = np.cumsum(size + 1) - (size + 1)         # in the text with single spaces
        self.end = self.start + size
        self.bytes = word_bytes(raw, a, b)
        self.hash = hashes_of(self.bytes, size)
        n = len(a) - WINDOW + 1
        self.at = np.flatnonzero(self.row[WINDOW - 1:] == self.row[:n]) if n > 0 else np.zeros(0, np.int64)

    @cached_property
    def plain(self) -> bytes:
        """All words, a space behind each."""
        out = np.full(int(self.end[-1]) + 1 if len(self.end) else 0, 32, np.uint8)
        word = np.ones(len(out), bool)
        word[self.end] = False
        out[word] = self.bytes
        return out.tobytes()

    def text(self, i: int, j: int) -> bytes:
        """Words i to j, joined by single spaces."""
        return self.plain[self.start[i]: self.end[j]]

    def minimisers(self) -> np.ndarray:
        """The minimiser of each window (in the order of ``at``)."""
        x = window_hashes(self.hash, SEED)
        width, span = 1, WINDOW - SEED + 1
        while 2 * width <= span:
            x = np.minimum(x[:-width], x[width:])
            width *= 2
        x = np.minimum(x[: len(x) - (span - width)], x[span - width:]) if span > width else x
        return x[self.at]

    def super_kmers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, last word and minimiser of each super-k-mer."""
        if not len(self.at):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        m = self.minimisers()
        new = np.ones(len(m), bool)
        new[1:] = (np.diff(self.at) != 1) | (self.row[self.at[1:]] != self.row[self.at[:-1]]) | (m[1:] != m[:-1])
        run = np.flatnonzero(new)
        inside = np.arange(len(m)) - run[np.cumsum(new) - 1]
        new |= inside % LONGEST == 0
        run = np.flatnonzero(new)
        last = np.append(run[1:], len(m)) - 1
        return self.at[run], self.at[last] + WINDOW - 1, m[run]


def _cells(minimiser: np.ndarray, cells: int) -> np.ndarray:
    return ((minimiser >> np.uint64(20)) % np.uint64(cells)).astype(np.int64)


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))


def hot_cells(source: DataFrame, cells: int) -> np.ndarray:
    """Cells with very many super-k-mers; their number is bounded by ``HOT_SHARE``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in slices(batches, "text"):                     # one row per cell and task
            more = _cells(Windows(b.column(2)).super_kmers()[2], cells)
            c, at = np.unique(np.concatenate([c, more]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([n, np.ones(len(more), np.int64)]), minlength=len(c)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])

    counts = source.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "cells")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return np.array(sorted(r.cell for r in counts.where(F.col("n") > max(HOT_ROWS, total // HOT_SHARE)).select("cell").collect()), np.int64)


def _packed(doc: np.ndarray, own: np.ndarray, first: np.ndarray, words: list[bytes]) -> bytes:
    """The super-k-mers of one bucket and slice: their number, then compressed columns."""
    size = np.fromiter(map(len, words), np.int32, len(words))
    data = doc.tobytes() + own.tobytes() + first.tobytes() + size.tobytes() + b"".join(words)
    return struct.pack("<QQ", len(words), len(data)) + pa.compress(data, "zstd", asbytes=True)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    n, size = struct.unpack_from("<QQ", blob)
    data = pa.decompress(blob[16:], size, "zstd", asbytes=True)
    return (*(np.frombuffer(data, np.int64, n, 8 * n * k) for k in range(3)), np.frombuffer(data, np.int32, n, 24 * n), data[28 * n:])


def _same_windows(w: Windows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the windows that start at words ``i`` and ``j`` have the same words.  Overlapping pairs
    that go on side by side are compared as one passage, and one by one only if it differs."""
    order = np.argsort(i, kind="stable")
    x, y = i[order], j[order]
    run = np.flatnonzero((np.diff(x, prepend=-2) != 1) | (np.diff(y, prepend=-2) != 1))
    stop = np.append(run[1:], len(x)) if len(run) else run
    a, b, n = x[run].tolist(), y[run].tolist(), (stop - run).tolist()
    equal = np.array([w.text(p, p + k + WINDOW - 2) == w.text(q, q + k + WINDOW - 2) for p, q, k in zip(a, b, n)], bool)
    out = np.repeat(equal, stop - run)
    for r in np.flatnonzero(~equal).tolist():
        for k in range(int(run[r]), int(stop[r])):
            out[k] = w.text(x[k], x[k] + WINDOW - 1) == w.text(y[k], y[k] + WINDOW - 1)
    same = np.empty(len(x), bool)
    same[order] = out
    return same


def _bucket(parts: list[tuple]) -> pa.RecordBatch:
    """Intervals (doc, hash, start, stop) of the windows that a smaller document also has."""
    doc, own, first, size = (np.concatenate(x) for x in list(zip(*parts))[:4])
    offsets = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(p[4] for p in parts))])
    w = Windows(texts)
    h = window_hashes(w.hash, WINDOW)[w.at]
    row = w.row[w.at]
    order = np.lexsort((doc[row], h))
    hs, ds = h[order], doc[row][order]
    head = np.ones(len(hs), bool)
    head[1:] = hs[1:] != hs[:-1]
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]          # the smallest document of equal hashes
    later = np.flatnonzero(ds > ds[lead])
    i, j = w.at[order[later]], w.at[order[lead[later]]]
    same = _same_windows(w, i, j)
    hit = order[later[same]]
    clashing = np.unique(hs[later[~same]]) if len(later) else np.zeros(0, np.uint64)
    if len(clashing):                                         # different words of one hash: by the words
        group = np.flatnonzero(np.isin(h, clashing))
        keys = [w.text(x, x + WINDOW - 1) for x in w.at[group].tolist()]
        least: dict[bytes, int] = {}
        for k, d in zip(keys, doc[row[group]].tolist()):
            least[k] = min(d, least.get(k, d))
        hit = np.union1d(hit, [g for g, k in zip(group.tolist(), keys) if doc[row[g]] > least[k]]).astype(np.int64)
    hit = np.sort(hit)
    r = row[hit]
    begin = first[r] + w.at[hit] - w.first[r]
    new = np.ones(len(hit), bool)
    new[1:] = (r[1:] != r[:-1]) | (np.diff(begin) > WINDOW)
    run = np.flatnonzero(new)
    stop = begin[np.append(run[1:], len(hit)) - 1] + WINDOW if len(hit) else begin
    at = r[run]
    return pa.RecordBatch.from_arrays([pa.array(doc[at]), pa.array(own[at]), pa.array(begin[run], pa.int64()), pa.array(stop, pa.int64())],
                                      names=["doc", "hash", "start", "stop"])


def repeated_intervals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written table (doc, hash, start, stop) of word intervals to remove (they may overlap)."""
    source = _source(docs, doc_id, text)
    size = source.agg(F.sum(F.length("text"))).first()[0] or 0
    cells = max(1, size // (36 * CELL_ROWS))                  # six words start a super-k-mer
    hot = hot_cells(source, cells)

    buckets = max(1, 3 * size // BUCKET_BYTES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            w = Windows(b.column(2))
            i, j, m = w.super_kmers()
            cold = ~np.isin(_cells(m, cells), hot)
            i, j, m = i[cold], j[cold], m[cold]
            bucket = (mix(m) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            i, j, bucket = i[order], j[order], bucket[order]
            row = w.row[i]
            doc, own = b.column(0).to_numpy()[row], b.column(1).to_numpy()[row]
            first, a, z = i - w.first[row], w.start[i], w.end[j]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
            blobs = [_packed(doc[x:y], own[x:y], first[x:y], [w.plain[s:e] for s, e in zip(a[x:y].tolist(), z[x:y].tolist())])
                     for x, y in zip(cuts, [*cuts[1:], len(bucket)])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for bucket, blob in zip(b.column(0).to_pylist(), b.column(1)):
                if bucket != now and held:
                    yield _bucket(held)
                    held = []
                now = bucket
                held.append(_unpacked(blob.as_py()))
        if held:
            yield _bucket(held)

    kmers = source.mapInArrow(cut, "bucket long, blob binary")
    found = kmers.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(sort, "doc long, hash long, start long, stop long")
    if len(hot):
        def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text", 1 << 20):
                w = Windows(b.column(2))
                if not len(w.at):
                    continue
                at = w.at[np.isin(_cells(w.minimisers(), cells), hot)]
                row = w.row[at]
                packed = [w.plain[x:y] for x, y in zip(w.start[at].tolist(), w.end[at + WINDOW - 1].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(at - w.first[row], pa.int64())],
                                                 names=["words", "doc", "hash", "start"])

        one = source.mapInArrow(single, "words binary, doc long, hash long, start long")
        least = one.groupBy("words").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").drop("most")
        salt = F.pmod(F.xxhash64("doc"), F.lit(16)).cast("int")
        salted = one.withColumn("salt", salt).join(least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15)))), ["words", "salt"])
        found = found.union(salted.where("doc > least").select("doc", "hash", "start", (F.col("start") + WINDOW).alias("stop")))
    return materialise(found, "intervals")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", full: bool = True) -> DataFrame:
    """Per document row: its id, n_words, n_removed and the kept words joined by one space
    (``kept``), or the SHA-256 of that (``kept_sha256``)."""
    spans = repeated_intervals(docs, doc_id, text)
    per = spans.groupBy("doc", "hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans")).toDF("_doc", "_hash", "spans")
    per = F.broadcast(per) if spans.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else per
    src = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    both = src.join(per, (F.col("doc") == F.col("_doc")) & (F.col("hash") == F.col("_hash")), "left").select("id", "text", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))
    out = "kept string" if full else "kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            n, gone, kept = [], [], []
            for t, starts, stops in zip(*(b.column(i) for i in (1, 2, 3))):
                words = (t.as_py() or "").encode().split()
                n.append(len(words))
                if starts.is_valid and len(starts):
                    drop = np.zeros(len(words) + 1, np.int64)
                    np.add.at(drop, np.array(starts.as_py()), 1)
                    np.add.at(drop, np.array(stops.as_py()), -1)
                    stay = np.cumsum(drop[:-1]) == 0
                    words = [x for x, s in zip(words, stay.tolist()) if s]
                gone.append(n[-1] - len(words))
                joined = b" ".join(words)
                kept.append(joined.decode() if full else hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                             names=[doc_id, "n_words", "n_removed", out.split()[0]])

    kind = dict(docs.dtypes)[doc_id]
    return both.mapInArrow(run, f"`{doc_id}` {kind}, n_words long, n_removed long, {out}")
