"""Operator 13: alignment of two tokenizers' tokens, with corpus-wide pair counts.

A text is encoded as space + text by a byte-level BPE (A) and as text by a SentencePiece BPE (B,
which adds the space).  Byte offsets where tokens of both end cut the text into groups; all A
and B occurrences of a group are linked.  A pair's count is the number of documents that hold it
linked.

Counting is external.  A task aligns its documents and keeps (pair, document, number of links);
when these fill a spill, its distinct pairs, each with its number of documents there, are dealt
by the radix of the A id into runs: sorted, in zstd frames.  Runs of one radix are merged k-way
by a heap (``FAN`` at a time, in as many rounds as it takes), which sums each pair.  The merged
run is in A-major order, so an A id's highest count is known when its pairs end.  Then the totals
stream past the runs once more and return to each spill the counts of its pairs, from which its
documents' sums follow.  A task holds one spill, or one radix' totals (its A ids by the
vocabulary of B at most) and one run; however often an id occurs, a run has each pair once.

No rule of either tokenizer reads across a space that follows a non-space character (of B's
pieces none has its space mark behind another character, which is checked), so texts are cut there
and the parts' alignments are kept in a bounded memo.

Defined results: texts that are null or empty, or whose joined token bytes of A or B differ from
space + text, have no tokens: zeros and an empty ``groups_sha256``.  Repeated rows count as
documents of their own.  An empty table has no rows.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import itertools
import json
import pickle
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import byte_alphabet
from tidemark.llm.common import added, file_bytes, materialise, per_worker, slices

FAN = 256                                    # runs merged at a time
SPILL_RECORDS, SPILL_DOCS = 2_000_000, 20_000
FRAME = 65_536                               # pairs in a zstd frame of a run
MOST_PARTS = 8192
PIECE = 1 << 20                              # characters of a long text that are cut at a time
SHORT = 64                                   # parts of at most so many bytes are learnt together
MARK = "▁"
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_CUT, _ODD = re.compile(r"(?<=\S) (?!\Z)"), re.compile(r" (?:\s|\Z)")
_NONE = (b"", "", b"", b"")
# --- fixed values: the split pattern of byte-level tokenizer files ---
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --- end of fixed values ---


def _cuts(text: str) -> Iterator[list[str]]:
    """The parts of a text, each of which stands for itself with a space in front."""
    at = 0
    while at < len(text):
        end = None
        if len(text) - at > PIECE and (m := _CUT.search(text, at + PIECE)):
            end = m.start()
        piece = text[at:end]
        yield _CUT.split(piece) if _ODD.search(" " + piece) else piece.split(" ")
        at = len(text) if end is None else end + 1


class Aligner:
    """Alignments of texts under two tokenizer files (pickled as one payload)."""

    def __init__(self, payload: bytes, entries: int = 250_000):
        import sentencepiece
        import tiktoken

        a, b = pickle.loads(payload)
        spec = json.loads(a)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True):
            raise ValueError("this tokenizer file has rules that the cut at spaces does not know")
        byte_of = {c: i for i, c in enumerate(byte_alphabet())}
        special = {t["content"] for t in spec["added_tokens"]}
        vocabulary = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        # With merges in the order of their ids, the id of a merged token is its rank.
        if any(vocabulary[x + y] != 256 + i for i, (x, y) in enumerate(merges)) or len(ranks) != 256 + len(merges):
            raise ValueError("the ids of this tokenizer file don't follow its merges")
        self.a = tiktoken.Encoding("a", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes_a[i] = t
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece reads across a space; texts can't be cut there")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.width = len(pieces)
        self.entries, self.young, self.old = entries, {}, {}

    def learn(self, parts: set[str]) -> None:
        """Put the alignments of ``parts`` into the memo."""
        if len(self.young) > self.entries:
            self.young, self.old = {}, self.young
        short = []
        for p in parts:
            if p in self.young:
                continue
            known = self.old.get(p)
            if known is not None:
                self.young[p] = known
            elif len(p) <= SHORT and MARK not in p and not p[0].isspace() and not p[-1].isspace():
                short.append(p)
            else:
                self.young[p] = self._one(p)
        for at in range(0, len(short), 2000):
            self._many(short[at: at + 2000])

    def forget_long(self, parts: Iterable[str]) -> None:
        for p in [p for p in parts if len(p) > SHORT]:
            self.young.pop(p, None)

    def _many(self, parts: list[str]) -> None:
        """Parts that neither begin nor end with white space, encoded as one text."""
        text = " ".join(parts)
        x, y = self.a.encode_ordinary(" " + text), self.b.encode(text)
        data = b" " + text.encode()
        ids_a, ids_b = np.array(x, np.int64), np.array(y, np.int64)
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        if b"".join([self.bytes_a[i] for i in x]) != data or b"".join([self.bytes_b[i] for i in y]) != data or not np.isin(ends, both).all():
            for p in parts:
                self.young[p] = self._one(p)
            return
        in_a, in_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        n_a, n_b = np.bincount(in_a, minlength=len(both)), np.bincount(in_b, minlength=len(both))
        from_a, from_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        part = np.searchsorted(ends, both)
        # Every A token with each B token of its group.
        times = n_b[in_a]
        other = np.repeat(from_b[in_a] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        key = np.repeat(ids_a, times) * self.width + ids_b[other]
        of = np.repeat(part[in_a], times)
        order = np.lexsort((key, of))
        key, of = key[order], of[order]
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (of[1:] != of[:-1])])
        links = np.diff(np.r_[new, len(key)])
        key, of = key[new], of[new]
        cut = np.searchsorted(of, np.arange(len(parts) + 1)).tolist()
        key_bytes, link_bytes = key.tobytes(), links.astype(np.int64).tobytes()
        numbers = np.stack([np.bincount(part, weights=w, minlength=len(parts)) for w in (n_a, n_b, np.ones(len(part)), n_a * n_b)], axis=1).astype(np.int64).tobytes()
        s, t = list(map(str, x)), list(map(str, y))
        shown = [(s[i] if k == 1 else ",".join(s[i: i + k])) + "|" + (t[j] if m == 1 else ",".join(t[j: j + m])) for i, k, j, m in zip(from_a.tolist(), n_a.tolist(), from_b.tolist(), n_b.tolist())]
        group = np.searchsorted(part, np.arange(len(parts) + 1)).tolist()
        for i, p in enumerate(parts):
            self.young[p] = (numbers[32 * i: 32 * i + 32], ";".join(shown[group[i]: group[i + 1]]), key_bytes[8 * cut[i]: 8 * cut[i + 1]], link_bytes[8 * cut[i]: 8 * cut[i + 1]])

    def _one(self, part: str) -> tuple[bytes, str, bytes, bytes]:
        """Any part; pairs of a group are made from its distinct ids, however long it is."""
        data = b" " + part.encode()
        x, y = self.a.encode_ordinary(" " + part), self.b.encode(part)
        if b"".join([self.bytes_a[i] for i in x]) != data or b"".join([self.bytes_b[i] for i in y]) != data:
            return _NONE
        ids_a, ids_b = np.array(x, np.int64), np.array(y, np.int64)
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        to_a, to_b = (np.searchsorted(e, both, "right").tolist() for e in (end_a, end_b))
        shown, found, n_links, i, j = [], Counter(), 0, 0, 0
        for k, m in zip(to_a, to_b):
            shown.append(",".join(map(str, x[i:k])) + "|" + ",".join(map(str, y[j:m])))
            n_links += (k - i) * (m - j)
            right = Counter(y[j:m]).items()
            for a, c in Counter(x[i:k]).items():
                for b, d in right:
                    found[a * self.width + b] += c * d
            i, j = k, m
        keys = sorted(found)
        return (np.array([len(x), len(y), len(both), n_links], np.int64).tobytes(), ";".join(shown), np.array(keys, np.int64).tobytes(), np.array([found[k] for k in keys], np.int64).tobytes())

    def align(self, pieces: Iterable[list[str]]) -> tuple[np.ndarray, str, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, n_links; the digest of the groups; distinct pairs and their links."""
        numbers, digest, keys, links, first = np.zeros(4, np.int64), hashlib.sha256(), np.zeros(0, np.int64), np.zeros(0, np.int64), True
        for parts in pieces:
            count = Counter(parts)
            own, shown, key, link = zip(*map(self.young.__getitem__, count))
            if not all(own):
                return np.zeros(4, np.int64), "", np.zeros(0, np.int64), np.zeros(0, np.int64)
            times = np.fromiter(count.values(), np.int64, len(count))
            numbers += times @ np.frombuffer(b"".join(own), np.int64).reshape(-1, 4)
            text_of = dict(zip(count, shown))
            digest.update(("" if first else ";").encode() + ";".join(map(text_of.__getitem__, parts)).encode())
            size = np.fromiter(map(len, key), np.int64, len(key)) >> 3
            link = np.frombuffer(b"".join(link), np.int64) * np.repeat(times, size)
            key = np.concatenate([keys, np.frombuffer(b"".join(key), np.int64)])
            order = np.argsort(key, kind="stable")
            key, link = key[order], np.concatenate([links, link])[order]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            keys, links, first = key[new], np.add.reduceat(link, new) if len(new) else link, False
        return (numbers, digest.hexdigest(), keys, links) if not first else (numbers, "", keys, links)


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(arrays).tobytes())


def _unsqueeze(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int64)


def pack_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run: zstd frames of key differences and counts, each with its size in front."""
    out = []
    for at in range(0, len(keys), FRAME):
        k = keys[at: at + FRAME]
        frame = _squeeze(np.diff(k, prepend=0), counts[at: at + FRAME])
        out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def read_run(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    while at < len(data):
        size = int.from_bytes(data[at: at + 4], "little")
        both = _unsqueeze(data[at + 4: at + 4 + size])
        n = len(both) // 2
        yield np.cumsum(both[:n]), both[n:]
        at += 4 + size


def merge_runs(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The runs merged by a heap: frames of each pair once, with its summed count."""
    def pairs(run):
        for k, c in read_run(run):
            yield from zip(k.tolist(), c.tolist())

    keys, counts, last = [], [], None
    for key, count in heapq.merge(*map(pairs, runs)):
        if key == last:
            counts[-1] += count
            continue
        if len(keys) == FRAME:
            yield np.array(keys, np.int64), np.array(counts, np.int64)
            keys, counts = [], []
        keys.append(key)
        counts.append(count)
        last = key
    if keys:
        yield np.array(keys, np.int64), np.array(counts, np.int64)


class _Spill:
    """Documents of a task until their records fill a spill."""

    def __init__(self, parts: int, width: int):
        self.parts, self.width = parts, width
        self.kept, self.keys, self.links, self.n = [], [], [], 0

    def add(self, kept: pa.RecordBatch, keys: list[np.ndarray], links: list[np.ndarray]) -> None:
        self.kept.append(kept)
        self.keys += keys
        self.links += links
        self.n += sum(map(len, keys))

    def rows(self) -> Iterator[tuple[str, int, bytes]]:
        """(spill, radix, run) rows, and one of radix -1 with the documents and their records."""
        name = uuid.uuid4().hex
        distinct, place, docs = np.unique(np.concatenate(self.keys), return_inverse=True, return_counts=True)
        radix = distinct // self.width % self.parts
        order = np.argsort(radix, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        distinct, docs, radix = distinct[order], docs[order], radix[order]
        table = pa.Table.from_batches(self.kept).combine_chunks()
        with pa.BufferOutputStream() as out:
            with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            head = out.getvalue().to_pybytes()
        wide = any(len(x) and x.max() >> 31 for x in self.links)
        records = np.concatenate([[len(k) for k in self.keys], rank[place], *self.links]).astype(np.int64 if wide else np.int32)
        yield name, -1, len(head).to_bytes(8, "little") + bytes([wide]) + head + zstandard.ZstdCompressor(level=1).compress(records.tobytes())
        cut = np.flatnonzero(np.r_[True, radix[1:] != radix[:-1]]).tolist() if len(radix) else []
        for a, b in zip(cut, [*cut[1:], len(radix)]):
            yield name, int(radix[a]), pack_run(distinct[a:b], docs[a:b])
        self.kept, self.keys, self.links, self.n = [], [], [], 0


def _documents(spill: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """The kept columns, and records by document: how many, which pair (in the spill's order), links."""
    size, wide = int.from_bytes(spill[:8], "little"), spill[8]
    table = pa.ipc.open_stream(spill[9: 9 + size]).read_all()
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(spill[9 + size:]), np.int64 if wide else np.int32).astype(np.int64)
    n = table.num_rows
    m = (len(data) - n) // 2
    return table, data[:n], data[n: n + m], data[n + m:]


_RUNS = "spill string, radix int, run binary"


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _spills(src: DataFrame, payload, radices: int, schema: T.StructType) -> DataFrame:
    """Align the texts (the last column) and write spills."""
    last = len(src.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(100_000, 50, 100)       # the memo's many small objects are in no cycles
        aligner = per_worker("aligner", payload.value, Aligner)
        spill = _Spill(radices, aligner.width)

        def out():
            for row in spill.rows():
                yield _batch([row], ["spill", "radix", "run"], [pa.string(), pa.int32(), pa.binary()])

        for b in slices(batches, last, 1 << 20):
            texts = [t or "" for t in b.column(last).to_pylist()]
            cut = [list(_cuts(t)) if len(t) <= PIECE else None for t in texts]
            parts = {p for c in cut if c for x in c for p in x}
            aligner.learn(parts)
            done = []
            for t, c in zip(texts, cut):
                done.append(aligner.align(c if c is not None else _learning(aligner, t)))
            aligner.forget_long(parts)
            made = [pa.array(x) for x in np.array([d[0] for d in done], np.int64).reshape(-1, 4).T] + [pa.array([d[1] for d in done], pa.string())]
            spill.add(pa.RecordBatch.from_arrays([*b.columns[:-1], *made], names=schema.names), [d[2] for d in done], [d[3] for d in done])
            if spill.n >= SPILL_RECORDS or len(spill.keys) >= SPILL_DOCS:
                yield from out()
        if spill.keys:
            yield from out()

    return src.mapInArrow(run, _RUNS)


def _learning(aligner: Aligner, text: str) -> Iterator[list[str]]:
    """The pieces of a very long text, each learnt when it is asked for."""
    for parts in _cuts(text):
        aligner.learn(set(parts))
        yield parts
        aligner.forget_long(parts)


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first ``keys`` columns; a group's rows must be used up first."""
    rows = (r for b in batches for i in range(b.num_rows) for r in [tuple(c[i].as_py() for c in b.columns)])
    return itertools.groupby(rows, key=lambda r: r[:keys])


def _merged(runs: DataFrame) -> DataFrame:
    """One run per (radix, bundle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (radix, bundle), rows in _grouped(batches, 2):
            merged = b"".join(pack_run(k, c) for k, c in merge_runs([r[2] for r in rows]))
            yield _batch([(radix, bundle, merged)], ["radix", "bundle", "run"], [pa.int32(), pa.int64(), pa.binary()])

    return runs.select("radix", "bundle", "run").repartition("radix", "bundle").sortWithinPartitions("radix", "bundle").mapInArrow(run, "radix int, bundle long, run binary")


def _returned(totals: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """Per run its pairs' total counts, doubled, plus one for an A id's highest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (radix, _), rows in _grouped(batches, 2):
            keys, marked = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for _, _, spill, data in rows:
                both = list(read_run(data))
                own = np.concatenate([k for k, _ in both])
                if spill is None:                # the totals come first
                    keys, counts = own, np.concatenate([c for _, c in both])
                    begins = np.flatnonzero(np.r_[True, keys[1:] // width != keys[:-1] // width])
                    most = np.repeat(np.maximum.reduceat(counts, begins), np.diff(np.r_[begins, len(keys)]))
                    marked = counts * 2 + (counts == most)
                else:
                    yield _batch([(spill, radix, _squeeze(marked[np.searchsorted(keys, own)]))], ["spill", "radix", "run"], [pa.string(), pa.int32(), pa.binary()])

    both = totals.select("radix", "bundle", F.lit(None).cast("string").alias("spill"), "run").unionByName(runs)
    return both.repartition("radix", "bundle").sortWithinPartitions("radix", "bundle", F.col("spill").asc_nulls_first()).mapInArrow(run, _RUNS)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, keep: list[str], text: str = "text", parts: int | None = None) -> DataFrame:
    """The ``keep`` columns, then per document n_a, n_b, n_groups, n_links, groups_sha256 (of
    ``a1,a2|b1;...``), n_best (links whose count is their A id's highest) and count_sum (over links).
    ``keep`` may not hold the names of the made columns.  ``parts``: radices of the A ids."""
    spark = docs.sparkSession
    parts = parts or min(MOST_PARTS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    src = docs.select(*keep, F.col(text).alias("_text"))
    long = T.LongType()
    aligned = added(src, **dict.fromkeys(NUMBERS, long), groups_sha256=T.StringType())
    schema = added(src, **dict.fromkeys(NUMBERS, long), groups_sha256=T.StringType(), n_best=long, count_sum=long)
    files = pickle.dumps((file_bytes(a_path), file_bytes(b_path)))
    payload = spark.sparkContext.broadcast(files)
    width = Aligner(files).width
    spills = materialise(_spills(src, payload, parts, aligned), "alignment-spills")
    n = spills.where("radix < 0").count()
    bundles = max(1, -(-n // FAN))
    runs = spills.where("radix >= 0").select("radix", F.pmod(F.xxhash64("spill"), F.lit(bundles)).cast("long").alias("bundle"), "spill", "run")
    totals, left = _merged(runs), bundles
    while left > 1:
        left = -(-left // FAN)
        totals = _merged(totals.withColumn("bundle", F.pmod("bundle", F.lit(left)).cast("long")))
    totals = totals.select("radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long"))).alias("bundle"), "run")
    back = _returned(totals, runs, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, 1):
            _, _, own = next(rows)               # radix -1: the documents
            table, size, place, links = _documents(own)
            counts = [_unsqueeze(r[2]) for r in rows]
            marked = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            sums = [np.r_[0, np.cumsum(links * v[place])] for v in (marked & 1, marked >> 1)]
            end = np.cumsum(size)
            columns = [pa.array(s[end] - s[end - size]) for s in sums]
            for c, f in zip(columns, schema.names[-2:]):
                table = table.append_column(f, c)
            yield from table.to_batches(max_chunksize=10_000)

    return spills.where("radix < 0").unionByName(back).repartition("spill").sortWithinPartitions("spill", "radix").mapInArrow(run, schema)
