"""Operator 11: ranked lexical search by dense blocked matrix products.

The items are the stated queries: their terms make a compact vocabulary.  One pass over the
documents counts the vocabulary's terms in each of them (the documents' postings, written once);
document frequencies and lengths come from the postings.  A second pass multiplies, for each tile
of documents, tiles of item weights (items x vocabulary) by the tile of document impacts
(vocabulary x documents), with the vocabulary compacted to the terms that occur in the tile.

All weights and impacts are integers.  They are multiplied in float64, and a vocabulary tile
ends before any item's weights in it could make a sum of 2^53; the tiles' products, each exact, are
added as 64-bit integers.  A tile's scores of at least an item's k-th best so far (ties
included) are merged into that item's best k, by score, then by id; a task returns k rows an
item at most, and the tasks' rows are ranked once more.

Scoring: w = floor(1000 ln((2N+2)/(2df+1))) in doubles, else 64-bit integers, divisions rounded
down: m = 25 + 75 n N / L, impact = 10^9 tf / (1000 tf + 8 m), score = sum of w x impact over the
item's terms, repeats included.  N documents have a term, L terms are in all, n in the document.

Items go in blocks (by a hash of their row) of at most ``BLOCK_TERMS`` distinct terms by item, an
item's own number if that is larger; a block is what is broadcast.  All documents are ranked for
each block.

Defined results: null and empty texts have no terms; such a document is in no ranking, such an
item has no rows.  Rows of one document id are documents of their own, equal scores of one id
are equal rows; rows without an id come after those with one.  Repeated items are ranked each
on its own.  Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import materialise, slices

BLOCK_TERMS = 2_000_000
DOC_TILE, TERM_TILE, ITEM_TILE = 512, 4096, 512
#: An impact is below 10^6, so sums of weights up to this keep products below 2^53.
MOST_WEIGHT = (1 << 53) // 10**6
PIECE = 4 << 20
_TABLE = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, in order; a long text comes in pieces."""
    data, at = text.encode().translate(_TABLE), 0
    while at < len(data):
        end = len(data) if len(data) - at <= PIECE else data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _item_rows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    src = items.select(F.col(item_id).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            counts = [sum(map(Counter, terms_of(t)), Counter()) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([list(c) for c in counts], pa.list_(pa.binary())), pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
                                              pa.array(list(map(len, counts)), pa.int64())], names=["item", "terms", "counts", "size"])

    kind = src.schema["item"].dataType.simpleString()
    return src.mapInArrow(run, f"item {kind}, terms array<binary>, counts array<long>, size long").where("size > 0").withColumn("salt", F.monotonically_increasing_id())


def _blocks(rows: DataFrame) -> list[DataFrame]:
    """The items in blocks of a proven number of terms."""
    total, largest = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    n = -(-total // BLOCK_TERMS)
    while n:
        parts = rows.withColumn("block", F.pmod(F.xxhash64("item", "salt"), F.lit(n)))
        sizes = parts.groupBy("block").agg(F.sum("size").alias("size"))
        # With so many blocks that a hash can't be blamed, an item of over half a block stands in the way.
        if sizes.agg(F.max("size")).first()[0] <= BLOCK_TERMS + largest:
            return [parts.where(F.col("block") == i) for i in range(n)]
        n *= 2
    return []


def _postings(docs: DataFrame, doc_id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: its number of terms, and which of the vocabulary's it has how often."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where("text <> ''")
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for b in slices(batches, "text"):
            n, ids, counts, ends = [], [], [], [0]
            for t in b.column(1):
                total, found = 0, Counter()
                for words in terms_of(t.as_py()):
                    total += len(words)
                    found.update(map(number, words))
                found.pop(None, None)
                n.append(total)
                ids.extend(found)
                counts.extend(found.values())
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                                              pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], names=["doc", "n", "terms", "tfs"])

    return src.mapInArrow(run, "doc long, n long, terms array<int>, tfs array<long>").where("n > 0")


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Items:
    """Weights of a block's items, by term: for each term the items that have it."""

    def __init__(self, rows: list, vocabulary: dict[bytes, int], term_tile: int = TERM_TILE, item_tile: int = ITEM_TILE, most: int = MOST_WEIGHT):
        self.n, self.term_tile, self.item_tile, self.most = len(rows), term_tile, item_tile, most
        sizes = [len(r.terms) for r in rows]
        item = np.repeat(np.arange(self.n), sizes)
        term = np.fromiter((vocabulary[bytes(t)] for r in rows for t in r.terms), np.int64, len(item))
        count = np.fromiter((c for r in rows for c in r.counts), np.int64, len(item))
        order = np.lexsort((item, term))
        self.item, self.count = item[order].astype(np.int32), count[order]
        self.first = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))

    def weigh(self, w: np.ndarray) -> Items:
        self.weight = self.count * np.repeat(w, np.diff(self.first))
        return self

    def tiles(self, terms: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(places in ``terms``, first item, weights as a dense items x terms tile).  A tile ends before
        the sum of an item's weights passes the bound; a weight of more than that goes in parts."""
        at = 0
        while at < len(terms):
            part = terms[at: at + self.term_tile]
            sizes = self.first[part + 1] - self.first[part]
            where = _ranges(self.first[part], sizes)
            item, place, rest = self.item[where], np.repeat(np.arange(len(part)), sizes), self.weight[where].copy()
            while rest.any():
                take = np.minimum(rest, self.most)
                # Running sums of each item's weights over the places; the tile ends before one passes the bound.
                order = np.lexsort((place, item))
                run = np.cumsum(take[order])
                begins = np.flatnonzero(np.r_[True, item[order][1:] != item[order][:-1]])
                run -= np.repeat((run - take[order])[begins], np.diff(np.r_[begins, len(order)]))
                over = place[order][run > self.most]
                take[place >= (over.min() if len(over) else len(part))] = 0
                rest -= take
                for low in range(0, self.n, self.item_tile):
                    own = (item >= low) & (item < low + self.item_tile) & (take > 0)
                    if own.any():
                        used, column = np.unique(place[own], return_inverse=True)
                        dense = np.zeros((min(self.item_tile, self.n - low), len(used)))
                        dense[item[own] - low, column] = take[own]
                        yield used + at, low, dense
            at += len(part)


class Best:
    """The best ``k`` documents of each item so far: by score, then by id (null last)."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score, self.doc, self.null = np.zeros((items, k), np.int64), np.zeros((items, k), np.int64), np.zeros((items, k), bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """``scores``: items x documents."""
        floor = np.maximum(self.score[:, -1], 1)
        for i in np.flatnonzero(scores.max(axis=1) >= floor):
            cand = np.flatnonzero(scores[i] >= floor[i])
            s = np.r_[self.score[i], scores[i][cand]]
            d, x = np.r_[self.doc[i], doc[cand]], np.r_[self.null[i], null[cand]]
            top = np.lexsort((d, x, -s))[: self.k]
            self.score[i], self.doc[i], self.null[i] = s[top], d[top], x[top]


def _rank(postings: DataFrame, items, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Each task's best k documents of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, best = items.value, None
        for b in batches:
            for at in range(0, b.num_rows, DOC_TILE):
                tile = b.slice(at, DOC_TILE)
                n = tile.column(1).to_numpy()
                lists, tfs = tile.column(2), tile.column(3).flatten().to_numpy()
                terms, size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
                if not len(terms):
                    continue
                best = best or Best(q.n, k)
                kinds, of = np.unique(n, return_inverse=True)
                m = np.array([25 + 75 * x * n_docs // n_terms for x in kinds.tolist()], np.int64)[of]     # whole numbers of any size
                column = np.repeat(np.arange(len(n)), size)
                present, row = np.unique(terms, return_inverse=True)
                impact = np.zeros((len(present), len(n)))
                impact[row, column] = 10**9 * tfs // (1000 * tfs + 8 * m[column])
                scores = np.zeros((q.n, len(n)), np.int64)
                for used, low, weights in q.tiles(present):
                    scores[low: low + len(weights)] += (weights @ impact[used]).astype(np.int64)
                doc = tile.column(0)
                best.add(scores, doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False))
        if best:
            item, place = np.nonzero(best.score)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(best.doc[item, place], pa.int64(), mask=best.null[item, place]), pa.array(best.score[item, place])],
                                             names=["row", "doc", "score"])

    return postings.mapInArrow(run, "row int, doc long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The ``k`` documents of highest score above 0 of each item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    out = None
    for block in _blocks(materialise(_item_rows(items, item_id, text), "search-items")):
        rows = block.collect()                   # a block: its number of terms was measured
        vocabulary: dict[bytes, int] = {}
        for r in rows:
            for t in r.terms:
                vocabulary.setdefault(bytes(t), len(vocabulary))
        postings = materialise(_postings(docs, doc_id, text, vocabulary), "search-postings")
        n_docs, n_terms = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():      # one row a term of the block
            df[r["term"]] = r["count"]
        w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) if x else 0 for x in df.tolist()], np.int64)
        weighed = spark.sparkContext.broadcast(Items(rows, vocabulary, TERM_TILE, ITEM_TILE, MOST_WEIGHT).weigh(w))
        order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
        ranked = _rank(postings, weighed, n_docs, n_terms, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = spark.createDataFrame([(i, r.item) for i, r in enumerate(rows)], f"row int, item {block.schema['item'].dataType.simpleString()}")
        done = ranked.join(named, "row").select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")
        out = done if out is None else out.unionByName(done)
    if out is None:
        kind = items.schema[item_id].dataType.simpleString()
        return spark.createDataFrame([], f"`{item_id}` {kind}, rank int, `{doc_id}` long, score long")
    return out
