"""Operator 10: near-duplicates by BagMinHash signatures of word-shingle multisets.

A document is the multiset of its five-word shingles (words lie between ASCII white space;
fewer than five words are one shingle).  Two documents are linked when the sum of the
smaller multiplicities is at least 80 % of the sum of the larger ones (weighted Jaccard).

Signature.  Each shingle owns Poisson processes over the discretised weight axis: one for
each dyadic interval (0,1], (1,2], (2,4], (4,8] ..., of a rate equal to its width, started
from the shingle's hash.  Every point has a time, a signature position and a unit cell of
its interval; a document of multiplicity w sees the points whose cell is at most w (in the
last interval only that part).  The signature holds the earliest time per position, so two
documents agree at a position with exactly their weighted Jaccard similarity.  Points later
than a bound near which all positions are expected to be filled are never generated;
documents with an empty position are run again with twice the bound.

Links.  Exact copies are folded first.  Documents that agree on all rows of a band share a
bucket; every member is compared with the bucket's first document.  Then, where a bucket
still holds documents of several components, each member outside its largest component is
compared with all members of other components, so no pair of a bucket is left out unless
its ends are connected already or it can't reach the similarity.  In buckets where many
pairs are left, the shingles that only one of their documents has are counted first, and each
document gets a bit set of the cells that its shingles hash into: shingles and cells of one
side alone bound the similarity of every pair (from above, so no link is lost).  In a few rounds
those apart are compared with single members of the largest component.  What is still very
crowded then is compared by a second band, and where components are left, by the rarest shingles
of each document, of which any pair that reaches the similarity shares one.  All comparisons
count shingles exactly.

Defined results: a null text, or one without words, has no shingles and is alone.  Rows with
one id are one document whose links are those of all its rows.  A null id can't stand for
a class: such a row has the class of its copies, else null.  Ties take the smallest id.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, mix, slices, utf8_rows, window_hashes, word_hashes, words_of

SHINGLE, SIMILARITY_PERCENT = 5, 80
BANDS, ROWS = 30, 5
#: Buckets with more pairs to compare than this are crowded; above the second, a second band and then rare
#: shingles split them.
CROWDED, SPLIT = 200, 10_000_000
#: 64-bit words of a document's bit set of shingle cells (columns).
BITS = [f"bits{i}" for i in range(16)]
#: Rounds of comparisons with single documents in crowded buckets, before all pairs.
HUBS = 2
#: Ids of candidates are sent to all executors below this number (16 MB), joined by a shuffle above.
BROADCAST_IDS = 1_000_000


def _uniform(seed: np.ndarray) -> np.ndarray:
    return ((mix(seed) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, size: int) -> np.ndarray:
    """BagMinHash signatures (rows x size, earliest times) of weighted elements (rows without
    elements keep infinite times)."""
    out = np.full(rows * size, np.inf)
    total = np.bincount(row, weights=weight, minlength=rows)
    # One process per element and dyadic interval that the weight reaches into.
    parts, low = [], 0
    who = np.arange(len(row))
    while len(who):
        width = max(1, low)
        parts.append((who, np.full(len(who), low), np.full(len(who), width)))
        low += width
        who = who[weight[who] > low]
    of, lows, widths = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
    seeds = mix(element[of] + mix(lows.astype(np.uint64) + np.uint64(0x51ED)))
    reach = weight[of] - lows                    # cells of the interval that count
    line = row[of]
    bound = np.full(rows, size * (math.log(size) + 5.0)) / np.maximum(total, 1)
    while True:
        todo = np.flatnonzero((total > 0) & np.isinf(out.reshape(rows, size)).any(axis=1))
        if not len(todo):
            return out.reshape(rows, size)
        wanted = np.zeros(rows, bool)
        wanted[todo] = True
        at = np.flatnonzero(wanted[line])
        time = np.zeros(len(at))
        step = 0
        while len(at):
            s = seeds[at] + np.uint64(step * 0xD1B54A32D192ED03 & (1 << 64) - 1)
            time = time - np.log(_uniform(s)) / widths[at]
            alive = time <= bound[line[at]]
            at, time, s = at[alive], time[alive], s[alive]
            place = mix(s ^ np.uint64(0xA0761D6478BD642F))
            seen = (place >> np.uint64(32)) % widths[at].astype(np.uint64) < reach[at].astype(np.uint64)
            slot = line[at] * size + ((place & np.uint64(0xFFFFFFFF)) % np.uint64(size)).astype(np.int64)
            np.minimum.at(out, slot[seen], time[seen])
            step += 1
        bound[todo] *= 2


def shingle_bags(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and multiplicity of the distinct shingles of each text."""
    raw, offsets = utf8_rows(col)
    a, b, row, counts = words_of(raw, offsets)
    h = word_hashes(raw, a, b)
    rows, hashes = [], []
    if len(h) >= SHINGLE:
        own = np.flatnonzero(row[SHINGLE - 1:] == row[: len(row) - SHINGLE + 1])
        rows.append(row[own])
        hashes.append(window_hashes(h, SHINGLE)[own])
    first = np.concatenate([[0], np.cumsum(counts)])
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)).tolist():
        rows.append(np.array([i]))
        hashes.append(window_hashes(h[first[i]: first[i + 1]], int(counts[i])) + np.uint64(counts[i]))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    r, x = np.concatenate(rows), np.concatenate(hashes)
    _, at, n = np.unique(mix(x + r.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)), return_index=True, return_counts=True)
    return r[at], x[at], n


def _content(text: str | None) -> bytes:
    return hashlib.blake2b(b" ".join((text or "").encode().split()), digest_size=16).digest()


def signed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """id, content (digest of the word sequence; null without words), weight (shingles) and one
    64-bit key per band."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text", 4 << 20):
            col, n = b.column(1), b.num_rows
            row, element, weight = shingle_bags(col)
            times = signatures(row, element, weight, n, BANDS * ROWS).view(np.uint64).reshape(n * BANDS, ROWS)
            keys = np.zeros(n * BANDS, np.uint64)
            for i in range(ROWS):
                keys = mix(keys * np.uint64(0x9FB21C651E98DF25) + times[:, i])
            total = np.bincount(row, weights=weight, minlength=n).astype(np.int64)
            content = [_content(t.as_py()) if w else None for t, w in zip(col, total)]
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32()), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(content, pa.binary()), pa.array(total), bands], names=["id", "content", "weight", "bands"])

    return src.mapInArrow(run, "id long, content binary, weight long, bands array<long>")


def _bag(text: str) -> Counter:
    words = text.encode().split()
    return Counter(zip(*[words[i:] for i in range(SHINGLE)])) if len(words) >= SHINGLE else Counter([tuple(words)] if words else [])


def similar(a: Counter, b: Counter) -> bool:
    """Whether two shingle multisets reach the similarity (in whole numbers, exact)."""
    small, large = sorted((a, b), key=len)
    both = sum([min(n, large[s]) for s, n in small.items() if s in large])
    return 100 * both >= SIMILARITY_PERCENT * (a.total() + b.total() - both) and both > 0


def _few(ids: DataFrame) -> DataFrame:
    """``ids`` marked for broadcast if there are few enough."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def verified(pairs: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity; the texts of candidates only are moved."""
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near-ids")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    texts = materialise(own.join(_few(ids), "id", "left_semi"), "near-texts")
    both = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag = None, Counter()
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column(2), batch.column(3)):
                ta = ta.as_py()
                if ta != last:
                    last, bag = ta, _bag(ta)
                keep.append(similar(bag, _bag(tb.as_py())))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of all ends of ``edges`` (a, b), root the smallest id that is connected: large-star
    and small-star steps in turn, each result written to a table, until the edges are stars
    (every end has one root, and no root has another)."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        """Edges (a, b) with a > b, no two alike, in and out."""
        both = (e.union(e.select("b", "a")) if large else e).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = both.join(low, "u")
        if large:
            return out.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        return out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(out.select("u", "m")).where("a != b").distinct()

    state = materialise(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        ends = state.groupBy("a").agg(F.count("*").alias("n"))
        if ends.where("n > 1").isEmpty() and state.select(F.col("b").alias("a")).join(state.select("a"), "a", "left_semi").isEmpty():
            return state.select(F.col("a").alias("id"), F.col("b").alias("root"))
        state = materialise(star(star(state, True), False), "edges")


def _mixed(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows of buckets with several components: the bucket's largest component (``top``), the
    number of pairs that it may have to compare (``work``)."""
    per = rows.groupBy(*key, "root").agg(F.count("*").alias("n"))
    of = (per.groupBy(*key).agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all"), F.count("*").alias("roots")).where("roots > 1")
          .select(*key, F.col("most.root").alias("top"), ((F.col("all") - F.col("most.n")) * F.col("all")).alias("work")))
    return rows.join(of, key)


def _across(rows: DataFrame, key: list[str], bounds: bool = True) -> DataFrame:
    """Pairs of a bucket between a row outside the largest component and a row of another one.
    With ``bounds``, ``own`` shingles of a row are in no other text of the bucket, and a bit
    that only one row has set is a shingle that isn't shared: both bound the overlap (bits only
    if both ids have one text, ``alone``)."""
    names = ["id", "root", "weight", *(["own", "alone", *BITS] if bounds else [])]
    x = rows.where("root != top").select(*key, *[F.col(c).alias(f"a_{c}") for c in names])
    y = rows.select(*key, (F.col("root") == F.col("top")).alias("main"), *[F.col(c).alias(f"b_{c}") for c in names])
    near = _reachable("a_weight", "a_own" if bounds else "0", "b_weight", "b_own" if bounds else "0")
    if bounds:
        apart = lambda p, q: " + ".join(f"bit_count({p}_{c} & ~{q}_{c})" for c in BITS)
        near += f" and (not (a_alone and b_alone) or {_reachable('a_weight', f'({apart("a", "b")})', 'b_weight', f'({apart("b", "a")})')})"
    return (x.join(y, key).where(f"a_root != b_root and (main or a_id < b_id) and {near}")
            .select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")))


def _reachable(wa: str, oa: str, wb: str, ob: str) -> str:
    """Whether weights, less what is surely not shared, let a pair reach the similarity."""
    return f"{100 + SIMILARITY_PERCENT} * least({wa} - {oa}, {wb} - {ob}) >= {SIMILARITY_PERCENT} * ({wa} + {wb})"


def own_shingles(docs: DataFrame, folded: DataFrame, ids: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, own, alone, bits): the number of shingles that only this one of the documents ``ids``
    has, at least, whether the id has one text, and a bit set for each hash cell that one of its
    shingles falls into.  For an id with several texts: no shingles, and bits that say nothing."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("_text")).join(_few(ids), "id", "left_semi")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text", 1 << 20):
            row, element, weight = shingle_bags(b.column(1))
            digest = pa.array([_content(t.as_py()) for t in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([digest.take(pa.array(row)), pa.array(element.view(np.int64)), pa.array(weight, pa.int64())], names=["content", "shingle", "n"])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text", 1 << 20):
            row, element, _ = shingle_bags(b.column(1))
            bits = np.zeros((b.num_rows, len(BITS)), np.uint64)
            cell = mix(element) % np.uint64(64 * len(BITS))
            np.bitwise_or.at(bits, (row, (cell >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (cell & np.uint64(63)))
            digest = pa.array([_content(t.as_py()) for t in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([digest, *(pa.array(bits[:, i].view(np.int64)) for i in range(len(BITS)))], names=["content", *BITS])

    one = src.mapInArrow(each, "content binary, shingle long, n long").groupBy("shingle").agg(F.min("content").alias("content"), F.max("content").alias("last"), F.min("n").alias("n"))
    own = one.where("content = last").groupBy("content").agg(F.sum("n").alias("own"))
    bits = src.mapInArrow(cells, "content binary, " + ", ".join(f"{c} long" for c in BITS)).dropDuplicates(["content"])
    got = folded.join(_few(ids), "id", "left_semi").join(own, "content", "left").join(bits, "content")
    alone = F.count("*") == 1
    return materialise(got.groupBy("id").agg(F.when(alone, F.coalesce(F.max("own"), F.lit(0))).otherwise(0).alias("own"), alone.alias("alone"), *[F.when(alone, F.max(c)).otherwise(-1).alias(c) for c in BITS]), "near-own")


def rare_shingles(docs: DataFrame, folded: DataFrame, ids: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, shingle, copy): of each text of the documents ``ids``, the rarest fifth of its shingles
    and one more, copies counted one by one.  Texts that reach the similarity share one of these: had
    the one with the earlier last of them none in common, over a fifth of it would not be shared."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("_text")).join(_few(ids), "id", "left_semi")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text", 1 << 20):
            row, element, weight = shingle_bags(b.column(1))
            digest = pa.array([_content(t.as_py()) for t in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([digest.take(pa.array(row)), pa.array(element.view(np.int64)), pa.array(weight, pa.int64())], names=["content", "shingle", "n"])

    bags = src.mapInArrow(each, "content binary, shingle long, n long").distinct()
    items = materialise(bags.select("content", "shingle", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")), "near-shingles")
    texts = items.groupBy("shingle", "copy").agg(F.count("*").alias("texts"))
    place = F.row_number().over(Window.partitionBy("content").orderBy("texts", "shingle", "copy"))
    ranked = items.join(texts, ["shingle", "copy"]).withColumn("place", place)
    weights = folded.join(_few(ids), "id", "left_semi").select("content", "id", "weight")
    first = ranked.join(weights, "content").where(f"100 * (place - 1) <= {100 - SIMILARITY_PERCENT} * weight")
    return materialise(first.select("id", "shingle", "copy").distinct(), "near-rare")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: its id, ``class_id`` (the smallest id of its class) and
    ``n_shingles``."""
    signs = materialise(signed(docs, id_col, text), "signatures")
    folded = materialise(signs.where("content is not null").groupBy("content").agg(F.min("id").alias("id"), F.first("weight").alias("weight"), F.first("bands").alias("bands")), "folded")
    # Rows of one id with several texts link their representatives.
    several = materialise(signs.where("id is not null and content is not null").groupBy("id").agg(F.min("content").alias("low"), F.max("content").alias("high")).where("low != high").select("id"), "several")
    known = None
    if not several.isEmpty():
        reps = signs.select("id", "content").join(several, "id", "left_semi").join(folded.select("content", F.col("id").alias("rep")), "content")
        known = reps.join(reps.groupBy("id").agg(F.min("rep").alias("a")), "id").select("a", F.col("rep").alias("b")).where("a != b").distinct()
    bands = folded.where("id is not null").select("id", "weight", F.posexplode("bands").alias("band", "key"))
    key = ["band", "key"]
    lead = bands.groupBy(*key).agg(F.min(F.struct("id", "weight")).alias("lead"), F.count("*").alias("n")).where("n > 1")
    first = (bands.join(lead, key).where(f"id != lead.id and {_reachable('weight', '0', 'lead.weight', '0')}").select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct())
    state = _Links(docs, id_col, text)
    state.add(first, known)

    mixed = materialise(_mixed(state.rooted(bands), key), "near-mixed").drop("root", "top")
    crowded, rest = mixed.where(f"work > {CROWDED}").drop("work"), None
    if not crowded.isEmpty():
        own = own_shingles(docs, folded, materialise(crowded.select("id").distinct(), "near-ids"), id_col, text)
        crowded = materialise(crowded.join(own, "id"), "near-crowded")
        # Before all pairs: compare those that are apart with one document of the largest component,
        # first the one with the fewest shingles of its own, then others, in each bucket another.
        for turn in range(HUBS):
            now = _mixed(state.rooted(crowded), key)
            order = F.col("own") if not turn else F.xxhash64("id", "band", F.lit(turn))
            hub = now.where("root = top").groupBy(*key).agg(F.min(F.struct(order.alias("order"), "id", "own", "weight")).alias("hub"))
            more = state.add(now.where("root != top").join(hub, key).where(_reachable("weight", "own", "hub.weight", "hub.own"))
                             .select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct())
            if turn and not more:
                break
        # Documents with too many shingles of their own link to none of their crowded buckets.
        able = materialise(_mixed(state.rooted(crowded.where(f"100 * (weight - own) >= {SIMILARITY_PERCENT} * weight")), key), "near-able")
        rest = _across(able.where(f"work <= {SPLIT}"), key)
        large = able.where(f"work > {SPLIT}").select("id", "weight", "own", "alone", *BITS, "root", F.col("band").alias("band0"), F.col("key").alias("key0"))
        if not large.isEmpty():
            state.add(_across(_mixed(large.join(bands.select("id", "band", "key"), "id").where("band > band0"), finer := ["band0", "key0", *key]), finer).distinct())
            # Pairs that share no second band: by rare shingles, where components are left.
            left = materialise(_mixed(state.rooted(large.drop("root")), ["band0", "key0"]).drop("top", "work"), "near-left")
            if not left.isEmpty():
                rare = rare_shingles(docs, folded, materialise(left.select("id").distinct(), "near-ids"), id_col, text)
                finer = ["band0", "key0", "shingle", "copy"]
                rest = rest.union(_across(_mixed(left.join(rare, "id"), finer), finer))
    few = _across(_mixed(state.rooted(mixed.where(f"work <= {CROWDED}").drop("work")), key), key, bounds=False)
    state.add((few if rest is None else few.union(rest)).distinct())

    rep = folded.join(state.roots, "id", "left").select("content", F.coalesce("root", "id").alias("class_id"))
    return (signs.join(rep, "content", "left")
            .select(F.col("id").alias(id_col), F.when(F.col("content").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.col("weight").alias("n_shingles")))


class _Links:
    """The links found so far, the pairs that were compared, and the components."""

    def __init__(self, docs: DataFrame, id_col: str, text: str):
        self.docs, self.id_col, self.text = docs, id_col, text
        self.seen = self.roots = None

    def add(self, pairs: DataFrame, known: DataFrame | None = None) -> bool:
        """Compare pairs (a < b) that weren't compared yet; ``known`` are links as they are.
        Whether new links were found."""
        if self.seen is not None:
            pairs = pairs.join(self.seen, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "near-pairs")
        if self.seen is not None and pairs.isEmpty():
            return False
        links = verified(pairs, self.docs, self.id_col, self.text)
        links = materialise(links.union(known) if known is not None else links, "near-links")
        self.seen = pairs if self.seen is None else self.seen.union(pairs)
        if self.roots is not None and links.isEmpty():
            return False
        # Known components as stars, and the new links.
        self.roots = components(links if self.roots is None else links.union(self.roots.select(F.col("id").alias("a"), F.col("root").alias("b"))))
        return True

    def rooted(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class, that of the smallest id."""
    gone = classes(docs, id_col, text).where(f"`{id_col}` != class_id").select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
