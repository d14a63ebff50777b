"""Operator 2: benchmark decontamination by a distributed positional inverted index.

The index is a written table of postings (document, position, term) of the terms that
benchmark items use.  A test phrase is a window of consecutive item words.  Its terms are
taken from the rarest one on: the postings of the rarest term, moved back by the term's
offset, are the candidate places; they are intersected with the moved-back postings of the
second rarest term, and what is left with those of all other terms at once.  Proximity
matches look for all terms of a phrase, in any order, within a span of positions.

All of it is DataFrame operations.  Small sides (benchmark terms and phrases) are broadcast
below a checked number of rows and joined by a shuffle above it.

Defined results: a null or empty text has no words, no hits and no items; the digest of no
items is that of the empty string.  Rows with one id and different texts are looked up each
on their own, equal rows give equal results.  An item without an id hits words but is not
listed.  Items with one id are one item.  Other columns of the tables are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

WINDOW = 10
#: Largest number of rows (of some tens of bytes each) that is sent to all executors.
BROADCAST_ROWS = 500_000
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DOC = ["doc", "text_hash"]


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words: runs of ASCII digits, letters and all non-ASCII characters."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _SEPARATORS), "")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is small enough."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def phrases(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, terms): each window of ``window`` consecutive words of an item, or all words of a
    shorter item that has any."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return items.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.slice("w", F.col("at") + 1, window).alias("terms")).distinct()


def build_index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written postings (doc, text_hash, pos, term_id) of ``terms`` (term, term_id)."""
    found = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("text_hash"), F.posexplode(words(F.col(text))).alias("pos", "term"))
    return materialise(found.join(_small(terms), "term").select(*_DOC, "pos", "term_id"), "postings")


def number_terms(test: DataFrame) -> DataFrame:
    """The written table (term, term_id) of all terms of the test phrases."""
    return materialise(test.select(F.explode("terms").alias("term")).distinct().withColumn("term_id", F.monotonically_increasing_id()), "terms")


def plan_phrases(test: DataFrame, terms: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written tables of phrases (phrase_id, n, steps: term ids and offsets, the rarest first)
    and of their items (phrase_id, item_id)."""
    rarity = index.groupBy("term_id").agg(F.count("*").alias("times"))
    known = materialise(terms.join(rarity, "term_id", "left").select("term", "term_id", F.coalesce("times", F.lit(0)).alias("times")), "term-counts")
    named = materialise(test.select("terms").distinct().withColumn("phrase_id", F.monotonically_increasing_id()), "phrases")
    steps = (named.select("phrase_id", F.posexplode("terms").alias("offset", "term")).join(_small(known), "term")
             .groupBy("phrase_id").agg(F.count("*").cast("int").alias("n"), F.array_sort(F.collect_list(F.struct("times", "offset", "term_id"))).alias("steps")))
    items = test.join(named, "terms").select("phrase_id", "item_id").distinct()
    # A term without postings leaves no place for its phrase.
    return materialise(steps.where("steps[0].times > 0"), "phrase-steps"), materialise(items, "phrase-items")


def phrase_matches(index: DataFrame, plan: DataFrame) -> DataFrame:
    """(doc, text_hash, start, n, phrase_id) of every place where a phrase occurs."""
    first = plan.select("phrase_id", "n", "steps", F.col("steps")[0]["term_id"].alias("term_id"), F.col("steps")[0]["offset"].alias("offset"))
    places = (index.join(_small(first), "term_id").withColumn("start", F.col("pos") - F.col("offset")).where("start >= 0")
              .select(*_DOC, "start", "phrase_id"))
    steps = plan.select("phrase_id", "n", "steps")
    # Second rarest terms: their postings alone are moved.
    second = _small(plan.where("n > 1").select(F.col("steps")[1]["term_id"].alias("term_id")).distinct())
    asked = places.join(_small(steps), "phrase_id").withColumn("want", F.when(F.col("n") > 1, F.col("steps")[1]))
    single = asked.where("n = 1").select(*_DOC, "start", "phrase_id", "n", "steps")
    paired = (asked.where("n > 1").withColumn("term_id", F.col("want.term_id")).withColumn("pos", F.col("start") + F.col("want.offset"))
              .select(*_DOC, "pos", "term_id", "start", "phrase_id"))
    both = _meet(paired, index.join(second, "term_id", "left_semi")).select(*_DOC, "start", "phrase_id").join(_small(steps), "phrase_id")
    left = materialise(single.union(both.select(*single.columns)).distinct(), "places")
    done = left.where("n <= 2").select(*_DOC, "start", "n", "phrase_id")
    # All other terms, in the documents that still have a place.
    here = _small(left.where("n > 2").select(*_DOC).distinct())
    rest = (left.where("n > 2").select(*_DOC, "start", "phrase_id", "n", F.explode(F.slice("steps", F.lit(3), F.col("n"))).alias("s"))
            .select(*_DOC, (F.col("start") + F.col("s.offset")).alias("pos"), F.col("s.term_id").alias("term_id"), "start", "phrase_id", "n"))
    own = index.join(here, (index["doc"].eqNullSafe(here["doc"])) & (index["text_hash"] == here["text_hash"]), "left_semi")
    whole = _meet(rest, own.distinct()).groupBy(*_DOC, "start", "n", "phrase_id").agg(F.count("*").alias("met")).where("met = n - 2").drop("met")
    return done.union(whole)


def _meet(asked: DataFrame, postings: DataFrame) -> DataFrame:
    """Rows of ``asked`` whose (doc, text_hash, pos, term_id) has a posting."""
    p = postings.toDF(*[f"_{c}" for c in postings.columns])
    return asked.join(p, F.col("doc").eqNullSafe(p["_doc"]) & (F.col("text_hash") == p["_text_hash"]) & (F.col("pos") == p["_pos"]) & (F.col("term_id") == p["_term_id"]), "left_semi")


def proximity_matches(index: DataFrame, plan: DataFrame, span: int) -> DataFrame:
    """(doc, text_hash, start, phrase_id): the starts of spans of ``span`` positions that begin with
    a word of the phrase and hold all its different terms, in any order."""
    parts = plan.select("phrase_id", F.explode("steps").alias("s")).select("phrase_id", F.col("s.term_id").alias("term_id")).distinct()
    need = parts.groupBy("phrase_id").agg(F.count("*").alias("need"))
    rare = plan.select("phrase_id", F.col("steps")[0]["term_id"].alias("term_id"))
    # Every such span holds the rarest term, so starts lie in reach of its postings.
    at = (index.join(_small(rare), "term_id").select(*_DOC, "phrase_id", F.explode(F.sequence(F.greatest(F.col("pos") - span + 1, F.lit(0)), F.col("pos"))).alias("start")).distinct())
    here = at.select(*_DOC).distinct().toDF("_doc", "_text_hash")
    near = index.join(_small(here), F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_text_hash")), "left_semi").join(_small(parts), "term_id")
    held = near.select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("phrase_id").alias("_phrase"), "term_id", "pos",
                       F.explode(F.sequence(F.greatest(F.col("pos") - span + 1, F.lit(0)), F.col("pos"))).alias("_start"))
    met = at.join(held, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")) & (F.col("phrase_id") == F.col("_phrase")) & (F.col("start") == F.col("_start")))
    return (met.groupBy(*_DOC, "start", "phrase_id").agg(F.count_distinct("term_id").alias("met"), F.min("pos").alias("low")).join(_small(need), "phrase_id")
            .where("met = need and low = start").select(*_DOC, "start", "phrase_id"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document row: its id, text_hash, n_words, n_hit (words inside an occurrence), n_items,
    items (sorted as strings) and contaminated."""
    test = phrases(benchmark, item_id, item_text, window)
    terms = number_terms(test)
    index = build_index(docs, terms, doc_id, text)
    plan, items = plan_phrases(test, terms, index)
    found = materialise(phrase_matches(index, plan), "phrase-matches")
    reach = F.aggregate(F.array_sort(F.collect_set(F.struct(F.col("start"), (F.col("start") + F.col("n")).alias("stop")))),
                        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
                        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], acc["end"]))).cast("long").alias("n"),
                                                F.greatest(acc["end"], x["stop"]).alias("end")), lambda acc: acc["n"])
    hits = found.groupBy(*_DOC).agg(reach.alias("n_hit"))
    listed = (found.select(*_DOC, "phrase_id").distinct().join(_small(items), "phrase_id").where("item_id is not null")
              .groupBy(*_DOC).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    per = hits.toDF("_doc", "_hash", "n_hit").join(listed, F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_hash") == F.col("text_hash")), "left").select("_doc", "_hash", "n_hit", "items")
    base = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("text_hash"), F.size(words(F.col(text))).cast("long").alias("n_words"))
    out = base.join(per, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(F.col("doc").alias(doc_id), "text_hash", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", (hit > 0).alias("contaminated"))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return found.select(doc_id, "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def keep_clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark window."""
    bad = contamination(docs, benchmark, doc_id, text).where("contaminated").select(F.col(doc_id).alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["_doc"]) & (F.xxhash64(docs[text]) == bad["_hash"]), "left_anti")
