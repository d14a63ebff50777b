"""Operator 7: quality rules whose cutoffs carry a risk guarantee.

Each rule rejects a document when a ratio of its base counts exceeds a cutoff.  Cutoffs are chosen
per stratum on labelled holdout documents, equal texts counting once.  Three tenths of them choose
an order of steps, each of which tightens one rule; the others certify the steps in this order: a
step is certified when the exact binomial (Clopper-Pearson) upper bound of the share of good
documents that all rules together reject stays within the allowed risk.  Testing stops at
the first step that fails (fixed sequence, so the steps need no correction), and the error
probability is divided over the strata (Bonferroni).  A stratum's rules are those of its last
certified step; without one its rules reject nothing.

Defined results: a null or empty text has no words and all counts 0 (so it fails the base
rule).  A null stratum is a stratum of its own.  A document with several labels counts as
bad if any of them says so; null labels are not regarded.  Strata without (enough) labels
keep whatever passes the base rule.  Documents with one id are each judged by their text.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import added, materialise, slices, small, utf8_rows, window_hashes, word_hashes, words_of

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_lines", "n_capitals"]
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Rule: a ratio of counts, and its cutoffs from the most lenient to the strictest.
RULES: dict[str, tuple[str, str, tuple[float, ...]]] = {
    "symbols_per_word": ("n_symbols", "n_words", (2.0, 1.0, 0.5, 0.25, 0.1, 0.05)),
    "repeat_share": ("n_repeat_words", "n_words", (0.25, 0.2, 0.15, 0.1, 0.05)),
    "dup_line_share": ("n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
    "word_length": ("word_chars", "n_words", (30.0, 20.0, 15.0, 12.0, 10.0)),
    "capital_share": ("n_capitals", "word_chars", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3)),
}
MAX_FALSE_REJECTION, ERROR_PROBABILITY = 0.02, 0.05
#: Tenths of the labelled texts that choose the order of the steps; the others certify them.
SELECTION_TENTHS = 3

_SYMBOL, _CAPITAL = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL[65:91] = True


def count_batch(col: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of each row of a text column."""
    raw, offsets = utf8_rows(col)
    rows = len(col)
    a, b, row, n_words = words_of(raw, offsets)

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    in_word = np.zeros(len(raw) + 1, np.int8)
    np.add.at(in_word, a, 1)
    np.add.at(in_word, b, -1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    out = {"n_words": n_words, "word_chars": per_row(in_word & ((raw & 0xC0) != 0x80)), "n_symbols": per_row(_SYMBOL[raw]),
           "n_capitals": per_row(_CAPITAL[raw])}
    data = raw.tobytes()
    dup, lines = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i in range(rows):
        if n_words[i]:
            own = [x for x in data[offsets[i]: offsets[i + 1]].split(b"\n") if x.strip()]
            lines[i], dup[i] = len(own), len(own) - len(set(own))
    return out | {"n_dup_lines": dup, "n_lines": lines, "n_repeat_words": _repeat_words(data, raw, a, b, row, rows)}


def _repeat_words(data: bytes, raw: np.ndarray, a: np.ndarray, b: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Words covered by windows whose word sequence is found twice or more in its own text."""
    if len(a) <= WINDOW:
        return np.zeros(rows, np.int64)
    own = np.flatnonzero(row[WINDOW - 1:] == row[: len(row) - WINDOW + 1])
    hashes = window_hashes(word_hashes(raw, a, b), WINDOW)[own] ^ (row[own].astype(np.uint64) << np.uint64(40))
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    found = own[twice]
    # Equal sequences have equal hashes; the words themselves decide among those.
    keys = [(row[i], b" ".join([data[a[j]: b[j]] for j in range(i, i + WINDOW)])) for i in found.tolist()]
    times = Counter(keys)
    covered = np.zeros(len(a) + 1, np.int64)
    for i, k in zip(found.tolist(), keys):
        if times[k] > 1:
            covered[i] += 1
            covered[i + WINDOW] -= 1
    return np.bincount(row[np.cumsum(covered[:-1]) > 0], minlength=rows)


def with_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and the counts (``COUNTS``) of every whole text."""
    src = docs.select(*keep, F.col(text).alias("_text"))
    schema = added(src, **{c: T.LongType() for c in COUNTS})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, len(keep)):
            counts = count_batch(b.column(len(keep)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(counts[c], pa.int64()) for c in COUNTS)],
                                             names=schema.names)

    return src.mapInArrow(run, schema)


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), as the regularised incomplete beta function
    I_{1-p}(n - k, k + 1) by its continued fraction (no sum over k terms)."""
    if k >= n:
        return 1.0
    x, a, b = 1.0 - p, float(n - k), k + 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_fraction(1.0 - x, b, a)
    return _beta_fraction(x, a, b)


def _beta_fraction(x: float, a: float, b: float) -> float:
    if x <= 0.0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    f = c = 1.0
    d = 0.0
    for i in range(100_000):
        m = i // 2
        if i == 0:
            t = 1.0
        elif i % 2 == 0:
            t = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            t = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 + t * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + t / c
        c = c if abs(c) > tiny else tiny
        f *= c * d
        if abs(1.0 - c * d) < 1e-13:
            break
    return front * (f - 1.0)


def certified(rejected: int, good: int, risk: float, error: float) -> bool:
    """Whether the exact upper bound (confidence 1 - ``error``) of the false rejection rate is
    at most ``risk``: equivalent to P(Binomial(good, risk) <= rejected) <= error."""
    return good > 0 and binomial_cdf(rejected, good, risk) <= error


def _exceeds(rule: str, cutoff) -> Column:
    top, base, _ = RULES[rule]
    return F.col(top) > cutoff * F.col(base)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _level(rule: str) -> Column:
    """How many of the rule's cutoffs a document exceeds (the strictest ones, as they are nested)."""
    return sum((F.when(_exceeds(rule, F.lit(c)), 1).otherwise(0) for c in RULES[rule][2]), F.lit(0))


def _choose(cells: list[tuple[bool, bool, tuple[int, ...], int]], risk: float, error: float) -> dict[str, float]:
    """Cutoffs of one stratum from (for certification, good, levels, documents) cells.

    The selection part orders the steps: each step tightens the rule whose next cutoff adds most
    (bad less good documents).  The certification part tests the steps' combined rejections in
    that order, each at the whole error probability, and stops at the first that fails (fixed
    sequence); what the last certified step has is taken."""
    rules = list(RULES)
    sizes = [len(RULES[r][2]) for r in rules]

    def rejects(steps: list[int], levels: tuple[int, ...]) -> bool:
        return any(s and v > m - s for s, v, m in zip(steps, levels, sizes))

    def rejected(steps: list[int], last: bool, good: bool) -> int:
        return sum(n for c, g, v, n in cells if c == last and g == good and rejects(steps, v))

    n_select, n_certify = (sum(n for c, g, _, n in cells if c == last and g) for last in (False, True))
    steps, path, gain = [0] * len(rules), [], 0
    while True:
        found = []
        for i, m in enumerate(sizes):
            for s in range(steps[i] + 1, m + 1):
                more = [*steps[:i], s, *steps[i + 1:]]
                good = rejected(more, False, True)
                if good <= risk * n_select:
                    found.append((rejected(more, False, False) - good, -s, -i, more))
        best = max(found, default=None)
        if best is None or best[0] <= gain:
            break
        gain, steps = best[0], best[3]
        path.append(steps)
    kept = [0] * len(rules)
    for steps in path:
        if not certified(rejected(steps, True, True), n_certify, risk, error):
            break
        kept = steps
    return {r: RULES[r][2][s - 1] for r, s in zip(rules, kept) if s}


def cutoff_table(docs: DataFrame, labels: DataFrame, stratum: str, text: str = "text", risk: float = MAX_FALSE_REJECTION,
                 error: float = ERROR_PROBABILITY) -> DataFrame:
    """The written cutoffs: _stratum and a column for each rule (null: none certified), for every
    stratum with labelled documents that pass the base rule.

    Only labelled texts are counted, and equal texts of a stratum count once.  The documents
    of a stratum come down to a row for each combination of levels, so a task's group is bounded
    by the rules, whatever the number of documents or strata."""
    label = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"))
    some = docs.select(F.col("doc_id").alias("_id"), F.col(stratum).alias("_stratum"), F.col(text).alias("_text")).join(small(label), "_id")
    counted = with_counts(some.withColumn("_same", F.xxhash64("_text")), ["_stratum", "_quality", "_same"], "_text").where(~base_failed())
    levels = [f"l{i}" for i in range(len(RULES))]
    once = counted.groupBy("_stratum", "_same").agg(F.min("_quality").alias("_quality"), *[F.max(_level(r)).alias(c) for r, c in zip(RULES, levels)])
    part = (F.pmod("_same", F.lit(10)) >= SELECTION_TENTHS).alias("last")
    cells = materialise(once.groupBy("_stratum", part, (F.col("_quality") > 0).alias("good"), *levels).agg(F.count(F.lit(1)).alias("n")), "quality-cells")
    each = error / max(1, cells.select("_stratum").distinct().count())
    names = list(RULES)

    def fit(pdf):
        import pandas as pd

        rows = [(bool(c), bool(g), tuple(map(int, v)), int(n)) for c, g, *v, n in zip(pdf["last"], pdf["good"], *[pdf[x] for x in levels], pdf["n"])]
        got = _choose(rows, risk, each)
        return pd.DataFrame([[pdf["_stratum"].iloc[0], *[got.get(r) for r in names]]], columns=["_stratum", *names]).astype({r: "float64" for r in names})

    kind = cells.schema["_stratum"].dataType.simpleString()
    return materialise(cells.groupBy("_stratum").applyInPandas(fit, f"_stratum {kind}, " + ", ".join(f"{r} double" for r in names)), "quality-cutoffs")


def select_cutoffs(docs: DataFrame, labels: DataFrame, stratum: str, text: str = "text", risk: float = MAX_FALSE_REJECTION,
                   error: float = ERROR_PROBABILITY) -> dict[str | None, dict[str, float]]:
    """The certified cutoffs as a dictionary, for a report on a few strata (at most 1,000)."""
    rows = cutoff_table(docs, labels, stratum, text, risk, error).limit(1000).collect()
    out = {x["_stratum"]: {r: x[r] for r in RULES if x[r] is not None and not math.isnan(x[r])} for x in rows}
    return {s: got for s, got in out.items() if got}


def with_verdict(counted: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """``counted`` with ``_kept``: true for documents that pass the base rule and every certified
    rule of their stratum."""
    own = small(cutoffs.select(F.col("_stratum").alias("_cut"), *[F.when(~F.isnan(r), F.col(r)).alias(f"_cut_{r}") for r in RULES]))
    joined = counted.join(own, F.col(stratum).eqNullSafe(F.col("_cut")), "left")
    rejected = [F.coalesce(_exceeds(r, F.col(f"_cut_{r}")), F.lit(False)) for r in RULES]
    return joined.withColumn("_kept", ~base_failed() & ~functools.reduce(lambda a, b: a | b, rejected)).drop("_cut", *[f"_cut_{r}" for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed and kept for every document."""
    counted = with_counts(docs.select("doc_id", F.col(stratum).alias("_of"), F.col(text).alias("_text")), ["doc_id", "_of"], "_text")
    judged = with_verdict(counted, cutoff_table(docs, labels, stratum, text), "_of")
    return judged.select("doc_id", *BASE, base_failed().alias("base_failed"), F.col("_kept").alias("kept"), "n_lines", "n_capitals")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text") -> DataFrame:
    """``docs`` without the documents that the rules reject (all columns as they are)."""
    names = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(stratum).alias("_of"), F.col(text).alias("_text"))
    judged = with_verdict(with_counts(boxed, ["_row", "_of"], "_text"), cutoff_table(docs, labels, stratum, text), "_of")
    return judged.where("_kept").select(*[F.col("_row").getField(c).alias(c) for c in names])
