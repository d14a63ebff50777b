import random

import pytest

#: Columns whose names the operators use inside.
CLASH = "hash string, n_words int, _row string, _doc int, id int, root string, words string, spans int, doc int, pos int, term string, kind string, subs string, _gone int"
N_CLASH = len(CLASH.split(","))


def lorem(rng, n, vocab=4000):
    return " ".join(f"w{rng.randrange(vocab)}{'abcde'[rng.randrange(5)]}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(5)
    base = lorem(rng, 300)
    rows = [(1, base), (2, base), (3, base.replace("w1", "v1", 1)), (4, base + " tail one two"), (5, None), (6, ""), (7, " \n\t "), (8, "one two three"), (9, "one two three"), (10, "one"),
            (11, lorem(rng, 20000)), (12, lorem(rng, 40) + " " + " ".join(base.split()[50:90])), (13, "x " * 3000), (14, "y" * 50000), (None, base), (None, "only here"), (15, "tie a b"), (15, "tie a b"),
            (15, lorem(rng, 60)), (16, "line one here\nline one here\n\nline two\nline one here"), (17, "É́Σ a b\x1cc 中文 \U0001f389"), (18, "a  b \n c " + lorem(rng, 30))]
    return rows + [(100 + i, lorem(rng, rng.randrange(1, 120))) for i in range(40)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
    rows = [(i, t, None if (i or 0) % 7 == 0 else "en", "s", None) + (None,) * N_CLASH for i, t in texts]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
