"""The pipeline's stages on a small table, each held against its brute-force version."""

import hashlib

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
import pytest
from test_bag_minhash import brute as classes_of
from test_decontaminate import brute as hits_of
from test_quality_rules import brute as counts_of
from tokenizers import Tokenizer

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    base = texts[0][1].split()
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], DOCUMENTS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, " ".join(texts[10][1].split()[40:60])), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    assert len(base) == 300
    return str(d)


def test_stages(spark, texts, folder):
    bench = [(1, " ".join(texts[10][1].split()[40:60]))]
    left = [(i, t) for i, t in texts if not ((b := counts_of(t))[0] < 20 or 100 * b[4] > 30 * b[0])]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    wants = [left]
    keep = {(i, c) for i, c, _ in classes_of(left)}
    left = [(i, t) for i, t in left if i is None or (i, i) in keep]
    wants.append(left)
    left = [r for r in left if not hits_of([r], bench)[0][-1]]
    wants.append(left)
    wants.append(left)                                     # no personal data in these texts
    for (name, stage), want in zip(corpus_pipeline.STAGES, wants):
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        assert sorted([(r.doc_id, r.text) for r in docs.collect()], key=repr) == sorted(want, key=repr), name
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: t.encode(x or "", add_special_tokens=False).ids for i, x in left}
    final = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256) for r in final} == {(i, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()) for i, x in ids.items()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=repr) == sorted(map(tuple, final), key=repr)


def test_registered_queries():
    names = set(entry.queries())
    assert {"pipeline", *(f"op{n}" for n in range(1, 11))} <= {n.split("_")[0] if n.startswith("op") else n for n in names}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "encoding"]
    assert set(entry.oracle_sql()) <= names


def test_oracles_on_the_small_tables(spark):
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    from tidemark.llm.queries import ORACLE, QUERIES
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, folder)
        want = con.sql(sql)
        assert sorted(df.columns) == sorted(want.columns)
        assert sorted(map(tuple, df.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr), name
