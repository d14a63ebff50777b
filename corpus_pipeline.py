"""Corpus pipeline: five stages, each written as Parquet and reread as the next one's input.

1. quality rules: documents that the base or a certified rule rejects go;
2. near-duplicates: one document (the smallest id) of each class stays;
3. decontamination: documents that hold a benchmark window go;
4. personal data: surrogates in place of mentions;
5. BPE: ids and decoded text of every document that is left, in digest form.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bag_minhash, bpe, decontaminate, pii, quality_rules
from tidemark.llm.common import materialise, read_table

#: No SQL: signatures, certified cutoffs, keyed surrogates and the tokenizer aren't expressible.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bag_minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace_mentions(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizer_path: str = public_tokenizers.path("word_bpe_49k.json")) -> DataFrame:
    return bpe.encode_texts(docs, tokenizer_path, ["doc_id"], full=False)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
