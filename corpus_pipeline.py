"""Corpus pipeline: documents -> kept, deduplicated, decontaminated, redacted, packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.

1. quality rules: documents that fail the base rules, or whose host does, go.
2. n-gram Jaccard join: of each group of near-duplicates (five-word shingles,
   similarity 0.8 or more) the document with the smallest id stays.
3. benchmark decontamination: documents that hold a benchmark item go.
4. secret scans: secrets that look live are replaced in the text.
5. best-fit packing: what is left, as sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars import session as S
from tickbars.llm.common import prepare, table
from tickbars.llm.decontaminate import keep_clean
from tickbars.llm.jaccard_join import keep_first
from tickbars.llm.packing import pack
from tickbars.llm.quality_rules import keep_good
from tickbars.llm.queries import tokenizer_path
from tickbars.llm.secret_scan import redact_live

NEAR_SHINGLE, NEAR_PCT = 5, 80

# Near-duplicate components and packing are iterative: no SQL for the whole.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return keep_first(docs, shingle=NEAR_SHINGLE, pct=NEAR_PCT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return redact_live(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = S.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
