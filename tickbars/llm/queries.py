"""Queries of the corpus operators over the test tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm.common import prepare, table
from tickbars.llm.decontaminate import decontaminate
from tickbars.llm.hard_negatives import mine
from tickbars.llm.html_text import extract
from tickbars.llm.jaccard_join import jaccard_components
from tickbars.llm.language_id import identify
from tickbars.llm.license_scan import license_scan
from tickbars.llm.maxent_lm import score_texts
from tickbars.llm.oracles import ORACLE_SQL
from tickbars.llm.packing import pack
from tickbars.llm.pii import find_pii
from tickbars.llm.prefix_trie import ends_digest, prefix_trie, rebuilt_turns, turns_of
from tickbars.llm.quality_rules import quality_rules
from tickbars.llm.secret_scan import secret_scan
from tickbars.llm.suffix_dedup import repeated_spans


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(prepare(spark), sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(prepare(spark), sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(prepare(spark), sf_dir, "documents"), tokenizer_path())


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(prepare(spark), sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(prepare(spark), sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(prepare(spark), sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(prepare(spark), sf_dir, "documents"))


def op9_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(prepare(spark), sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(prepare(spark), sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(prepare(spark), sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0, scale=256.0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = S.materialize(turns_of(table(prepare(spark), sf_dir, "conversations")), "turns")
    nodes, ends = prefix_trie(*rebuilt_turns(turns))
    key = ["depth", "z1", "z2"]
    none = F.sha2(F.lit(b"").cast("binary"), 256)
    return nodes.join(ends_digest(ends), key, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(prepare(spark), sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_license_scan, op2_quality_rules, op3_best_fit_packing, op4_language_id, op5_html_text,
           op6_pii, op7_decontaminate, op8_secret_scan, op9_maxent_lm, op10_jaccard_join, op11_hard_negatives,
           op12_prefix_trie, op13_suffix_dedup)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
