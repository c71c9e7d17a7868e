"""Quality rules with host verdicts.

Document rules are counted per text in one Arrow pass.  Their failures are
added up per host (map-side partial sums, so one hot host costs one row per
task), each host's failure rate is shrunk towards the mean of all hosts with a
beta prior fitted to the hosts' own rates (method of moments), and a host whose
shrunk rate passes ``host_limit`` takes all of its documents with it.

Defined results: a null text has no words (fails the base rule); a null host
has no verdict; repeated rows are judged row by row; an empty table gives an
empty result; only the named id, text and host columns are read, so further
columns, whatever their names, change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm.common import in_turn, only, text_bytes

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_SYMBOL_PCT = 25
REPEAT_WINDOW = 5
#: Shrunk failure rate above which a host is rejected.
HOST_LIMIT = 0.9

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_WS = bytes(range(9, 14)) + b" "
_NOT_WORD_CHARS = _WS + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes
_SYMBOLS = b"#*$%&|<>"


def repeat_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words lying in a window of ``width`` words that occurs twice or more.
    Window ids are built exactly: pairs of ids are renumbered densely."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    one = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    win = one[:n]
    for k in range(1, width):
        _, win = np.unique(win * np.int64(len(ids)) + one[k:k + n], return_inverse=True)
    hit = np.flatnonzero(np.bincount(win)[win] > 1)
    if not len(hit):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(text.translate(None, _NOT_WORD_CHARS)),
            len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


def counts_struct(text: Column) -> Column:
    """Struct of the five counts of a binary text column."""
    schema = ", ".join(f"{c}: bigint" for c in COUNTS)

    @F.arrow_udf(f"struct<{schema}>")
    def count(texts: pa.Array) -> pa.Array:
        only()
        rows = [text_counts(t) for t in texts.to_pylist()]
        cols = list(zip(*rows)) if rows else [[]] * len(COUNTS)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], COUNTS)

    return count.asNondeterministic()(text)  # one evaluation, however many fields are read


def base_failed(at: str = "") -> Column:
    c = lambda x: F.col(at + x)
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PCT * c("n_words"))


def rule_columns(at: str = "") -> dict[str, Column]:
    """Rules whose failures count against a host."""
    c = lambda x: F.col(at + x)
    return {"r_short": c("n_words") < MIN_WORDS,
            "r_repeat": 100 * c("n_repeat_words") > MAX_REPEAT_PCT * c("n_words"),
            "r_symbols": 100 * c("n_symbols") > MAX_SYMBOL_PCT * c("word_chars")}


def rejected_hosts(features: DataFrame, host: str, at: str = "", host_limit: float = HOST_LIMIT) -> DataFrame:
    """Hosts whose share of documents failing any rule, shrunk by the beta
    prior, is above ``host_limit``: one column, ``host``.

    Prior: with m and v the mean and variance of the hosts' rates, a + b =
    m(1-m)/v - 1 (at least 1; no variance: all weight on the mean).
    """
    rules = list(rule_columns(at).values())
    any_rule = rules[0]
    for r in rules[1:]:
        any_rule = any_rule | r
    hosts = features.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(any_rule.cast("long")).alias("failed"))
    hosts = S.materialize(hosts, "hosts")
    rate = F.col("failed") / F.col("n")
    m, v = hosts.agg(F.avg(rate), F.var_pop(rate)).first()  # one row, whatever the input
    if m is None:
        return hosts.select("host")
    weight = max(m * (1 - m) / v - 1, 1.0) if v > 1e-12 else 1e9
    shrunk = (F.col("failed") + F.lit(weight * m)) / (F.col("n") + F.lit(weight))
    return hosts.filter(shrunk > F.lit(host_limit)).select("host")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """(id, five counts, base_failed, kept, host_rejected) per row of ``docs``."""
    feats = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                        counts_struct(text_bytes(text_col)).alias("q"))
    feats = S.materialize(feats.select("doc_id", "host", *[f"q.{c}" for c in COUNTS]), "quality")
    bad = rejected_hosts(feats, "host", host_limit=host_limit).withColumn("rejected", F.lit(True))
    out = feats.join(bad, "host", "left").withColumns({
        "base_failed": base_failed(), "host_rejected": F.coalesce("rejected", F.lit(False))})
    return out.select("doc_id", *COUNTS, "base_failed",
                      (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"), "host_rejected")


def _passing(text_col: str):
    """Rows that pass the base rules, all columns as they are."""
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
            keep = []
            for t in texts:
                n, _, _, _, repeats = text_counts(t or b"")
                keep.append(n >= MIN_WORDS and 100 * repeats <= MAX_REPEAT_PCT * n)
            yield batch.filter(pa.array(keep, pa.bool_()))
    return in_turn(run)


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source",
              host_limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that pass: all their columns, unchanged.  A first
    pass counts for the hosts' verdicts and writes no text; a second one streams
    whole rows through the base rules.  No column is added, so none can clash."""
    counts = docs.select(F.col(host_col).alias("host"), counts_struct(text_bytes(text_col)).alias("q"))
    hosts = S.materialize(counts.select("host", *[f"q.{c}" for c in COUNTS]), "quality")
    bad = rejected_hosts(hosts, "host", host_limit=host_limit).select(F.col("host").alias("h"))
    clean = docs.alias("d").join(bad.alias("b"), F.col(f"d.{host_col}") == F.col("b.h"), "left_anti")
    return clean.mapInArrow(_passing(text_col), docs.schema)
