"""Secret scan with corpus-wide ownership frequency; built-in functions only.

Candidates come from three base patterns (assignments, access keys, long hex
runs) and from opaque tokens that mix digits and both cases.  The hash of each
candidate value is counted over the distinct repositories and owners that hold
it: a value that many owners carry is an example copied around, a value of few
owners looks live.  Base spans are always reported; an opaque token only when
its value looks live and it lies outside the base spans.

Counts are partial sums before every shuffle, first per (value, owner,
repository), then per (value, owner), then per value, so a value found in a
third of all rows never meets in one task.  Texts are not shuffled.

Defined results: a null or empty text has no secrets; a null owner counts as
one owner; repeated rows are reported row by row (and are one repository); an
empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm.regex_spans import SPAN, joined, of_kind, replaced, spans

#: A value held by more owners than this is an example.
MAX_OWNERS = 2

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"


def base_spans(text: Column) -> Column:
    """Base spans in order of start, then kind as listed.  An assignment is
    matched whole and dropped if its value is short; nothing is tried again
    inside it.  The length bounds of the other kinds sit in their patterns: a
    longest run is either long enough from its start or from nowhere."""
    assign = F.filter(spans(text, ASSIGN, "assign", 0, value_group=2), lambda x: F.length(x["value"]) >= 6)
    return F.array_sort(F.concat(assign, spans(text, ACCESS, "access", 1), spans(text, HEX, "hex", 2)))


def opaque_spans(text: Column, base: Column) -> Column:
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")
    return F.filter(spans(text, OPAQUE, "opaque", 3), lambda x: mixed(x["value"]) & ~F.exists(
        base, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))


def candidates(docs: DataFrame, text_col: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = base_spans(text)
    return base, opaque_spans(text, base)


def live_values(found: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """(value_hash) of the candidate values that few owners hold, from rows of
    (owner, repo, found)."""
    held = found.select(F.coalesce(F.col("owner").cast("string"), F.lit("\0")).alias("owner"), "repo",
                        F.explode("found.value").alias("value")) \
        .select(F.sha2("value", 256).alias("value_hash"), "owner", "repo").distinct()
    owners = held.groupBy("value_hash", "owner").agg(F.count("repo").alias("repos"))
    return owners.groupBy("value_hash").agg(
        F.count("owner").alias("n_owners"), F.sum("repos").alias("n_repos")).filter(
        F.col("n_owners") <= max_owners)


def _judged(found: DataFrame, live: DataFrame) -> DataFrame:
    """(rid, live) per row with candidates: the spans whose value looks live."""
    one = found.select("rid", F.explode("found").alias("x")).withColumn("value_hash", F.sha2("x.value", 256))
    return one.join(live.select("value_hash"), "value_hash").groupBy("rid").agg(
        F.array_sort(F.collect_list("x")).alias("live"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                repo_col: str | None = None, max_owners: int = MAX_OWNERS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live) per row.
    ``repo_col`` defaults to the id column: a document is its own repository."""
    base, opaque = candidates(docs, text_col)
    found = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                        F.col(owner_col).alias("owner"), F.col(repo_col or id_col).alias("repo"),
                        base.alias("base"), opaque.alias("opaque")) \
        .withColumn("found", F.concat("base", "opaque"))
    found = S.materialize(found, "secrets")
    live = _judged(found, live_values(found, max_owners))
    out = found.join(live, "rid", "left").withColumn("live", F.coalesce("live", F.array().cast(SPAN)))
    shown = F.array_sort(F.concat("base", F.filter("live", lambda x: x["kind"] == "opaque")))
    return out.select("doc_id", *[of_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                      F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(shown).alias("spans"),
                      F.size("live").cast("long").alias("n_live"))


def redact_live(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                length_col: str | None = "n_chars", max_owners: int = MAX_OWNERS) -> DataFrame:
    """``docs`` with every live-looking secret replaced by ``<secret>`` (and
    ``length_col`` set to the new length where that column exists).  Rows
    without candidates pass through untouched."""
    base, opaque = candidates(docs, text_col)
    cand = docs.withColumn("__found", F.concat(base, opaque))
    hit = S.materialize(cand.filter(F.size("__found") > 0).withColumn("__rid", F.monotonically_increasing_id()),
                        "secret-docs")
    found = hit.select(F.col("__rid").alias("rid"), F.col(id_col).alias("repo"), F.col(owner_col).alias("owner"),
                       F.col("__found").alias("found"))
    live = _judged(found, live_values(found, max_owners)).select(F.col("rid").alias("__rid"), F.col("live").alias("__live"))
    # a large number of hits is shuffled like any join: only rows with candidates are
    joined_ = hit.join(live, "__rid", "left")
    text = F.when(F.col("__live").isNull(), F.col(text_col)).otherwise(
        replaced(F.col(text_col), F.col("__live"), lambda x: F.lit("<secret>")))
    new = {text_col: text}
    if length_col in docs.columns:
        new[length_col] = F.when(F.col("__live").isNull(), F.col(length_col)).otherwise(
            F.length(text).cast(docs.schema[length_col].dataType))
    changed = joined_.withColumns(new).select(*docs.columns)
    return cand.filter(F.size("__found") == 0).select(*docs.columns).unionByName(changed)
