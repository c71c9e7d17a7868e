"""Personal data, with information-theoretic sanitisation; built-in functions only.

Base spans are addresses, numbers and the like, found by pattern.  Terms near
them can give a person away as well: for each entity (a base value) and each
word within ``CONTEXT`` characters of it, the corpus tells in how many distinct
texts both occur, in how many the word occurs at all, and so how much the word
reveals,

    p(entity | term) = n(entity, term) / n(term),
    bits = log2(p(entity | term) / p(entity)).

A term seen beside one entity in at least ``SUPPORT`` distinct texts whose
p(entity | term) and bits reach the thresholds gives the entity away; every
occurrence of it, in any text, becomes a span of kind ``term``.  ``sanitise``
replaces base spans by their type and such terms by a placeholder.

Copies count once (texts are told apart by a 64-bit hash), whole texts are
counted, and partial sums are taken before every shuffle.  Candidate terms are
broadcast only after a count shows them to be under ``BROADCAST_TERMS``; beyond
it the words are shuffled to them.

Defined results: a null or empty text has no spans; repeated rows are reported
row by row; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm.regex_spans import SPAN, joined, of_kind, replaced, spans

KINDS = ["email", "ip", "card", "phone"]
CONTEXT = 40
SUPPORT = 3
DISCLOSURE = 0.9
BITS = 4.0
BROADCAST_TERMS = 200_000
#: One text in ``SHARE`` is read to rule common words out early.
SHARE = 32

# A match of these kinds starts where its leading run starts, or right behind
# the match before it; all later starts in the run fail or succeed with it.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
# Digits with single separators, from first to last: 16 to 19 of them, no more on either side.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"\p{L}{4,}"
WORD_END = r"[\p{L}\p{N}]"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a value pass the Luhn check."""
    digits = F.split(F.reverse(_digits(value)), "")
    each = F.transform(digits, lambda d, i: F.when(d == "", 0).otherwise(
        F.when(i % 2 == 0, d.cast("int")).otherwise(2 * d.cast("int") - F.when(d >= "5", 9).otherwise(0))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> Column:
    """Base spans by kind as listed, then start."""
    email = spans(text, EMAIL, "email", 0)
    ip = F.filter(spans(text, IP, "ip", 1), lambda x: x["value"].rlike(IP_PARTS))
    card = F.filter(spans(text, CARD, "card", 2), lambda x: luhn(x["value"]))
    phone = F.filter(spans(text, PHONE, "phone", 3), lambda x: F.length(_digits(x["value"])).between(8, 15))
    return F.concat(email, ip, card, phone)


def _context_terms(text: Column, x: Column) -> Column:
    """Distinct whole words of letters beside a span; a word that the context's
    edge may cut is left out."""
    before = F.substring(text, F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT)))
    before = F.when(x["start"] > CONTEXT, F.regexp_replace(before, rf"^{WORD_END}+", " ")).otherwise(before)
    after = F.substring(text, x["end"] + 1, F.lit(CONTEXT))
    after = F.when(F.length(text) > x["end"] + CONTEXT, F.regexp_replace(after, rf"{WORD_END}+$", " ")).otherwise(after)
    pattern = rf"(?<!{WORD_END}){TERM}(?!{WORD_END})"
    return F.array_distinct(F.regexp_extract_all(F.concat_ws(" | ", before, after), F.lit(pattern), F.lit(0)))


def _holding(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, term): the distinct texts that hold each of the terms as a word."""
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    words = texts.select("key", F.explode(F.split("text", rf"(?:(?!{WORD_END})[\s\S])+")).alias("term"))
    return words.join(terms, "term").distinct()


def revealing_terms(texts: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE,
                    bits: float = BITS) -> DataFrame:
    """(key, terms): per distinct text, the terms in it that give an entity away.
    ``texts`` has columns (key, text), key telling texts apart."""
    beside = texts.withColumn("base", base_spans(F.col("text"))).filter(F.size("base") > 0) \
        .select("key", "text", F.explode("base").alias("x")) \
        .select("key", F.concat_ws(":", "x.kind", "x.value").alias("entity"),
                _context_terms(F.col("text"), F.col("x")).alias("terms"))
    beside = S.materialize(beside.distinct(), "entities")
    having = beside.select("entity", "key").distinct()
    entities = having.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")) \
        .filter(F.col("n_e") >= support)
    pairs = beside.select("key", "entity", F.explode("terms").alias("term")).distinct() \
        .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_beside")).filter(F.col("n_beside") >= support)
    pairs = S.materialize(pairs.join(entities, "entity"), "entity-terms")
    # A term in more texts of a share of the corpus than its entity allows in all
    # of it cannot reach the threshold: common words go before all texts are read.
    most = pairs.groupBy("term").agg(F.max("n_e").alias("most"))
    seen = _holding(texts.filter(F.pmod("key", F.lit(SHARE)) == 0), most.select("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("seen"))
    terms = S.materialize(most.join(seen, "term", "left").filter(
        F.coalesce("seen", F.lit(0)) * disclosure <= F.col("most") + 1e-6).select("term"), "candidate-terms")
    held = S.materialize(_holding(texts, terms), "held-terms")
    n_texts = texts.select("key").distinct().count()
    counts = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    both = having.join(entities.select("entity"), "entity", "left_semi").join(held, "key") \
        .join(pairs.select("entity", "term"), ["entity", "term"], "left_semi") \
        .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"))
    p = F.col("n_et") / F.col("n_t")
    strong = pairs.join(both, ["entity", "term"]).join(counts, "term").filter(
        (p >= disclosure) & (F.log2(p * n_texts / F.col("n_e")) >= bits)).select("term").distinct()
    return held.join(strong, "term").groupBy("key").agg(F.collect_set("term").alias("terms"))


def _scanned(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``__base`` and ``__all`` (base and term) spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(text)
    found = revealing_terms(docs.select(key.alias("key"), text.alias("text")))
    found = S.materialize(found, "revealing").select(F.col("key").alias("__key"), F.col("terms").alias("__terms"))
    with_terms = docs.join(found, key == F.col("__key"), "left")
    base = base_spans(text)
    pattern = F.concat(F.lit(rf"(?<!{WORD_END})(?:"), F.array_join("__terms", "|"), F.lit(rf")(?!{WORD_END})"))
    terms = F.when(F.col("__terms").isNull(), F.array().cast(SPAN)).otherwise(
        F.filter(spans(text, pattern, "term", 4), lambda x: ~F.exists(
            F.col("__base"), lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))))
    return with_terms.withColumn("__base", base).withColumn("__all", F.concat("__base", terms))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term) per row."""
    s = _scanned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    return s.select("doc_id", *[of_kind(F.col("__base"), k).alias(f"n_{k}") for k in KINDS],
                    F.sha2(joined(F.col("__base")), 256).alias("base_sha256"),
                    joined(F.col("__all")).alias("spans"), of_kind(F.col("__all"), "term").alias("n_term"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): base spans generalised to their type, revealing terms removed."""
    s = _scanned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    label = lambda x: F.when(x["kind"] == "term", F.lit("<term>")).otherwise(
        F.concat(F.lit("<"), x["kind"], F.lit(">")))
    return s.select("doc_id", F.when(F.col("text").isNotNull(), replaced(
        F.col("text"), F.array_sort("__all"), label)).alias("text"))
