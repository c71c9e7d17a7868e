"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, everything but letters becomes one space, and all 1- to
``ORDER``-grams are hashed into ``BUCKETS`` counters.  Training adds the counters
up per language, per task first; the log-probability matrix (languages x
buckets, a fixed size) is broadcast and texts are scored in numpy, as counters
times matrix, a block of texts at a time.

The classifier is fitted on about ``TRAIN_ROWS`` labelled rows, picked by a hash
of their id and text: below that number on all of them.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
with nothing to learn from every text is; a null id is neither held out nor
learned from; repeated rows are judged row by row (and learned from as often);
ties go to the language first in alphabetical order; an empty table gives no
rows; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 3
BITS = 14
BUCKETS = 1 << BITS
TRAIN_ROWS = 50_000
#: Added to every counter (Laplace).
SMOOTHING = 0.5
UNKNOWN = "und"
#: Texts scored together; bounds the block of counters.
BLOCK = 64

# Odd multipliers of the n-gram hash (fixed values; any odd numbers do).
_K = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters (built once per worker)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def ngram_buckets(text: str) -> np.ndarray:
    """Bucket of every n-gram of a text; empty if it has no letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(letters()[c], c, np.uint32(32))
    space = c == 32
    if space.all():
        return np.empty(0, np.int64)
    c = np.concatenate([[np.uint32(32)], c[~(space & np.concatenate([[True], space[:-1]]))], [np.uint32(32)]])
    out = [c * _K[0]]
    for n in range(2, ORDER + 1):
        out.append((out[-1][:-1] ^ np.uint32(n)) * _K[1] + c[n - 1:] * _K[2])
    h = np.concatenate(out)
    h ^= h >> np.uint32(15)
    h *= _K[1]
    return (h >> np.uint32(32 - BITS)).astype(np.int64)


def counters(texts: list[str]) -> np.ndarray:
    return np.stack([np.bincount(ngram_buckets(t), minlength=BUCKETS) for t in texts]).astype(np.float32)


def _count(langs: list[str]):
    """Per task: (lang, bucket, n) and, with bucket -1, the number of texts."""
    at = {x: k for k, x in enumerate(langs)}

    def run(batches):
        total, texts = np.zeros((len(langs), BUCKETS), np.int64), np.zeros(len(langs), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = ngram_buckets(text)
                if len(ids):
                    total[at[lang]] += np.bincount(ids, minlength=BUCKETS)
                    texts[at[lang]] += 1
        lang, bucket = np.nonzero(total)
        n = np.concatenate([total[lang, bucket], texts])
        lang = np.concatenate([lang, np.arange(len(langs))])
        bucket = np.concatenate([bucket, np.full(len(langs), -1)])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()),
                                          pa.array(n, pa.int64())], ["lang", "bucket", "n"])
    return run


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS):
    """(languages, priors, log-probability matrix) from rows of (id, lang, text)."""
    per_lang = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs, rows = sorted(per_lang), sum(per_lang.values())
    if not langs:
        return [], np.empty(0), np.empty((0, BUCKETS), np.float32)
    if rows > train_rows:
        share = int(1_000_000 * train_rows / rows)
        labelled = labelled.filter(F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) < share)
    found = labelled.select("lang", "text").mapInArrow(_count(langs), "lang int, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    total, texts = np.zeros((len(langs), BUCKETS)), np.zeros(len(langs))
    for r in found.toLocalIterator():  # at most languages x buckets rows
        if r.bucket < 0:
            texts[r.lang] = r.n
        else:
            total[r.lang, r.bucket] = r.n
    log_p = np.log((total + SMOOTHING) / (total.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))
    prior = np.log((texts + 1) / (texts.sum() + len(langs)))
    return langs, prior, log_p.astype(np.float32)


def predict(spark, model, text: Column) -> Column:
    """Struct (lang_pred, score) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(texts: pa.Array) -> pa.Array:
        langs, prior, log_p = shared.value
        pred, score = [], []
        rows = texts.to_pylist()
        for k in range(0, len(rows), BLOCK):
            part = [t or "" for t in rows[k:k + BLOCK]]
            counts = counters(part)
            known = counts.any(axis=1)
            if not langs:
                known[:] = False
                best = prob = np.zeros(len(part), int)
            else:
                s = counts.astype(np.float64) @ log_p.T + prior
                best = s.argmax(axis=1)
                prob = 1 / np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)
            pred += [langs[b] if ok else UNKNOWN for b, ok in zip(best, known)]
            score += [float(p) if ok else 0.0 for p, ok in zip(prob, known)]
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                          ["lang_pred", "score"])

    return run.asNondeterministic()(text)


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row; rows whose fold is 2 of 4
    are held out, the others with a language and a text are learned from."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    labelled = rows.filter((fold("id", 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = train(labelled, train_rows)
    return rows.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", 4) == 2, F.lit(False)).alias("held_out"),
                       predict(docs.sparkSession, model, F.col("text")).alias("p")) \
        .select("doc_id", "held_out", "p.lang_pred", "p.score")
