"""Hashed maximum-entropy language model with a class-factored softmax.

    P(w | h) = P(class(w) | h) * P(w | class(w))

The class factor is a softmax over hashed features of the history: the word
before, the two words before (n-gram features) and the second word before
alone (a skip feature).  It is trained by distributed gradient updates: in each
round every task runs stochastic gradient steps over its share of the training
texts, and the tasks' weights are averaged by their token counts.  Each round
takes another part of the texts, so all training texts are used once.  The
word factor is the smoothed share of the word among its class.  The most
frequent words (and the end of a text) are classes of their own, all others are
classed by their last bytes.

Counts of all training words stay a distributed table.  The ``HEAD`` most
frequent ones are broadcast (a fixed number of rows); the words outside, a small
share of all tokens, are joined to the table by a 64-bit hash.

Defined results: a null text is an empty one, whose only token is its end; a null
id is neither held out nor learned from; with nothing to learn from, every word
is unknown; repeated rows are scored row by row and learned from as often; an
empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm.common import signed, text_bytes
from tickbars.llm.language_id import fold

#: Frequent words whose counts are broadcast.
HEAD = 200_000
#: Frequent words with a class of their own, and classes of the others.
OWN, SUFFIXES = 16, 16
CLASSES = OWN + SUFFIXES
#: The hashed feature table grows with the square root of the training tokens, between these powers of two
#: (the larger one bounds what a task holds and hands over).
LEAST_FEATURES, MOST_FEATURES, FEATURES_PER_ROOT = 1 << 15, 1 << 20, 4
ROUNDS = 4
STEP = 8192
RATE = 0.5
ALPHA = 0.1
#: Words a worker remembers; past this the memory is emptied.
MEMORY = 300_000
#: Parts in which a task hands its weights over.
PARTS = 16

_END_HASH = np.uint64(xxhash.xxh3_64_intdigest(b""))
_ONES, _COLUMNS = np.ones(CLASSES, np.float32), np.arange(CLASSES)
_START = np.uint64(0x9E3779B97F4A7C15)
# Odd multipliers of the feature hash (fixed values; any odd 64-bit numbers do).
_K = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


class Vocabulary(dict):
    """word -> row of ``hash`` and ``suffix``; one per worker.  ``head`` rows
    hold a word's place among the broadcast ones, -1 if it is not there."""

    def __init__(self):
        super().__init__()
        self.hash = np.zeros(MEMORY, np.uint64)
        self.suffix = np.zeros(MEMORY, np.int64)
        self.head = np.zeros(MEMORY, np.int64)
        self.placed, self.head_id = 0, None

    def __missing__(self, word: bytes) -> int:
        row = len(self)
        if row >= len(self.hash):
            for name in ("hash", "suffix", "head"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        self[word] = row
        self.hash[row] = xxhash.xxh3_64_intdigest(word)
        self.suffix[row] = zlib.crc32(word[-2:]) % SUFFIXES
        return row

    def full(self) -> bool:
        return len(self) > MEMORY

    def empty(self):
        self.clear()
        self.placed = 0

    def rows(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(rows of all tokens, tokens per text); every text ends in ``b""``."""
        words: list[bytes] = []
        count = np.empty(len(texts), np.int64)
        for k, t in enumerate(texts):
            w = t.lower().split()
            words += w
            words.append(b"")
            count[k] = len(w) + 1
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words)), count

    def place(self, head_id, hashes: np.ndarray):
        """Bring ``head`` up to date with the broadcast words (sorted hashes)."""
        if head_id != self.head_id:
            self.placed, self.head_id = 0, head_id
        new = self.hash[self.placed:len(self)]
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, new), len(hashes) - 1)
            at[hashes[at] != new] = -1
        else:
            at = np.full(len(new), -1)
        self.head[self.placed:len(self)] = at
        self.placed = len(self)


_VOCABULARY = Vocabulary()


def _count(batches):
    """(hash, suffix, n) of the words of a task."""
    v, total = _VOCABULARY, np.zeros(0, np.int64)

    def rows():
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(v.hash[at].view(np.int64)), pa.array(v.suffix[at].astype(np.int32)),
                                           pa.array(total[at])], ["hash", "suffix", "n"])

    for batch in batches:
        if v.full():
            yield rows()
            v.empty()
            total = np.zeros(0, np.int64)
        at, _ = v.rows(batch.column(0).to_pylist())
        now = np.bincount(at, minlength=len(v))
        now[:len(total)] += total
        total = now
    yield rows()


class Head:
    """The broadcast part of the model: frequent words by hash with their log
    counts and classes, and the log denominators of all classes."""

    def __init__(self, rows, class_tokens, class_words):
        self.key = uuid.uuid4().hex
        ranked = sorted(rows, key=lambda r: (r[0] != signed(int(_END_HASH)), -r[1], r[0]))
        own = {h: k for k, (h, _) in enumerate(ranked[:OWN])}
        order = sorted(rows, key=lambda r: r[0] & (1 << 64) - 1)
        self.hash = np.array([h & (1 << 64) - 1 for h, _ in order], np.uint64)
        self.log_count = np.log10(np.array([n for _, n in order], np.float64) + ALPHA)
        self.own = np.array([own.get(h, -1) for h, _ in order], np.int64)
        self.own_hashes = list(own)
        self.denominator = np.log10(class_tokens + ALPHA * (class_words + 1))

    def classes(self, v: Vocabulary, rows: np.ndarray) -> np.ndarray:
        at = v.head[rows]
        own = self.own[at] if len(self.own) else np.full(len(rows), -1)
        return np.where((at >= 0) & (own >= 0), own, OWN + v.suffix[rows])


def feature_rows(tokens: int) -> int:
    """Rows of the feature table for a number of training tokens: a power of two."""
    wanted = int(FEATURES_PER_ROOT * math.sqrt(tokens))
    return min(max(1 << max(wanted - 1, 0).bit_length(), LEAST_FEATURES), MOST_FEATURES)


def features(h: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """Feature rows (3 x tokens, below ``size``) from token hashes and tokens per text."""
    one = np.concatenate([[_START], h[:-1]])
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    one[first] = _START
    two = np.concatenate([[_START], one[:-1]])
    two[first] = _START
    shift = np.uint64(64 - size.bit_length() + 1)
    return np.stack([(x ^ (x >> np.uint64(31))) * _K[3] >> shift for x in (
        one * _K[0], one * _K[1] + two * _K[2], two * _K[2] + _K[0])]).astype(np.int64)


def class_scores(w: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Scores of the classes before normalising, a row per token, the largest 0.
    The last row of the weights is the bias."""
    z = w.take(f[0], axis=0)
    z += w.take(f[1], axis=0)
    z += w.take(f[2], axis=0)
    z += w[-1]
    z -= z.max(axis=1, keepdims=True)
    return z


def class_log_probability(w: np.ndarray, f: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Natural log probability of each token's class."""
    z = class_scores(w, f)
    own = z[np.arange(len(z)), cls]
    return own - np.log(np.exp(z, out=z) @ _ONES)


def descend(w: np.ndarray, seen: np.ndarray, f: np.ndarray, cls: np.ndarray):
    """One gradient step in place over a few thousand tokens; ``seen`` sums the
    squared gradients per row (adaptive rates)."""
    z = class_scores(w, f)
    g = np.exp(z, out=z)
    g /= (g @ _ONES)[:, None]
    g[np.arange(len(cls)), cls] -= 1
    for rows in (*f, None):
        if rows is None:
            at, sums, n = np.array([len(w) - 1]), g.sum(axis=0, keepdims=True), np.array([len(g)])
        else:
            order = np.argsort(rows.astype(np.int32))
            ordered = rows[order]
            start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            at, n = ordered[start], np.diff(np.append(start, len(rows)))
            # most rows of a step occur once: only the others are summed
            sums = g.take(order[start], axis=0)
            more = n > 1
            if more.any():
                group = np.repeat(np.arange(more.sum()) * CLASSES, n[more])
                again = g.take(order[np.repeat(more, n)], axis=0)
                sums[more] = np.bincount((group[:, None] + _COLUMNS).ravel(), again.ravel()).reshape(-1, CLASSES)
        sums /= np.sqrt(n, dtype=np.float32)[:, None]
        seen[at] += np.einsum("ij,ij->i", sums, sums) / sums.shape[1]
        sums *= (RATE / np.sqrt(seen[at] + np.float32(1e-4)))[:, None]
        w[at] = w.take(at, axis=0) - sums


def _train(head, weights, size: int):
    """A task's weights after its texts, times its tokens, in parts."""
    def run(batches):
        v, t = _VOCABULARY, head.value
        w = np.frombuffer(weights.value, np.float32).reshape(size + 1, CLASSES).copy()
        seen, tokens = np.full(size + 1, 1e-2, np.float32), 0
        for batch in batches:
            if v.full():
                v.empty()
            rows, count = v.rows(batch.column(0).to_pylist())
            if not len(rows):
                continue
            v.place(t.key, t.hash)
            f, cls = features(v.hash[rows], count, size), t.classes(v, rows)
            for k in range(0, len(cls), STEP):
                descend(w, seen, f[:, k:k + STEP], cls[k:k + STEP])
            tokens += len(cls)
        if tokens:
            for k, part in enumerate(np.array_split(w.astype(np.float64) * tokens, PARTS)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([tokens], pa.int64()),
                     pa.array([part.astype(np.float32).tobytes()], pa.binary())], ["part", "tokens", "w"])
    return run


def _sum_parts(batches):
    """Running sums of the parts: one part's sum is held, not its rows."""
    total: dict[int, list] = {}
    for batch in batches:
        for k, n, w in zip(*(c.to_pylist() for c in batch.columns)):
            x = np.frombuffer(w, np.float32).astype(np.float64)
            if k in total:
                total[k][0] += n
                total[k][1] += x
            else:
                total[k] = [n, x]
    for k, (n, x) in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([n], pa.int64()),
             pa.array([(x / n).astype(np.float32).tobytes()], pa.binary())], ["part", "tokens", "w"])


def train(texts: DataFrame, head, size: int) -> np.ndarray:
    """Weights of the class softmax from all rows of ``texts`` (t)."""
    spark = texts.sparkSession
    w = np.zeros((size + 1, CLASSES), np.float32)
    schema = "part int, tokens long, w binary"
    tasks = 2 * spark.sparkContext.defaultParallelism  # weights handed over: by cores, not by input
    for k in range(ROUNDS):
        share = texts.filter(F.pmod(F.xxhash64("t"), F.lit(ROUNDS)) == k).coalesce(tasks)
        shared = spark.sparkContext.broadcast(w.tobytes())
        got = {r.part: r.w for r in share.mapInArrow(_train(head, shared, size), schema)
               .repartition(PARTS, "part").mapInArrow(_sum_parts, schema).collect()}
        if got:
            w = np.concatenate([np.frombuffer(got[p], np.float32) for p in range(PARTS)]).reshape(w.shape)
        shared.unpersist()
    return w


def _score(head, weights, size: int):
    """Per text: tokens, known tokens and log counts of the frequent words, the
    class part of the log probability, and the hashes of all other words."""
    def run(batches):
        v, t = _VOCABULARY, head.value
        w = np.frombuffer(weights.value, np.float32).reshape(size + 1, CLASSES)
        for batch in batches:
            if v.full():
                v.empty()
            rows, count = v.rows(batch.column(2).to_pylist())
            v.place(t.key, t.hash)
            h, cls = v.hash[rows], t.classes(v, rows)
            f = features(h, count, size) if len(h) else np.zeros((3, 0), np.int64)
            p = np.empty(len(h))
            for k in range(0, len(h), STEP):
                p[k:k + STEP] = class_log_probability(w, f[:, k:k + STEP], cls[k:k + STEP])
            p = p / np.log(10) - t.denominator[cls]
            at = v.head[rows]
            known = at >= 0
            logs = np.where(known, t.log_count[at] if len(t.hash) else 0.0, 0.0)
            ends = np.concatenate([[0], np.cumsum(count)])
            per = lambda x: np.add.reduceat(x, ends[:-1]) if len(count) else x
            tail = h[~known].view(np.int64)
            cut = np.concatenate([[0], np.cumsum(per((~known).astype(np.int64)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(count), pa.array(per(known.astype(np.int64))),
                pa.array(per(logs)), pa.array(per(p)),
                pa.ListArray.from_arrays(pa.array(cut), pa.array(tail))],
                ["doc_id", "held_out", "n_tokens", "head_known", "head_logs", "class_logs", "tail"])
    return run


def _head_floor(counts: DataFrame) -> int:
    """The least count that at most ``HEAD`` words reach, to an eighth of a
    power of two: from a histogram with a few hundred bins."""
    bins = counts.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("m")).collect()
    words, floor = 0, 1 << 62
    for bin_, m in sorted(((r.bin, r.m) for r in bins), reverse=True):
        words += m
        if words > HEAD:
            break
        floor = int(np.ceil(2 ** (bin_ / 8)))
    return floor


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per
    row; rows whose fold is 0 of 10 are held out, all others learned from."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold(id_col, 10) == 0, F.lit(False)).alias("held_out"),
                       text_bytes(text_col).alias("t"))
    texts = docs.filter(fold(id_col, 10) != 0).select(text_bytes(text_col).alias("t"))
    counts = texts.mapInArrow(_count, "hash long, suffix int, n long") \
        .groupBy("hash").agg(F.first("suffix").alias("suffix"), F.sum("n").alias("n"))
    counts = S.materialize(counts, "word-counts")
    end = signed(int(_END_HASH))
    top = counts.filter((F.col("n") >= _head_floor(counts)) | (F.col("hash") == end)).select("hash", "n").toPandas()
    per_class = counts.groupBy("suffix").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).collect()
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per_class:
        class_tokens[OWN + r.suffix], class_words[OWN + r.suffix] = r.n, r.v
    n_train, n_words = int(class_tokens.sum()), int(class_words.sum())
    listed = list(zip(top["hash"].tolist(), top["n"].tolist()))
    model = Head(listed, class_tokens, class_words)
    if model.own_hashes:  # words with a class of their own leave their suffix class
        suffix = {r.hash: (r.suffix, r.n) for r in counts.filter(F.col("hash").isin(model.own_hashes)).collect()}
        for k, h in enumerate(model.own_hashes):
            s, n = suffix[h]
            class_tokens[OWN + s] -= n
            class_words[OWN + s] -= 1
            class_tokens[k], class_words[k] = n, 1
        model = Head(listed, class_tokens, class_words)
    head = spark.sparkContext.broadcast(model)
    size = feature_rows(n_train)
    weights = spark.sparkContext.broadcast(train(texts, head, size).tobytes())

    scored = rows.mapInArrow(_score(head, weights, size), f"doc_id {kind}, held_out boolean, n_tokens long, head_known long, "
                             "head_logs double, class_logs double, tail array<long>")
    scored = S.materialize(scored.withColumn("rid", F.monotonically_increasing_id()), "scored")
    tail = scored.select("rid", F.explode("tail").alias("hash")).join(counts.select("hash", "n"), "hash", "left") \
        .groupBy("rid").agg(F.count("n").alias("tail_known"),
                            F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(ALPHA))).alias("tail_logs"))
    logs = F.col("head_logs") + F.coalesce("tail_logs", F.lit(0.0))
    whole = float(np.log10(n_train + ALPHA * (n_words + 1)))
    return scored.drop("tail").join(tail, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("class_logs") + logs).alias("score"))
