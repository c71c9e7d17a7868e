"""Benchmark decontamination by template canonicalisation.

Numbers, units and names become typed placeholders, so a question asked again
with other values has the same template.  Windows of ``WINDOW`` canonical words
of the documents are hash-joined to those of the benchmark; matches are lined up
per (document, item, shift), and the placeholder values must map consistently:
one item value always to one document value.  Whether the values are the same
(a verbatim copy) or consistently others (a re-parameterised one), the document
is contaminated if the line-up covers ``RUN`` words, or the whole item if that
is shorter, or every window of the item that is a template.

Every window is hashed word for word, so a verbatim copy is found however dense
it is in values, and as a template if at least ``LITERALS`` of its words stay
literal.  A soft word may be a value or an ordinary word: a capitalised word that
opens a sentence, a line or a text, a number word, a name in other case (O'Brien,
Jean-Luc, McDonald, USA).  A window is hashed in every reading of its soft words.

Bitmaps of the benchmark's window and word hashes (a fixed number of buckets,
whatever the benchmark's size) filter document windows inside the scan: a window
with a word read literally that no item has is not hashed, and only windows that
hit are shuffled.  The join itself compares 64-bit hashes.

Defined results: null or empty texts match nothing; an item of fewer than
``MIN_ITEM`` words cannot be told from chance inside a sentence and is looked up
whole, as the words between two ends of sentences, lines or texts; a null id is
reported as null; repeated rows of one id give one row per item; an empty table
on either side gives no rows; only the named columns are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm.common import WORD_MEMORY, _MULT, in_turn, mix, remembered, split_by_keys, text_bytes

import xxhash

WINDOW = 8
RUN = 13
MIN_ITEM = 5
#: Literal words a template needs: placeholders alone match too much.
LITERALS = 4
BUCKETS = 1 << 22
#: Readings of soft words hashed at a time (bounds memory only).
READINGS = 1 << 18

# Units (fixed values).
UNITS = frozenset("""mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr ms
second seconds minute minutes hour hours day days week weeks month months year years
meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters
mile miles foot feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce ounces
liter liters litre litres dollar dollars euro euros cent cents percent degree degrees
mph kph km/h""".split())
# Number words (fixed values), also joined by hyphens.
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
billion dozen half""".split())

LITERAL, NUMBER, UNIT, NAME, BREAK = range(5)
_NUMBER = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*%?")
_QUANTITY = re.compile(r"[+-]?\d+(?:[.,]\d+)*([A-Za-z/]+)")
_MARK = b"\xff"  # line end: never part of UTF-8 text


class Canon(dict):
    """word -> row of the arrays ``code`` (hash of the literal), ``kind``, ``ends``,
    ``soft`` (may be an ordinary word as well) and of the texts ``core``."""

    def __init__(self):
        super().__init__()
        self.core = {}
        self.clear()

    def clear(self):
        super().clear()
        self.core.clear()
        self.code = np.zeros(WORD_MEMORY, np.uint64)
        self.kind = np.zeros(WORD_MEMORY, np.int8)
        self.ends = np.zeros(WORD_MEMORY, bool)
        self.soft = np.zeros(WORD_MEMORY, bool)

    def __missing__(self, word: bytes) -> int:
        row = len(self)
        self[word] = row
        kind, core, ends = canonical(word)
        if row >= len(self.code):
            for name in ("code", "kind", "ends", "soft"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        self.core[row] = low = core.lower()
        self.code[row] = xxhash.xxh3_64_intdigest(low)
        if ends:  # a new row holds zeros
            self.ends[row] = True
        if kind:
            self.kind[row] = kind
            self.soft[row] = (kind == NUMBER and not core[-1:].isdigit() and _number_word(core)) \
                or (kind == NAME and not _plain_name(core))
        return row


def _number_word(core: str) -> bool:
    return all(x in NUMBER_WORDS for x in core.lower().split("-"))


def _plain_name(core: str) -> bool:
    return len(core) > 1 and core[0].isupper() and core[1:].islower()


def canonical(word: bytes) -> tuple[int, str, bool]:
    """(kind, word without outer punctuation, does it end a sentence)."""
    if word == _MARK:
        return BREAK, "", True
    w = word.decode("utf-8", "replace")
    core = w.rstrip(".,;:!?")
    if core.isalpha():  # most words: letters, maybe a stop; no number, no other punctuation
        low = core.lower()
        kind = UNIT if low in UNITS else NUMBER if low in NUMBER_WORDS else LITERAL
        if not kind and len(core) > 1 and not core.islower() and any(x.isupper() for x in core):
            kind = NAME
        return kind, core, w[-1] in ".!?:;"
    ends = w.rstrip("\"')]}»”’")[-1:] in tuple(".!?:;")
    a, b = 0, len(w)
    while a < b and not w[a].isalnum() and not (w[a] in "+-" and w[a + 1:a + 2].isdigit()):
        a += 1
    while b > a and not w[b - 1].isalnum() and w[b - 1] != "%":
        b -= 1
    core = w[a:b]
    if not core:
        return BREAK, "", ends
    if _NUMBER.fullmatch(core):
        return NUMBER, core, ends
    m = _QUANTITY.fullmatch(core)
    if m and m[1].lower() in UNITS:
        return NUMBER, core, ends
    if core.lower() in UNITS:
        return UNIT, core, ends
    if _number_word(core):
        return NUMBER, core, ends
    if len(core) > 1 and any(x.isupper() for x in core):
        return NAME, core, ends
    return LITERAL, core, ends


_CANON = remembered("canonical words", Canon())


def canonical_words(texts: list[bytes]):
    """(row in the word memory, document, literal hash, kind, soft, begins, ends) of a
    batch's canonical words: punctuation-only words are left out; a word begins or
    ends what stands between two ends of sentences, lines or texts."""
    if len(_CANON) >= WORD_MEMORY:
        _CANON.clear()
    words, counts = [], []
    for t in texts:
        w = t.replace(b"\n", b" \xff ").split()
        counts.append(len(w) + 1)
        words.append(_MARK)
        words.extend(w)
    rows = np.fromiter(map(_CANON.__getitem__, words), np.int64, len(words))
    kind, soft = _CANON.kind[rows], _CANON.soft[rows]
    opens = np.ones(len(rows), bool)
    opens[1:] = _CANON.ends[rows[:-1]]
    soft |= (kind == NAME) & opens
    # a piece between two ends, counted without its punctuation-only words
    piece = np.cumsum(opens | (rows == _CANON[_MARK]))
    keep = np.flatnonzero(kind != BREAK)
    doc = np.repeat(np.arange(len(texts)), counts)[keep]
    change = np.diff(piece[keep]) > 0
    edge = np.ones(1, bool)
    return (rows[keep], doc, _CANON.code[rows[keep]], kind[keep], soft[keep],
            np.concatenate([edge, change]), np.concatenate([change, edge]))


def core_words(rows: np.ndarray) -> list[str]:
    """Texts of words of the batch last read."""
    return [_CANON.core[k] for k in rows.tolist()]


def windows(doc, lit, kind, soft, begins, ends, width: int, known=None):
    """(start, hash, slots, soft slots, is a template in every reading) of the
    windows inside one document, in pieces; slots are bits of the places read as
    values (word for word: of those that are values in every reading).  ``known``:
    the words that can be matched literally (None: all)."""
    n = len(lit) - width + 1
    if n <= 0:
        return
    inside = doc[:n] == doc[width - 1:]
    if width < MIN_ITEM:
        inside &= begins[:n] & ends[width - 1:]
        pieces = np.add.accumulate(begins, dtype=np.int64)
        inside &= pieces[:n] == pieces[width - 1:]
    known = np.ones(len(lit), bool) if known is None else known
    hard = (kind != LITERAL) & ~soft

    def many(flag, at):
        before = np.concatenate([[0], np.cumsum(flag)])
        return before[at + width] - before[at]

    every = np.flatnonzero(inside)
    every = every[many(~known & (kind == LITERAL) & ~soft, every) == 0]
    before = np.concatenate([[0], np.cumsum(soft)])
    n_soft, forced, strange = before[every + width] - before[every], many(~known & soft, every), many(~known, every)
    code = np.where(hard, kind.astype(np.uint64), lit)
    literal_hash, hash_ = np.full(len(every), width, np.uint64), np.full(len(every), width, np.uint64)
    bits = np.zeros(len(every), np.int64)
    for k in range(width):
        literal_hash += lit[every + k] * _MULT[k]
        hash_ += code[every + k] * _MULT[k]
        bits |= hard[every + k].astype(np.int64) << k
    literals = width - np.bitwise_count(bits).astype(np.int64)
    safe = literals - n_soft >= LITERALS
    none = np.zeros(len(every), np.int64)
    x = np.flatnonzero(strange == 0)
    yield every[x], mix(literal_hash[x]), bits[x], none[x], safe[x]
    if width < MIN_ITEM:
        return
    x = np.flatnonzero((bits > 0) & (forced == 0) & (literals >= LITERALS))
    yield every[x], mix(hash_[x]), bits[x], none[x], safe[x]
    place = np.flatnonzero(soft)
    for k in range(1, width + 1):
        some = np.flatnonzero((n_soft == k) & (literals - np.maximum(forced, 1) >= LITERALS))
        step = READINGS >> k
        for start in range(0, len(some), step):
            x = some[start:start + step]
            at = every[x]
            held = place[before[at][:, None] + np.arange(k)]
            offset = held - at[:, None]
            delta = (kind[held].astype(np.uint64) - lit[held]) * np.array(_MULT)[offset]
            must = (~known[held] << offset).sum(axis=1)
            h, b = hash_[x][:, None], np.zeros((len(x), 1), np.int64)
            for j in range(k):
                h = np.hstack([h, h + delta[:, j:j + 1]])
                b = np.hstack([b, b | (1 << offset[:, j:j + 1])])
            ok = (literals[x][:, None] - np.bitwise_count(b) >= LITERALS) & (b & must[:, None] == must[:, None])
            ok[:, 0] = False
            row, col = np.nonzero(ok)
            yield at[row], mix(h[row, col]), bits[x[row]] | b[row, col], b[row, col], safe[x[row]]


_ROWS = "words long, pos long, hash long, slots array<string>, held long, soft long, safe boolean, n_safe long"


def _scan(widths: tuple[int, ...], flags):
    """A row of every window that may match, in each of its readings; ``slots``
    are all its words.  ``flags`` None: of every window, only of the width an item
    is cut by, shorter items whole."""
    def run(batches):
        has, word = (None, None) if flags is None else (
            np.unpackbits(np.frombuffer(x, np.uint8)).view(bool) for x in flags.value)
        for batch in batches:
            rows, doc, *marks = canonical_words(batch.column(1).to_pylist())
            count = np.bincount(doc, minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(count)])
            if has is None:  # a short item is looked for by all its words
                marks[-2:] = np.isin(np.arange(len(doc)), first[:-1]), np.isin(np.arange(len(doc)), first[1:] - 1)
            known = None if has is None else word[marks[0] % np.uint64(BUCKETS)]
            parts = [[np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, bool, np.int64)]]
            n_safe = np.zeros(batch.num_rows, np.int64)
            for width in widths:
                for k, (at, h, held, soft, safe) in enumerate(windows(doc, *marks, width, known)):
                    if has is None:
                        sel = np.minimum(count[doc[at]], WINDOW) == width
                        if k == 0:
                            n_safe += np.bincount(doc[at[sel & safe]], minlength=batch.num_rows)
                    else:
                        sel = has[h % np.uint64(BUCKETS)]
                    parts.append([x[sel] for x in (at, h, held, soft, safe)] + [np.full(int(sel.sum()), width)])
            at, h, held, soft, safe, width = (np.concatenate(x) for x in zip(*parts))
            slots = [core_words(rows[a:a + w]) for a, w in zip(at, width)]
            d = doc[at]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(d, pa.int64())), pa.array(count[d], pa.int64()),
                pa.array(at - first[d], pa.int64()), pa.array(h.view(np.int64), pa.int64()),
                pa.array(slots, pa.list_(pa.string())), pa.array(held, pa.int64()), pa.array(soft, pa.int64()),
                pa.array(safe, pa.bool_()), pa.array(n_safe[d], pa.int64())],
                ["key", "words", "pos", "hash", "slots", "held", "soft", "safe", "n_safe"])
    return in_turn(run, "canonical words")


def _windows(df: DataFrame, key: Column, key_type: str, text_col: str, widths, flags) -> DataFrame:
    return df.select(key.alias("key"), text_bytes(text_col).alias("t")).mapInArrow(
        _scan(widths, flags), f"key {key_type}, {_ROWS}")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: Column, text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, n_words, same_values) of every contaminated document and
    item: the canonical words lined up, and whether all slots agree."""
    spark = docs.sparkSession
    # the type without a plan over the texts: the key is a column or a digest of one
    key_type = docs.select(key.alias("key")).schema["key"].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType.simpleString()
    items = S.materialize(_windows(benchmark, F.col(item_col), item_type, item_text,
                                   tuple(range(1, WINDOW + 1)), None), "benchmark-windows")
    flags = np.zeros(BUCKETS, bool)
    buckets = items.select(F.pmod("hash", F.lit(BUCKETS)).cast("int").alias("k")).distinct() \
        .groupBy(F.pmod("k", F.lit(4096)).alias("g")).agg(F.collect_list("k").alias("ks"))
    for row in buckets.toLocalIterator():
        flags[row.ks] = True
    words = np.zeros(BUCKETS, bool)
    for row in items.select(F.explode("slots").alias("w")).distinct().groupBy(F.pmod(F.xxhash64("w"), F.lit(4096)).alias("g")) \
            .agg(F.collect_list("w").alias("ws")).toLocalIterator():
        words[[xxhash.xxh3_64_intdigest(w) % BUCKETS for w in row.ws]] = True
    # an item shorter than the window is one window of its own length
    widths = tuple(r.w for r in items.select(F.least("words", F.lit(WINDOW)).cast("int").alias("w")).distinct().collect())
    found = _windows(docs, key, key_type, text_col, tuple(sorted(widths)),
                     spark.sparkContext.broadcast((np.packbits(flags).tobytes(), np.packbits(words).tobytes()))).select("key", "pos", "hash", "slots")
    items = items.select(F.col("key").alias("item_id"), F.col("words").alias("m"), F.col("pos").alias("ipos"),
                         "hash", F.col("slots").alias("islots"), "held", "soft", "safe", "n_safe")
    values = F.filter(F.transform(F.arrays_zip("islots", "slots"), lambda x, i: F.struct(
        x["islots"].alias("v"), x["slots"].alias("d"), (F.getbit("held", i) == 1).alias("held"),
        (F.getbit("soft", i) == 1).alias("soft"))), lambda x: x["held"])
    lined = found.join(items, "hash").select(
        "key", "item_id", "m", "n_safe", "safe", "pos", (F.col("pos") - F.col("ipos")).alias("shift"),
        values.alias("slots"))
    lined = S.materialize(lined, "lined-up")
    group = ["key", "item_id", "shift"]
    # One item value, two document values: between values the line-up is no copy,
    # with a soft word only the readings that take it for a value are none.
    firm = F.when(~F.col("x.soft"), F.col("x.d"))
    clash = lined.select(*group, F.explode("slots").alias("x")).groupBy(*group, F.col("x.v").alias("v")).agg(
        (F.min("x.d") != F.max("x.d")).alias("two"),
        F.coalesce(F.min(firm) != F.max(firm), F.lit(False)).alias("no")).filter("two") \
        .groupBy(*group).agg(F.bool_or("no").alias("no"), F.collect_set("v").alias("vs"))
    r, c = lined.alias("r"), clash.alias("c")
    kept = r.join(c, F.col("r.key").eqNullSafe(F.col("c.key")) & (F.col("r.item_id") == F.col("c.item_id"))
                  & (F.col("r.shift") == F.col("c.shift")), "left") \
        .filter(F.col("c.no").isNull() | (~F.col("c.no") & ~F.exists(
            "r.slots", lambda x: x["soft"] & F.array_contains(F.col("c.vs"), x["v"])))).select("r.*")
    runs = kept.groupBy(*group).agg(
        F.max("m").alias("m"), (F.count_distinct("pos") + F.least(F.max("m"), F.lit(WINDOW)) - 1).alias("n_words"),
        F.max("n_safe").alias("n_safe"), F.count_distinct(F.when(F.col("safe"), F.col("pos"))).alias("hit"),
        F.bool_and(F.forall("slots", lambda x: x["v"].eqNullSafe(x["d"]))).alias("same_values")) \
        .filter((F.col("n_words") >= F.least("m", F.lit(RUN))) | ((F.col("n_safe") > 0) & (F.col("hit") >= F.col("n_safe"))))
    return runs.groupBy("key", "item_id").agg(F.max("n_words").alias("n_words"),
                                              F.bool_or("same_values").alias("same_values"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_words, same_values) of the contaminated documents."""
    return contaminated(docs, benchmark, F.col(id_col), text_col).withColumnRenamed("key", "doc_id")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text matches no item, with all columns.  Only
    texts that may be contaminated are shuffled."""
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    bad = S.materialize(contaminated(docs, benchmark, digest, text_col).select(F.col("key").alias("__digest")).distinct(),
                        "contaminated")
    may, clean = split_by_keys(docs, digest, bad)
    return clean.unionByName(may.join(bad, digest == F.col("__digest"), "left_anti"))
