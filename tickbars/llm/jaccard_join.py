"""N-gram Jaccard join by signature trees.

Sets of distinct word shingles are compared by 64-bit hashes.  Equal sets share
a set id, so copies collapse before anything is compared.  Then

1. prefixes: two sets with a similarity of at least ``pct`` share a token among
   the first n - ceil(pct n) + 1 tokens of any common order (tokens seen often
   come last).  A token of two or more sets is the root of a forest of signature
   trees over them.
2. neighbours: in every forest of more than one node, and in a share of the
   smaller ones, each leaf is compared with the next few by size; verified links
   are merged to components.  This only lets the trees skip pairs already decided
   (in a group of near copies, nearly all of them): a token whose sets all lie in
   one component is finished and dropped.
3. signature trees: every other forest is cut into blocks of ``BLOCK`` leaves,
   block pairs are pruned by size range and component, and each surviving pair of
   blocks is one traversal (see ``signature_tree``).
4. every surviving pair is compared exactly, links are merged again.

Nothing is capped: hot tokens only get more blocks.  The list of often-seen
tokens is bounded and only chooses the common order, never the result.

Defined results: no words or a null text give an empty set, linked with
nothing; rows with a null id are reported with the smallest id of their
component; repeated rows appear as often as they came; an empty table gives no
rows; only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm import signature_tree as T
from tickbars.llm.common import WORD_HASHES, in_turn, only, signed, split_by_keys, text_bytes, window_hashes
from tickbars.llm.components import components

SHINGLE = 4
LINK_PCT = 85
#: Often-seen tokens that go last in the common order (bound of a broadcast).
OFTEN = 50_000
#: Leaves of one block of a token's forest.
BLOCK = 4096
#: Buckets (of document ids) of the bitmap that tells which texts a scan must read.
WANTED_BUCKETS = 1 << 22
#: Bits of a leaf bitmap: of sets up to NARROW_SIZE in trees of one node and in larger trees, and of larger sets.
#: A larger tree compares many near copies: the slack of a narrow bitmap would let most of its pairs through.
NARROW, DENSE, WIDE, NARROW_SIZE = 1024, 4096, 8192, 1200
#: Of the forests of one node, one in ``NEAR_SHARE`` is searched for neighbours, ``NEAR`` of them a leaf.
NEAR_SHARE, NEAR = 4, 16


def shingle_set(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (A-Z lower-cased)."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = WORD_HASHES.of(words)
    if len(h) < width:
        padded = np.concatenate([h, np.full(width - len(h) + 1, len(h), np.uint64)])
        return window_hashes(padded, width + 1)
    return np.unique(window_hashes(h, width))


def set_id(tokens: np.ndarray) -> int | None:
    return signed(xxhash.xxh3_64_intdigest(tokens.tobytes())) if len(tokens) else None


def links(x: np.ndarray, y: np.ndarray, pct: int = LINK_PCT) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return bool(both) and 100 * both >= pct * (len(x) + len(y) - both)


def _bitmap(tokens: np.ndarray, bits: int) -> bytes:
    out = np.zeros(bits, bool)
    out[tokens % np.uint64(bits)] = True
    return np.packbits(out).tobytes()


def _sketches(shingle: int):
    """doc_id, n, sid; the first row of a batch also lists the batch's most
    repeated tokens (over its distinct sets) with their counts."""
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, shingle) for t in batch.column(1).to_pylist()]
            sids = [set_id(s) for s in sets]
            distinct = {i: s for i, s in zip(sids, sets) if i is not None}
            often, count = np.empty(0, np.uint64), np.empty(0, np.int64)
            if distinct:
                often, count = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
                keep = count >= 3
                often, count = often[keep], count[keep]
            first = [[int(x) for x in often.view(np.int64)]] + [None] * (len(sets) - 1)
            first_n = [[int(x) for x in count]] + [None] * (len(sets) - 1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(sids, pa.int64()),
                pa.array(first[:len(sets)], pa.list_(pa.int64())),
                pa.array(first_n[:len(sets)], pa.list_(pa.int64()))],
                ["doc_id", "n", "sid", "often", "often_n"])
    return in_turn(run, "word hashes")


def _sets(wanted, shingle: int):
    """(sid, tokens) of the rows whose bucket is wanted, once per task; texts of
    other rows are not read."""
    def run(batches):
        has, done = np.unpackbits(np.frombuffer(wanted.value, np.uint8)).view(bool), set()
        for batch in batches:
            ids, sets = [], []
            for t in batch.column(1).filter(pa.array(has[np.asarray(batch.column(0))])).to_pylist():
                s = shingle_set(t, shingle)
                i = set_id(s)
                if i is not None and i not in done:
                    done.add(i)
                    ids.append(i)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())],
                                             ["sid", "tokens"])
    return in_turn(run, "word hashes")


def _prefixes(often, shingle: int, pct: int):
    """(sid, n, prefix, three bitmaps) of every set, once per task."""
    def run(batches):
        last, done = np.frombuffer(often.value, np.uint64), set()
        for batch in batches:
            rows = []
            for t in batch.column(0).to_pylist():
                s = shingle_set(t, shingle)
                i = set_id(s)
                if i is None or i in done:
                    continue
                done.add(i)
                n = len(s)
                take = n - -(-pct * n // 100) + 1
                late = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s if len(last) else np.zeros(n, bool)
                order = np.concatenate([s[~late], s[late]])[:take]
                small = pct * n <= 100 * NARROW_SIZE
                rows.append((i, n, order.view(np.int64), _bitmap(s, NARROW) if small else None,
                             _bitmap(s, DENSE) if small else None, _bitmap(s, WIDE) if n > NARROW_SIZE else None))
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                pa.array(cols[2], pa.list_(pa.int64())), pa.array(cols[3], pa.binary()),
                pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.binary())],
                ["sid", "n", "prefix", "bits", "bits_dense", "bits_wide"])
    return in_turn(run, "word hashes")


def _pairs(a, b):
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    return pa.RecordBatch.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], ["a", "b"])


def _near_leaves(cols, bits, run, sel, reach: int, pct: int):
    """Pairs of the selected leaves up to ``reach`` rows apart in one run (of the
    rows' tree) that may link."""
    width = np.fromiter((len(bits[k]) for k in sel), np.int64, len(sel))
    for w in np.unique(width):
        at = sel[width == w]
        level = T.leaves(cols["n"][at], cols["comp"][at], cols["rest"][at],
                         np.frombuffer(b"".join(bits[k] for k in at), np.uint64).reshape(len(at), -1))
        r, sid = run[at], cols["sid"][at]
        for d in range(1, min(reach, len(at) - 1) + 1):
            i = np.flatnonzero(r[d:] == r[:-d])
            if not len(i):
                break
            i = i[T.possible(level, level, i, i + d, pct)]
            if len(i):
                yield _pairs(sid[i], sid[i + d])


def _runs(cols, keys) -> np.ndarray:
    """Starts of the runs of equal keys."""
    change = np.zeros(len(cols[keys[0]]), bool)
    for k in keys:
        change[1:] |= cols[k][1:] != cols[k][:-1]
    change[:1] = True
    return np.flatnonzero(change)


def _neighbours(pct: int):
    """Near pairs of rows sorted by tree and size; each batch on its own (a
    missed neighbour costs the trees work, never a link)."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cols = {k: np.asarray(batch.column(batch.schema.get_field_index(k)))
                        for k in ("tier", "token", "sid", "n", "rest")}
                cols["comp"] = cols["sid"]
                bits = batch.column(batch.schema.get_field_index("bits")).to_pylist()
                start = _runs(cols, ["tier", "token"])
                group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(bits))))
                yield from _near_leaves(cols, bits, group, np.arange(len(bits)), NEAR, pct)
    return in_turn(run)


def _candidates(pct: int):
    """Leaf pairs of every cell (token, tier, block i, block j) of sorted rows.
    Cells of up to ``FAN`` leaves are one node: their leaves are compared by
    shifts over the whole batch."""
    keys = ["tier", "token", "bi", "bj"]

    def cells(cols, bits):
        n = len(cols["sid"])
        start = _runs(cols, keys)
        length = np.diff(np.append(start, n))
        small = (length <= T.FAN) & (cols["bi"][start] == cols["bj"][start])
        group = np.repeat(np.arange(len(start)), length)
        yield from _near_leaves(cols, bits, group, np.flatnonzero(np.repeat(small, length)), T.FAN - 1, pct)
        for s, m in zip(start[~small], length[~small]):
            at = np.arange(s, s + m)
            sides = [at] if cols["bi"][s] == cols["bj"][s] else [at[cols["side"][at] == k] for k in (0, 1)]
            if not all(len(x) for x in sides):
                continue
            trees, ids, height = [], [], 0
            for x in sides:
                x = x[np.lexsort((cols["sid"][x], cols["n"][x]))]
                ids.append(cols["sid"][x])
                trees.append(T.leaves(cols["n"][x], cols["comp"][x], cols["rest"][x],
                                      np.frombuffer(b"".join(bits[k] for k in x), np.uint64).reshape(len(x), -1)))
            height = max(len(T.grow(t)) for t in trees) if len(trees) > 1 else 0
            grown = [T.grow(t, height) for t in trees]
            for i, j in T.traverse(grown[0], grown[-1], pct):
                yield _pairs(ids[0][i], ids[-1][j])

    def run(batches):
        held, held_bits = None, []
        names = [*keys, "side", "sid", "n", "comp", "rest"]
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {k: np.asarray(batch.column(batch.schema.get_field_index(k))) for k in names}
            bits = batch.column(batch.schema.get_field_index("bits")).to_pylist()
            if held is not None:
                cols = {k: np.concatenate([held[k], cols[k]]) for k in names}
                bits = held_bits + bits
            same = np.ones(len(bits), bool)
            for k in keys:
                same &= cols[k] == cols[k][-1]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield from cells({k: v[:cut] for k, v in cols.items()}, bits[:cut])
            held, held_bits = {k: v[cut:] for k, v in cols.items()}, bits[cut:]
        if held is not None:
            yield from cells(held, held_bits)
    return in_turn(run)


def _bucket():
    """Bucket of a row's document id (a null id has one too)."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(WANTED_BUCKETS)).cast("int")


def _verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, shingle: int, pct: int, name: str,
              done: tuple[DataFrame, ...] = ()) -> DataFrame:
    """The pairs (a, b) of set ids whose sets link, by exact comparison.  Of each
    set that takes part one document is read again, told by the bucket of its id;
    the texts are scanned, not shuffled.  ``done``: tables that nothing reads
    once the pairs are written."""
    spark = pairs.sparkSession
    pairs = S.materialize(pairs, f"{name}-pairs")
    for table in done:
        S.discard(table)
    sids = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    flags = np.zeros(WANTED_BUCKETS, bool)
    one = members.join(sids, "sid", "left_semi").groupBy("sid").agg(F.min(_bucket()).alias("k"))
    for row in one.select("k").distinct() \
            .select(F.pmod("k", F.lit(4096)).alias("g"), "k").groupBy("g").agg(F.collect_list("k").alias("ks")) \
            .toLocalIterator():
        flags[row.ks] = True
    if not flags.any():
        return pairs
    wanted = spark.sparkContext.broadcast(np.packbits(flags).tobytes())
    sets = docs.select(_bucket().alias("k"), text_bytes("text").alias("t")).mapInArrow(
        _sets(wanted, shingle), "sid long, tokens binary")
    sets = S.materialize(sets.join(sids, "sid", "left_semi").groupBy("sid").agg(F.first("tokens").alias("tokens")),
                         f"{name}-sets")

    @F.arrow_udf("boolean")
    def linked(x: pa.Array, y: pa.Array) -> pa.Array:
        only()
        return pa.array([links(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), pct)
                         for a, b in zip(x.to_pylist(), y.to_pylist())], pa.bool_())

    joined = pairs.join(sets.select(F.col("sid").alias("a"), F.col("tokens").alias("x")), "a") \
        .join(sets.select(F.col("sid").alias("b"), F.col("tokens").alias("y")), "b")
    found = S.materialize(joined.filter(linked("x", "y")).select("a", "b"), f"{name}-links")
    S.discard(sets)
    S.discard(pairs)
    return found


def _with_bits(posts: DataFrame, sets: DataFrame) -> DataFrame:
    return posts.join(sets.select("sid", "bits", "bits_dense", "bits_wide"), "sid").withColumn(
        "bits", F.when(F.col("tier") == 1, F.col("bits_wide")).when(F.col("in_tree") > T.FAN, F.col("bits_dense"))
        .otherwise(F.col("bits"))).drop("bits_dense", "bits_wide")


def _posts(docs: DataFrame, often, shingle: int, pct: int) -> tuple[DataFrame, DataFrame]:
    """The distinct sets with prefix and bitmaps, and a row per set and prefix
    token by which another set may link: (sid, n, rest, token, tier, in_tree)."""
    schema = "sid long, n long, prefix array<long>, bits binary, bits_dense binary, bits_wide binary"
    sets = docs.select(text_bytes("text").alias("t")).mapInArrow(_prefixes(often, shingle, pct), schema)
    sets = S.materialize(sets.groupBy("sid").agg(*[F.first(c).alias(c) for c in schema.replace(",", "").split()[2::2]]),
                         "prefixes")
    tiers = F.filter(F.array(F.when(F.col("bits").isNotNull(), F.lit(0)), F.when(F.col("bits_wide").isNotNull(), F.lit(1))),
                     lambda x: x.isNotNull())
    posts = sets.select("sid", "n", tiers.alias("tiers"), F.posexplode("prefix").alias("at", "token")) \
        .select("sid", "n", (F.col("n") - F.col("at")).alias("rest"), "token", F.explode("tiers").alias("tier"))
    whole = Window.partitionBy("tier", "token")
    # At the first token that two linked sets share, what is to come of each holds all they share:
    # neither is larger than ``most`` of the other.  So a row matters if the next larger set is not,
    # or if a smaller set may be, and its size is not over ``most`` of one before it.
    by_size = whole.orderBy("n", "sid")
    posts = posts.withColumn("most", F.expr(f"{100 + pct} * rest div {pct} - n")).withColumns({
        "least": F.first("n").over(by_size.rowsBetween(Window.unboundedPreceding, 0)),
        "before": F.max("most").over(by_size.rowsBetween(Window.unboundedPreceding, -1)),
        "next": F.lead("n").over(by_size)}) \
        .filter("next <= most or (least <= most and n <= before)").drop("most", "least", "before", "next")
    posts = posts.withColumns({"low": F.min("sid").over(whole), "high": F.max("sid").over(whole),
                               "in_tree": F.count(F.lit(1)).over(whole)}).filter("low < high").drop("low", "high")
    return sets, S.materialize(posts, "posts")


def _near_pairs(sets: DataFrame, posts: DataFrame, pct: int) -> DataFrame:
    """Candidate pairs of neighbouring leaves, in all forests whose pairs may outnumber their rows by far (a group
    of near copies has but few tokens that count, and a share may miss them all) and in a share of the others."""
    some = _with_bits(posts.filter((F.col("in_tree") > T.FAN) | (F.pmod(F.xxhash64("token"), F.lit(NEAR_SHARE)) == 0)), sets)
    return some.repartition("tier", "token").sortWithinPartitions("tier", "token", "n", "sid").mapInArrow(
        _neighbours(pct), "a long, b long").distinct()


def _open_posts(posts: DataFrame, comps: DataFrame) -> DataFrame:
    """The rows of trees that hold more than one component, cut into blocks."""
    whole = Window.partitionBy("tier", "token")
    posts = posts.join(comps.select(F.col("node").alias("sid"), "comp"), "sid", "left").withColumn(
        "comp", F.coalesce("comp", "sid"))
    posts = posts.withColumns({"low": F.min("comp").over(whole), "high": F.max("comp").over(whole)}).filter("low < high") \
        .withColumn("block", F.floor((F.row_number().over(whole.orderBy("n", "sid")) - 1) / BLOCK).cast("int")) \
        .withColumn("blocks", F.max("block").over(whole) + 1).drop("low", "high")
    return S.materialize(posts, "open-posts")


def _tree_pairs(sets: DataFrame, posts: DataFrame, pct: int) -> DataFrame:
    """Candidate pairs of different components, from the signature trees."""
    one = posts.filter("blocks = 1").select(
        "tier", "token", F.lit(0).alias("bi"), F.lit(0).alias("bj"), F.lit(0).alias("side"), "sid", "n", "comp", "rest", "in_tree")
    many = posts.filter("blocks > 1")
    blocks = many.groupBy("tier", "token", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("comp").alias("cl"), F.max("comp").alias("ch"))
    i, j = blocks.alias("i"), blocks.alias("j")
    cells = i.join(j, (F.col("i.tier") == F.col("j.tier")) & (F.col("i.token") == F.col("j.token"))
                   & (F.col("i.block") <= F.col("j.block"))
                   & (100 * F.col("i.high") >= pct * F.col("j.low"))
                   & ~((F.col("i.cl") == F.col("j.ch")) & (F.col("i.ch") == F.col("j.cl")) & (F.col("i.cl") == F.col("i.ch")))) \
        .select("i.tier", "i.token", F.col("i.block").alias("bi"), F.col("j.block").alias("bj"))
    cells = cells.select("*", F.explode(F.when(F.col("bi") == F.col("bj"), F.array(F.lit(0))).otherwise(
        F.array(F.lit(0), F.lit(1)))).alias("side")).withColumn(
        "block", F.when(F.col("side") == 0, F.col("bi")).otherwise(F.col("bj")))
    leaves = one.unionByName(many.join(cells, ["tier", "token", "block"]).select(one.columns))
    leaves = _with_bits(leaves, sets)
    keys = ["tier", "token", "bi", "bj"]
    return leaves.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _candidates(pct), "a long, b long").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, pct: int = LINK_PCT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``; two documents
    link when 100 * intersection >= pct * union of their shingle sets."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n long, sid long, often array<long>, often_n array<long>"
    sketches = S.materialize(docs.select("doc_id", text_bytes("text").alias("t")).mapInArrow(
        _sketches(shingle), schema), "sketches")
    members = sketches.select("doc_id", "n", "sid")
    top = sketches.filter("often is not null").select(F.explode(F.arrays_zip("often", "often_n")).alias("x")) \
        .groupBy(F.col("x.often").alias("token")).agg(F.sum("x.often_n").alias("c")) \
        .orderBy(F.desc("c"), "token").limit(OFTEN).select("token")
    last = np.sort(np.array([r.token for r in top.collect()], np.int64).view(np.uint64))
    often = spark.sparkContext.broadcast(last.tobytes())

    sets, posts = _posts(docs, often, shingle, pct)
    near = _verified(_near_pairs(sets, posts, pct), docs, members, shingle, pct, "near")
    comps = S.materialize(components(near), "near-components")
    still = _open_posts(posts, comps)
    S.discard(posts)
    rest = _verified(_tree_pairs(sets, still, pct), docs, members, shingle, pct, "tree", (sets, still))
    stars = comps.select(F.col("node").alias("a"), F.col("comp").alias("b"))
    comps = components(rest.select("a", "b").union(stars))

    named = S.materialize(members.join(comps.select(F.col("node").alias("sid"), "comp"), "sid", "left").withColumn(
        "comp", F.coalesce("comp", "sid")), "members")
    S.discard(sketches)
    least = named.filter("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return named.join(least, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE, pct: int = LINK_PCT) -> DataFrame:
    """One document of each group, that of the smallest id, with its columns
    unchanged.  Rows of one id and one text are one document; rows with a null
    id belong to no group and stay."""
    found = jaccard_components(docs, id_col, text_col, shingle, pct).filter(F.col("doc_id").isNotNull())
    marked = S.materialize(found.groupBy(F.col("doc_id").alias("__id")).agg(
        F.bool_or(F.col("doc_id") != F.col("component_id")).alias("gone"), F.count(F.lit(1)).alias("m"))
        .filter("gone or m > 1"), "marked")
    # only rows that may go or repeat are shuffled; of the others each id comes once
    may, others = split_by_keys(docs, docs[id_col], marked.select("__id"))
    kept = may.join(marked.filter("gone"), may[id_col] == F.col("__id"), "left_anti")
    return others.unionByName(kept.dropDuplicates([id_col, text_col]))
