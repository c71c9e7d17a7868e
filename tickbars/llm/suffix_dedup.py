"""Repeated 200-byte strings by merging the Burrows-Wheeler transforms of shards.

Every byte that lies in a string of ``LENGTH`` bytes which starts anywhere else
too (in the same text or another) is found; matches never cross texts.

Shards.  Each task cuts its texts into shards of about ``SHARD_BYTES`` and
parses them into *phrases* at cut points that depend on a few bytes of content
only (``cut_points``), so equal passages are cut alike wherever they stand.  A
shard's suffixes start at phrases and are compared phrase by phrase; the shard
sorts them (suffix array) and keeps the array and the phrase hashes, which hold
its transform: the symbol before a suffix and the step to that suffix's rank
(LF).  Nothing is sorted again after this.

Merge by interleave refinement.  After k steps the merged order is known up to
the first k symbols: it is a sequence of blocks, each an interval of every
shard's ranks.  A step takes each shard's blocks through LF (the block of c + x
follows from the block of x), and counts a block's suffixes over the shards by
its hash.  A block of one suffix shares no longer prefix with any other: the
suffix's longest common prefix is known and it takes no further part; a block
of two or more goes on.  So the work shrinks to what is repeated, and a suffix
stops once its prefix covers every window that starts in its first phrase.
Blocks are counted after the steps in ``STEPS``, one exchange each; a shard
sends one hash per block and step, however many of its suffixes are in it, so a
passage in a third of all texts costs one hash per shard.  Hashes travel packed,
a row per shard and range of hashes, and a range's are sorted where they meet.

Repeated intervals.  A repeated prefix of ``LENGTH`` bytes or more is removed
as it is.  A repeated window may also stick out of a repeated run of phrases
into the next phrase on either side.  Such *edge* windows are few (about a
phrase's length at each end of a repeated passage); they are counted by a
128-bit hash of their bytes.  The same window may lie inside a longer repeated
run elsewhere, where it is no edge.  Groups of neighbouring windows are
therefore counted first, by the bytes that the windows of a group share; single
windows are sent only for groups that stand twice, hold an edge somewhere and
have other bytes around the shared ones in places.

The shard table is bucketed by shard, so every round joins its few rows to it
without moving texts or suffix arrays.  Blocks are told apart by 64-bit hashes.

Defined results: a null text is empty (no spans, nothing kept); repeated rows
and null ids are rows of their own, so exact copies remove each other; texts
under ``LENGTH`` bytes lose nothing; an empty table gives no rows.  Columns
beside the id and the text are not read.  A text longer than ``SHARD_BYTES`` is
a shard of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm.common import mix, text_bytes

LENGTH = 200
SHARD_BYTES = 4 << 20
#: Most buckets of the shard table (Spark's own bound is 100,000).
MAX_BUCKETS = 50_000

# Cut points: bytes read at a point, mean distance, the distance after which weak points count, their mean
# distance, and the distance without weak points after which every position counts.
GRAM, MEAN, GAP, WEAK, WEAK_GAP = 8, 28, 128, 8, 32
_STRONG = np.uint64((1 << 64) // MEAN)
#: Last place in a window of LENGTH bytes at which a cut point is decided by the window's own bytes.
_SEEN = LENGTH - GRAM
#: Neighbouring windows that are asked for together.
GROUP = 16
#: Steps after which blocks are counted.  A suffix is followed no further than the last one; what that leaves open
#: (lengths between two counts, windows in stretches of short phrases) is decided by the windows' bytes.
STEPS = (1, 3, 6, 15)
MOST_STEPS = STEPS[-1]
_CHUNK = 1 << 16
#: Key ranges by which shards' hashes meet: a shard sends one row of packed hashes per range, so a range is all that a
#: task holds at a time.
RANGE_BITS = 10
#: Bits of a sent hash's flags: the shard has it more than once; asks for it.
_MORE, _ASKED = np.uint8(1), np.uint8(2)
#: Positions whose bytes are hashed together (bounds memory only), and a multiplier per lane (any odd numbers do).
_AT_ONCE = 1 << 12
_LANES = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93], np.uint64)
#: A phrase is at most GAP + WEAK_GAP + GRAM bytes long: one random number per (place in phrase, byte).
_LONGEST = GAP + WEAK_GAP + GRAM + 8
_PLACES = np.random.default_rng(20240613).integers(0, 1 << 64, (_LONGEST, 256), np.uint64).ravel()
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FAR = np.int64(1) << 60


def cut_points(buf: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, strong?) of the cut points of texts lying at [begin, end) of ``buf``.

    A position is strong by the hash of its GRAM bytes.  Where no strong one lies in the GAP bytes before, weak
    ones (a commoner hash) count, and every position with no weak one in the WEAK_GAP bytes before.  A point is
    thus decided by bytes from GAP before it (strong: from itself) to GRAM after it, and every window of LENGTH
    bytes holds one that its own bytes decide."""
    raw = np.frombuffer(buf + bytes(GRAM), np.uint8)
    strong, weak = [], []
    for a in range(0, len(buf), _CHUNK):
        n = min(_CHUNK, len(buf) - a)
        h = mix(np.lib.stride_tricks.sliding_window_view(raw[a:a + n + GRAM - 1], GRAM).copy().view(np.uint64)[:, 0] * _STEP)
        strong.append(np.flatnonzero(h < _STRONG) + a)
        weak.append(np.flatnonzero((h & np.uint64(WEAK - 1)) == 0) + a)
    strong = np.concatenate(strong) if strong else np.empty(0, np.int64)
    weak = np.concatenate(weak) if weak else np.empty(0, np.int64)
    of = np.searchsorted(begins, strong, "right") - 1
    strong = strong[strong + GRAM <= ends[of]]
    # stretches without a strong point: after each strong point, and from each begin
    after = np.concatenate([strong + GAP + 1, begins + GAP])
    until = np.searchsorted(begins, np.concatenate([strong, begins]), "right") - 1
    nxt = np.searchsorted(strong, np.concatenate([strong, begins - 1]), "right")
    stop = np.minimum(np.append(strong, _FAR)[nxt], ends[until] - GRAM + 1)
    size = np.maximum(stop - after, 0)
    pos = np.repeat(after - (np.cumsum(size) - size), size) + np.arange(size.sum())
    at = np.searchsorted(weak, pos)
    is_weak = np.append(weak, -1)[at] == pos
    last = np.append(-_FAR, weak)[at]
    extra = pos[is_weak | (pos - last > WEAK_GAP)]
    points = np.concatenate([strong, extra])
    order = np.argsort(points, kind="stable")
    return points[order], (np.arange(len(points)) < len(strong))[order]


def phrase_hashes(buf: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(buf, np.uint8)
    out, a = [], 0
    while a < len(starts):  # whole phrases of about a chunk of bytes
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + _CHUNK)))
        s, z = starts[a:b] - starts[a], sizes[a:b]
        place = np.arange(z.sum()) - np.repeat(s, z)
        out.append(np.add.reduceat(_PLACES[(place << 8) + raw[starts[a]:starts[a] + len(place)]], s))
        a = b
    return mix(np.concatenate(out) + sizes.astype(np.uint64) * _STEP) if out else np.empty(0, np.uint64)


def suffix_array(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order by the first MOST_STEPS symbols at least, by prefix doubling; ``left``: symbols up to the text's end.  A
    suffix that is alone with its prefix has its place and is sorted no more."""
    n = len(symbols)
    if not n:
        return np.empty(0, np.int32)
    order = np.argsort(symbols)
    head = np.r_[True, symbols[order[1:]] != symbols[order[:-1]]]
    rank = np.empty(n, np.int64)  # the first place of its equals
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    k, most = 1, min(int(left.max()), MOST_STEPS)
    at = np.flatnonzero(~(head & np.append(head[1:], True)))
    while k < most and len(at):
        own = order[at]
        key = rank[own] * (n + 1) + np.where(left[own] > k, rank[np.minimum(own + k, n - 1)] + 1, 0)
        by = np.argsort(key)
        own, key = own[by], key[by]
        head = np.r_[True, key[1:] != key[:-1]]
        order[at] = own
        rank[own] = np.maximum.accumulate(np.where(head, at, 0))
        at = at[~(head & np.append(head[1:], True))]
        k *= 2
    return order.astype(np.int32)


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are in an ascending array."""
    at = np.searchsorted(ascending, values)
    return np.append(ascending, ~values[:1])[at] == values if len(ascending) else np.zeros(len(values), bool)


class Shard:
    """A shard's suffixes in text order (positions, sizes, symbols, kinds of start) and in rank order (suffix
    array, LF)."""

    def __init__(self, lengths: np.ndarray, phrases: np.ndarray, sizes: np.ndarray, symbols: np.ndarray, sa: np.ndarray,
                 kinds: np.ndarray):
        self.kinds = kinds
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        self.symbols, self.sa = symbols, sa
        self.sizes = sizes = sizes.astype(np.int64)
        self.starts = np.cumsum(sizes) - sizes
        n = len(sa)
        last = np.repeat(np.cumsum(phrases), phrases)
        self.left = last - np.arange(n)
        self.end = np.repeat(self.ends, phrases)
        isa = np.empty(n, np.int64)
        isa[sa] = np.arange(n)
        first = np.ones(n, bool)
        first[1:] = last[1:] != last[:-1]
        self.lf = np.where(first[sa], -1, isa[sa - 1])
        # symbols until a prefix covers every window that starts in the first phrase (or the text or patience ends)
        reach = np.searchsorted(self.starts, self.starts + sizes + LENGTH - 1)
        self.covers = np.minimum(reach - np.arange(n), self.left)
        self.need = np.minimum(self.covers, MOST_STEPS)[sa]

    def points(self) -> tuple[np.ndarray, np.ndarray]:
        """Cut points and whether they are strong."""
        point = self.kinds > 0
        return self.starts[point], self.kinds[point] == 2

    def refine(self, ranks: np.ndarray, blocks: np.ndarray, level: np.ndarray, known: int,
               k: int) -> tuple[np.ndarray, np.ndarray]:
        """One step of the interleave: (ranks, blocks) of the prefixes of k symbols, by rank, from those of k - 1
        symbols.  Only ranks known to be repeated for ``known`` symbols and not yet followed far enough go on."""
        if k == 1:
            return np.arange(len(self.sa)), self.symbols[self.sa]
        to = self.lf[ranks]
        go = (to >= 0) & (level[to] >= known) & (self.need[to] >= k)
        to, blocks = to[go], blocks[go]
        order = np.argsort(to)
        to = to[order]
        return to, mix(self.symbols[self.sa[to]] * _STEP + blocks[order])

    @staticmethod
    def intervals(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, ranks) per interval of ranks with one block."""
        head = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else np.empty(0, np.int64)
        return blocks[head], np.diff(np.append(head, len(blocks)))

    def settle(self, level: np.ndarray, blocks: np.ndarray, shared: np.ndarray, low: int, high: int) -> np.ndarray:
        """Takes the counts between steps ``low`` and ``high`` in: raises ``level`` (symbols known to be repeated, by
        rank) where the block has company in the shard or is one of ``shared``.  ``blocks``: those of the ranks at
        ``low``; returns those of the ranks at ``high``."""
        ranks, last = np.flatnonzero(level == low), blocks
        before = level.copy()
        for k in range(low + 1, high + 1):
            ranks, blocks = self.refine(ranks, blocks, before, low, k)
            sent = (self.need[ranks] == k) | (k == high)
            b, n = self.intervals(blocks[sent])
            alive = np.repeat((n > 1) | _among(b, shared), n)
            level[ranks[sent][alive]] = k
            last = blocks[sent][alive]
        return last

    def messages(self, level: np.ndarray, blocks: np.ndarray, high: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, suffixes) of the ranks that may go on after step ``high``: each at step ``upto``, or before that
        where it needs no more symbols."""
        ranks = np.flatnonzero(level == high)
        keys, counts = [], []
        for k in range(high + 1, upto + 1):
            ranks, blocks = self.refine(ranks, blocks, level, high, k)
            b, n = self.intervals(blocks[(self.need[ranks] == k) | (k == upto)])
            keys.append(b)
            counts.append(n)
        return np.concatenate(keys), np.concatenate(counts)

    def reach(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text order: where the longest repeated prefix of each suffix ends, as known and at most."""
        k, need = np.empty(len(self.sa), np.int64), np.empty(len(self.sa), np.int64)
        k[self.sa], need[self.sa] = level, self.need
        later = np.append(STEPS, MOST_STEPS)[np.searchsorted(STEPS, k, "right")]
        most = np.where(k < need, np.minimum(need, later) - 1, k)
        known, most = self._ends(k), self._ends(most)
        return known, np.where((k == MOST_STEPS) & (self.covers > k), self.end, most)

    def _ends(self, k: np.ndarray) -> np.ndarray:
        full = k == self.left
        at = np.append(self.starts, 0)[np.arange(len(k)) + np.where(full, 0, k)]
        return np.where(full, self.end, at)


def anchored_windows(shard: Shard, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, anchor, inside a repeated prefix?) of every window that may be repeated.

    A window's anchor is its first strong point or, with none, the first point from GAP on: its own bytes decide
    which.  If the window is repeated, so is the run of phrases from its anchor to the last point that its bytes
    decide.  So per point: the windows it anchors, up to the place where that run would outgrow its reach at most."""
    points, strong = shard.points()
    reach, at_most = shard.reach(level)
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    text = np.searchsorted(shard.begins, points, "right") - 1
    begin, end = shard.begins[text], shard.ends[text]
    s = points[strong]
    before = np.maximum(np.append(-_FAR, s)[np.searchsorted(s, points)], begin - 1)
    following = np.append(s, _FAR)[np.searchsorted(s, points, "right")]
    following = np.where(following < end, following, _FAR)
    previous = np.maximum(np.append(-_FAR, points)[:-1], begin - 1)
    mine = at_most[shard.kinds > 0]
    outgrows = np.append(points, _FAR)[np.searchsorted(points, mine, "right")]
    outgrows = np.where(outgrows < end, outgrows, _FAR)
    low = np.maximum(before + 1, np.where(strong, points - _SEEN, previous + 1 - GAP))
    # a weak point anchors windows without any strong point
    high = np.where(strong, points, np.minimum(points - GAP, following - _SEEN - 1))
    low = np.maximum(low, begin)
    high = np.minimum(np.minimum(high, outgrows - _SEEN - 1), end - LENGTH)
    size = np.maximum(high - low + 1, 0)
    at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
    anchor = np.repeat(points, size)
    order = np.argsort(at, kind="stable")
    at, anchor = at[order], anchor[order]
    own = np.repeat(np.arange(len(shard.sa), dtype=np.int32), shard.sizes)[at]  # the phrase of a byte
    return at, anchor, np.maximum.accumulate(reach)[own] >= at + LENGTH


def _bytes_hashes(buf: bytes, at: np.ndarray, length: int, seed: np.ndarray | int, lane: int = 0) -> np.ndarray:
    """64-bit hash of the ``length`` bytes from each position and of the seed (one, or one a position), eight bytes at
    a time over many positions; lanes are independent of each other."""
    out = np.empty(len(at), np.uint64)
    if not len(at):
        return out
    rows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(buf, np.uint8), length)
    out[:] = (np.atleast_1d(seed).astype(np.uint64) + np.uint64(length)) * _STEP
    for a in range(0, len(at), _AT_ONCE):
        h = out[a:a + _AT_ONCE]
        held = np.zeros((len(h), -(-length // 8) * 8), np.uint8)
        held[:, :length] = rows[at[a:a + _AT_ONCE]]
        for word in held.view(np.uint64).T:
            h ^= word
            h *= _LANES[lane]
            h ^= h >> np.uint64(32)
    return mix(out)


def _routes(buf: bytes, at: np.ndarray, anchor: np.ndarray, shard: Shard,
            whole: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Neighbouring windows of one anchor in groups of GROUP: (hash of the bytes that all windows of a group share and
    of their step before the anchor, hash of all bytes of its windows (``whole``), group of each window).  Equal windows
    lie equally far before their anchors, so their groups share bytes and step; the step tells groups at one place, of
    two anchors, apart."""
    step = (anchor - at) // GROUP
    pair = anchor * LENGTH + step  # windows are in order, so a group's are neighbours
    head = np.r_[True, pair[1:] != pair[:-1]][:len(pair)]
    pair, group = pair[head], np.cumsum(head) - 1
    first = pair // LENGTH - pair % LENGTH * GROUP
    text = np.searchsorted(shard.ends, first, "right")
    low = np.maximum(first - GROUP + 1, shard.begins[text])
    high = np.minimum(first + LENGTH, shard.ends[text])
    core = _bytes_hashes(buf, first, LENGTH - GROUP + 1, pair % LENGTH)
    if not whole:
        return core, None, group
    around, full = np.empty(len(first), np.uint64), high - low == LENGTH + GROUP - 1
    around[full] = _bytes_hashes(buf, low[full], LENGTH + GROUP - 1, 0)
    # what a text's end cuts off has other lengths
    around[~full] = [xxhash.xxh3_64_intdigest(buf[i:j], seed=j - k)
                     for i, j, k in zip(low[~full].tolist(), high[~full].tolist(), first[~full].tolist())]
    return core, around, group


def _window_groups(buf: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit hashes of the distinct windows (n x 2), the window's place among them, and windows per hash."""
    h = np.stack([_bytes_hashes(buf, at, LENGTH, lane, lane) for lane in (0, 1)], axis=1)
    order = np.lexsort((h[:, 1], h[:, 0]))
    h = h[order]
    head = np.r_[True, (h[1:] != h[:-1]).any(axis=1)][:len(h)]
    group = np.empty(len(h), np.int32)
    group[order] = np.cumsum(head) - 1
    return h[head], group, np.diff(np.append(np.flatnonzero(head), len(h)))


_SHARDS = ("shard long, doc_ids array<long>, lengths array<int>, phrases array<int>, text binary, sizes binary, "
           "symbols binary, ranks binary, kinds binary")


def _shards(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, ids, texts, held = 0, [], [], 0

    def row():
        buf = b"".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        begins = ends - lengths
        full = lengths > 0
        points, strong = cut_points(buf, begins[full], ends[full])
        starts = np.union1d(points, begins[full])
        kinds = np.zeros(len(starts), np.uint8)
        kinds[np.searchsorted(starts, points)] = 1 + strong
        sizes = np.diff(np.append(starts, len(buf)))
        phrases = np.searchsorted(starts, ends) - np.searchsorted(starts, begins)
        symbols = phrase_hashes(buf, starts, sizes)
        left = np.repeat(np.cumsum(phrases), phrases) - np.arange(len(starts))
        one = [pa.array([(part << 24) + number]), pa.array([ids], pa.list_(pa.int64())),
               pa.array([lengths], pa.list_(pa.int32())), pa.array([phrases], pa.list_(pa.int32())),
               *[pa.array([x], pa.binary()) for x in (
                   buf, sizes.astype(np.uint8).tobytes(), symbols.tobytes(), suffix_array(symbols, left).tobytes(),
                   kinds.tobytes())]]
        return pa.RecordBatch.from_arrays(one, [c.split()[0] for c in _SHARDS.split(", ")])

    for batch in batches:
        for i, t in zip(batch.column("id"), batch.column("text")):
            text = t.as_py()
            if texts and held + len(text) > SHARD_BYTES:
                yield row()
                number, ids, texts, held = number + 1, [], [], 0
            ids.append(i.as_py())
            texts.append(text)
            held += len(text)
    if texts:
        yield row()


def _loaded(r: dict) -> Shard:
    return Shard(np.array(r["lengths"], np.int64), np.array(r["phrases"], np.int64), np.frombuffer(r["sizes"], np.uint8),
                 np.frombuffer(r["symbols"], np.uint64), np.frombuffer(r["ranks"], np.int32),
                 np.frombuffer(r["kinds"], np.uint8))


def _level(r: dict, shard: Shard) -> np.ndarray:
    return np.frombuffer(r["level"], np.uint16).astype(np.int64) if r["level"] else np.zeros(len(shard.sa), np.int64)


def _keys(values: list | None) -> np.ndarray:
    """Hashes in packed pieces, ascending."""
    return np.sort(np.frombuffer(b"".join(values or []), np.uint64))


_SENT = "sent array<struct<range:int,first:int,keys:binary,others:binary,flags:binary>>"


def _sent(keys: np.ndarray, flags: np.ndarray, others: np.ndarray | None = None) -> pa.Array:
    """Ascending hashes, each with a second one if given, packed by range; ``first``: place of a range's first."""
    part = keys >> np.uint64(64 - RANGE_BITS)
    head = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][:len(part)])
    cuts = list(zip(head.tolist(), [*head[1:].tolist(), len(keys)]))

    def packed(x):
        return pa.array([None if x is None else x[a:b].tobytes() for a, b in cuts], pa.binary())

    rows = pa.StructArray.from_arrays(
        [pa.array(part[head].astype(np.int32)), pa.array(head.astype(np.int32)), packed(keys), packed(others), packed(flags)],
        ["range", "first", "keys", "others", "flags"])
    return pa.ListArray.from_arrays(pa.array([0, len(cuts)], pa.int32()), rows)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _step(low: int, high: int, upto: int):
    def run(batches):
        for r in _rows(batches):
            shard = _loaded(r)
            level = _level(r, shard)
            blocks = shard.settle(level, np.frombuffer(r["blocks"] or b"", np.uint64), _keys(r["shared"]), low, high)
            keys, n = shard.messages(level, blocks, high, upto)
            order = np.argsort(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["shard"]]), pa.array([level.astype(np.uint16).tobytes()], pa.binary()),
                 pa.array([blocks.tobytes()], pa.binary()), _sent(keys[order], (n[order] > 1) * _MORE)],
                ["shard", "level", "blocks", "sent"])
    return run


def _ask(low: int, high: int):
    """Takes the last counts in; sends the groups of windows that may be repeated, with their number in the shard
    and whether a window of them is an edge (asked: 1) or all lie inside repeated prefixes (0)."""
    def run(batches):
        for r in _rows(batches):
            shard = _loaded(r)
            level = _level(r, shard)
            shard.settle(level, np.frombuffer(r["blocks"], np.uint64), _keys(r["shared"]), low, high)
            at, anchor, inside = anchored_windows(shard, level)
            core, whole, group = _routes(r["text"], at, anchor, shard, True)
            edge = np.zeros(len(core), bool)
            edge[group[~inside]] = True
            order = np.lexsort((whole, core))
            core, whole, edge = core[order], whole[order], edge[order]
            head = np.r_[True, (core[1:] != core[:-1]) | (whole[1:] != whole[:-1])][:len(core)]
            same = np.cumsum(head) - 1
            flags = (np.bincount(same) > 1) * _MORE
            flags[same[edge]] |= _ASKED
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["shard"]]), pa.array([level.astype(np.uint16).tobytes()], pa.binary()),
                 _sent(core[head], flags, whole[head])], ["shard", "level", "sent"])
    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes the groups that are repeated as a whole in; sends the windows of the groups that are repeated in part
    only, with their number."""
    for r in _rows(batches):
        shard = _loaded(r)
        at, anchor, _ = anchored_windows(shard, _level(r, shard))
        core, _, group = _routes(r["text"], at, anchor, shard, False)
        whole = at[_among(core, _keys(r["shared"]))[group]]
        s, e = _merged(whole, whole + LENGTH, touching=False)
        at = at[_among(core, _keys(r["parts"]))[group]]
        keys, group, n = _window_groups(r["text"], at)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["shard"]]), pa.array([r["level"]], pa.binary()),
             *[pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (s, e, at, group, n)],
             _sent(keys[:, 0], (n > 1) * _MORE, keys[:, 1])],
            ["shard", "level", "found", "found_end", "windows", "groups", "counts", "sent"])


def _merged(start: np.ndarray, end: np.ndarray, touching: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals; touching ones become one, if asked (those of neighbouring texts touch, but never overlap)."""
    if not len(start):
        return start, start
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    head = np.flatnonzero(np.r_[True, s[1:] > e[:-1] if touching else s[1:] >= e[:-1]])
    return s[head], e[np.append(head[1:], len(s)) - 1]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: id, bytes, removed [start, end) spans and the bytes that stay."""
    for r in _rows(batches):
        shard, buf = _loaded(r), r["text"]
        reach, _ = shard.reach(_level(r, shard))
        run = reach - shard.starts >= LENGTH
        at, group, n = (np.frombuffer(r[c], np.int32).astype(np.int64) for c in ("windows", "groups", "counts"))
        found = n > 1
        found[np.frombuffer(b"".join(r["shared"] or []), np.int64)] = True
        at = at[found[group]]
        # per text, so that spans of neighbouring texts never merge
        whole, whole_end = (np.frombuffer(r[c], np.int32).astype(np.int64) for c in ("found", "found_end"))
        start = np.concatenate([shard.starts[run], at, whole])
        end = np.concatenate([reach[run], at + LENGTH, whole_end])
        owner = np.searchsorted(shard.ends, start, "right")
        order = np.argsort(start, kind="stable")
        start, end, owner = start[order], end[order], owner[order]
        cut = np.searchsorted(owner, np.arange(len(shard.ends) + 1))
        out, held = [], 0
        for d, doc in enumerate(r["doc_ids"]):
            b, e = int(shard.begins[d]), int(shard.ends[d])
            s, t = _merged(start[cut[d]:cut[d + 1]], end[cut[d]:cut[d + 1]])
            stays = zip([b, *t.tolist()], [*s.tolist(), e])
            kept = b"".join(buf[x:y] for x, y in stays)
            out.append((doc, e - b, [{"start": x - b, "end": y - b} for x, y in zip(s.tolist(), t.tolist())], kept))
            held += len(kept)
            if held > SHARD_BYTES:
                yield _doc_batch(out)
                out, held = [], 0
        if out:
            yield _doc_batch(out)


def _doc_batch(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64(), pa.int64(), span, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                                      ["doc_id", "n_bytes", "spans", "kept"])


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by range, whole ranges at a time."""
    held = None
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            cut = int(np.searchsorted(rows["range"].to_numpy(), rows["range"][-1].as_py()))
            if cut:
                yield rows.slice(0, cut)
            held = rows.slice(cut)
    if held is not None:
        yield held


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _heads(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Where other keys begin in an order."""
    head = np.ones(len(order), bool)
    head[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    return head


def _answers(rows: pa.Table, answer: np.ndarray, owner: np.ndarray, found: np.ndarray) -> pa.Array:
    """Per row, its hashes' answers that are found."""
    found = np.sort(found)
    cuts = np.searchsorted(owner[found], np.arange(len(rows) + 1)).tolist()
    answer = answer[found]
    return pa.array([answer[a:b].tobytes() if b > a else None for a, b in zip(cuts, cuts[1:])], pa.binary())


def _met(groups: bool):
    """Per shard and range, the hashes that stand twice or more over all shards.  ``groups``: of groups of windows that
    any shard asks for, those with the same bytes everywhere (``shared``), and the others (``parts``).  Else those that
    the shard has once: the hash itself or, of a hash with a second one, its place."""
    def run(batches):
        for rows in _ranges(batches):
            keys, flags = _joined(rows["keys"], np.uint64), _joined(rows["flags"], np.uint8)
            size = np.fromiter(map(len, rows["flags"].to_pylist()), np.int64, len(rows))
            owner = np.repeat(np.arange(len(rows)), size)
            two = rows["others"].null_count == 0
            others = _joined(rows["others"], np.uint64) if two else None
            parts = np.empty(0, np.int64)
            if groups:
                order = np.argsort(keys)
                head = _heads(order, keys)
                start, group = np.flatnonzero(head), np.cumsum(head) - 1
                twice = (np.bincount(group) > 1) | ((np.bitwise_or.reduceat(flags[order], start) & _MORE) > 0)
                wanted = (np.bitwise_or.reduceat(flags[order], start) & _ASKED) > 0
                same = np.minimum.reduceat(others[order], start) == np.maximum.reduceat(others[order], start)
                take = (wanted & twice)[group]
                found = order[take & same[group] & ((flags[order] & _ASKED) > 0)]
                parts = order[take & ~same[group]]
                answer = keys
            else:
                by = (keys, others) if two else (keys,)
                order = np.lexsort(by[::-1]) if two else np.argsort(keys)
                head = _heads(order, *by)
                alone = head & np.append(head[1:], True)
                found = order[~alone & ((flags[order] & _MORE) == 0)]
                begin = np.cumsum(size) - size
                answer = keys if not two else np.arange(len(keys)) + np.repeat(rows["first"].to_numpy() - begin, size)
            yield pa.RecordBatch.from_arrays(
                [rows["shard"].combine_chunks(), _answers(rows, answer, owner, found), _answers(rows, answer, owner, parts)],
                ["shard", "shared", "parts"])
    return run


def _shared(rows: DataFrame, groups: bool = False) -> DataFrame:
    """Per shard, its part of the hashes sent that shards share (see ``_met``).  A shard sends a hash once."""
    sent = rows.select("shard", F.inline("sent"))
    return sent.repartition("range").sortWithinPartitions("range").mapInArrow(
        _met(groups), "shard long, shared binary, parts binary").filter("shared is not null or parts is not null") \
        .groupBy("shard").agg(F.collect_list("shared").alias("shared"), F.collect_list("parts").alias("parts"))


def _discard(tables: list[DataFrame | None]) -> None:
    for t in tables:
        if t is not None:
            S.discard(t)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) per row: removed byte spans [start, end) and the bytes that stay."""
    spark = docs.sparkSession
    part = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))

    def shard_rows(batches):
        from pyspark import TaskContext

        return _shards(TaskContext.get().partitionId(), batches)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"shards_{uuid.uuid4().hex[:12]}"
    part.mapInArrow(shard_rows, _SHARDS).write.bucketBy(min(buckets, MAX_BUCKETS), "shard").option(
        "path", S.fresh_path(spark, "shards")).option("compression", "zstd").format("parquet").saveAsTable(name)
    try:
        shards = spark.table(name)
        body = ["shard", "lengths", "phrases", "sizes", "symbols", "ranks", "kinds"]

        def small(df: DataFrame, *cols: str) -> DataFrame:
            # the hashed side of a join: a shard's own rows are streamed past it, never sorted
            return df.select("shard", *cols).hint("shuffle_hash")

        state, shared = None, None
        low, high = 0, 0
        for upto in STEPS:
            x = shards.select(*body)
            if state is None:
                x = x.withColumns({"level": F.lit(None).cast("binary"), "blocks": F.lit(None).cast("binary"),
                                   "shared": F.lit(None).cast("array<binary>")})
            else:
                x = x.join(small(state, "level", "blocks"), "shard").join(small(shared, "shared"), "shard", "left")
            used = [state, shared]
            state = S.materialize(x.mapInArrow(
                _step(low, high, upto), f"shard long, level binary, blocks binary, {_SENT}"), "interleave")
            shared = S.materialize(_shared(state), "shared")
            _discard(used)
            low, high = high, upto
        x = shards.select(*body, "text").join(small(state, "level", "blocks"), "shard").join(small(shared, "shared"), "shard", "left")
        used = [state, shared]
        state = S.materialize(x.mapInArrow(_ask(low, high), f"shard long, level binary, {_SENT}"), "asked")
        asked = S.materialize(_shared(state, groups=True), "asked")
        _discard(used)
        x = shards.select(*body, "text").join(small(state, "level"), "shard").join(small(asked, "shared", "parts"), "shard", "left")
        edges = S.materialize(x.mapInArrow(
            _answer, f"shard long, level binary, found binary, found_end binary, windows binary, groups binary, counts binary, {_SENT}"), "edges")
        _discard([state, asked])
        shared = S.materialize(_shared(edges), "shared")
        x = shards.select("doc_ids", *body, "text") \
            .join(small(edges, "level", "found", "found_end", "windows", "groups", "counts"), "shard") \
            .join(small(shared, "shared"), "shard", "left")
        return x.mapInArrow(_spans, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    finally:  # the name only: the files, in the shared folder, stay for the result
        spark.sql(f"DROP TABLE IF EXISTS {name}")
