import random
from collections import Counter

import numpy as np
import pytest

from tickbars.llm import suffix_dedup as D

SCHEMA = "doc_id long, text string, spans int, shard string"
L = D.LENGTH


def brute(texts):
    """Kept bytes of every text, window by window."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + L] for b in data for i in range(len(b) - L + 1))
    out = []
    for b in data:
        gone, until = bytearray(len(b)), 0
        for i in range(len(b) - L + 1):
            if seen[b[i:i + L]] > 1:
                for j in range(max(i, until), i + L):
                    gone[j] = 1
                until = i + L
        out.append(bytes(x for x, g in zip(b, gone) if not g))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghijklmnopü") for _ in range(rnd.randrange(1, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    base = [prose(rnd.randrange(20, 300)) for _ in range(25)]
    texts = ["", None, "short", "a" * 900, "a" * 199, "ab" * 600, "b" * 400 + prose(30) + "b" * 350, *base]
    for _ in range(70):
        b, k = rnd.choice(base), rnd.random()
        if k < .2:
            texts.append(b)
        elif k < .6:  # a passage of about the length that counts, among other words
            i = rnd.randrange(len(b))
            texts.append(prose(20) + b[i:i + rnd.randrange(150, 420)] + prose(20))
        else:  # near copies
            w = b.split(" ")
            for _ in range(3):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            texts.append(" ".join(w))
    for n in (198, 199, 200, 201, 230):
        s = prose(100)[:n]
        texts += ["x" + s + "y", "z" + s + "w", s]
    return texts


@pytest.mark.parametrize("seed, parts, shard_bytes", [(1, 1, 10_000), (2, 5, 3_000), (3, 2, 4 << 20)])
def test_equals_brute_force(llm, monkeypatch, seed, parts, shard_bytes):
    monkeypatch.setattr(D, "SHARD_BYTES", shard_bytes)
    texts = corpus(seed)
    df = llm.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)], SCHEMA).repartition(parts)
    got = {r.doc_id: r for r in D.repeated_spans(df).collect()}
    assert len(got) == len(texts)
    for i, (t, want) in enumerate(zip(texts, brute(texts))):
        b = (t or "").encode()
        assert bytes(got[i].kept) == want, i
        assert got[i].n_bytes == len(b)
        assert sum(s.end - s.start for s in got[i].spans) == len(b) - len(want)
        assert all(x.end < y.start for x, y in zip(got[i].spans, got[i].spans[1:]))


def test_nulls_copies_empty_table(llm):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(None, text, 1, "s"), (None, text, 1, "s"), (5, None, 1, "s"), (5, None, None, None), (6, text[:150], 1, "s")]
    got = sorted((r.n_bytes, len(r.spans), len(r.kept)) for r in D.repeated_spans(llm.createDataFrame(rows, SCHEMA)).collect())
    n = len(text)
    assert got == [(0, 0, 0), (0, 0, 0), (150, 0, 150), (n, 1, 0), (n, 1, 0)]
    assert D.repeated_spans(llm.createDataFrame([], SCHEMA)).count() == 0
    assert D.repeated_spans(llm.createDataFrame([(1, None, 1, "s"), (2, "", 1, "s")], SCHEMA)).count() == 2


def spans_equal_brute_force(llm, texts):
    df = llm.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    got = {r.doc_id: r for r in D.repeated_spans(df).collect()}
    for i, (t, want) in enumerate(zip(texts, brute(texts))):
        assert bytes(got[i].kept) == want, i
        assert sum(s.end - s.start for s in got[i].spans) == len(t.encode()) - len(want), i


def test_windows_of_two_anchors_at_one_place_are_not_equal_windows(llm):
    spans_equal_brute_force(llm, ["aabbbbababaaaaaba" + "ab" * 95 + "aaabbaabbbbabbabaaaabbaabbbaabaaa"])


def test_spans_that_touch_over_two_texts_stay_apart(llm):
    rnd = random.Random(0)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(1, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rnd.choice(words) for _ in range(n))[:n]

    texts = []
    for k in range(30):  # a text that ends with a passage, then one that begins with another
        s, t = prose(205 + k), prose(240)
        texts += [prose(40) + s, t + prose(40), prose(45) + s, t + prose(35)]
    spans_equal_brute_force(llm, texts)


def test_cut_points_depend_on_content_only():
    rnd = random.Random(8)
    s = bytes(rnd.choice(b"abcd ") for _ in range(600))
    whole, _ = D.cut_points(s, np.array([0]), np.array([600]))
    a = b"q" * 77 + s + b"r" * 31
    inside, _ = D.cut_points(a, np.array([0]), np.array([len(a)]))
    decided = [p for p in whole if D.GAP <= p <= 600 - D.GRAM]
    assert decided == [p - 77 for p in inside if D.GAP <= p - 77 <= 600 - D.GRAM]
    for text in (s, b"a" * 600, b"ab" * 300):
        points, strong = D.cut_points(text, np.array([0]), np.array([len(text)]))
        for i in range(len(text) - L + 1):  # every window holds a point that its own bytes decide
            assert any(i + (0 if f else D.GAP) <= p <= i + L - D.GRAM for p, f in zip(points, strong))


def test_shard_is_sorted_and_refines_by_steps():
    text = b"the cat sat on the mat and the cat sat on the hat " * 20
    lengths = np.array([500, 500])
    ends = np.cumsum(lengths)
    points, _ = D.cut_points(text, ends - 500, ends)
    starts = np.union1d(points, ends - 500)
    sizes = np.diff(np.append(starts, 1000))
    phrases = np.searchsorted(starts, ends) - np.searchsorted(starts, ends - 500)
    symbols = D.phrase_hashes(text, starts, sizes)
    left = np.repeat(np.cumsum(phrases), phrases) - np.arange(len(starts))
    shard = D.Shard(lengths, phrases, sizes, symbols, D.suffix_array(symbols, left), np.ones(len(starts), np.uint8))
    runs = [tuple(symbols[p:p + left[p]]) for p in shard.sa]
    level, ranks, blocks = np.zeros(len(runs), np.int64), None, None
    for k in range(1, 6):
        ranks, blocks = shard.refine(ranks, blocks, level, 0, k)
        assert ranks.tolist() == [r for r, run in enumerate(runs) if shard.need[r] >= k]
        groups = {}
        for r, b in zip(ranks.tolist(), blocks.tolist()):
            groups.setdefault(runs[r][:k], []).append((r, b))
        assert all(len({b for _, b in g}) == 1 for g in groups.values())
        assert len({g[0][1] for g in groups.values()}) == len(groups) == len(shard.intervals(blocks)[0])


def test_bytes_hashes_tell_bytes_seeds_and_lanes_apart():
    rnd = random.Random(5)
    buf = bytes(rnd.randrange(256) for _ in range(400)) * 40
    for length in (L - D.GROUP + 1, L, L + D.GROUP - 1):
        at = np.arange(len(buf) - length + 1)
        h = D._bytes_hashes(buf, at, length, 0)
        assert len(set(h.tolist())) == 400 and (h[:-400] == h[400:]).all()
        assert len(set(h.tolist()) & set(D._bytes_hashes(buf, at, length, 0, 1).tolist())) == 0
        seeded = D._bytes_hashes(buf, at, length, at // 400)
        assert len(set(seeded.tolist())) == len(at) and (seeded[:400] == h[:400]).all()
    one = bytearray(buf[:L])
    seen = {int(D._bytes_hashes(bytes(one), np.zeros(1, np.int64), L, 0)[0])}
    for i in range(L):  # every byte counts, the last ones too
        one[i] ^= 1
        seen.add(int(D._bytes_hashes(bytes(one), np.zeros(1, np.int64), L, 0)[0]))
        one[i] ^= 1
    assert len(seen) == L + 1


def test_groups_of_windows_are_hashed_together(monkeypatch):
    """Only what a text's end cuts off is hashed on its own."""
    calls, real = [], D.xxhash

    class Counted:
        def __getattr__(self, name):
            calls.append(name)
            return getattr(real, name)

    rnd = random.Random(6)
    shared = " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(2000))
    texts = ["x" * k + shared + str(k) for k in range(3)]
    batch = D.pa.RecordBatch.from_arrays([D.pa.array(range(3), D.pa.int64()), D.pa.array([t.encode() for t in texts])], ["id", "text"])
    row = next(D._rows([next(D._shards(0, iter([batch])))]))
    shard = D._loaded(row)
    level = np.minimum(shard.need, D.MOST_STEPS)
    at, anchor, _ = D.anchored_windows(shard, level)
    assert len(at) > 30_000
    monkeypatch.setattr(D, "xxhash", Counted())
    core, whole, group = D._routes(row["text"], at, anchor, shard, True)
    assert len(core) > 2000 and len(core) == len(whole)
    assert len(calls) <= 20 * len(texts)


def test_hashes_meet_packed_by_range(llm):
    """A shard sends a row per range of hashes, not one per hash, and is told those that shards share."""
    rnd = np.random.default_rng(4)
    pool = rnd.integers(0, 1 << 64, 3000, np.uint64)
    pool[:40] = np.arange(40)  # many in one range
    sent, rows = {}, []
    for shard in range(5):
        keys = np.sort(rnd.choice(pool, 900, replace=False))
        whole = keys % np.uint64(3) + np.where(keys % np.uint64(5) == 0, np.uint64(shard), np.uint64(0))
        flags = (rnd.random(900) < 0.1) * D._MORE | (rnd.random(900) < 0.4) * D._ASKED
        sent[shard] = list(zip(keys.tolist(), whole.tolist(), flags.tolist()))
        packed = D._sent(keys, flags, whole), D._sent(keys, flags & D._MORE)
        rows.append((shard, *[x.to_pylist()[0] for x in packed]))
    assert all(len(x) <= 1 << D.RANGE_BITS for _, *both in rows for x in both) and len(rows[0][1]) < 900
    df = llm.createDataFrame(rows, f"shard long, pairs {D._SENT[5:]}, single {D._SENT[5:]}").repartition(3)

    def got(sent_as, groups, column, dtype):
        found = {r.shard: b"".join(r[column]) for r in D._shared(df.select("shard", df[sent_as].alias("sent")), groups).collect()}
        return {s: sorted(np.frombuffer(found.get(s, b""), dtype).tolist()) for s in sent}

    def brute(test, answer=lambda at, key: key):
        return {s: sorted(answer(at, k) for at, (k, w, f) in enumerate(x) if test(k, w, f)) for s, x in sent.items()}

    by_key, by_both = {}, {}
    for x in sent.values():
        for k, w, f in x:
            by_key.setdefault(k, []).append((w, f))
            by_both.setdefault((k, w), []).append(f)
    more, asked = int(D._MORE), int(D._ASKED)
    assert got("single", False, "shared", np.uint64) == brute(lambda k, w, f: not f & more and len(by_key[k]) > 1)
    assert got("pairs", False, "shared", np.int64) == brute(
        lambda k, w, f: not f & more and len(by_both[k, w]) > 1, lambda at, key: at)
    twice = {k for k, x in by_key.items() if len(x) > 1 or x[0][1] & more}
    wanted = {k for k in twice if any(f & asked for _, f in by_key[k])}
    same = {k for k in wanted if len({w for w, _ in by_key[k]}) == 1}
    assert got("pairs", True, "shared", np.uint64) == brute(lambda k, w, f: k in same and f & asked)
    assert got("pairs", True, "parts", np.uint64) == brute(lambda k, w, f: k in wanted - same)
