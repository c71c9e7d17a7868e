import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, pos string, depth int"


def rebuilt(rows):
    own = {}
    for c, n, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((-(1 << 63) if n is None else n, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def brute(convs):
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    rows = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        parents = {p[:-1] for p in nodes if p}
        rows.add((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                  sum(1 for p in nodes if p and p[:-1] == path), sum(1 for p in below if p not in parents),
                  sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                  hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return rows


def run(llm, rows, width=T.WIDTH):
    df = llm.createDataFrame([(*r, "p", 7) for r in rows], SCHEMA).repartition(3)
    turns = S.materialize(T.turns_of(df), "turns")
    nodes, ends = T.prefix_trie(*T.rebuilt_turns(turns), width=width)
    none = hashlib.sha256(b"").hexdigest()
    got = nodes.join(T.ends_digest(ends), T.KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none))).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def conversations(seed, n, longest):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for k in range(rnd.randrange(1, longest)):
            rows.append((c, k, rnd.choice(["user", "assistant"]), rnd.choice(["hé", "yes", "no", "a longer text"])))
    return rows


@pytest.mark.parametrize("width", [2, 8])
def test_equals_brute_force(llm, width):
    rows = conversations(1, 60, 9) + [(61, k, "user", f"t{k % 3}") for k in range(45)] + [
        (62, k, "user", f"t{k % 3}") for k in range(30)]
    assert run(llm, rows, width) == brute(rebuilt(rows))


def test_nulls_copies_and_turnless(llm):
    rows = [(None, 0, "user", "x"), (0, None, None, "first"), (0, 3, "user", None), (0, 7, "user", ""), (10, 1, "a", "b")]
    for c in range(20, 60):  # copies; some lose all turns because their base is absent
        rows += [(c, 0, "user", "same"), (c, 1, "assistant", "same too")]
    rows += [(7, 1 << 40, "user", "late"), (7, -(1 << 40), "user", "early")]
    want = rebuilt(rows)
    assert any(not ts for ts in want.values())
    assert run(llm, rows) == brute(want)


def test_hot_parent_is_looked_up_in_the_broadcast_table(llm, monkeypatch):
    rows = [(c, k, "user", f"{c}-{k}" if k else "hello") for c in range(0, 400, 5) for k in range(3)]
    for share in (0.0, 0.1, 1.0):  # every parent hot, some, none
        monkeypatch.setattr(T, "HOT_SHARE", share)
        assert run(llm, rows) == brute(rebuilt(rows))


def test_empty(llm):
    df = llm.createDataFrame([], SCHEMA)
    nodes, ends = T.prefix_trie(*T.rebuilt_turns(T.turns_of(df)))
    assert nodes.count() == 0 and T.ends_digest(ends).count() == 0


def test_digest_of_many_ends_is_one_stream(llm):
    ids = list(range(5000, 0, -1))
    df = llm.createDataFrame([(1, 2, 3, i) for i in ids] + [(1, 2, 4, 9)], "depth long, z1 long, z2 long, conv_id long").repartition(7)
    got = {r.z2: r.ends_sha256 for r in T.ends_digest(df).collect()}
    assert got == {3: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), 4: hashlib.sha256(b"9").hexdigest()}
