import itertools
import random

import numpy as np
import pyarrow as pa

from tickbars.llm import signature_tree as T
from tickbars.llm.components import components
from tickbars.llm import jaccard_join as J

SCHEMA = "doc_id long, text string, sid string, n string"


def brute(rows, width, pct):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= pct * len(sets[i] | sets[j]):
            parent[find(j)] = find(i)
    least = {}
    for k, (d, _) in enumerate(rows):
        least.setdefault(find(k), []).append(d)
    return [(d, len(sets[k]), min(least[find(k)])) for k, (d, _) in enumerate(rows)]


def corpus(seed=3):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(4000)}"
    passage = [word() for _ in range(40)]
    rows, k = [], 0
    for base in range(30):
        text = [word() for _ in range(rnd.choice([3, 5, 8, 30, 90, 200, 1500]))]
        if base % 3 == 0:
            text = text[:len(text) // 2] + passage + text[len(text) // 2:]
        for _ in range(rnd.choice([1, 1, 2, 6])):
            t = list(text)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                t[rnd.randrange(len(t))] = word()
            rows.append((k, " ".join(t).upper() if k % 5 == 0 else " ".join(t)))
            k += 1
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(df, **kw).collect())


def test_components_match_brute_force(llm):
    rows = corpus() + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE two")]
    assert run(llm, rows) == sorted(brute(rows, 4, 85))
    assert run(llm, rows, shingle=5, pct=80) == sorted(brute(rows, 5, 80))


def test_trees_alone_find_every_link(llm, monkeypatch):
    """Without neighbours and with tiny blocks, the trees must find all links."""
    monkeypatch.setattr(J, "BLOCK", 3)
    near = J._near_pairs
    monkeypatch.setattr(J, "_near_pairs", lambda sets, posts, pct: near(sets, posts, pct).filter("a is null"))
    rows = corpus(5)
    assert run(llm, rows) == sorted(brute(rows, 4, 85))


def test_traversal_keeps_every_link():
    rng = np.random.default_rng(1)
    base = [rng.choice(10**6, rng.integers(20, 300), replace=False).astype(np.uint64) for _ in range(40)]
    sets = base + [np.unique(np.concatenate([b[2:], rng.choice(10**6, 2).astype(np.uint64)])) for b in base]
    sets.sort(key=len)
    size = np.array([len(s) for s in sets])
    bits = np.stack([np.frombuffer(J._bitmap(s, 1024), np.uint64) for s in sets])
    tree = T.grow(T.leaves(size, np.arange(len(sets)), size, bits))
    found = {(i, j) for a, b in T.traverse(tree, tree, 85) for i, j in zip(a.tolist(), b.tolist())}
    links = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if J.links(sets[i], sets[j])}
    assert links and links <= found
    other = T.grow(T.leaves(size, np.arange(len(sets)), size, bits))
    cross = {(i, j) for a, b in T.traverse(tree, other, 85) for i, j in zip(a.tolist(), b.tolist())}
    assert links <= cross


def test_keep_first(llm):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text, "a", "b"), (5, text, "a", "b"), (3, text + " more", "c", "d"), (7, "other words here now", "e", "f"),
            (None, text, "g", "h"), (None, None, None, None), (8, None, None, None), (9, "", None, None)]
    docs = llm.createDataFrame(rows, SCHEMA)
    kept = J.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3, 7, 8, 9]
    assert J.keep_first(llm.createDataFrame([], SCHEMA)).count() == 0


def test_connected_components(llm):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.comp for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100}


def test_links_across_the_bitmap_widths(llm):
    """A set small enough for the narrow bitmap links with one that needs the wide one."""
    rows, k = [], 0
    for small, more in ((1150, 280), (1130, 282), (1200, 300), (1199, 215), (1210, 290), (1150, 290)):
        text = [f"t{k}w{i}" for i in range(small + more + 4)]
        rows += [(k, " ".join(text[:small + 4])), (k + 1, " ".join(text))]
        k += 2
    want = sorted(brute(rows, 5, 80))
    assert [c for _, _, c in want] == [0, 0, 2, 2, 4, 4, 6, 6, 8, 8, 10, 11]
    assert run(llm, rows, shingle=5, pct=80) == want


def test_candidates_follow_the_links_of_near_copies(llm, monkeypatch):
    """Near copies of one text: the trees' pairs stay within a few times the links."""
    rnd = random.Random(9)
    text = [f"w{rnd.randrange(5000)}" for _ in range(300)]
    for copies in (200, 400):
        rows = []
        for i in range(copies):
            t = list(text)
            for _ in range(4):
                t[rnd.randrange(300)] = f"x{rnd.randrange(10 ** 6)}"
            rows.append((i, " ".join(t)))
        sets = [J.shingle_set(t.encode()) for _, t in rows]
        linked = sum(J.links(a, b) for a, b in itertools.combinations(sets, 2))
        seen = []
        verified = J._verified
        monkeypatch.setattr(J, "_verified", lambda pairs, *a: (seen.append(pairs.count()), verified(pairs, *a))[1])
        df = llm.createDataFrame([(*r, "s", "n") for r in rows], SCHEMA).repartition(4)
        got = {r.doc_id: r.component_id for r in J.jaccard_components(df).collect()}
        monkeypatch.undo()
        assert [(d, got[d]) for d, _, c in brute(rows, 4, 85)] == [(d, c) for d, _, c in brute(rows, 4, 85)]
        assert sum(seen) <= 3 * linked + copies, (sum(seen), linked)


def test_neighbours_are_searched_in_every_larger_forest(llm):
    """Whatever its token: a group of near copies may have no token in a share of the forests."""
    bits = np.full(J.NARROW // 64, (1 << 64) - 1, np.uint64).tobytes()
    sids = range(T.FAN + 4)
    sets = llm.createDataFrame([(i, bits, bits, None) for i in sids], "sid long, bits binary, bits_dense binary, bits_wide binary")
    for token in range(8):
        posts = llm.createDataFrame([(i, 2000, 2000, token, 0, len(sids)) for i in sids],
                                    "sid long, n long, rest long, token long, tier int, in_tree long")
        near = {(r.a, r.b) for r in J._near_pairs(sets, posts, 85).collect()}
        assert near == {(a, b) for a in sids for b in sids if a < b <= a + J.NEAR}


def test_traversal_memory_is_bounded():
    """Pairs that passed wait unexpanded: a tree whose pairs all pass takes little memory."""
    import tracemalloc

    n = 2048
    tree = T.grow(T.leaves(np.full(n, 40), np.arange(n), np.full(n, 40), np.full((n, 2), (1 << 20) - 1, np.uint64)))
    tracemalloc.start()
    pairs = sum(len(i) for i, _ in T.traverse(tree, tree, 85))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs == n * (n - 1) // 2 and peak < 8_000_000


def test_rows_without_a_partner_leave_no_posts(llm):
    """Sets that share a token but are too far apart in size never meet in a tree."""
    words = [f"w{k}" for k in range(400)]
    texts = [words[:10], words[:200], words[300:340], words[300:338], words[:7] + words[200:300]]
    docs = llm.createDataFrame([(" ".join(t),) for t in texts], "text string")
    often = llm.sparkContext.broadcast(b"")
    posts = J._posts(docs, often, 4, 85)[1]
    assert {r.n for r in posts.collect()} == {37, 35}


def test_split_by_keys(llm):
    from tickbars.llm.common import split_by_keys

    docs = llm.range(1000).selectExpr("nullif(id, 5) doc_id", "cast(id as string) text")
    may, others = split_by_keys(docs, docs["doc_id"], llm.range(0, 1000, 10).selectExpr("id k"))
    may, others = {r.text for r in may.collect()}, {r.text for r in others.collect()}
    assert not may & others and len(may | others) == 1000 and "5" in others
    assert {str(k) for k in range(0, 1000, 10)} <= may and len(may) < 110


def test_keep_first_shuffles_only_rows_that_may_go(llm, tmp_path):
    """A row that is no copy reaches no join of two large sides, and tables that nothing reads are gone."""
    import os

    from tickbars import session as S

    rnd = random.Random(5)
    texts = [" ".join(f"w{rnd.randrange(900)}" for _ in range(60)) for _ in range(200)]
    docs = llm.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(500, texts[3]), (501, texts[4] + " end"),
                               (7, texts[7]), (None, texts[8]), (None, texts[8])], "doc_id long, text string")
    root = S.shared_root(llm).split(":", 1)[-1].replace("//", "", 1) if ":" in S.shared_root(llm) else S.shared_root(llm)
    before = set(os.listdir(f"{root}/tickbars"))
    was = llm.conf.get("spark.sql.autoBroadcastJoinThreshold")
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = J.keep_first(docs)
        rows = kept.collect()
    finally:
        llm.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, k) for k in range(200)] + [(True, 0)] * 2
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("Union") and plan.count("LeftAnti") == 1
    new = {x.rsplit("-", 1)[0] for x in set(os.listdir(f"{root}/tickbars")) - before
           if os.path.isdir(f"{root}/tickbars/{x}")}
    assert not new & {"sketches", "prefixes", "posts", "open-posts", "near-sets", "tree-sets"}


def test_tasks_leave_a_worker_no_memory_of_other_operators():
    """Tasks get pickled copies of what their closures hold; a worker's memories are its modules' own."""
    from pyspark import cloudpickle

    from tickbars.llm import common as C
    from tickbars.llm import decontaminate as D

    def task(run, *batches):
        return list(cloudpickle.loads(cloudpickle.dumps(run))(iter(batches)))

    rows = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([b"one two three four five"])], ["doc_id", "t"])
    D.canonical_words([b"six seven"])
    assert len(D._CANON) and len(D._CANON.core)
    assert [x.num_rows for x in task(J._sketches(4), rows)] == [1]
    assert not D._CANON and not D._CANON.core
    assert len(C.WORD_HASHES) == 5
    task(J._neighbours(85))
    assert not C.WORD_HASHES
