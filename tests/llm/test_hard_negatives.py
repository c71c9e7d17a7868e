import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tickbars.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, score string, slot int"


def brute(rows, scale):
    """Row by row, in whole numbers."""
    live = [(i, [math.floor(scale * x) for x in v], l) for i, v, l in rows
            if i is not None and v is not None and l is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    anchors = {}
    for i, v, l in live:
        if i % 100 == 0 and (i not in anchors or (l, v) < anchors[i]):
            anchors[i] = (l, v)
    for a, (al, av) in anchors.items():
        same, other = {}, {}
        for i, v, l in live:
            if i == a:
                continue
            s = max(min(sum(x * y for x, y in zip(av, v)), H.SCORE_LIMIT), -H.SCORE_LIMIT)
            if l == al:
                same[i] = max(s, same.get(i, s))
            else:
                other.setdefault(i, []).append(s)
        for p, ps in sorted(same.items(), key=lambda x: (-x[1], x[0]))[:5]:
            fit = {i: max(s for s in ss if 30 * ps <= 100 * s <= 90 * ps)
                   for i, ss in other.items() if any(30 * ps <= 100 * s <= 90 * ps for s in ss)}
            for rank, (n, ns) in enumerate(sorted(fit.items(), key=lambda x: (-x[1], x[0]))[:10], 1):
                out.add((a, p, rank, n, ps, ns))
    return out


def run(llm, rows, scale=256.0, **kw):
    df = llm.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in H.mine(df, F.col("vec_id") % 100 == 0, scale=scale, **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_brute_force_in_blocks(llm):
    rnd = random.Random(5)
    rows = []
    for i in range(700):
        v = [round(rnd.gauss(0.2, 0.4), 1) for _ in range(6)]
        rows.append((i, v, rnd.randrange(3)))
    for i in range(0, 700, 90):  # copies of one vector: ties by id
        rows[i + 1] = (i + 1, rows[0][1], (rows[0][2] + i) % 3)
    assert run(llm, rows) == brute(rows, 256)
    assert run(llm, rows, anchor_block=3) == brute(rows, 256)


def test_nulls_repeats_ragged_huge(llm):
    rnd = random.Random(6)
    rows = [(i, [rnd.uniform(-1, 2) for _ in range(rnd.randrange(1, 5))], rnd.randrange(2)) for i in range(0, 400, 5)]
    rows += rows[:40] + [(i, v, 1 - l) for i, v, l in rows[10:20]]
    rows += [(None, [1.0], 1), (100, None, 1), (200, [1.0], None), (300, [None, 1.0], 0), (301, [float("nan")], 0),
             (302, [float("inf")], 1), (303, [], 0), (304, [1e308, 1e308], 1)]
    assert run(llm, rows) == brute(rows[:-1], 256)
    big = [(i, [rnd.uniform(1e13, 9e13) for _ in range(3)], i % 2) for i in range(0, 300, 20)]
    assert run(llm, big, scale=1.0) == brute(big, 1)


def test_no_anchor_no_positive_no_rows(llm):
    assert run(llm, [(1, [1.0], 1), (2, [1.0], 2)]) == set()
    assert run(llm, [(100, [1.0], 1), (2, [1.0], 2)]) == set()
    df = llm.createDataFrame([], SCHEMA)
    assert H.mine(df, F.col("vec_id") % 100 == 0).count() == 0


def test_scores_are_exact_in_every_type():
    rng = np.random.default_rng(3)
    for most in (50, 1 << 20, 1 << 40):
        a, b = rng.integers(-most, most, (5, 7)).astype(float), rng.integers(-most, most, (4, 7)).astype(float)
        want = [[max(-H.SCORE_LIMIT, min(H.SCORE_LIMIT, sum(int(x) * int(y) for x, y in zip(r, q)))) for q in b] for r in a]
        assert H.scores(a, b).astype(object).tolist() == want


def test_top_rows_count_an_id_once():
    top = H.TopRows(2, 2)
    top.add(np.array([0, 0, 0, 1]), np.array([7, 7, 8, 9]), np.array([5, 6, 6, 1]))
    top.add(np.array([0, 1]), np.array([1, 9]), np.array([6, 3]))
    assert list(zip(top.group, top.id, top.score)) == [(0, 1, 6), (0, 7, 6), (1, 9, 3)]
    assert top.least.tolist() == [6, -H.SCORE_LIMIT - 1]


def test_quantised_marks_bad_rows():
    x, ok = H.quantised(pa.array([[0.5, -0.001], None, [], [None], [float("nan")], [1.0]], pa.list_(pa.float64())), 256)
    assert ok.tolist() == [True, False, True, False, False, True]
    assert x[0].tolist() == [128, -1] and x[5].tolist() == [256, 0]
