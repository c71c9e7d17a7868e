import random

from pyspark.sql import functions as F

from tickbars.operators.scan import chunked_running


def test_chunked_running_matches_sequential(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), i, rnd.randrange(100)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    for how, excl, rev in (("sum", False, False), ("max", True, False), ("min", True, True)):
        got = {(r.k, r.o): r.out for r in chunked_running(
            df, ["k"], ["o"], F.col("v"), how, F.floor(F.col("o") / 17), "out",
            exclusive=excl, reverse=rev).collect()}
        for k in "ab":
            seq = [(o, v) for kk, o, v in rows if kk == k]
            if rev:
                seq = seq[::-1]
            acc = None
            for o, v in seq:
                if excl:
                    exp = acc
                agg = {"sum": lambda a, b: a + b, "max": max, "min": min}[how]
                acc = v if acc is None else agg(acc, v)
                if not excl:
                    exp = acc
                assert got[(k, o)] == exp, (how, k, o)


def test_chunked_scans_multi(spark):
    from tickbars.operators.scan import chunked_scans

    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), i, rnd.randrange(100)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = {(r.k, r.o): r for r in chunked_scans(df, ["k"], ["o"], F.floor(F.col("o") / 13), [
        ("s", F.col("v"), "sum", False, False),
        ("mx", F.col("v"), "max", True, False),
        ("nx", F.col("v"), "min", True, True)]).collect()}
    for k in "ab":
        seq = [(o, v) for kk, o, v in rows if kk == k]
        for i, (o, v) in enumerate(seq):
            r = got[(k, o)]
            assert r.s == sum(x for _, x in seq[:i + 1])
            assert r.mx == (max(x for _, x in seq[:i]) if i else None)
            assert r.nx == (min(x for _, x in seq[i + 1:]) if i + 1 < len(seq) else None)


def test_null_key_is_a_key(spark):
    from tickbars.operators.scan import chunked_scans

    rows = [(None, i, 1) for i in range(30)] + [("a", i, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = {(r.k, r.o): r.s for r in chunked_scans(df, ["k"], ["o"], F.floor(F.col("o") / 7),
                                                  [("s", F.col("v"), "sum", False, False)]).collect()}
    assert len(got) == 60
    assert got[(None, 29)] == 30 and got[("a", 29)] == 60
    r = {(x.k, x.o): x.m for x in chunked_running(df, ["k"], ["o"], F.col("o"), "max",
                                                  F.floor(F.col("o") / 7), "m", exclusive=True).collect()}
    assert r[(None, 29)] == 28 and len(r) == 60
