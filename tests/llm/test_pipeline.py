import random
import sys
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as C  # noqa: E402
from tickbars import session as S  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "Which river runs past the old mill before it meets the sea near the long pier at the northern harbour wall today"


def words(seed, n=60):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(50_000)}" for _ in range(n))


def corpus():
    docs = [(k, words(k), "en", f"s{k % 5}", 0) for k in range(30)]
    near = words(3).split()
    near[30] = "changed"
    docs += [(100, words(3), "en", "s1", 0), (101, " ".join(near), "en", "s2", 0),
             (102, "too short", "en", "s0", 0), (103, "a b c d e f " * 12, "en", "s0", 0),
             (104, f"{words(104)} {ITEM} {words(105)}", "en", "s3", 0),
             (105, f"{words(106)} token = abcdef0123456789 {words(107)}", "en", "s4", 0),
             (106, None, None, None, None), (107, "", "en", "s1", 0), (None, words(200), None, None, None),
             (5, words(5), "en", "s0", 0)]
    return [(d, t, lang, s, None if t is None or n is None else len(t)) for d, t, lang, s, n in docs]


@pytest.fixture(scope="module")
def folder(llm, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    llm.createDataFrame(corpus(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    llm.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def ids(df):
    return sorted(r.doc_id if r.doc_id is not None else -1 for r in df.select("doc_id").collect())


def test_stages_take_effect(llm, folder):
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    base = list(range(30))
    want = [sorted([-1, 5, *base, 100, 101, 104, 105]), sorted([-1, *base, 104, 105]), sorted([-1, *base, 105]),
            sorted([-1, *base, 105])]
    for (name, stage), left in zip(C.STAGES[:4], want):
        out = S.materialize(stage(llm, docs, folder), "stage")
        assert out.columns == docs.columns, name
        assert ids(out) == left, name
        docs = out
    secret = docs.filter("doc_id = 105").first()
    assert "<secret>" in secret.text and "abcdef0123" not in secret.text and secret.n_chars == len(secret.text)
    packed = C.STAGES[4][1](llm, docs, folder)
    assert ids(packed) == want[3]
    assert [n for n, _ in C.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination",
                                        "secret scans", "best-fit packing"]


def test_run_is_the_stages_in_order(llm, folder):
    got = C.run(llm, folder)
    assert ids(got) == sorted([-1, *range(30), 105])
    assert got.groupBy("sequence_id").count().count() >= 1


@pytest.mark.parametrize("k", range(5))
def test_edge_tables(llm, folder, k):
    name, stage = C.STAGES[k]
    schema = SCHEMA + ", kept string, key string, n_words int, hash long, comp string, spans string, found string"
    rows = [(None,) * 12, (1, None, None, None, None, *["x", "y", 1, 2, "z", "s", "f"]), (1, "", "en", "s", 0, *[None] * 7),
            (2, words(1), None, None, None, *["x", "y", 1, 2, "z", "s", "f"])]
    docs = llm.createDataFrame(rows, schema)
    out = stage(llm, docs, folder)
    kept = ids(out)
    assert 2 in kept
    if k < 4:
        assert out.columns == docs.columns, name
    assert stage(llm, docs.filter("false"), folder).count() == 0


def test_stages_keep_one_word_memory_a_worker():
    """A worker outlives a stage: the tokenizer of one run must not stay beside the word memories of the next."""
    from tickbars.llm import common as C
    from tickbars.llm import decontaminate as D
    from tickbars.llm import word_bpe as W
    from tickbars.llm.packing import _pieces
    from tickbars.llm.quality_rules import _passing
    from tickbars.llm.queries import tokenizer_path

    rows = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([b"one two"])], ["doc_id", "text"])
    none = (bytes(D.BUCKETS // 8),) * 2
    runs = {"word bpe": _pieces(tokenizer_path(), 2048), None: _passing("text"),
            "canonical words": D._scan((D.WINDOW,), SimpleNamespace(value=none))}
    for name, run in [*runs.items(), *runs.items()]:
        list(run(iter([rows])))
        assert {k for k, m in C._REMEMBERED.items() if m} == {name} - {None}
