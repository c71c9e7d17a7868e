import itertools
import random
import zlib

import numpy as np
import public_tokenizers as PT
import pytest
from tokenizers import Tokenizer

from tickbars.llm import packing as K
from tickbars.llm.word_bpe import WordBpe

PATH = PT.path("word_bpe_49k.json")
TEXTS = ["", "  ", "Hello world", "it's DON'T we'll 12 a1b2", "Ünï ªº ×÷ ΣΑΣ İstanbul ﬁ", "日本語　x", "x\xa0y z", "a<|endoftext|>b",
         "é é", "token " * 3000, "﻿abc 's 'd"]


def test_ids_equal_the_library():
    ids, ends = WordBpe(PATH).encode([t.encode() for t in TEXTS])
    lib, start = Tokenizer.from_file(PATH), 0
    for t, e in zip(TEXTS, ends):
        assert ids[start:e].tolist() == [*lib.encode(t, add_special_tokens=False).ids, 0], t
        start = e


def test_fullest_combination_is_optimal():
    rnd = random.Random(4)
    for _ in range(200):
        counts = {rnd.randrange(1, 30): rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 6))}
        room = rnd.randrange(0, 60)
        best = max(s for s in (sum(x * k for x, k in zip(counts, ks)) for ks in itertools.product(
            *[range(n + 1) for n in counts.values()])) if s <= room)
        got = K.fullest(counts, room)
        assert sum(x * k for x, k in got.items()) == best
        assert all(0 < k <= counts[x] for x, k in got.items())


def test_plan_covers_every_piece():
    rng = np.random.default_rng(2)
    sizes = np.minimum(rng.lognormal(4, 1, 5000).astype(int) + 1, 512)
    hist = {int(a): int(b) for a, b in zip(*np.unique(sizes, return_counts=True))}
    plan, bins = K.minimum_bin_slack(hist, 512)
    assert bins <= -(-sizes.sum() // 512) + 1
    for x, n in hist.items():
        runs = sorted((first, per, base) for l, first, per, base, _ in plan if l == x)
        assert runs[0][0] == 0
    assert K.minimum_bin_slack({}, 512) == ([], 0)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pack_round_trip(llm, capacity):
    texts = TEXTS + [" ".join(f"w{j * k}" for j in range(k % 97)) for k in range(300)] + [None, None]
    docs = llm.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, length int").repartition(5)
    rows = K.pack(docs, PATH, capacity=capacity).collect()
    lib = Tokenizer.from_file(PATH)
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    for k, t in enumerate(texts):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[k], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert [p.start for p in parts] == list(range(0, len(ids), capacity))
        for p in parts:
            piece = ids[p.start:p.start + p.length]
            assert p.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        assert sum(p.length for p in parts) == len(ids) and all(p.length == capacity for p in parts[:-1])
    for parts in by_bin.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    total = sum(r.length for r in rows)
    assert len(by_bin) <= -(-total // capacity) + 2


def test_repeats_and_empty(llm):
    docs = llm.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    rows = K.pack(docs, PATH).collect()
    assert len(rows) == 3 and sorted(r.offset for r in rows) == [0, 3, 6] and len({r.sequence_id for r in rows}) == 1
    assert K.pack(docs.filter("false"), PATH).count() == 0
