"""Trained operators: language ID, HTML extraction, language model."""
import math
import random
import re
import zlib

import numpy as np
import pytest

from tickbars.llm import html_text as W
from tickbars.llm import language_id as I
from tickbars.llm import maxent_lm as M

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    out = I.identify(docs)
    both = out.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in both if r.lang and r.lang_pred != "und")
    assert right >= 0.95 * sum(1 for r in both if r.lang and r.lang_pred != "und")
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in out.collect())


def test_language_edge_rows(llm):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(k, "the cat and the dog", "en", "") for k in range(20)] + [(k, "der hund und die katze", "de", "") for k in range(20, 40)]
    rows += [(100, None, "en", ""), (101, "123 !", "en", ""), (102, "", None, ""), (None, "und der hund", None, None),
             (103, "the dog " * 20000, None, "")]
    out = {r.doc_id: r for r in I.identify(llm.createDataFrame(rows, schema)).collect()}
    assert [out[k].lang_pred for k in (100, 101, 102)] == ["und"] * 3 and out[100].score == 0.0
    assert out[None].lang_pred == "de" and not out[None].held_out and out[103].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in out.values())
    empty = llm.createDataFrame([], schema)
    assert I.identify(empty).count() == 0
    assert {r.lang_pred for r in I.identify(llm.createDataFrame([(1, "abc", None, "")], schema)).collect()} == {"und"}


def test_blocks():
    page = ("<html><head><title>t</title><script>var t='</p>';</script></head><body><nav><li><a href=x>menu</a><li>two</nav>"
            "<!-- x --><article class='a b'><p>one &amp; <b>two\n three<p>four<br>five</article>tail")
    assert [(b[0][-1] if b[0] else "", b[1]) for b in W.blocks(page)] == [
        ("li", "menu"), ("li", "two"), ("p", "one & two three"), ("p", "four five"), ("body", "tail")]
    assert W.blocks("") == [] and W.blocks("just text")[0][1] == "just text" and W.blocks("a < b <p") != []


def test_lstm_gradient():
    rng = np.random.default_rng(0)
    m = W.Labeller(1)
    for p in m.params():
        p *= 3
    pages = [rng.normal(size=(n, W.DIMS)).astype(np.float32) for n in (3, 5)]
    labels = [rng.integers(0, 2, n) for n in (3, 5)]
    _, grads = m.step(pages, labels)
    for p, g in zip(m.params(), grads):
        k = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = p[k], 1e-2
        p[k] = old + e
        up = m.step(pages, labels)[0]
        p[k] = old - e
        down = m.step(pages, labels)[0]
        p[k] = old
        assert (up - down) / (2 * e) == pytest.approx(g[k], rel=0.05, abs=2e-3)


def test_extraction_on_the_table_and_on_other_layouts(llm):
    pages = llm.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in W.extract(pages).collect()}
    wrong = 0
    for r in pages.collect():
        want = "\n\n".join(b[1] for b in W.blocks(r.html) if any(p.startswith("article") for p in b[0]))
        wrong += got[r.page_id].text != want
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    assert wrong <= 0.01 * len(got)
    model = W.train([r.html for r in pages.collect()])
    page = ("<body><div class=cookie-notice>We use cookies</div><header><p>site</p></header><main><h1>Title here</h1>"
            "<p>The body of the text stands here and is long enough.</p><p>And it goes on in a second paragraph.</p>"
            "<div class=comments><p>first! nice post</p></div></main><aside>also see</aside><footer>about</footer>")
    b = W.blocks(page)
    label = model.label([W.vectors(b, {})])[0]
    assert [x[1] for x, y in zip(b, label) if y] == [
        "Title here", "The body of the text stands here and is long enough.", "And it goes on in a second paragraph."]


def test_extraction_edge_rows(llm):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "", None), (2, "v", "<script>x()</script>", "")]
    out = W.extract(llm.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(out) == 4 and all(r.text == "" and r.n_chars == 0 for r in out)
    assert W.extract(llm.createDataFrame([], "page_id long, url string, html string, text string")).count() == 0


def lm_brute(rows):
    tok = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").encode().lower().decode()) + ["\0end"]
    from collections import Counter
    c = Counter()
    for d, t in rows:
        if zlib.crc32(str(d).encode()) % 10:
            c.update(tok(t))
    n, v = sum(c.values()), len(c)
    return {d: (len(tok(t)), sum(w in c for w in tok(t)), n,
                sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tok(t))) for d, t in rows}


def test_lm_base_scores_and_gain(llm, monkeypatch):
    monkeypatch.setattr(M, "HEAD", 300)
    docs = llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(9_000_001, None), (9_000_002, ""), (9_000_003, "zzqx zzqx")]
    out = {r.doc_id: r for r in M.score_texts(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = lm_brute(rows)
    for d, (n, known, total, base) in want.items():
        r = out[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in out.values() if r.held_out]
    # the model beats the unigram base on texts it has not seen
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_probabilities_sum_to_one():
    words = ["a", "b", "cc", "dd", "ab", "cab", "xx", "b"]
    v = M.Vocabulary()
    rows, count = v.rows([" ".join(words).encode()])
    hashes = {int(v.hash[k]): 1 + (w == b"b") for w, k in v.items()}
    listed = [(M.signed(h), n) for h, n in hashes.items()][:4]
    tokens, kinds = np.zeros(M.CLASSES), np.zeros(M.CLASSES)
    head = M.Head(listed, tokens, kinds)
    v.place(head.key, head.hash)
    all_rows = np.arange(len(v))
    cls = head.classes(v, all_rows)
    for k, c in enumerate(cls):
        tokens[c] += hashes[int(v.hash[k])]
        kinds[c] += 1
    w = np.random.default_rng(0).normal(size=(257, M.CLASSES)).astype(np.float32)
    f = M.features(v.hash[rows], count, 256)
    p = np.exp([M.class_log_probability(w, f[:, :1], np.array([c]))[0] for c in range(M.CLASSES)])
    total = sum(p[c] * (hashes[int(v.hash[k])] + 0.1) / (tokens[c] + 0.1 * (kinds[c] + 1)) for k, c in enumerate(cls))
    total += sum(p[c] * 0.1 / (tokens[c] + 0.1 * (kinds[c] + 1)) for c in range(M.CLASSES))
    assert total == pytest.approx(1, abs=1e-5)


def test_lm_edge_tables(llm):
    empty = llm.createDataFrame([], "doc_id long, text string, score string")
    assert M.score_texts(empty).count() == 0
    one = llm.createDataFrame([(None, "a b", "x"), (None, None, None)], "doc_id long, text string, score string")
    out = M.score_texts(one).collect()
    assert [r.train_tokens for r in out] == [0, 0] and all(r.n_known == 0 for r in out)


def test_lm_features_grow_with_the_corpus():
    sizes = [M.feature_rows(n) for n in (0, 10 ** 6, 10 ** 8, 10 ** 10, 10 ** 13)]
    assert sizes[0] == M.LEAST_FEATURES and sizes[-1] == M.MOST_FEATURES
    assert sizes == sorted(sizes) and all(x & (x - 1) == 0 for x in sizes) and len(set(sizes)) >= 4


def test_lm_gradient_step_equals_a_plain_one():
    rng = np.random.default_rng(1)
    w = rng.normal(size=(17, M.CLASSES)).astype(np.float32)
    f, cls = rng.integers(0, 16, (3, 50)), rng.integers(0, M.CLASSES, 50)
    z = w[f[0]] + w[f[1]] + w[f[2]] + w[-1]
    g = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert np.allclose(M.class_log_probability(w, f, cls), np.log(g[np.arange(50), cls]), atol=1e-4)
    g[np.arange(50), cls] -= 1
    want, seen = w.copy(), np.full(17, 1e-2, np.float32)
    for rows in (*f, np.full(50, 16)):
        for row in np.unique(rows):
            s = g[rows == row].sum(axis=0) / np.sqrt((rows == row).sum())
            seen[row] += (s * s).mean()
            want[row] -= M.RATE * s / np.sqrt(seen[row] + 1e-4)
    got, mine = w.copy(), np.full(17, 1e-2, np.float32)
    M.descend(got, mine, f, cls)
    assert np.allclose(got, want, atol=1e-3) and np.allclose(mine, seen, rtol=1e-3)


def test_html_formulas_fallback_text_and_open_quotes():
    texts = lambda page: [b[1] for b in W.blocks(page)]
    assert texts("<p>energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> is</p>") == ["energy E=m is"]
    assert texts("<p>a <object data=x>fallback</object> b <video src=y>no video</video></p>") == ["a fallback b no video"]
    assert texts("<article><noscript><p>shown without scripts</p></noscript></article>") == ["shown without scripts"]
    assert texts('<p title="x>Hello <b>you</b></p><p>two</p>') == ["Hello you", "two"]


def test_html_reads_every_word_of_a_block():
    block = lambda words: [(("html", "p"), " ".join(words), 0, 0)]
    words = [f"w{i}" for i in range(1000)]
    base = W.vectors(block(words), {})
    for k in (1, 499, 998):
        assert not (W.vectors(block(words[:k] + ["changed" * k] + words[k + 1:]), {})[0, W.PATH_DIMS:-W.SHAPE_DIMS]
                    == base[0, W.PATH_DIMS:-W.SHAPE_DIMS]).all()


def test_html_long_pages_beside_short_ones():
    """A page of very many blocks is scored alone; every page gets the labels it
    gets by itself."""
    model = W.Labeller()
    rng = np.random.default_rng(1)
    pages = [rng.normal(size=(n, W.DIMS)).astype(np.float32) for n in (3, 70_000, 0, 5, 900, 1)]
    together = model.label(pages)
    assert [len(y) for y in together] == [len(p) for p in pages]
    for page, y in zip(pages, together):
        assert (y == model.label([page])[0]).mean() > 0.999 if len(page) else len(y) == 0
    import pyarrow as pa
    assert [len(s) for s in W.slices(pa.array(["a"] * 1030 + [None, "b" * (1 << 25), "c"]))] == [1024, 7, 1, 1]
