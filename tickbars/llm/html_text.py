"""HTML extraction by a recurrent block labeller.

A page is read into its sequence of leaf blocks (text between block-level tags,
with the path of the elements around it).  A bidirectional LSTM in numpy reads
one vector per block - hashed tag path, hashed words, a few shape numbers - over
the whole page, and labels every block as main text or not with both sides of
the page in view.

The labeller is trained here, on about ``TRAIN_PAGES`` pages of the table picked
by a hash: blocks of an article or main element count as text unless a side
element (menu, footer, advert, comments, ...) lies between, all others do not.
Pages are varied for training: side blocks of kinds that the table may not show
(comments, forms, notices, sidebars) are put in, with words of other blocks, and
container names change, so that the labeller learns names, neighbours and shape
instead of one layout.

Pages of similar length are scored together, a bounded number of blocks at a time;
nothing is cut, and every word of a block is read.  Formulas and the fallback text
of media are text of the block around them.

Defined results: a null or empty html gives an empty text; a page without text
blocks too; repeated rows are read row by row; an empty table gives no rows;
only the id, url and html columns are read.
"""

from __future__ import annotations

import html as H
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Expected number of pages that the labeller is fitted on.
TRAIN_PAGES = 300
EPOCHS = 10
PATH_DIMS, WORD_DIMS, SHAPE_DIMS = 128, 16, 6
DIMS = PATH_DIMS + WORD_DIMS + SHAPE_DIMS
HIDDEN = 16
#: Pages scored side by side, blocks of them together (longer pages alone), and
#: pages and characters read before they are scored.
SIDE, CELLS = 128, 1 << 16
READ_PAGES, READ_CHARS = 1024, 1 << 24

# Elements that never hold page text, elements that do not break a
# block, elements without content, and words that name main and side containers.
SILENT = frozenset("script style template svg iframe head title select option textarea button datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp "
                   "rt s samp small span strike strong sub sup time tt u var wbr input audio canvas object video "
                   "math annotation menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms "
                   "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": "p", "li": "li", "tr": "tr", "td": "td", "th": "th", "dt": "dt", "dd": "dd"}
MAIN = ["article", "main", "div.content", "div.post", "div.entry-content", "section.article-body", "div#content",
        "div.story", "div.post-content", "div.article"]
SIDE_BLOCKS = ["div.comments", "section.comments", "div#comments", "li.comment", "div.comment-body", "ol.commentlist",
               "aside", "div.sidebar", "aside.related", "div.related", "div.ad", "div.ads", "div.advert",
               "div.advertisement", "div.sponsored", "div.promo", "div.banner", "div.cookie", "div.cookie-notice",
               "div.notice", "div.newsletter", "form", "form.search", "form.subscribe", "header", "div.header",
               "nav", "nav.menu", "div.menu", "ul.nav", "div.breadcrumb", "footer", "div.footer", "div.share",
               "div.social", "div.popup", "div.login", "div.tags", "div.meta", "fieldset", "div#sidebar", "div#footer",
               "div#header", "div#nav"]
SIDE_WORD = re.compile(r"(?:^|[-_ ])(?:comments?|commentlist|respond|sidebar|related|ads?|advert\w*|sponsored|promo|"
                       r"banner|cookies?|notice|newsletter|subscribe|menu|nav\w*|breadcrumbs?|footer|header|share|social|"
                       r"popup|login|tags|meta|search|disclaimer|legal)(?:$|[-_ ])")
SIDE_TAG = frozenset("nav aside footer header form fieldset menu dialog".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
                    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int, int]]:
    """(path, text, characters inside links, links) of each leaf block in page
    order.  A path part is ``tag`` or ``tag`` and its class, id and role words.
    Unclosed and stray tags are borne the way browsers bear them: a closing tag
    ends the innermost open element of its name, or nothing."""
    out: list[tuple[tuple[str, ...], str, int, int]] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    linked = links = 0
    in_link = False

    def end_block():
        nonlocal linked, links
        if text:
            t = _SPACE.sub(" ", H.unescape("".join(text))).strip()
            if t:
                out.append((tuple(p for _, p in stack), t, linked, links))
            text.clear()
        linked = links = 0

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        raw = page[at:m.start()] if m else page[at:]
        if raw:
            text.append(raw)
            if in_link:
                linked += len(raw)
        if not m:
            break
        at = m.end()
        slash, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])  # the second: a quote never closed
        if not name:
            continue
        name, closing = name.lower(), bool(slash)
        if name in SILENT:
            if not closing and not (attrs or "").rstrip().endswith("/"):
                if name not in ("head",):
                    e = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                    if e:
                        at = e.end()
                    elif name in ("script", "style", "textarea", "title"):
                        at = size
            continue
        if name == "a":
            in_link = not closing
            links += not closing
            continue
        if name in INLINE:
            if name == "br":
                text.append(" ")
            continue
        end_block()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            in_link = False
        elif name not in VOID:
            if stack and stack[-1][0] == "p" or name in CLOSES and stack and stack[-1][0] == CLOSES[name]:
                stack.pop()
            words = [f"{a.lower()}={v}" for a, *vs in _ATTR.findall(attrs) for v in " ".join(vs).lower().split()] if attrs else []
            stack.append((name, " ".join([name, *words])))
    end_block()
    return out


def is_side(part: str) -> bool:
    name, *words = part.split(" ")
    return name in SIDE_TAG or any(SIDE_WORD.search(w.split("=", 1)[1]) for w in words)


def weak_label(path: tuple[str, ...]) -> int:
    """Training label: below a main container with no side element from there on."""
    for k in range(len(path) - 1, -1, -1):
        if is_side(path[k]):
            return 0
        if path[k].split(" ")[0] in ("article", "main") or "role=main" in path[k]:
            return 1
    return 0


def _hashed(word: str, dims: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "replace"))
    return h % dims, 1.0 if h >> 31 else -1.0


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(PATH_DIMS, np.float32)
    for depth, part in enumerate(reversed(path)):
        for word in part.split(" "):
            pieces = re.split(r"[-_]", word.split("=", 1)[1]) if "=" in word else [word]
            for p in pieces:
                k, sign = _hashed(("w:" if "=" in word else "t:") + p, PATH_DIMS)
                v[k] += sign * (1.0 if depth < 3 else 0.6)
    return v


class _Slots(dict):
    """Word -> its dimension, or WORD_DIMS more where its sign is negative."""

    def __missing__(self, word: str) -> int:
        d, sign = _hashed(word, WORD_DIMS)
        if len(self) > 100_000:
            self.clear()
        slot = self[word] = d + WORD_DIMS * (sign < 0)
        return slot


_WORD_SLOT = _Slots()


def vectors(page: list[tuple[tuple[str, ...], str, int, int]], paths: dict) -> np.ndarray:
    """One row per block."""
    x = np.zeros((len(page), DIMS), np.float32)
    for k, (path, text, linked, links) in enumerate(page):
        p = paths.get(path)
        if p is None:
            if len(paths) > 50_000:
                paths.clear()
            p = paths[path] = path_vector(path)
        x[k, :PATH_DIMS] = p
        words = text.lower().split(" ")
        n = np.bincount([_WORD_SLOT[w] for w in words], minlength=2 * WORD_DIMS)
        x[k, PATH_DIMS:PATH_DIMS + WORD_DIMS] = (n[:WORD_DIMS] - n[WORD_DIMS:]) / len(words)
        x[k, -SHAPE_DIMS:] = (np.log1p(len(text)) / 8, np.log1p(len(words)) / 6, linked / (len(text) + 1),
                              min(links, 5) / 5, text[-1:] in ".!?", k / len(page))
    return x


class Lstm:
    """One direction; gates in the order input, forget, output, candidate."""

    def __init__(self, rng):
        s = 1 / np.sqrt(HIDDEN)
        self.w = rng.uniform(-s, s, (DIMS, 4 * HIDDEN)).astype(np.float32)
        self.u = rng.uniform(-s, s, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN:2 * HIDDEN] = 1

    def forward(self, x, mask, keep=False):
        """x: steps x pages x dims, mask: steps x pages; returns the states."""
        steps, pages, _ = x.shape
        z = x.reshape(-1, DIMS) @ self.w + self.b
        z = z.reshape(steps, pages, -1)
        h = c = np.zeros((pages, HIDDEN), np.float32)
        hs = np.zeros((steps, pages, HIDDEN), np.float32)
        saved = []
        n = HIDDEN
        for t in range(steps):
            a = z[t] + h @ self.u
            g = 1 / (1 + np.exp(-a[:, :3 * n]))
            cand = np.tanh(a[:, 3 * n:])
            m = mask[t][:, None]
            c_new = g[:, n:2 * n] * c + g[:, :n] * cand
            tanh = np.tanh(c_new)
            h_new = g[:, 2 * n:] * tanh
            if keep:
                saved.append((h, c, g, cand, tanh, m))
            c, h = np.where(m, c_new, c), np.where(m, h_new, h)
            hs[t] = h
        return hs, saved

    def backward(self, x, saved, dhs):
        gw, gu, gb = np.zeros_like(self.w), np.zeros_like(self.u), np.zeros_like(self.b)
        n = HIDDEN
        dh = dc = np.zeros_like(dhs[0])
        for t in range(len(saved) - 1, -1, -1):
            h, c, g, cand, tanh, m = saved[t]
            dh = dh + dhs[t]
            dh_in, dc_in = np.where(m, dh, 0), np.where(m, dc, 0)
            dc_new = dc_in + dh_in * g[:, 2 * n:] * (1 - tanh ** 2)
            da = np.concatenate([dc_new * cand, dc_new * c, dh_in * tanh], axis=1) * g * (1 - g)
            da = np.concatenate([da, dc_new * g[:, :n] * (1 - cand ** 2)], axis=1)
            gw += x[t].T @ da
            gu += h.T @ da
            gb += da.sum(axis=0)
            dh = np.where(m, 0, dh) + da @ self.u.T
            dc = np.where(m, 0, dc) + dc_new * g[:, n:2 * n]
        return [gw, gu, gb]


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.left, self.right = Lstm(rng), Lstm(rng)
        self.v = rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
        self.d = np.zeros(1, np.float32)

    def params(self):
        return [self.left.w, self.left.u, self.left.b, self.right.w, self.right.u, self.right.b, self.v, self.d]

    @staticmethod
    def padded(pages: list[np.ndarray]):
        steps = max(map(len, pages))
        x = np.zeros((steps, len(pages), DIMS), np.float32)
        mask = np.zeros((steps, len(pages)), bool)
        for k, p in enumerate(pages):
            x[:len(p), k] = p
            mask[:len(p), k] = True
        return x, mask

    def states(self, x, mask, keep=False):
        a, sa = self.left.forward(x, mask, keep)
        b, sb = self.right.forward(x[::-1], mask[::-1], keep)
        return np.concatenate([a, b[::-1]], axis=2), sa, sb

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        parts: list[list[int]] = []
        for k in order:
            if not parts or len(parts[-1]) == SIDE or (len(parts[-1]) + 1) * len(pages[k]) > CELLS:
                parts.append([])
            parts[-1].append(k)
        for part in parts:
            hs, _, _ = self.states(*self.padded([pages[k] for k in part]))
            y = hs @ self.v + self.d > 0
            for j, k in enumerate(part):
                out[k] = y[:len(pages[k]), j]
        return out

    def step(self, pages, labels):
        """(loss, gradients) of a batch."""
        x, mask = self.padded(pages)
        y = np.zeros(mask.shape, np.float32)
        for k, p in enumerate(labels):
            y[:len(p), k] = p
        hs, sa, sb = self.states(x, mask, keep=True)
        prob = 1 / (1 + np.exp(-(hs @ self.v + self.d)))
        dz = (prob - y) * mask / mask.sum()
        dh = dz[:, :, None] * self.v
        grads = self.left.backward(x, sa, dh[:, :, :HIDDEN])
        grads += self.right.backward(x[::-1], sb, dh[::-1, :, HIDDEN:])
        grads += [np.einsum("tp,tph->h", dz, hs), dz.sum(keepdims=True).reshape(1)]
        loss = -np.log(np.where(y > 0, prob, 1 - prob) + 1e-9)[mask].mean()
        return loss, grads


def varied(page, rng):
    """A training page: its blocks with labels, containers renamed and side
    blocks put in."""
    rows = [(path, text, linked, links, weak_label(path)) for path, text, linked, links in page]
    if not rows:
        return rows
    spell = lambda x: x.replace(".", " class=").replace("#", " id=")
    main = spell(MAIN[rng.integers(len(MAIN))]) if rng.random() < 0.6 else None
    if main:
        rows = [(tuple(main if p.split(" ")[0] in ("article", "main") else p for p in path), *rest) for path, *rest in rows]
    words = " ".join(t for _, t, *_ in rows).split(" ")
    inner = next((path[:-1] for path, *_, y in rows if y), ("html", "body"))
    for _ in range(rng.integers(0, 7)):
        side = spell(SIDE_BLOCKS[rng.integers(len(SIDE_BLOCKS))])
        base = inner if rng.random() < 0.6 else ("html", "body")
        at = int(rng.integers(0, len(rows) + 1))
        for _ in range(rng.integers(1, 5)):
            k = int(rng.integers(1, 40))
            s = int(rng.integers(0, max(1, len(words) - k)))
            text = " ".join(words[s:s + k]) or "x"
            leaf = ("p", "li", "div", "span", "h3")[rng.integers(5)]
            link = rng.random() < 0.3
            rows.insert(at, (base + (side,) + ((leaf,) if leaf != "span" else ()), text, len(text) * link, int(link), 0))
            at += 1
    return rows


def train(pages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Labeller:
    """Fit the labeller on whole pages (html); built-in layouts join them, so
    that a table without usable pages still gives a working one."""
    rng = np.random.default_rng(seed)
    text = "<p>" + "</p><p>".join(" ".join(f"w{rng.integers(500)}" for _ in range(rng.integers(8, 60))) + "."
                                  for _ in range(4)) + "</p>"
    layout = ("<html><body><header><p>site name</p></header><nav><ul><li><a>one</a></li><li><a>two</a></li></ul></nav>"
              f"<div class=ad>buy this</div><article><h1>a title</h1>{text}</article><aside><p>more links</p></aside>"
              "<footer><p>all about us</p></footer></body></html>")
    read = [b for b in map(blocks, sorted(pages)) if any(weak_label(p) for p, *_ in b)]
    read += [blocks(layout)] * max(20, len(read) // 10)
    model, paths = Labeller(seed), {}
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in model.params()]
    steps = 0
    for _ in range(epochs):
        data = []
        for page in read:
            rows = varied(page, rng)
            data.append((vectors([r[:4] for r in rows], paths), np.array([r[4] for r in rows], np.float32)))
        order = sorted(range(len(data)), key=lambda k: (len(data[k][0]) // 4, rng.random()))
        parts = [order[s:s + 16] for s in range(0, len(order), 16)]
        for k in rng.permutation(len(parts)):
            part = parts[k]
            _, grads = model.step([data[j][0] for j in part], [data[j][1] for j in part])
            steps += 1
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            for p, g, (m, v) in zip(model.params(), grads, moment):
                g = g * min(1.0, 5 / (norm + 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9 ** steps)) / (np.sqrt(v / (1 - 0.99 ** steps)) + 1e-6)
    return model


def slices(html: pa.Array):
    """The pages of a batch in parts of bounded size (a longer page is one alone)."""
    part, chars = [], 0
    for h in html:
        h = h.as_py() or ""
        if part and (len(part) == READ_PAGES or chars + len(h) > READ_CHARS):
            yield part
            part, chars = [], 0
        part.append(h)
        chars += len(h)
    if part:
        yield part


def page_texts(model: Labeller, pages: list[str], paths: dict) -> list[str]:
    read = [blocks(h) for h in pages]
    labels = model.label([vectors(b, paths) for b in read])
    return ["\n\n".join(b[1] for b, y in zip(page, label) if y) for page, label in zip(read, labels)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    n = rows.count()
    picked = rows.filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(max(1, n // train_pages))) == 0) \
        .filter("html is not null").select("html").limit(2 * train_pages)
    model = spark.sparkContext.broadcast(train([r.html for r in picked.collect()]))
    paths: dict = {}

    @F.arrow_udf("string")
    def main_text(html: pa.Array) -> pa.Array:
        return pa.array([t for part in slices(html) for t in page_texts(model.value, part, paths)], pa.string())

    return rows.select("page_id", "url", main_text.asNondeterministic()("html").alias("text")) \
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
