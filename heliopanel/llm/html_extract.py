"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks (``html_blocks``).  A block's input vector holds hashed
features of its tag path, hashed features of its words, and a few ratios.  A bidirectional
LSTM reads the sequence both ways and labels every block as article or not, so a block is
judged with the whole document around it.  The article's blocks are joined by newlines.

Learning uses at most ``TRAIN_PAGES`` pages (a documented bound, chosen by a hash of their
html).  Blocks inside ``article`` or ``main`` and outside elements that the HTML standard
reserves for navigation, asides, forms, headers and footers give the first labels; the same
blocks are then set in other templates, among further notices, adverts, menus, forms,
sidebars and reader comments, so that the labeller has to use what surrounds a block.

Null or empty html: empty text.  Every page gives one row; repeated rows are read each; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, raw_bytes, text_chunks
from .html_blocks import Block, blocks

TRAIN_PAGES = 120
VARIANT_BLOCKS = 40         # blocks of a training article that its variants take: a longer one teaches no more of a template
VARIANTS = 5
PATH_DIM, WORD_DIM, RATIOS = 96, 24, 9
HIDDEN = 20
EPOCHS = 10
BATCH_BLOCKS = 6000
KEEP = 300_000

# Element names that mark, or exclude, article text.
INSIDE = frozenset(["article", "main"])
OUTSIDE = frozenset("nav aside footer form head script style noscript button select iframe dialog menu".split())

_words: dict[str, int] = {}


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


def block_vector(b: Block, nth: int, n: int) -> np.ndarray:
    x = np.zeros(PATH_DIM + WORD_DIM + RATIOS, np.float32)
    path = b.path
    for i, f in enumerate(path):
        h = _hash(f)
        x[h % PATH_DIM] += 1 if h & 0x10000 else -1
        if i == len(path) - 1 or not path[i + 1].startswith(".") and i >= len(path) - 3:    # the innermost elements again
            h = _hash("in " + f)
            x[h % PATH_DIM] += 1 if h & 0x10000 else -1
    words = b.text.split()
    known = _words
    if len(known) > KEEP:
        known.clear()
    at = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = _hash(w.lower())
            known[w] = h = (h % WORD_DIM) * 2 + (h >> 16 & 1)
        at.append(h)
    counts = np.bincount(at, minlength=2 * WORD_DIM)
    x[PATH_DIM:PATH_DIM + WORD_DIM] = (counts[1::2] - counts[::2]) / np.sqrt(len(words))
    size = len(b.text)
    ends = sum(b.text.count(c) for c in ".!?")
    x[PATH_DIM + WORD_DIM:] = (np.log1p(len(words)) / 3, np.log1p(size) / 5, b.linked / size, ends / len(words),
                               b.text.count(",") / len(words), size / len(words) / 10, nth / n, (n - 1 - nth) / n,
                               sum(map(str.isdigit, b.text[:1])))
    return x


def page_matrix(found: list[Block]) -> np.ndarray:
    return np.array([block_vector(b, i, len(found)) for i, b in enumerate(found)], np.float32) \
        .reshape(len(found), PATH_DIM + WORD_DIM + RATIOS)


# the network -----------------------------------------------------------------------------------------
def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Two LSTMs (``f`` reads forward, ``b`` backward) and a logistic output over both and the input."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = 11) -> Labeller:
        r = np.random.default_rng(seed)
        d, h = PATH_DIM + WORD_DIM + RATIOS, HIDDEN
        p = {"out_h": r.normal(0, 0.2, 2 * h), "out_x": np.zeros(d), "out_b": np.zeros(1)}
        for way in "fb":
            p[way + "_x"] = r.normal(0, 1 / np.sqrt(d), (d, 4 * h))
            p[way + "_h"] = r.normal(0, 1 / np.sqrt(h), (h, 4 * h))
            p[way + "_b"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, way: str, x: np.ndarray, there: np.ndarray, keep: bool):
        """x: [time, page, input]; states stay unchanged where no block is."""
        t_max, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        ahead = x @ self.p[way + "_x"] + self.p[way + "_b"]
        out = np.zeros((t_max, n, HIDDEN), np.float32)
        tape = []
        for t in range(t_max) if way == "f" else range(t_max - 1, -1, -1):
            z = ahead[t] + h @ self.p[way + "_h"]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = there[t][:, None]
            c_new = np.where(m, f * c + i * g, c)
            tc = np.tanh(c_new)
            h_new = np.where(m, o * tc, h)
            if keep:
                tape.append((t, h, c, i, f, o, g, tc, m))
            h, c = h_new, c_new
            out[t] = h
        return out, tape

    def logits(self, x: np.ndarray, there: np.ndarray, keep: bool = False):
        f, tape_f = self._run("f", x, there, keep)
        b, tape_b = self._run("b", x, there, keep)
        z = f @ self.p["out_h"][:HIDDEN] + b @ self.p["out_h"][HIDDEN:] + x @ self.p["out_x"] + self.p["out_b"]
        return z, (f, b, tape_f, tape_b)

    def gradients(self, x, there, y) -> tuple[float, dict[str, np.ndarray]]:
        z, (f, b, tape_f, tape_b) = self.logits(x, there, keep=True)
        prob = _sigmoid(z)
        n = max(there.sum(), 1)
        loss = -np.where(there, np.log(np.where(y, prob, 1 - prob) + 1e-9), 0).sum() / n
        d = (np.where(there, prob - y, 0) / n).astype(np.float32)
        g = {"out_b": d.sum(keepdims=True).reshape(1), "out_x": np.einsum("tn,tnd->d", d, x),
             "out_h": np.concatenate([np.einsum("tn,tnh->h", d, f), np.einsum("tn,tnh->h", d, b)])}
        for way, tape, part in (("f", tape_f, slice(0, HIDDEN)), ("b", tape_b, slice(HIDDEN, None))):
            w = self.p[way + "_h"]
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dw = np.zeros_like(w)
            dh, dc = np.zeros(f.shape[1:], np.float32), np.zeros(f.shape[1:], np.float32)
            for t, h_in, c_in, i, fg, o, gg, tc, m in reversed(tape):
                dh = dh + d[t][:, None] * self.p["out_h"][part]
                dc_here = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc_here * gg * i * (1 - i), dc_here * c_in * fg * (1 - fg), dh * tc * o * (1 - o),
                                     dc_here * i * (1 - gg * gg)], axis=1)
                dz = np.where(m, dz, 0)
                dz_all[t] = dz
                dw += h_in.T @ dz
                dh = np.where(m, dz @ w.T, dh)
                dc = np.where(m, dc_here * fg, dc)
            g[way + "_h"] = dw
            g[way + "_b"] = dz_all.sum(axis=(0, 1))
            g[way + "_x"] = np.einsum("tnd,tnk->dk", x, dz_all, optimize=True)
        return float(loss), g

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """P(article) of every block of every page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        for batch in batches_by_length(pages):
            x, there = padded([pages[i] for i in batch])
            p = _sigmoid(self.logits(x, there)[0])
            for k, i in enumerate(batch):
                out[i] = p[:len(pages[i]), k]
        return out


def batches_by_length(pages: list[np.ndarray]):
    """Page numbers grouped so that a padded batch stays within ``BATCH_BLOCKS`` blocks (or one page)."""
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
    held: list[int] = []
    for i in order:
        if held and len(pages[i]) * (len(held) + 1) > BATCH_BLOCKS:
            yield held
            held = []
        held.append(i)
    if held:
        yield held


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t_max = max(len(p) for p in pages)
    x = np.zeros((t_max, len(pages), pages[0].shape[1]), np.float32)
    there = np.zeros((t_max, len(pages)), bool)
    for k, p in enumerate(pages):
        x[:len(p), k] = p
        there[:len(p), k] = True
    return x, there


# learning -------------------------------------------------------------------------------------------
def standard_labels(found: list[Block]) -> np.ndarray:
    return np.array([bool(INSIDE & set(b.path)) and not OUTSIDE & set(b.path) for b in found], bool)


def _sentence(r, pool: list[str]) -> str:
    words = pool[r.integers(len(pool))].split()
    lo = int(r.integers(0, max(1, len(words) - 3)))
    return " ".join(words[lo:lo + int(r.integers(3, 30))])


def variant(r, content: list[str], pool: list[str]) -> tuple[str, list[bool]]:
    """A page in a template drawn at random: html, and whether each leaf block is article text.

    Names of classes and elements below are ordinary ones; they are examples for learning,
    no rules.
    """
    parts: list[tuple[str, bool]] = []
    pick = lambda *options: options[r.integers(len(options))]

    def attr(*names: str) -> str:
        return f' {pick("class", "class", "id")}="{pick("", "", "site-", "page-", "main-", "top-")}{pick(*names)}{pick("", "", "-box", " block", "-wrap")}"'

    def boiler(kind: str) -> None:
        text = _sentence(r, pool)
        links = [" ".join(_sentence(r, pool).split()[:3]) for _ in range(r.integers(2, 8))]
        if kind == "menu":
            box = pick("<nav>", "<nav" + attr("nav", "menu") + ">", "<div" + attr("menu", "nav", "navbar", "navigation", "breadcrumb", "links", "tags", "share", "pagination") + ">")
            parts.append((box + "<ul>", False))
            parts.extend((f'<li><a href="/x">{x}</a></li>', "leaf") for x in links)
            parts.append(("</ul>" + ("</nav>" if box.startswith("<nav") else "</div>"), False))
            return
        if kind == "head":
            tag = pick("header", "div")
            box = f"<{tag}" + (attr("header", "masthead", "topbar", "banner", "brand", "logo") if tag == "div" or r.random() < 0.5 else "") + ">"
            inner = [f"<{pick('p', 'div', 'h1', 'h2', 'span')}>"]
        elif kind == "foot":
            tag = pick("footer", "footer", "div")
            box = f"<{tag}" + (attr("footer", "copyright", "legal", "bottom", "imprint", "foot") if tag == "div" else "") + ">"
            inner = [pick("<p>", "<div>", "")]
        elif kind == "side":
            tag = pick("aside", "div", "section")
            box = f"<{tag}" + (attr("sidebar", "related", "widget", "aside", "more", "popular", "trending", "recommended", "side") if tag != "aside" or r.random() < 0.4 else "") + ">"
            inner = ["<h3>", "<p>"]
        elif kind == "ad":
            tag = pick("div", "div", "p", "section", "aside", "ins")
            box = f"<{tag}" + attr("ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor", "adslot", "commercial") + ">"
            inner = [pick("<p>", "")]
        elif kind == "notice":
            tag = pick("div", "div", "section", "p", "aside")
            box = f"<{tag}" + attr("cookie", "notice", "consent", "alert", "banner", "gdpr", "popup", "modal", "privacy", "paywall", "message", "cookies", "warning", "disclaimer") + ">"
            inner = [pick("<p>", "<span>", "")]
        elif kind == "form":
            tag = "form"
            box = "<form" + pick("", attr("search", "newsletter", "subscribe", "signup", "login", "contact")) + ">"
            inner = [pick("<label>", "<p>", "<div>"), "<button>"]
        else:
            tag = pick("section", "div", "div", "ol", "ul")
            box = f"<{tag}" + attr("comments", "comment-list", "responses", "replies", "discussion", "commentlist", "reader-comments", "feedback", "reviews") + ">"
            parts.append((box, False))
            if r.random() < 0.6:
                parts.append((f"<h{r.integers(2, 5)}>{' '.join(text.split()[:2])}</h3>", "leaf"))
            for _ in range(r.integers(1, 6)):
                item = "li" if tag in ("ol", "ul") else pick("div", "article", "div", "p")
                name = attr("comment", "reply", "response", "review") if r.random() < 0.7 else ""
                body = pool[r.integers(len(pool))] if r.random() < 0.5 else _sentence(r, pool)
                inner_tag = "" if item == "p" else pick("<p>", "<p>", "")
                parts.append((f"<{item}{name}>{inner_tag}{body}</{item}>", "leaf"))
            parts.append((f"</{tag}>", False))
            return
        parts.append((box, False))
        for k, t in enumerate(inner):
            body = text if k else (text if len(inner) == 1 else " ".join(text.split()[:4]))
            if kind in ("side", "ad", "notice") and k == len(inner) - 1 and r.random() < 0.3:
                body = pool[r.integers(len(pool))]
            if kind in ("foot", "side") and r.random() < 0.3:
                body = f'<a href="/y">{body}</a>'
            parts.append((f"{t}{body}{t.replace('<', '</') if t else ''}", "leaf"))
        if kind == "side" and r.random() < 0.5:
            parts.extend((f'<li><a href="/x">{x}</a></li>', "leaf") for x in links)
        parts.append((f"</{tag}>", False))

    title = " ".join(content[0].split()[:8])
    parts.append((f"<html><head><title>{title}</title></head><body" + pick("", attr("home", "single", "post")) + ">", "leaf"))
    before, after = ["menu", "head", "ad", "notice", "form", "side"], ["foot", "side", "ad", "comments", "form", "menu", "notice"]
    for kind in r.permutation(before)[:r.integers(0, 5)]:
        boiler(kind)
    shape = int(r.integers(0, 6))
    opening = ["<article>", "<main>", "<main><article" + pick("", attr("post", "entry", "article")) + ">",
               "<div" + attr("content", "article", "post", "entry", "story", "body", "text", "article-body", "main", "post-content") + ">",
               "<section" + attr("content", "article", "story", "post") + ">", "<div>"][shape]
    closing = ["</article>", "</main>", "</article></main>", "</div>", "</section>", "</div>"][shape]
    parts.append((opening, False))
    if r.random() < 0.8:
        heading = f"<h1>{title}</h1>"
        parts.append((f"<header>{heading}</header>" if r.random() < 0.15 else heading, True))
    inside = set(r.integers(1, len(content) + 1, int(r.integers(0, 3))).tolist())
    for k, text in enumerate(content):
        if k in inside and k:
            boiler(pick("ad", "notice", "side", "form", "menu"))
        form = r.random()
        if form < 0.82:
            parts.append((f"<p>{text}</p>" if r.random() < 0.7 else f"<p>{text}", True))
        elif form < 0.88:
            parts.append((f"<h2>{' '.join(text.split()[:6])}</h2>", True))
        elif form < 0.93:
            parts.append((f"<blockquote>{text}</blockquote>", True))
        else:
            parts.append((f"<ul><li>{text}</li></ul>", True))
    if r.random() < 0.25:
        boiler("comments")
    parts.append((closing, False))
    for kind in r.permutation(after)[:r.integers(0, 5)]:
        boiler(kind)
    parts.append(("</body></html>", False))
    labels = [tag is True for _, tag in parts if tag is True or tag == "leaf"]
    return "".join(p for p, _ in parts), labels


def train(pages: list[str], seed: int = 5, epochs: int = EPOCHS) -> Labeller:
    """Fit the labeller to pages and to variants of them."""
    r = np.random.default_rng(seed)
    net = Labeller.new()
    parsed = [blocks(p) for p in pages]
    labelled = [(b, standard_labels(b)) for b in parsed]
    article = [[x.text for x, y in zip(b, lab) if y and len(x.text.split()) > 2 and not {"h1", "h2"} & set(x.path[-1:])]
               for b, lab in labelled]
    article = [a for a in article if a] or [[x.text for x in b if len(x.text) > 40] for b in parsed]
    article = [a[:VARIANT_BLOCKS] for a in article if a]
    if not article:
        net.p["out_h"][:] = 0
        net.p["out_b"][:] = 1
        return net
    pool = [t for a in article for t in a]
    data = [(page_matrix(b), lab) for b, lab in labelled if lab.any()]
    for _ in range(VARIANTS):
        for content in article:
            page, labels = variant(r, [t.replace("<", " ").replace("&", " ") for t in content],
                                   [t.replace("<", " ").replace("&", " ") for t in pool])
            found = blocks(page)
            if len(found) == len(labels):
                data.append((page_matrix(found), np.array(labels)))
    groups = [[data[i] for i in g] for g in _minibatches([m for m, _ in data])]
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        for i in r.permutation(len(groups)):
            x, there = padded([m for m, _ in groups[i]])
            y = np.zeros(there.shape, bool)
            for k, (m, lab) in enumerate(groups[i]):
                y[:len(m), k] = lab
            _, g = net.gradients(x, there, y)
            step += 1
            rate = 0.02 * (1 - epoch / epochs) + 0.002
            size = np.sqrt(sum(float((v ** 2).sum()) for v in g.values()))
            for name, v in g.items():
                v = v * min(1.0, 1.0 / max(size, 1e-9))
                first[name] = 0.9 * first[name] + 0.1 * v
                second[name] = 0.99 * second[name] + 0.01 * v * v
                net.p[name] -= (rate * (first[name] / (1 - 0.9 ** step))
                                / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def _minibatches(pages: list[np.ndarray], size: int = 16):
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
    return [order[k:k + size] for k in range(0, len(order), size)]


# the operator -----------------------------------------------------------------------------------------
def main_texts(net: Labeller, pages: list[str]) -> list[str]:
    found = [blocks(p) for p in pages]
    scores = net.probabilities([page_matrix(b) for b in found])
    return ["\n".join(b.text for b, s in zip(bs, ss) if s >= 0.5) for bs, ss in zip(found, scores)]


def fit(pages: DataFrame, limit: int = TRAIN_PAGES) -> Labeller:
    rows = bounded_sample(pages.select("html").where("html is not null and html != ''"), F.xxhash64("html"), limit)
    return train(sorted({r["html"] for r in rows.collect()}))


def extract(pages: DataFrame, net: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    net = net or fit(pages)
    shared = pages.sparkSession.sparkContext.broadcast(net)      # fixed size

    def run(batches):
        for part in text_chunks(batches, "html"):
            texts = main_texts(shared.value, [b.decode("utf-8", "replace") for b in raw_bytes(part, "html")])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
