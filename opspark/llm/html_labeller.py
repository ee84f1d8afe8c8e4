"""Main text of HTML pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Each has a vector of its tag path, the words of its class and id attributes, its own words (all
hashed) and a few measures; a bidirectional LSTM in numpy reads the sequence both ways, so every block is labelled with
the whole page in view. Training pages are composed here: texts come from a bounded sample of the pages, layouts from
a generator that draws the element and attribute names which sites give to articles, menus, notices, forms, comments and
so on, with and without telling names; sampled pages with semantic elements are training pages themselves.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opspark.llm.common import digits, small_batches, table
from opspark.llm.html_blocks import Block, blocks

#: Bounds and settings of the training.
SAMPLE_PAGES = 300
COMPOSED_PAGES = 1400
EPOCHS = 5
HIDDEN = 16

#: Blocks times pages that are labelled at once.
GROUP_BLOCKS = 1 << 14

#: Blocks of a given page from which on it is no training page: composed pages have less, and one page should not be most of a batch.
TRAIN_BLOCKS = 120

TAGS, PATH, MARKS, WORDS, MEASURES = 24, 48, 96, 48, 8
_WIDTH = TAGS + PATH + MARKS + WORDS + MEASURES

#: Names that sites use, by part of the page. A part's first list has elements, its second class and id words.
PARTS = {
    "menu": (["nav", "div", "ul", "header"], ["nav", "navbar", "menu", "main menu", "breadcrumb", "topbar", "navigation", "links", "site nav"]),
    "header": (["header", "div"], ["header", "site header", "masthead", "top", "logo", "branding", "page header"]),
    "footer": (["footer", "div"], ["footer", "site footer", "copyright", "bottom", "legal", "colophon"]),
    "side": (["aside", "div", "section"], ["sidebar", "side", "widget", "related", "popular", "recommended", "trending", "more stories", "rail"]),
    "notice": (["div", "section", "p", "aside"], ["cookie", "consent", "notice", "banner", "gdpr", "alert", "cookie banner", "privacy notice", "message", "paywall"]),
    "advert": (["div", "aside", "section"], ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad slot", "banner ad", "sponsor"]),
    "form": (["form", "div"], ["newsletter", "subscribe", "search", "search form", "signup", "contact form", "login", "subscription"]),
    "comments": (["section", "div", "ol", "ul", "article"], ["comments", "comment list", "comment", "responses", "discussion", "reader comments", "replies", "disqus thread"]),
    "share": (["div", "ul"], ["share", "social", "tags", "author bio", "pager", "pagination", "byline meta", "toolbar"]),
}
CONTENT = (["article", "main", "div", "section", "td"], ["article", "content", "post", "entry content", "post body", "story", "article body", "main content", "text", "body", "main"])

#: Words that parts other than the article often hold.
USUAL = {
    "menu": "home about contact news products services blog login help", "header": "welcome search login site",
    "footer": "copyright all rights reserved privacy terms imprint contact", "side": "related popular read more recent posts categories archive",
    "notice": "we use cookies accept privacy policy settings agree consent", "advert": "advertisement sponsored buy now offer sale discount",
    "form": "email name subscribe newsletter submit sign up search password", "comments": "comment reply posted says like report anonymous ago",
    "share": "share tweet facebook print tags author next previous",
}


class Vectors:
    """Block vectors; those of paths and attributes are remembered, as pages repeat them."""

    def __init__(self):
        self.shape: dict[tuple, np.ndarray] = {}
        self.place: dict[str, int] = {}

    def _shape(self, path: tuple, marks: tuple) -> np.ndarray:
        got = self.shape.get((path, marks))
        if got is None:
            got = np.zeros(TAGS + PATH + MARKS, np.float32)
            slot = lambda s, n: zlib.crc32(s.encode()) % n
            got[slot("leaf " + (path[-1] if path else ""), TAGS)] = 1
            for t in path:
                got[TAGS + slot("path " + t, PATH)] = 1
            for m in marks:
                got[TAGS + PATH + slot("mark " + m, MARKS)] = 1
            if len(self.shape) > 50_000:
                self.shape.clear()
            self.shape[path, marks] = got
        return got

    def of(self, page: list[Block]) -> np.ndarray:
        out = np.zeros((len(page), _WIDTH), np.float32)
        words_at, measures_at = TAGS + PATH + MARKS, _WIDTH - MEASURES
        place = self.place
        for i, b in enumerate(page):
            out[i, :words_at] = self._shape(b.path, b.marks)
            words = b.text.lower().split()
            slots = []
            for w in words:
                at = place.get(w)
                if at is None:
                    if len(place) > 200_000:
                        place.clear()
                    at = place[w] = zlib.crc32(w.encode("utf-8", "replace")) % WORDS
                slots.append(at)
            out[i, words_at:measures_at] = np.bincount(slots, minlength=WORDS) / np.sqrt(len(words))
            n = len(b.text)
            out[i, measures_at:] = (
                np.log1p(n) / 8, np.log1p(len(words)) / 6, min(1.0, b.link / n), i / len(page), 1 - i / len(page),
                b.text[-1] in ".!?", len(b.path) / 10, sum(map(b.text.count, ".,;")) / n * 10)
        return out


@dataclass
class Labeller:
    """Weights of both directions (input, recurrent, bias) and of the output."""

    weights: dict[str, np.ndarray]

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of main text for each block of each page."""
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: -len(pages[i]))
        out = [np.zeros(0, np.float32) for _ in pages]
        start = 0
        while start < len(order):
            # pages are filled up to the longest of their group: its length times the pages is bounded
            part = order[start : start + max(1, min(64, GROUP_BLOCKS // len(pages[order[start]])))]
            start += len(part)
            x, lengths = _padded([pages[i] for i in part])
            p, _ = forward(self.weights, x, lengths, keep=False)
            for row, i in enumerate(part):
                out[i] = p[: lengths[row], row]
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in pages])
    x = np.zeros((lengths.max(), len(pages), pages[0].shape[1]), np.float32)
    for i, p in enumerate(pages):
        x[: len(p), i] = p
    return x, lengths


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(w: dict, side: str, x: np.ndarray, mask: np.ndarray, keep: bool = True):
    """States of one direction over (time, page, width); where the mask is 0 the state stays as it is.

    With ``keep`` also what the gradients need of each step.
    """
    steps, n, _ = x.shape
    drive = x @ w[side + "x"] + w[side + "b"]
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    states, kept = np.zeros((steps, n, HIDDEN), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        z = drive[t] + h @ w[side + "h"]
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        c_new = m * (f * c + i * g) + (1 - m) * c
        tc = np.tanh(c_new)
        if keep:
            kept.append((t, i, f, o, g, c, tc, h, m))
        h = m * (o * tc) + (1 - m) * h
        c = c_new
        states[t] = h
    return states, kept


def forward(w: dict, x: np.ndarray, lengths: np.ndarray, keep: bool = True):
    mask = (np.arange(len(x))[:, None] < lengths[None, :]).astype(np.float32)
    ahead, back = _run(w, "f", x, mask, keep), _run(w, "r", x, mask, keep)
    both = np.concatenate([ahead[0], back[0]], 2)
    return _sigmoid(both @ w["o"] + w["ob"]), (mask, ahead, back, both)


def gradients(w: dict, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> tuple[dict, float]:
    """Gradients of the mean cross-entropy over the blocks, through time in both directions."""
    p, (mask, ahead, back, both) = forward(w, x, lengths)
    total = mask.sum()
    loss = float(-(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / total)
    d = (p - y) * mask / total
    grads = {"o": np.einsum("tnh,tn->h", both, d), "ob": d.sum()}
    d_both = d[:, :, None] * w["o"]
    for side, (_, kept), part in (("f", ahead, slice(0, HIDDEN)), ("r", back, slice(HIDDEN, None))):
        dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        dh = np.zeros((x.shape[1], HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        grads[side + "h"] = np.zeros_like(w[side + "h"])
        for t, i, f, o, g, c, tc, h, m in reversed(kept):
            dh = dh + d_both[t][:, part]
            new = m * dh
            dcell = dc + new * o * (1 - tc * tc)
            inner = m * dcell
            dz = np.concatenate([inner * g * i * (1 - i), inner * c * f * (1 - f), new * tc * o * (1 - o), inner * i * (1 - g * g)], 1)
            dz_all[t] = dz
            grads[side + "h"] += h.T @ dz
            dh = dz @ w[side + "h"].T + (1 - m) * dh
            dc = inner * f + (1 - m) * dcell
        grads[side + "x"] = np.tensordot(x, dz_all, ([0, 1], [0, 1]))
        grads[side + "b"] = dz_all.sum((0, 1))
    return grads, loss


def train(pages: list[tuple[np.ndarray, np.ndarray]], seed: int = 5, epochs: int = EPOCHS) -> Labeller:
    """A labeller from (vectors, labels) of pages, by Adam on batches of pages of like length."""
    rng = np.random.default_rng(seed)
    w: dict[str, np.ndarray] = {"o": rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), "ob": np.zeros((), np.float32)}
    for side in "fr":
        w[side + "x"] = rng.normal(0, 0.08, (_WIDTH, 4 * HIDDEN)).astype(np.float32)
        w[side + "h"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        w[side + "b"] = np.zeros(4 * HIDDEN, np.float32)
        w[side + "b"][HIDDEN : 2 * HIDDEN] = 1
    pages = [p for p in pages if len(p[0])]
    order = sorted(range(len(pages)), key=lambda i: len(pages[i][0]))
    batches = [order[i : i + 32] for i in range(0, len(order), 32)]
    m, v, t = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}, 0
    for _ in range(epochs):
        for k in rng.permutation(len(batches)):
            x, lengths = _padded([pages[i][0] for i in batches[k]])
            y = _padded([pages[i][1][:, None] for i in batches[k]])[0][:, :, 0]
            grads, _ = gradients(w, x, lengths, y)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            t += 1
            for name, g in grads.items():
                g = g * min(1.0, 2.0 / (norm + 1e-9))
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                w[name] = (w[name] - 0.01 * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return Labeller(w)


def compose(texts: list[str], rng: random.Random) -> tuple[list[Block], np.ndarray]:
    """A page of drawn layout with its labels. The article's texts carry a mark, which is taken out of the blocks again."""
    mark = "\x02"
    named = rng.random() < 0.8
    words = " ".join(rng.choice(texts) for _ in range(3)).split() or ["x"]

    def esc(s: str) -> str:
        return s.replace("&", "&amp;").replace("<", "&lt;")

    def some(low: int, high: int) -> str:
        n = rng.randint(low, high)
        at = rng.randrange(len(words))
        return esc(" ".join((words[at:] + words * (n // len(words) + 1))[:n]))

    def attrs(names: list[str], plain: float = 0.15) -> str:
        if not named or rng.random() < plain:
            return rng.choice(["", "", f' class="{rng.choice(["row", "col", "wrap", "inner", "box", "c" + str(rng.randint(1, 99))])}"'])
        value = rng.choice(names).replace(" ", rng.choice(["-", "_", " "]))
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice(["", "", "js ", "m-"])}{value}"'

    def item(part: str) -> str:
        usual = USUAL[part].split()
        text = " ".join(rng.sample(usual, min(len(usual), rng.randint(1, 4)))) if rng.random() < 0.5 else some(1, 6)
        return text if rng.random() < 0.7 else text + " " + some(1, 8)

    def other(part: str) -> str:
        tags, names = PARTS[part]
        tag = rng.choice(tags)
        if part in ("menu", "share") or part in ("footer", "side", "header") and rng.random() < 0.5:
            inner = "<ul>" * (tag != "ul") + "".join(f'<li><a href="/x">{item(part)}</a></li>' for _ in range(rng.randint(2, 9))) + "</ul>" * (tag != "ul")
        elif part == "comments":
            each = rng.choice(["<div{0}><span>{1}</span><p>{2}</p></div>", "<article{0}><header>{1}</header><p>{2}</p></article>", "<li{0}><b>{1}</b> {2}</li>", "<p>{1}: {2}</p>"])
            inner = f"<h3>{item(part)}</h3>" * rng.randint(0, 1) + "".join(
                each.format(attrs(["comment", "comment body", "reply", "response"]), some(1, 3), some(3, 50)) for _ in range(rng.randint(1, 6)))
        elif part == "form":
            inner = f"<label>{item(part)}</label><input><p>{item(part)}</p>" * rng.randint(1, 3) + f"<button>{item(part)}</button>"
        elif part in ("side", "notice", "advert"):
            inner = f"<h4>{item(part)}</h4>" * rng.randint(0, 1) + (f"<p>{some(4, 40)}</p>" * rng.randint(1, 2) if rng.random() < 0.5 else some(3, 25))
        else:
            inner = rng.choice(["{}", "<p>{}</p>", "<div>{}</div>", "&copy; {}"]).format(item(part) + " " + some(0, 15))
        return f"<{tag}{attrs(names)}>{inner}</{tag}>"

    def body() -> str:
        tag = rng.choice(["p"] * 8 + ["div"])
        out = [f"<h{rng.choice('112')}>{mark}{some(2, 12)}</h2>"] if rng.random() < 0.85 else []
        for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 20])):
            kind = rng.random()
            text = mark + some(*rng.choice([(1, 8), (5, 40), (30, 160)]))
            if kind < 0.8:
                out.append(rng.choice(["<{0}>{1}</{0}>"] * 5 + ["<{0}><b>{1}<br><{0}>"]).format(tag, text))
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{mark}{some(2, 20)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.94:
                out.append(f"<h{rng.choice('234')}>{mark}{some(1, 8)}</h3>")
            elif kind < 0.96:
                out.append("<table>" + f"<tr><td>{mark}{some(1, 5)}</td><td>{mark}{some(1, 5)}</td></tr>" * rng.randint(1, 3) + "</table>")
            else:
                out.append(other(rng.choice(["advert", "side", "share", "form", "notice"])))
        return "".join(out)

    tag = rng.choice(CONTENT[0])
    main = f"<{tag}{attrs(CONTENT[1], 0.5 if tag in ('article', 'main') else 0.1)}>{body()}</{tag}>"
    for _ in range(rng.choice([0, 0, 1, 2])):
        wrap = rng.choice(["div", "main", "section", "div"])
        before, after = (other(rng.choice(["share", "advert", "notice"])) if rng.random() < 0.3 else "" for _ in range(2))
        main = f"<{wrap}{attrs(CONTENT[1] + ['page', 'container', 'wrapper'], 0.5)}>{before}{main}{after}</{wrap}>"
    first = [other(p) for p in ("notice", "header", "menu", "advert", "side", "form") if rng.random() < (0.75 if p == "menu" else 0.35)]
    last = [other(p) for p in ("share", "comments", "side", "advert", "form", "notice", "footer") if rng.random() < (0.75 if p == "footer" else 0.4)]
    page = blocks(f"<html><head><title>{some(2, 9)}</title></head><body>{''.join(first)}{main}{''.join(last)}</body></html>")
    return [b._replace(text=b.text.replace(mark, "") or "-") for b in page], np.array([mark in b.text for b in page], np.float32)


def weak_labels(page: list[Block]) -> np.ndarray | None:
    """Labels by semantic elements, for a page whose blocks stand partly under exactly one kind of article element."""
    other = {"nav", "footer", "aside", "form", "header"}
    y = np.array(["article" in b.path and not other & set(b.path) for b in page], np.float32)
    return y if 0 < y.sum() < len(y) else None


def learn(pages: DataFrame, seed: int = 5) -> Labeller:
    """Train on a sample of at most SAMPLE_PAGES pages (by digest of the id) and on pages composed from its texts."""
    have = pages.count()
    span = 1 << 48
    level = span if have <= SAMPLE_PAGES else int(span * min(1.0, 1.2 * SAMPLE_PAGES / have + 30 / have))
    sample = pages.select(digits(F.lit("html"), F.col("page_id")).alias("order"), "html").where((F.col("order") < level) & F.col("html").isNotNull())
    found = [blocks(r.html) for r in sample.orderBy("order", F.crc32(F.col("html").cast("binary"))).limit(SAMPLE_PAGES).collect()]
    rng, vectors = random.Random(seed), Vectors()
    texts = [b.text for p in found for b in p if len(b.text) > 40] or ["some words of a page without any text to learn from"]
    known = [(p, y) for p in found if (y := weak_labels(p)) is not None and len(p) <= TRAIN_BLOCKS]
    composed = [compose(texts, rng) for _ in range(COMPOSED_PAGES)]
    return train([(vectors.of(p), y) for p, y in known + composed if p], seed)


def extract(pages: DataFrame, labeller: Labeller, threshold: float = 0.5) -> DataFrame:
    """(page_id, url, text) of each page: the blocks that are labelled main text, in order, joined by one space.

    A null or empty page, and one without main text, has an empty text. Repeated rows are each read.
    """
    small_batches(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(labeller)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        for b in batches:
            found = [blocks(h.as_py()) for h in b.column("html")]
            labels = sent.value.label([vectors.of(p) for p in found])
            texts = [" ".join(x.text for x, y in zip(p, keep) if y >= threshold) for p, keep in zip(found, labels)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(read, "page_id long, url string, text string")


def op5_block_labeller(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extract(pages, learn(pages)).withColumn("n_chars", F.char_length("text").cast("long"))
