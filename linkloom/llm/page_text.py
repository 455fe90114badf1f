"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of blocks: runs of text that no block-level tag interrupts, each with the path of open elements above it.
A bidirectional LSTM in numpy reads the sequence. Its input for a block is the sum of hashed vectors of the path's tags and of the words
in their class, id and role attributes, the mean of hashed vectors of the block's words, and a few measures (length, share of linked
text, sentence marks). So every block is classified with the whole document before and after it in view. Main text
is the positive blocks, in page order.

Pages carry no labels. The training set is a bounded sample of pages (``max_pages``, smallest hashes first) labelled by a rule on
clear cases (text inside an article or main element and inside nothing that is marked as navigation, advertising, comments and so on),
and as many pages made from the sample's texts with other layouts, so that the labeller knows elements that the sample lacks.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.textcols import slices

MAX_PAGES = 250
MAX_BLOCKS = 80  # of a training page: as many consecutive blocks
PATH_ROWS = 1 << 11
WORD_ROWS = 1 << 12
WIDTH = 16
HIDDEN = 20
MEASURES = 7
EPOCHS = 14
RATE = 0.01
SLICE_BYTES = 1 << 20
OUTER, INNER, MARKS = 8, 32, 30  # of a very deep path: its outermost and innermost elements; and attribute words of an element

SCHEMA = "page_id long, url string, text string, n_blocks int, n_main_blocks int"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^<>]*>", re.S)
_ATTR = re.compile(r"""\b(class|id|role|itemprop|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Za-z0-9]+")

#: Elements whose content is no text of the page.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "title", "textarea", "select", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
    "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "img",
}
#: Elements that end an open paragraph.
ENDS_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main",
    "nav", "ol", "p", "pre", "section", "table", "ul",
}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags and attribute words, outermost first
    linked: int = 0
    label: int = 0


@dataclass
class _Parser:
    blocks: list[Block] = field(default_factory=list)
    stack: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    linked: int = 0
    opened: Counter = field(default_factory=Counter)  # names on the stack

    def flush(self) -> None:
        if self.text:
            found = " ".join(html.unescape("".join(self.text)).split())
            if found:
                above = self.stack if len(self.stack) <= OUTER + INNER else [*self.stack[:OUTER], *self.stack[-INNER:]]
                path = tuple(x for name, marks in above if name not in INLINE for x in (f"<{name}", *marks))
                self.blocks.append(Block(found, path, self.linked))
            self.text, self.linked = [], 0

    def close(self, name: str) -> None:
        for k in () if not self.opened[name] else range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                if name not in INLINE:
                    self.flush()
                self.opened.subtract(x[0] for x in self.stack[k:])
                del self.stack[k:]
                return
        if name not in INLINE:
            self.flush()

    def open(self, name: str, rest: str) -> None:
        if name in ENDS_P and self.opened["p"]:
            self.close("p")
        if name not in INLINE:
            self.flush()
        if name == "li" and self.stack and self.stack[-1][0] == "li":
            self.close("li")
        if name in VOID or rest.endswith("/"):
            if name in ("br", "img", "hr"):
                self.text.append(" ")
            return
        marks: list[str] = []
        if "=" in rest or "hidden" in rest:
            for m in _ATTR.finditer(rest):
                value = m[2] or m[3] or m[4] or ""
                marks += [w.lower() for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value))]
                if m[1].lower() == "hidden":
                    marks.append("hidden")
        self.stack.append((name, tuple(marks[:MARKS])))
        self.opened[name] += 1

    def feed(self, page: str) -> list[Block]:
        at = 0
        while True:
            m = _TOKEN.search(page, at)
            part = page[at : m.start()] if m else page[at:]
            if not m and "<" in part and re.search(r"<[/!A-Za-z][^<]*\Z", part):
                part = part[: part.rindex("<")]  # the page ends inside a tag
            if part:
                self.text.append(part)
                if self.opened["a"]:
                    self.linked += len(part)
            if not m:
                self.flush()
                return self.blocks
            at = m.end()
            if not (name := m["name"]):
                continue
            name = name.lower()
            if m["close"]:
                self.close(name)
            elif name in SILENT:
                if name not in INLINE:
                    self.flush()
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            else:
                self.open(name, m["rest"])


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order. Unclosed and stray tags are borne; what stands in comments, scripts and styles is left out."""
    return _Parser().feed(page or "")


#: Words that mark an element as no part of the main text.
MARKED = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar aside widget related recommended share sharing social comment comments reply replies respond disqus footer header masthead toolbar "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login search form pagination pager tags "
    "copyright legal skip hidden".split()
)
MARKED_TAGS = {"<nav", "<header", "<footer", "<aside", "<form", "<button", "<dialog", "<menu", "<fieldset", "<head"}
MAIN_TAGS = {"<article", "<main"}


def rule_label(block: Block, framed: bool) -> int:
    """The teacher's label. ``framed``: the page has an article or main element."""
    path = set(block.path)
    if path & MARKED_TAGS or path & MARKED:
        return 0
    if framed:
        return int(bool(path & MAIN_TAGS))
    return int(block.linked * 2 < len(block.text) and bool({"<p", "<h1", "<h2", "<h3", "<blockquote", "<pre"} & path))


def labelled(page: str) -> list[Block]:
    blocks = blocks_of(page)
    framed = any(MAIN_TAGS & set(b.path) for b in blocks)
    for b in blocks:
        b.label = rule_label(b, framed)
    return blocks


def made_page(rng: np.random.Generator, main: list[str], other: list[str]) -> list[Block]:
    """A page in another layout with known labels, from texts of the sample."""

    def some(n: int, pool: list[str]) -> list[str]:
        return [pool[int(i)] for i in rng.integers(len(pool), size=n)] if pool else []

    def part(tag: str, marks: str, inner: str, n: int, label: int, pool: list[str], outer: tuple[str, ...], linked: bool = False) -> list[Block]:
        path = (*outer, f"<{tag}", *marks.split(), *inner.split())
        return [Block(t, path, len(t) if linked else 0, label) for t in some(n, pool)]

    body = ("<html", "<body")
    if rng.random() < 0.5:
        body = (*body, "<div", str(rng.choice(["page", "wrapper", "container", "site", "layout"])))
    pick = lambda *options: str(rng.choice(list(options)))
    any_text, short = [*main, *other], [" ".join(t.split()[: int(rng.integers(1, 4))]) for t in some(8, [*main, *other])]
    n = lambda low, high: int(rng.integers(low, high))
    before = [
        part("nav", pick("", "menu", "main menu"), "<ul <li", n(3, 9), 0, short, body, True),
        part("header", pick("", "site header", "masthead"), pick("<h1", "<p", "<div", "<div title"), n(1, 4), 0, any_text, body),
        part("div", pick("header", "top bar", "site header", "breadcrumb", "breadcrumbs", "navbar"), pick("<ul <li", "<p", "<div"), n(1, 6), 0, short, body, rng.random() < 0.7),
        part("div", pick("cookie notice", "notice", "cookie banner", "consent", "alert", "popup", "gdpr"), pick("<p", "<div", ""), n(1, 3), 0, any_text, body),
        part("div", pick("ad", "ads", "advert", "banner", "sponsored", "ad slot", "promo"), pick("", "<p", "<div"), n(1, 3), 0, any_text, body),
        part("form", pick("", "search", "login", "newsletter"), pick("<label", "<p", "<div", "<button"), n(1, 4), 0, any_text, body),
    ]
    after = [
        part("aside", pick("", "sidebar", "related"), pick("<p", "<ul <li", "<h3", "<div"), n(1, 6), 0, any_text, body),
        part("div", pick("sidebar", "side bar", "widget", "related posts", "recommended", "right column sidebar"), pick("<p", "<ul <li", "<h3", "<div"), n(1, 6), 0, any_text, body),
        part(pick("section", "div", "ol", "ul"), pick("comments", "comment list", "user comments", "responses comments", "replies", "comments area"), pick("<p", "<div comment <p", "<li comment <p", "<article comment <p", "<li"), n(1, 9), 0, any_text, body),
        part("div", pick("share", "social", "social links", "share buttons", "tags", "pagination"), pick("<ul <li", "<span", "<p"), n(1, 6), 0, short, body, True),
        part("form", pick("", "comment form", "newsletter", "subscribe"), pick("<label", "<p", "<div"), n(1, 4), 0, any_text, body),
        part("footer", pick("", "site footer"), pick("", "<p", "<ul <li", "<div"), n(1, 5), 0, any_text, body),
        part("div", pick("footer", "site footer", "copyright", "bottom footer"), pick("<p", "", "<ul <li"), n(1, 4), 0, any_text, body),
    ]
    frame = [("<article",), ("<main",), ("<main", "<article"), ("<div", "content"), ("<div", "post"), ("<div", "entry", "content"), ("<section", "article", "body"), ("<div", "story"), ("<div", "main", "content"), ()]
    outer = (*body, *frame[n(0, len(frame))])
    middle = part(pick("h1", "h2"), pick("", "title", "headline"), "", n(0, 2), 1, [" ".join(t.split()[:9]) for t in main], outer)
    for _ in range(n(1, 5)):
        middle += part(*pick_main(rng), n(1, 6), 1, main, outer)
        if rng.random() < 0.3:  # an advert or a notice inside the article
            middle += part("div", pick("ad", "advert", "sponsored", "newsletter", "related", "share"), pick("", "<p"), n(1, 2), 0, any_text, outer)
    if rng.random() < 0.2:
        middle += part("section", "comments", pick("<p", "<div comment <p"), n(1, 5), 0, any_text, outer)
    chosen = lambda parts, p: [b for x in parts if rng.random() < p for b in x]
    return [*chosen(before, 0.4), *middle, *chosen(after, 0.4)]


def pick_main(rng: np.random.Generator) -> tuple[str, str, str]:
    options = [("p", "", "")] * 6 + [("blockquote", "", "<p"), ("ul", "", "<li"), ("ol", "", "<li"), ("h2", "", ""), ("h3", "", ""), ("pre", "", ""), ("table", "", "<tr <td"), ("figure", "", "<figcaption"), ("div", "", "")]
    return options[int(rng.integers(len(options)))]


# --- features ---------------------------------------------------------------------------------------------------


def _row(word: str, rows: int) -> int:
    return zlib.crc32(word.encode()) % rows


class Features:
    """Hashed rows of the blocks of some pages, flat; words and path parts with the block that each belongs to."""

    def __init__(self, pages: list[list[Block]], paths: dict[tuple[str, ...], list[int]] | None = None) -> None:
        self.lengths = np.array([len(p) for p in pages], np.int64)
        flat = [b for p in pages for b in p]
        paths = {} if paths is None else paths
        words: list[int] = []
        n_words, tags, n_tags = [], [], []
        measures = np.zeros((len(flat), MEASURES), np.float32)
        for i, b in enumerate(flat):
            if (found := paths.get(b.path)) is None:
                depth = len(b.path)
                found = [_row(x, PATH_ROWS) for x in b.path] + [_row(f"{x}^{y}", PATH_ROWS) for x, y in zip(b.path[-3:], b.path[-2:])] + [_row(f"depth{min(depth, 12)}", PATH_ROWS)]
                if len(paths) < 50_000:
                    paths[b.path] = found
            tags += found
            n_tags.append(len(found))
            own = b.text.lower().split()
            n_words.append(len(own))
            words += own
            size = len(b.text)
            last = b.text[-1]
            measures[i] = (np.log1p(size) / 5, np.log1p(len(own)) / 4, b.linked / size if b.linked < size else 1.0, last in ".!?:", size < 30, b.text.count(".") / 10 if size < 2000 else 1.0, 1.0)
        self.measures = measures
        self.tags, self.tag_block = np.array(tags, np.int64), np.repeat(np.arange(len(flat)), n_tags)
        rows = np.fromiter((zlib.crc32(w.encode()) & (WORD_ROWS - 1) for w in words), np.int64, len(words))
        self.words, self.word_block, self.n_words = rows, np.repeat(np.arange(len(flat)), n_words), np.array(n_words, np.int64)
        self.labels = np.array([b.label for b in flat], np.int64)


def _summed(table: np.ndarray, rows: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, table.shape[1]), np.float32)
    if len(rows):
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out[owner[first]] = np.add.reduceat(table[rows], first, axis=0)
    return out


class Labeller:
    """Embedding tables, one LSTM for each direction, and a logistic output on both states."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        wide = 2 * WIDTH + MEASURES
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {"path": draw(0.3, PATH_ROWS, WIDTH), "word": draw(0.1, WORD_ROWS, WIDTH)}
        for d in "fb":
            self.p |= {f"w{d}": draw(0.2, wide, 4 * HIDDEN), f"u{d}": draw(0.2, HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1  # forget gates start open
        self.p |= {"out": draw(0.2, 2 * HIDDEN + wide, 1), "bias": np.zeros(1, np.float32)}

    def inputs(self, f: Features) -> np.ndarray:
        n = len(f.measures)
        path = _summed(self.p["path"], f.tags, f.tag_block, n)
        word = _summed(self.p["word"], f.words, f.word_block, n) / np.maximum(f.n_words, 1)[:, None]
        return np.concatenate([path, word, f.measures], axis=1)

    def lstm(self, x: np.ndarray, live: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """States for (pages, steps, features); ``live``: how many pages (they come longest first) have each step."""
        n, steps, _ = x.shape
        gates_x = x @ self.p[f"w{d}"] + self.p[f"c{d}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, steps, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            m = int(live[t])
            z = gates_x[:m, t] + h[:m] @ self.p[f"u{d}"]
            s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            g = np.tanh(z[:, 3 * HIDDEN :])
            i, fo, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            new = fo * c[:m] + i * g
            tanh = np.tanh(new)
            if trace is not None:
                trace.append((t, m, i, fo, o, g, c[:m].copy(), tanh, h[:m].copy()))
            c[:m] = new
            h[:m] = o * tanh
            out[:m, t] = h[:m]
        return out

    def _padded(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the pages (longest first), flat block number of each (page, step), and live pages by step."""
        order = np.argsort(-f.lengths, kind="stable")
        lengths = f.lengths[order]
        begin = (np.cumsum(f.lengths) - f.lengths)[order]
        steps = int(lengths[0]) if len(lengths) else 0
        at = begin[:, None] + np.minimum(np.arange(steps)[None, :], np.maximum(lengths - 1, 0)[:, None])
        live = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")
        return order, at, live

    def predict(self, f: Features) -> np.ndarray:
        """Whether each block is main text."""
        if not len(f.measures):
            return np.zeros(0, bool)
        x = self.inputs(f)
        _, at, live = self._padded(f)
        some = int(live[0])
        at = at[:some]
        seq = x[at]
        both = np.concatenate([self.lstm(seq, live, "f"), self.lstm(seq, live, "b"), seq], axis=2)
        score = (both @ self.p["out"])[:, :, 0] + self.p["bias"]
        out = np.zeros(len(x), bool)
        inside = np.arange(at.shape[0])[:, None] < live[None, :]
        out[at[inside]] = score[inside] > 0
        return out

    def gradients(self, f: Features) -> tuple[float, dict[str, np.ndarray]]:
        x = self.inputs(f)
        _, at, live = self._padded(f)
        inside = np.arange(at.shape[0])[:, None] < live[None, :]
        seq = x[at]
        traces: dict[str, list] = {"f": [], "b": []}
        states = {d: self.lstm(seq, live, d, traces[d]) for d in "fb"}
        both = np.concatenate([states["f"], states["b"], seq], axis=2)
        score = (both @ self.p["out"])[:, :, 0] + self.p["bias"]
        chance = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        gold = f.labels[at]
        total = inside.sum()
        loss = -(np.log(np.where(gold == 1, chance, 1 - chance) + 1e-9) * inside).sum() / total
        error = ((chance - gold) * inside / total).astype(np.float32)
        grad = {"out": np.einsum("nsk,ns->k", both, error)[:, None], "bias": np.array([error.sum()], np.float32)}
        back = error[:, :, None] * self.p["out"][:, 0]
        d_seq = back[:, :, 2 * HIDDEN :].copy()
        for k, d in enumerate("fb"):
            d_out = back[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            d_gates = np.zeros((*seq.shape[:2], 4 * HIDDEN), np.float32)
            d_h, d_c = np.zeros((len(seq), HIDDEN), np.float32), np.zeros((len(seq), HIDDEN), np.float32)
            d_u = np.zeros_like(self.p[f"u{d}"])
            for t, m, i, fo, o, g, c_old, tanh, h_old in reversed(traces[d]):
                dh = d_out[:m, t] + d_h[:m]
                dc = d_c[:m] + dh * o * (1 - tanh * tanh)
                z = np.concatenate([dc * g * i * (1 - i), dc * c_old * fo * (1 - fo), dh * tanh * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                d_gates[:m, t] = z
                d_u += h_old.T @ z
                d_h[:m] = z @ self.p[f"u{d}"].T
                d_c[:m] = dc * fo
            grad |= {f"w{d}": np.einsum("nsk,nsg->kg", seq, d_gates), f"u{d}": d_u, f"c{d}": d_gates.sum((0, 1))}
            d_seq += d_gates @ self.p[f"w{d}"].T
        d_x = np.zeros_like(x)
        d_x[at[inside]] = d_seq[inside]
        grad["path"] = np.zeros_like(self.p["path"])
        np.add.at(grad["path"], f.tags, d_x[f.tag_block, :WIDTH])
        grad["word"] = np.zeros_like(self.p["word"])
        np.add.at(grad["word"], f.words, d_x[f.word_block, WIDTH : 2 * WIDTH] / np.maximum(f.n_words, 1)[f.word_block][:, None])
        return float(loss), grad

    def fit(self, pages: list[list[Block]], epochs: int = EPOCHS, batch: int = 25, seed: int = 4) -> float:
        """Adam on batches of pages; returns the last epoch's mean loss."""
        rng, step, loss = np.random.default_rng(seed), 0, 0.0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        pages = [p for p in pages if p]
        for _ in range(epochs):
            order, losses = rng.permutation(len(pages)), []
            for at in range(0, len(order), batch):
                step += 1
                loss, grad = self.gradients(Features([pages[i] for i in order[at : at + batch]]))
                losses.append(loss)
                for k, g in grad.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= (RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            loss = float(np.mean(losses)) if losses else 0.0
        return loss


def train_labeller(pages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Labeller | None:
    """A labeller fitted on these pages and as many made ones; None if the pages have no main text to learn from."""
    rng = np.random.default_rng(seed)
    real = [labelled(p) for p in pages]
    main = [b.text for p in real for b in p if b.label]
    other = [b.text for p in real for b in p if not b.label]
    if not main:
        return None
    cut = []
    for p in real:
        start = int(rng.integers(max(1, len(p) - MAX_BLOCKS + 1)))
        cut.append(p[start : start + MAX_BLOCKS])
    made = [made_page(rng, main, other)[:MAX_BLOCKS] for _ in range(max(len(pages), 50))]
    model = Labeller()
    model.fit([*cut, *made], epochs)
    return model


def sample_pages(pages: DataFrame, max_pages: int) -> list[str]:
    ids = [r[0] for r in pages.where("page_id is not null").select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages).collect()]
    rows = pages.where(F.col("page_id").isin(ids)).select("page_id", "html").limit(2 * max_pages).collect() if ids else []
    return [h for _, h in sorted((r[0], r[1]) for r in rows if r[1])]


def extract_main_text(pages: DataFrame, *, max_pages: int = MAX_PAGES, training: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages`` (``page_id``, ``url``, ``html``): the main blocks' ``text`` joined by line feeds, and block counts.

    Character references are decoded, white space inside a block becomes one space. A null or empty page, or one without main text, has an
    empty text. If the sample (of ``training``, by default ``pages``) has nothing to learn from, the rule itself labels the blocks. Repeated rows
    are read one by one; other columns are ignored.
    """
    model = train_labeller(sample_pages(pages if training is None else training, max_pages))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, paths = shared.value, {}
        for batch in slices(batches, "html", SLICE_BYTES):
            found = [blocks_of(p) for p in batch.column("html").to_pylist()] if net else [labelled(p or "") for p in batch.column("html").to_pylist()]
            main = net.predict(Features(found, paths)) if net else np.array([b.label for p in found for b in p], bool)
            texts, kept, at = [], [], 0
            for p in found:
                chosen = [b.text for b, m in zip(p, main[at : at + len(p)]) if m]
                at += len(p)
                texts.append("\n".join(chosen))
                kept.append(len(chosen))
            yield pa.record_batch(
                {
                    "page_id": batch.column("page_id").cast(pa.int64()),
                    "url": batch.column("url").cast(pa.string()),
                    "text": pa.array(texts, pa.string()),
                    "n_blocks": pa.array([len(p) for p in found], pa.int32()),
                    "n_main_blocks": pa.array(kept, pa.int32()),
                }
            )

    return pages.select("page_id", "url", "html").mapInArrow(extract, SCHEMA)
