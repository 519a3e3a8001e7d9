"""HTML extraction by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags.  Each
block has the vector of its tag path (tags, classes, ids of its ancestors),
of its words, both hashed and embedded, and a few counts.  A bidirectional LSTM in
numpy reads the vectors of the whole page in order and says of every block
whether it belongs to the article.

The model is trained here: on a bounded, seeded sample of the pages, labelled
by their own structure, and on pages composed from the sample's blocks, whose
labels are known as they are built and which show furniture that the sample lacks.
"""
from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicebox.llm.common import table

#: Pages and bytes of html that the model is fitted on, at most.
SAMPLE_PAGES = 120
SAMPLE_BYTES = 2_000_000
COMPOSED = 700
EPOCHS = 6
BATCH = 32
#: Blocks of one training sequence, at most; longer pages are trained on in pieces. Labelling reads whole pages.
TRAIN_BLOCKS = 60
SEED = 11

PATH_BUCKETS, WORD_BUCKETS = 2048, 2048
PATH_SIZE, WORD_SIZE, COUNTS, HIDDEN = 24, 8, 6, 16

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html iframe label legend li main menu nav noscript ol optgroup option p pre search section "
    "select summary table tbody td template textarea tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these ends an open one of the others, unless one of the bounds is in between.
ENDS = {
    "p": ({"p"}, {"div", "td", "th", "li", "article", "section", "main", "body", "form", "blockquote"}),
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head", "title"}, set()),
}
#: Block tags that end an open paragraph.
ENDS_P = BLOCK_TAGS - {"p", "li", "dt", "dd", "tr", "td", "th", "option", "body", "button", "label"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    text: str
    path: tuple[int, ...]
    linked: int


def _bucket(name: str, buckets: int) -> int:
    return zlib.crc32(name.encode()) % buckets


_marks: dict[tuple[str, str], tuple[int, ...]] = {}


def element_marks(name: str, attributes: str) -> tuple[int, ...]:
    """Hashed tag, classes, ids and role of an element."""
    key = (name, attributes)
    if key not in _marks:
        if len(_marks) > 50_000:
            _marks.clear()
        found = {_bucket("<" + name, PATH_BUCKETS)}
        for _, a, b, c in _ATTRIBUTE.findall(attributes):
            for word in _SPLIT.split((a or b or c).lower()):
                if word:
                    found.add(_bucket("." + word, PATH_BUCKETS))
        _marks[key] = tuple(sorted(found))
    return _marks[key]


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order, with references decoded and white space folded."""
    page = page or ""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[int, ...]]] = []
    texts: list[str] = []
    linked = links = at = 0

    def flush():
        nonlocal linked
        if texts:
            joined = "".join(texts)
            text = " ".join((html.unescape(joined) if "&" in joined else joined).split())
            if text:
                blocks.append(Block(text, tuple(m for _, marks in stack for m in marks), linked))
            texts.clear()
        linked = 0

    def end(names, bounds):
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in bounds:
                return

    for tag in _TAG.finditer(page):
        if tag.start() > at:
            texts.append(page[at:tag.start()])
            if links:
                linked += tag.start() - at
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            links = 0 if tag["close"] else 1
        elif name == "br":
            texts.append("\n")
        elif name in BLOCK_TAGS:
            flush()
            if tag["close"]:
                end({name}, set())
            else:
                if name in ENDS:
                    end(*ENDS[name])
                elif name in ENDS_P:
                    end(*ENDS["p"])
                if name not in VOID_TAGS:
                    stack.append((name, element_marks(name, tag["attributes"])))
    if at < len(page):
        texts.append(page[at:])
    flush()
    return blocks


@dataclass
class Page:
    """What the network reads: hashed path and word lists of every block, and the counts."""

    paths: list[np.ndarray] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    counts: np.ndarray | None = None


_word_buckets: dict[str, int] = {}


def page_of(blocks: list[Block]) -> Page:
    page, counts = Page(), np.zeros((len(blocks), COUNTS), np.float32)
    if len(_word_buckets) > 200_000:
        _word_buckets.clear()
    for k, block in enumerate(blocks):
        words = block.text.split(" ")
        ids = []
        for word in words:
            b = _word_buckets.get(word)
            if b is None:
                b = _word_buckets[word] = _bucket(word.lower(), WORD_BUCKETS)
            ids.append(b)
        page.paths.append(np.array(block.path, np.int64))
        page.words.append(np.array(ids, np.int64))
        counts[k] = (np.log1p(len(words)) / 4, min(1.0, block.linked / (len(block.text) + 1)), block.text[-1] in ".!?…\"'”", block.text[:1].isupper(),
                     "©" in block.text or "|" in block.text, (k + 1) / (len(blocks) + 1))
    page.counts = counts
    return page


# --- the network

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors; parameters in one dictionary."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        inputs = PATH_SIZE + WORD_SIZE + COUNTS
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"path": normal(PATH_BUCKETS, PATH_SIZE, scale=0.1), "word": normal(WORD_BUCKETS, WORD_SIZE, scale=0.02),
                  "out": normal(2 * HIDDEN, scale=0.1), "bias": np.zeros(1, np.float32)}
        for way in ("ahead", "back"):
            self.p[f"{way}_w"] = normal(inputs + HIDDEN, 4 * HIDDEN, scale=0.15)
            self.p[f"{way}_b"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)

    # Sequences of one batch are padded at their ends: x is (time, batch, inputs), mask (time, batch, 1).

    def vectors(self, pages: list[Page]):
        """x, mask, and the flat lists they were embedded from."""
        lengths = [len(p.paths) for p in pages]
        x = np.zeros((max(lengths), len(pages), PATH_SIZE + WORD_SIZE + COUNTS), np.float32)
        mask = np.zeros((max(lengths), len(pages), 1), np.float32)
        place = (np.concatenate([np.arange(n) for n in lengths]), np.repeat(np.arange(len(pages)), lengths))
        flat = []
        for name, lists, begin, size in (("path", [a for p in pages for a in p.paths], 0, PATH_SIZE),
                                         ("word", [a for p in pages for a in p.words], PATH_SIZE, WORD_SIZE)):
            amount = np.array([len(a) for a in lists])
            ids, owner = np.concatenate(lists), np.repeat(np.arange(len(lists)), amount)
            scale = (1 / np.sqrt(np.maximum(amount, 1)) if name == "path" else 1 / np.maximum(amount, 1)).astype(np.float32)
            total = np.zeros((len(lists), size), np.float32)
            some = np.flatnonzero(amount)
            if len(some):
                total[some] = np.add.reduceat(self.p[name][ids], (np.cumsum(amount) - amount)[some], axis=0)
            x[place[0], place[1], begin:begin + size] = total * scale[:, None]
            flat.append((name, ids, owner, scale, begin, size))
        x[place[0], place[1], PATH_SIZE + WORD_SIZE:] = np.concatenate([p.counts for p in pages])
        mask[place] = 1
        return x, mask, place, flat

    def _run(self, x, mask, way):
        steps, batch = x.shape[:2]
        order = range(steps) if way == "ahead" else range(steps - 1, -1, -1)
        w, b = self.p[f"{way}_w"], self.p[f"{way}_b"]
        projected = x @ w[:-HIDDEN] + b
        h = c = np.zeros((batch, HIDDEN), np.float32)
        out, kept = np.zeros((steps, batch, HIDDEN), np.float32), {}
        for t in order:
            z = projected[t] + h @ w[-HIDDEN:]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            new = f * c + i * g
            tan = np.tanh(new)
            kept[t] = (h, c, i, f, o, g, tan)
            # Past a page's end the state stays at zero, so that the way back begins with its last block.
            c, h = new * mask[t], o * tan * mask[t]
            out[t] = h
        return out, kept

    def forward(self, pages: list[Page]):
        x, mask, place, flat = self.vectors(pages)
        ahead, kept_ahead = self._run(x, mask, "ahead")
        back, kept_back = self._run(x, mask, "back")
        hidden = np.concatenate([ahead, back], axis=2)
        return _sigmoid(hidden @ self.p["out"] + self.p["bias"][0]), (x, mask, place, flat, hidden, kept_ahead, kept_back)

    def gradients(self, pages: list[Page], labels: list[np.ndarray]):
        """Mean log loss over all blocks and its gradients."""
        scores, (x, mask, place, flat, hidden, *kept) = self.forward(pages)
        wanted = np.zeros(scores.shape, np.float32)
        wanted[place] = np.concatenate(labels)
        n = mask.sum()
        inside = mask[:, :, 0]
        loss = -(inside * (wanted * np.log(scores + 1e-7) + (1 - wanted) * np.log(1 - scores + 1e-7))).sum() / n
        error = (scores - wanted) * inside / n
        grads = {"out": np.einsum("tb,tbh->h", error, hidden), "bias": np.array([error.sum()], np.float32)}
        into = error[:, :, None] * self.p["out"]
        dx = np.zeros_like(x)
        for k, way in enumerate(("ahead", "back")):
            w = self.p[f"{way}_w"]
            dw, db = np.zeros_like(w), np.zeros_like(self.p[f"{way}_b"])
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t in (range(x.shape[0] - 1, -1, -1) if way == "ahead" else range(x.shape[0])):
                h, c, i, f, o, g, tan = kept[k][t]
                dh = (dh + into[t, :, k * HIDDEN:(k + 1) * HIDDEN]) * mask[t]
                dc = dc * mask[t] + dh * o * (1 - tan * tan)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tan * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                dw[:-HIDDEN] += x[t].T @ dz
                dw[-HIDDEN:] += h.T @ dz
                db += dz.sum(axis=0)
                dx[t] += dz @ w[:-HIDDEN].T
                dh, dc = dz @ w[-HIDDEN:].T, dc * f
            grads[f"{way}_w"], grads[f"{way}_b"] = dw, db
        flat_dx = dx[place]
        for name, ids, owner, scale, begin, size in flat:
            grads[name] = np.zeros_like(self.p[name])
            np.add.at(grads[name], ids, (flat_dx[:, begin:begin + size] * scale[:, None])[owner])
        return loss, grads

    def fit(self, pages: list[Page], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), BATCH):
                chosen = order[at:at + BATCH]
                _, grads = self.gradients([pages[k] for k in chosen], [labels[k] for k in chosen])
                step += 1
                rate = 0.02 * (1 - epoch / epochs) + 0.001
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self

    def label(self, pages: list[Page]) -> list[np.ndarray]:
        """Of each page, which blocks belong to the article."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k].paths), key=lambda k: len(pages[k].paths))
        while order:
            # Pages of similar lengths together, in bounded batches.
            count = max(1, min(BATCH, 20_000 // len(pages[order[-1]].paths)))
            chosen, order = order[-count:], order[:-count]
            scores = self.forward([pages[k] for k in chosen])[0]
            for column, k in enumerate(chosen):
                out[k] = scores[:len(pages[k].paths), column] >= 0.5
        return out


# --- training pages

# Names of what is not the article and of what holds one.
FURNITURE = {
    "nav": ["", "menu", "navbar", "breadcrumb"], "header": ["", "site-header", "masthead"], "footer": ["", "site-footer", "footer"],
    "aside": ["", "sidebar", "related", "widget"], "form": ["", "search", "newsletter", "login", "comment-form"],
    "ul": ["menu", "nav", "breadcrumbs", "social", "share", "tags", "pagination"], "ol": ["commentlist", "comments", "breadcrumb"],
    "section": ["comments", "related", "newsletter", "sidebar", "responses"], "figure": ["ad", "advert", "sponsor"],
    "p": ["notice", "ad", "advert", "copyright", "legal", "disclaimer"], "dialog": ["", "cookie", "consent"], "button": [""],
    "div": ["ad", "ads", "advert", "advertisement", "ad-box", "banner", "sponsored", "promo", "cookie", "cookie-banner", "cookie-notice", "notice",
            "consent", "alert", "popup", "modal", "sidebar", "side-bar", "menu", "nav", "navigation", "header", "top-bar", "footer", "site-footer",
            "comments", "comment", "comment-list", "reader-comments", "disqus", "responses", "reply", "related", "recommended", "share", "social",
            "newsletter", "subscribe", "signup", "widget", "toolbar", "breadcrumbs", "pagination", "copyright", "legal", "login", "search"],
}
ARTICLE = [("article", ""), ("article", "post"), ("main", ""), ("main", "content"), ("div", "content"), ("div", "post-content"), ("div", "entry-content"),
           ("div", "article-body"), ("div", "story"), ("div", "text"), ("section", ""), ("section", "article"), ("div", "main"), ("div", ""), ("td", ""), ("", "")]
NOT_ARTICLE = frozenset(n for n in FURNITURE if n not in ("ul", "ol", "section", "figure", "p", "div")) | {"head", "title", "select", "option", "textarea", "noscript"}
_NOISE = {_bucket("<" + n, PATH_BUCKETS) for n in NOT_ARTICLE} | {
    _bucket("." + w, PATH_BUCKETS) for names in FURNITURE.values() for n in names for w in _SPLIT.split(n)
    if w and w not in ("side", "site", "top", "bar", "box", "list", "form", "reader")}
_HOLDS = {_bucket("<article", PATH_BUCKETS), _bucket("<main", PATH_BUCKETS)}


def structural_labels(blocks: list[Block]) -> np.ndarray:
    """Labels of a sampled page by its own markup: in an article or main element, if it has one, and in no furniture."""
    noise = np.array([any(m in _NOISE for m in b.path) for b in blocks], bool)
    held = np.array([any(m in _HOLDS for m in b.path) for b in blocks], bool)
    return (~noise & (held if held.any() else True)).astype(np.float32)


def _wrap(tag: str, name: str, inner: str, rng: random.Random) -> str:
    if not tag:
        return inner
    given = f' {rng.choice(["class", "class", "id"])}="{name}"' if name else ""
    return f"<{tag}{given}>{inner}</{tag}>"


def compose(texts: list[str], rng: random.Random) -> tuple[str, list[bool]]:
    """A page of the given texts with furniture around and inside the article, and its blocks' labels."""
    labels: list[bool] = []

    def take(short=False):
        text = rng.choice(texts)
        words = text.split(" ")
        return html.escape(" ".join(words[:rng.randrange(1, 8)]) if short or rng.random() < 0.2 else text)

    def furniture():
        tag = rng.choice(["nav", "header", "footer", "aside", "form", "div", "div", "div", "div", "div", "div", "section", "ul", "ol", "p", "figure", "dialog", "button"])
        name, parts = rng.choice(FURNITURE[tag]), rng.randrange(1, 6)
        if tag in ("p", "button"):
            labels.append(False)
            return _wrap(tag, name, take(), rng)
        labels.extend([False] * parts)
        kind = rng.choice(["li", "p", "div", "link"]) if tag not in ("ul", "ol") else "li"
        inner = "".join(f'<div><a href="/{k}">{take(True)}</a></div>' if kind == "link" else f"<{kind}>{take(rng.random() < 0.5)}</{kind}>" for k in range(parts))
        if kind == "li" and tag not in ("ul", "ol"):
            inner = f"<ul>{inner}</ul>"
        if rng.random() < 0.3:
            inner = _wrap("div", rng.choice(["", "inner", "wrap", "container"]), inner, rng)
        return _wrap(tag, name, inner, rng)

    def paragraph():
        labels.append(True)
        kind = rng.choice(["p"] * 8 + ["h2", "h3", "blockquote", "pre", "li", "div"])
        text = take(kind in ("h2", "h3"))
        if kind == "p" and rng.random() < 0.15:
            return f"<p><b>{text}<br>"
        if rng.random() < 0.15:
            text = f'<a href="/x">{text}</a>'
        return f"<ul><li>{text}</li></ul>" if kind == "li" else f"<{kind}>{text}</{kind}>"

    out = []
    if rng.random() < 0.8:
        labels.append(False)
        out.append(f"<head><title>{take(True)}</title></head>")
    out.append("<body>")
    out += [furniture() for _ in range(rng.randrange(4))]
    inner = []
    if rng.random() < 0.7:
        labels.append(True)
        inner.append(f"<h1>{take(True)}</h1>")
    for _ in range(rng.randrange(1, 16)):
        if rng.random() < 0.12:
            inner.append(furniture())
        inner.append(paragraph())
    tag, name = rng.choice(ARTICLE)
    out.append(_wrap(tag, name, "".join(inner), rng) if tag != "td" else f"<table><tr><td>{''.join(inner)}</td></tr></table>")
    out += [furniture() for _ in range(rng.randrange(4))]
    return "<html>" + "".join(out) + "</body></html>", labels


def _pieces(page: Page, labels: np.ndarray) -> Iterator[tuple[Page, np.ndarray]]:
    for at in range(0, len(page.paths), TRAIN_BLOCKS):
        end = at + TRAIN_BLOCKS
        yield Page(page.paths[at:end], page.words[at:end], page.counts[at:end]), labels[at:end]


def train(pages: list[str]) -> Labeller:
    """A labeller fitted on the given pages and on pages composed from their blocks."""
    rng, examples, texts = random.Random(SEED), [], []
    for page in pages:
        blocks = blocks_of(page)
        if blocks:
            texts += [b.text for b in blocks]
            examples += _pieces(page_of(blocks), structural_labels(blocks))
    texts = texts or ["A few words", "and some more of them."]
    for _ in range(COMPOSED):
        page, labels = compose(texts, rng)
        blocks = blocks_of(page)
        if len(blocks) == len(labels):
            examples += _pieces(page_of(blocks), np.array(labels, np.float32))
    return Labeller().fit([p for p, _ in examples], [y for _, y in examples])


# --- the operator

_SCHEMA = "page_id bigint, url string, text string, n_chars bigint"


def _extract(sent):
    def run(batches):
        model = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                blocks = [blocks_of(h.as_py()) for h in part.column("html")]
                texts = ["\n\n".join(b.text for b, y in zip(own, kept) if y)
                         for own, kept in zip(blocks, model.label([page_of(b) for b in blocks]))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id").cast(pa.int64()), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def sample_of(pages: DataFrame) -> list[str]:
    """Html of at most SAMPLE_PAGES pages and SAMPLE_BYTES bytes, seeded by page_id."""
    rows = pages.where("html IS NOT NULL AND page_id IS NOT NULL").where(F.octet_length("html") <= SAMPLE_BYTES // 10)
    rows = rows.orderBy(F.xxhash64("page_id"), "page_id", "html").select("html").limit(SAMPLE_PAGES).toArrow().column("html")
    out, left = [], SAMPLE_BYTES
    for text in rows:
        left -= len(text.as_py())
        if left < 0:
            break
        out.append(text.as_py())
    return out


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page; one row per input row.

    text joins the blocks labelled as article, in page order, by an empty line;
    it is empty for null or empty html and for pages without article.  Repeated
    rows get equal texts.  An empty table gives no rows.  Only page_id, url and html are read.
    """
    sent = pages.sparkSession.sparkContext.broadcast(train(sample_of(pages)))  # about 300 kB, fixed by the layer sizes
    return pages.select("page_id", "url", "html").mapInArrow(_extract(sent), _SCHEMA)


def op7_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
