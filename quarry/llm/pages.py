"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks, each with the path of tags and class words above it, its words
and a few measures.  A bidirectional LSTM reads the whole sequence and says of every block
whether it belongs to the article.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.llm.common import ALNUM, lower_ascii, prefix_hashes, span_hashes, text_slices, without, word_hashes, word_spans

#: Hashed path tokens and words, their vectors' sizes, measures of a block, and cells in each direction.
PATHS, WORDS, PATH_DIM, WORD_DIM, MEASURES, CELLS = 1024, 1024, 16, 8, 7, 16

# Fixed values of HTML: elements that start a block, that hold no text, whose content is no markup, that are never text, and that close themselves.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
                   "select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
HIDDEN = frozenset("svg math template noscript iframe object canvas".split())
CLOSED_BY_LIKE = frozenset("li dt dd tr td th option p".split())

# Fixed words of class names and ids, for training pages.
CONTENT_NAMES = ("content", "article", "post", "entry", "story", "body", "text", "main", "page", "blog", "detail", "prose")
BOILER_NAMES = {
    "nav": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topnav", "links", "tabs", "pagination", "skip"),
    "header": ("header", "masthead", "banner", "topbar", "logo", "brand", "hero"),
    "footer": ("footer", "copyright", "legal", "bottom", "colophon", "imprint"),
    "aside": ("sidebar", "aside", "widget", "related", "recommended", "trending", "popular", "rail", "more"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor", "adsense", "teaser", "banner"),
    "notice": ("cookie", "cookies", "consent", "notice", "gdpr", "popup", "modal", "overlay", "alert", "privacy", "toast"),
    "form": ("form", "search", "login", "signup", "subscribe", "newsletter", "register", "contact"),
    "comment": ("comment", "comments", "reply", "replies", "discussion", "disqus", "respond", "reader", "responses"),
    "share": ("share", "social", "sharing", "tags", "meta", "byline", "follow"),
}

_COMMENT = r"<!--.*?(?:-->|\Z)"
_ATTRIBUTES = r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*)>"
_TOKEN = re.compile(rf"{_COMMENT}|<(/?)([a-z][^\s/>]*){_ATTRIBUTES}|<[!?/][^>]*>", re.S | re.I)
_HIDES = re.compile(rf"{_COMMENT}|<(/?)({'|'.join(sorted(HIDDEN | {'script', 'style', 'textarea'}))})(?=[\s/>]){_ATTRIBUTES}", re.S | re.I)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Leaf:
    path: tuple[str, ...]
    text: str
    linked: int


def _after_raw(html: str, name: str, at: int, closed: bool) -> int:
    """End of an element whose text is no markup.  Without an end tag it takes the rest, or, written as closed, nothing."""
    end = _END[name].search(html, at)
    return end.end() if end else at if closed else len(html)


def _hidden_ends(html: str) -> dict[int, int]:
    """Start of the hidden elements that have an end tag of their own, and where they end."""
    opened: dict[str, list[int]] = {name: [] for name in HIDDEN}
    ends, at = {}, 0
    while m := _HIDES.search(html, at):
        at, name = m.end(), (m[2] or "").lower()
        closed = m[3] is not None and m[3].endswith("/")
        if name in HIDDEN:
            if not m[1]:
                if not (closed and name in ("svg", "math")):
                    opened[name].append(m.start())
            elif opened[name]:
                ends[opened[name].pop()] = at
        elif name and not m[1] and not (closed and (opened["svg"] or opened["math"])):
            at = _after_raw(html, name, at, closed)
    return ends


def leaves(html: str | None) -> list[Leaf]:
    """Leaf blocks in page order.  Character references are decoded and white space is one space.  A hidden
    element without an end tag is only a tag; head is none, its elements hold no text."""
    found: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    state = {"path": None, "linked": 0, "links": 0}

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            found.append(Leaf(state["path"] or (), text, state["linked"]))
        parts.clear()
        state["path"], state["linked"] = None, 0

    def data(text: str) -> None:
        if text:
            if state["path"] is None and not text.isspace():
                state["path"] = tuple(x for _, names in stack for x in names)
            parts.append(text)
            if state["links"]:
                state["linked"] += len(text)

    def pop(at: int) -> None:
        for name, _ in stack[at:]:
            state["links"] -= name == "a"
        del stack[at:]

    html, at, hidden = html or "", 0, None
    while m := _TOKEN.search(html, at):
        data(html[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name or name == "head":
            continue
        closing, attributes = m[1], m[3]
        if name in RAW and not closing:
            at = _after_raw(html, name, at, attributes.endswith("/"))
            continue
        if name in HIDDEN:
            if not closing:
                hidden = _hidden_ends(html) if hidden is None else hidden
                at = hidden.get(m.start(), at)
            continue
        if name in BLOCKS:
            flush()
        elif name == "br":
            data(" ")
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop(k)
                    break
            continue
        if name in BLOCKS:
            # A block ends an open paragraph; an item ends the open item beside it.
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or stack[k][0] == name and name in CLOSED_BY_LIKE:
                    pop(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if name in VOID or attributes.endswith("/"):
            continue
        words = [p.lower() for a in _NAMES.finditer(attributes) for p in _PART.findall(a[1] or a[2] or a[3] or "")]
        stack.append((name, (f"<{name}", *words)))
        state["links"] += name == "a"
    data(html[at:])
    flush()
    return found


@dataclass
class Labeller:
    paths: np.ndarray
    words: np.ndarray
    inputs: list[np.ndarray]     # by direction: (input + 1, 4 * CELLS)
    states: list[np.ndarray]     # by direction: (CELLS, 4 * CELLS)
    out: np.ndarray              # (2 * CELLS + 1,)
    cache: dict = field(default_factory=dict)

    def parameters(self) -> list[np.ndarray]:
        return [self.paths, self.words, *self.inputs, *self.states, self.out]


def _path_slots(path: tuple[str, ...]) -> np.ndarray:
    """Buckets of a block's path: every token, and the innermost tag on its own."""
    tags = [x for x in path if x.startswith("<")]
    return np.unique((word_hashes([*path, "last" + (tags[-1] if tags else "")]) % np.uint64(PATHS)).astype(np.int64))


def _words_of(blocks: list[Leaf]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, bucket) of every word, and the words of each block."""
    batch = pa.RecordBatch.from_arrays([pa.array([b.text for b in blocks], pa.large_string())], ["t"])
    blocks_of, buckets, at = [], [], 0
    for rows, raw, offsets in text_slices(batch, "t"):
        low = lower_ascii(raw)
        starts, ends, first = word_spans(ALNUM[low], offsets)
        blocks_of.append(at + np.repeat(np.arange(rows.num_rows), np.diff(first)))
        buckets.append((span_hashes(prefix_hashes(low), starts, ends) % np.uint64(WORDS)).astype(np.int64))
        at += rows.num_rows
    block, bucket = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (blocks_of, buckets))
    return block, bucket, np.bincount(block, minlength=len(blocks))


def _measures(blocks: list[Leaf], n_words: np.ndarray, first: np.ndarray) -> np.ndarray:
    size = np.array([len(b.text) for b in blocks], float)
    linked = np.array([min(1.0, b.linked / len(b.text)) for b in blocks])
    stop = np.array([b.text[-1] in ".!?…\"'" for b in blocks], float)
    commas = np.array([b.text.count(",") + b.text.count(". ") for b in blocks], float)
    depth = np.array([len(b.path) for b in blocks], float)
    place = np.concatenate([np.linspace(0, 1, n) for n in np.diff(first)]) if len(first) > 1 else np.zeros(0)
    return np.stack([np.log1p(size) / 6, linked, np.log1p(n_words) / 4, stop, np.minimum(commas / np.maximum(n_words, 1) * 8, 2), depth / 8, place], 1)


def _inputs(model: Labeller, blocks: list[Leaf], first: np.ndarray) -> np.ndarray:
    block, bucket, n_words = _words_of(blocks)
    vectors = np.empty((len(blocks), WORD_DIM))
    for j in range(WORD_DIM):
        vectors[:, j] = np.bincount(block, weights=model.words[bucket, j], minlength=len(blocks)) / np.maximum(n_words, 1)
    distinct = {b.path for b in blocks}
    if len(model.cache) > 100_000:
        model.cache.clear()
    for path in distinct - model.cache.keys():
        model.cache[path] = model.paths[_path_slots(path)].sum(axis=0)
    paths = np.array([model.cache[b.path] for b in blocks]).reshape(-1, PATH_DIM)
    return np.concatenate([paths, vectors, _measures(blocks, n_words, first), np.ones((len(blocks), 1))], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _lstm(z: np.ndarray, rows: list[np.ndarray], u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of all blocks.  ``rows``: for each step the blocks read, those of longer pages first."""
    out = np.zeros((len(z), CELLS))
    h = np.zeros((len(rows[0]), CELLS)) if rows else np.zeros((0, CELLS))
    c = h.copy()
    for at in rows:
        k = len(at)
        before_h, before_c = h[:k].copy(), c[:k].copy()
        a = z[at] + before_h @ u
        i, f, o = (_sigmoid(a[:, n * CELLS:(n + 1) * CELLS]) for n in range(3))
        g = np.tanh(a[:, 3 * CELLS:])
        c[:k] = f * before_c + i * g
        t = np.tanh(c[:k])
        h[:k] = o * t
        out[at] = h[:k]
        if keep is not None:
            keep.append((at, before_h, before_c, i, f, o, g, t))
    return out


def _lstm_back(slope: np.ndarray, keep: list, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the inputs' projections and of the state weights, from the slopes of the states."""
    dz, du = np.zeros((len(slope), 4 * CELLS)), np.zeros_like(u)
    widest = len(keep[0][0]) if keep else 0
    dh, dc = np.zeros((widest, CELLS)), np.zeros((widest, CELLS))
    for at, before_h, before_c, i, f, o, g, t in reversed(keep):
        k = len(at)
        h = dh[:k] + slope[at]
        c = dc[:k] + h * o * (1 - t * t)
        a = np.concatenate([c * g * i * (1 - i), c * before_c * f * (1 - f), h * t * o * (1 - o), c * i * (1 - g * g)], 1)
        dz[at] = a
        du += before_h.T @ a
        dh[:k], dc[:k] = a @ u.T, c * f
    return dz, du


def _steps(first: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size[0]) if len(size) else 0)]
    return [begin[:k] + t for t, k in enumerate(live)], [begin[:k] + size[:k] - 1 - t for t, k in enumerate(live)]


def label_blocks(model: Labeller, blocks: list[Leaf], first: np.ndarray) -> np.ndarray:
    """Probability of every block to be the article's.  ``first``: each page's first block, n + 1."""
    if not blocks:
        return np.zeros(0)
    x = _inputs(model, blocks, first)
    states = [_lstm(x @ w, rows, u) for w, u, rows in zip(model.inputs, model.states, _steps(first), strict=True)]
    return _sigmoid(np.concatenate([*states, np.ones((len(x), 1))], 1) @ model.out)


def taught(blocks: list[Leaf]) -> list[int] | None:
    """Labels of a page whose tags name its article, else None: blocks below article or main, but not
    below an element whose tag or names say that it is something else."""
    other = {n for names in BOILER_NAMES.values() for n in names} - {"text", "more", "bottom", "meta", "links"}
    other |= {f"<{t}" for t in ("nav", "footer", "aside", "form", "button", "select", "label")}
    labels, named = [], False
    for b in blocks:
        at = next((k for k, x in enumerate(b.path) if x in ("<article", "<main")), None)
        named |= at is not None
        labels.append(int(at is not None and not other & set(b.path[:at] + tuple(x for x in b.path[at:]))))
    return labels if named and any(labels) else None


def made_page(rng: np.random.Generator, texts: list[str], short: list[str]) -> tuple[list[Leaf], list[int]]:
    """A training page: given texts set in a random layout, with the labels of its blocks."""
    pick = lambda items: items[int(rng.integers(len(items)))]
    base = ("<html", "<body") + (("<div", pick(("wrapper", "container", "site", "page", "app", "layout"))) if rng.random() < .5 else ())
    blocks: list[Leaf] = []
    labels: list[int] = []

    def put(path, text, label, linked=0.0):
        blocks.append(Leaf(base + tuple(path), text, int(linked * len(text))))
        labels.append(label)

    def boiler(kind):
        names = BOILER_NAMES[kind]
        tag = {"nav": "<nav", "header": "<header", "footer": "<footer", "aside": "<aside", "form": "<form"}.get(kind)
        own = (tag,) if tag and rng.random() < .6 else (pick(("<div", "<section")), pick(names))
        if rng.random() < .3:
            own += (pick(names),)
        n = int(rng.integers(1, 9 if kind in ("nav", "comment", "aside", "footer") else 4))
        for _ in range(n):
            if kind in ("nav", "share") or kind in ("aside", "footer", "header") and rng.random() < .5:
                put((*own, "<ul", "<li", "<a"), pick(short), 0, 1.0)
            elif kind == "comment":
                put((*own, pick(("<div", "<li", "<article")), pick(names), *(("<p",) if rng.random() < .7 else ())), pick(texts), 0)
            elif kind == "form":
                put((*own, pick(("<label", "<button", "<div", "<p"))), pick(short), 0)
            else:
                put((*own, *((pick(("<p", "<div", "<span", "<h3")),) if rng.random() < .6 else ())), pick(texts if rng.random() < .5 else short), 0)

    for kind in ("header", "nav", "notice", "ad", "form"):
        if rng.random() < .5:
            boiler(kind)
    style = rng.random()
    main = ("<article",) if style < .3 else ("<main",) if style < .45 else (pick(("<div", "<section", "<td")), pick(CONTENT_NAMES))
    if rng.random() < .4:
        main += ("<div", pick(CONTENT_NAMES), pick(CONTENT_NAMES))
    if rng.random() < .8:
        put((*main, *(("<header",) if rng.random() < .15 else ()), pick(("<h1", "<h1", "<h2"))), pick(short if rng.random() < .6 else texts), 1)
    for _ in range(int(rng.integers(1, 14))):
        kind = rng.random()
        tail = ("<p",) if kind < .7 else ("<ul", "<li") if kind < .78 else ("<blockquote", "<p") if kind < .83 else (pick(("<h2", "<h3")),) if kind < .9 else ("<div",) if kind < .95 else ("<pre",)
        put((*main, *tail, *(("<b",) if rng.random() < .1 else ())), pick(texts if tail[0][1] != "h" and rng.random() < .85 else short), 1, .2 * (rng.random() < .2))
        if rng.random() < .06:
            boiler(pick(("ad", "share", "aside")))
    for kind in ("share", "comment", "aside", "ad", "form", "notice", "footer"):
        if rng.random() < .45:
            boiler(kind)
    return blocks, labels


def train(pages: list[str], made: int = 700, epochs: int = 8, batch: int = 40, rate: float = 0.01, seed: int = 5) -> Labeller:
    """A labeller learnt from pages whose tags name their article, and from as many layouts made of their texts."""
    rng = np.random.default_rng(seed)
    scale = lambda *shape: rng.normal(0, 0.3 / np.sqrt(shape[0]), shape)
    size = PATH_DIM + WORD_DIM + MEASURES + 1
    model = Labeller(rng.normal(0, 0.05, (PATHS, PATH_DIM)), np.zeros((WORDS, WORD_DIM)), [scale(size, 4 * CELLS) for _ in range(2)],
                     [scale(CELLS, 4 * CELLS) for _ in range(2)], scale(2 * CELLS + 1))
    parsed = [p for p in map(leaves, pages) if p]
    if not parsed:
        return model
    every = [b.text for p in parsed for b in p]
    texts = [t for t in every if len(t) >= 60] or every
    short = [t for t in every if len(t) < 60] or every
    data = [(p, y) for p in parsed if (y := taught(p))]
    data += [made_page(rng, texts, short) for _ in range(made)]
    moment = [np.zeros_like(p) for p in model.parameters()]
    square = [np.zeros_like(p) for p in model.parameters()]
    step = 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(data)), max(1, len(data) // batch)):
            blocks = [b for k in at for b in data[k][0]]
            label = np.array([y for k in at for y in data[k][1]], float)
            first = np.concatenate([[0], np.cumsum([len(data[k][0]) for k in at])])
            model.cache.clear()
            x = _inputs(model, blocks, first)
            # Unknown names must not matter: now and then a path's vector is left out.
            shown = rng.random(len(blocks)) > 0.05
            x[~shown, :PATH_DIM] = 0
            kept: list[list] = [[], []]
            ways = _steps(first)
            states = np.concatenate([*[_lstm(x @ model.inputs[d], ways[d], model.states[d], kept[d]) for d in range(2)], np.ones((len(x), 1))], 1)
            slope = (_sigmoid(states @ model.out) - label) / len(label)
            ds = np.outer(slope, model.out)
            grads = [np.zeros_like(model.paths), np.zeros_like(model.words)]
            back = [_lstm_back(ds[:, d * CELLS:(d + 1) * CELLS], kept[d], model.states[d]) for d in range(2)]
            dx = sum(dz @ model.inputs[d].T for d, (dz, _) in enumerate(back))
            slots = [_path_slots(b.path) for b in blocks]
            owner = np.repeat(np.arange(len(blocks)), [len(s) for s in slots])
            np.add.at(grads[0], np.concatenate(slots), (dx[:, :PATH_DIM] * shown[:, None])[owner])
            block, bucket, n_words = _words_of(blocks)
            np.add.at(grads[1], bucket, (dx[:, PATH_DIM:PATH_DIM + WORD_DIM] / np.maximum(n_words, 1)[:, None])[block])
            grads += [x.T @ dz for dz, _ in back] + [du for _, du in back] + [states.T @ slope]
            step += 1
            for p, g, m, s in zip(model.parameters(), grads, moment, square, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    model.cache.clear()
    return model


def _extract(batches: Iterator[pa.RecordBatch], model: Labeller, html: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, _, _ in text_slices(batch, html):
            parsed = [leaves(x) for x in rows.column(html).to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(p) for p in parsed])]).astype(np.int64)
            blocks = [b for p in parsed for b in p]
            chosen = label_blocks(model, blocks, first) >= 0.5
            text = ["\n".join(b.text for b, y in zip(p, chosen[a:], strict=False) if y) for p, a in zip(parsed, first.tolist(), strict=False)]
            put = {"text": text, "n_chars": [len(t) for t in text]}
            yield pa.RecordBatch.from_arrays([pa.array(put[f.name], f.type) if f.name in put else rows.column(f.name).cast(f.type) for f in schema], schema=schema)


def learn(pages: DataFrame, html: str = "html", key: str = "page_id", most_rows: int = 250, most_chars: int = 60_000) -> Labeller:
    """A labeller learnt from a bounded sample: the ``most_rows`` distinct pages of at most ``most_chars`` that
    come first by a hash of their key.  Only hashes are ranked; then the chosen pages alone are fetched."""
    rows = pages.filter(F.length(html) <= most_chars).select(F.col(html).alias("h"), F.xxhash64(key).alias("o"), F.xxhash64(html).alias("p"))
    first = rows.select("o", "p").distinct().orderBy("o", "p").limit(most_rows).collect()
    chosen = {(r["o"], r["p"]) for r in first}
    got = rows.filter(F.col("o").isin([r["o"] for r in first]) & F.col("p").isin([r["p"] for r in first])).dropDuplicates(["o", "p"]).collect()
    return train([r["h"] for r in sorted(got, key=lambda r: (r["o"], r["p"])) if (r["o"], r["p"]) in chosen])


def extract_main_text(pages: DataFrame, model: Labeller, html: str = "html") -> DataFrame:
    """``pages`` without html, with text (the article's blocks in page order, joined by a line feed) and
    n_chars (its code points).

    Every block of a page is read and labelled with the whole page as context; nothing is capped.
    A null or empty page, or one without article blocks, has empty text.  Broken markup is read as
    far as it goes: an open element ends with its parent or the page, and hides nothing unless it is a
    comment, script, style, title or textarea.  Input columns named like the output
    columns are replaced, others pass through; equal pages give equal texts.
    """
    pages = without(pages, "text", "n_chars")
    out = pages.drop(html).select("*", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema])
    arrow = to_arrow_schema(schema)
    sent = pages.sparkSession.sparkContext.broadcast(model)
    return pages.mapInArrow(lambda b: _extract(b, sent.value, html, arrow), schema)
