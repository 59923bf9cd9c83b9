"""Main text of web pages: a bidirectional LSTM in numpy labels every block of a page.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags,
character references decoded, white space collapsed. Each block is a vector of its tag
path (hashed tag names and the words of class, id and role of all open elements), its
hashed words, and its length, link share and punctuation. One LSTM reads the sequence
forwards, one backwards; from both states each block gets the probability that it is main
text, so that every decision sees the whole document. Blocks above one half are joined.

The network is trained here, in one task, on a bounded sample of the pages at hand
(``SAMPLE_PAGES``, first by hash of page_id): pages whose markup names its article teach
themselves, and their paragraphs are dealt anew into varied layouts (menus, headers,
notices, adverts, side columns, forms, reader comments, footers) whose labels are known.
Layouts and order come from a seed, so runs agree.

Results in special cases: null and empty pages have an empty text; unclosed and stray
tags are tolerated; scripts, styles, head, comments and markup never are text; pages are
read whole, in batches of bounded size, however long; equal pages get equal texts; with
no page to learn from, the layouts are filled with stand-in words; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that are learned from, and layouts dealt from their paragraphs.
SAMPLE_PAGES, LAYOUTS = 48, 900
EPOCHS, BATCH, RATE = 8, 32, 0.01
PATH, WORDS, SHAPE = 128, 32, 6
HIDDEN = 20
#: Pages labelled together have at most so many blocks in all, padding included (a longer page goes alone).
BLOCKS_AT_ONCE = 20_000

INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i img input ins kbd label mark q s samp small span strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "head", "select", "object", "math")
#: Elements whose start ends an open paragraph or item of the same kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|[^<]+|<", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")
_END_OF = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    links: int


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    links, in_link, at = 0, 0, 0

    def flush() -> None:
        nonlocal links
        words = "".join(text).split()
        if words:
            out.append(Block(tuple(x for _, names in stack for x in names), " ".join(words), links))
        text.clear()
        links = 0

    while m := _TOKEN.match(page, at):
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                piece = html.unescape(m[0])
                text.append(piece)
                links += len(piece) if in_link else 0
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                in_link = 0
            if tag in INLINE:
                continue
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in RAW and not m[3].endswith("/"):
            if tag not in ("noscript", "object", "svg", "math"):
                flush()
            end = _END_OF[tag].search(page, at)
            # an unclosed head ends where the body starts; others run to the end of the page
            body = re.compile(r"<body\b", re.I).search(page, at) if tag == "head" else None
            at = min([x for x in (end and end.end(), body and body.start()) if x is not None], default=len(page))
            continue
        if tag in INLINE:
            in_link = 1 if tag == "a" else in_link
            continue
        flush()
        if tag in VOID:
            continue
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == "p" or stack[i][0] in CLOSES.get(tag, ()):
                del stack[i:]
                break
            if stack[i][0] in ("ul", "ol", "table", "div", "article", "section", "td", "dl", "body"):
                break
        found = " ".join(x for g in _NAMES.findall(m[3]) for x in g).lower()
        stack.append((tag, (tag, *("." + x for x in _PARTS.findall(found)))))
    flush()
    return out


def _bucket(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % size


_PATHS: dict[tuple[str, ...], np.ndarray] = {}


def vectors(found: list[Block]) -> np.ndarray:
    """One row of features a block."""
    x = np.zeros((len(found), PATH + WORDS + SHAPE), np.float32)
    for k, b in enumerate(found):
        path = _PATHS.get(b.path)
        if path is None:
            if len(_PATHS) > 50_000:
                _PATHS.clear()
            path = np.zeros(PATH, np.float32)
            for t in b.path:
                path[_bucket(t, PATH)] = 1
            if b.path:
                path[_bucket("leaf " + b.path[-1], PATH)] = 1
            _PATHS[b.path] = path
        words = b.text.split(" ")
        counts = np.bincount([_bucket(w.lower(), WORDS) for w in words], minlength=WORDS)
        n = len(b.text)
        x[k, :PATH] = path
        x[k, PATH : PATH + WORDS] = np.log1p(counts) / (1 + np.log1p(len(words)))
        x[k, PATH + WORDS :] = (np.log1p(len(words)) / 6, b.links / n, sum(map(b.text.count, ".,;:!?")) / len(words), b.text[-1] in ".!?", k / len(found), 1 / (1 + k))
    return x


class Labeller:
    """Weights of the network: for each direction input, recurrent and bias, then the output layer."""

    def __init__(self, weights: list[np.ndarray]):
        self.weights = [w.astype(np.float32) for w in weights]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> "Labeller":
        size, out = PATH + WORDS + SHAPE, []
        for _ in range(2):
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember by default
            out += [rng.normal(0, 0.1, (size, 4 * HIDDEN)), rng.normal(0, 0.1, (HIDDEN, 4 * HIDDEN)), bias]
        return cls([*out, rng.normal(0, 0.1, 2 * HIDDEN), np.zeros(1)])

    def run(self, x: np.ndarray, mask: np.ndarray, learning: bool = False) -> tuple[np.ndarray, list]:
        """Probabilities of (pages, blocks) and what the backward pass needs. Padding stands at the end of a page."""
        pages, steps, _ = x.shape
        sides, kept = [], []
        for d in range(2):
            wx, wh, bias = self.weights[3 * d : 3 * d + 3]
            given = x.reshape(-1, x.shape[2]) @ wx + bias
            given = given.reshape(pages, steps, -1)
            h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
            hs, track = np.zeros((pages, steps, HIDDEN), np.float32), []
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                a = given[:, t] + h @ wh
                gate = 1 / (1 + np.exp(-np.clip(a[:, : 3 * HIDDEN], -30, 30)))
                i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
                g, on = np.tanh(a[:, 3 * HIDDEN :]), mask[:, t, None]
                new = f * c + i * g
                tanh = np.tanh(new)
                if learning:
                    track.append((t, h, c, i, f, o, g, tanh, on))
                c = np.where(on, new, c)
                h = np.where(on, o * tanh, h)
                hs[:, t] = h
            sides.append(hs)
            kept.append(track)
        both = np.concatenate(sides, axis=2)
        return 1 / (1 + np.exp(-np.clip(both @ self.weights[6] + self.weights[7][0], -30, 30))), [both, kept]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        p, (both, kept) = self.run(x, mask, True)
        p = np.clip(p, 1e-7, 1 - 1e-7)
        n = mask.sum()
        loss = -(np.where(y, np.log(p), np.log(1 - p)) * mask).sum() / n
        out = ((p - y) * mask / n).astype(np.float32)
        grads: list[np.ndarray] = []
        for d in range(2):
            wx, wh, bias = self.weights[3 * d : 3 * d + 3]
            own = out[:, :, None] * self.weights[6][d * HIDDEN : (d + 1) * HIDDEN]
            gx, gh = np.zeros_like(wx), np.zeros_like(wh)
            gb = np.zeros_like(bias)
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tanh, on in reversed(kept[d]):
                dh = dh + own[:, t]
                inner = dh * on
                through = dc * on + inner * o * (1 - tanh * tanh)
                da = np.concatenate([through * g * i * (1 - i), through * c * f * (1 - f), inner * tanh * o * (1 - o), through * i * (1 - g * g)], axis=1)
                gx += x[:, t].T @ da
                gh += h.T @ da
                gb += da.sum(0)
                dh = np.where(on, da @ wh.T, dh)
                dc = np.where(on, through * f, dc)
            grads += [gx, gh, gb]
        return loss, [*grads, (out[:, :, None] * both).sum((0, 1)), np.array([out.sum()])]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which of its blocks are main text. Pages of like length are run together."""
        out: list[np.ndarray] = [np.empty(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        while order:
            # from the longest down
            longest = len(pages[order[-1]])
            group = order[-max(1, BLOCKS_AT_ONCE // longest) :]
            del order[-len(group) :]
            x, mask = _padded([vectors(pages[k]) for k in group])
            p, _ = self.run(x, mask)
            for row, k in enumerate(group):
                out[k] = p[row, : len(pages[k])] > 0.5
        return out


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((len(rows), steps, rows[0].shape[1]), np.float32), np.zeros((len(rows), steps), bool)
    for k, r in enumerate(rows):
        x[k, : len(r)], mask[k, : len(r)] = r, True
    return x, mask


#: Element names and class words of the layouts that are dealt for training.
MAIN = ("article", "main", "div content", "div main", "div post", "div entry content", "section story", "div article body", "div text", "td main", "section", "div page content", "div")
OTHER = {
    "menu": ("nav", "ul menu", "div nav", "div navbar", "div navigation", "nav main nav", "div breadcrumb", "ol breadcrumbs", "div topbar", "div tabs", "div pagination", "div toc"),
    "header": ("header", "div header", "div masthead", "div banner", "header site header", "div logo", "div site title"),
    "notice": ("div cookie", "div cookie notice", "div consent", "div notice", "div alert", "section notice", "div gdpr", "div popup", "div modal", "p notice", "div message", "div disclaimer"),
    "advert": ("div ad", "div ads", "div advert", "div advertisement", "aside ad", "div sponsor", "div sponsored", "div promo", "section ad", "div banner ad"),
    "side": ("aside", "div sidebar", "aside sidebar", "div side", "div widget", "div related", "section related", "div recommended", "div popular", "ul links", "div tags", "div share", "div social", "div author bio"),
    "form": ("form", "form search", "form newsletter", "div form", "form subscribe", "div newsletter", "form login", "div search", "fieldset"),
    "comments": ("div comments", "section comments", "div comment list", "ol comments", "div reader comments", "section discussion", "div replies", "div comment", "div disqus"),
    "footer": ("footer", "div footer", "footer site footer", "div copyright", "div bottom", "div legal", "small copyright"),
}
SAID = {
    "menu": "Home About Contact News Blog Products Login Register Help".split(), "header": ["Site", "Welcome", "Daily", "Welcome to our site", "Subscribe"],
    "notice": ["This site uses cookies.", "We use cookies to improve your experience.", "Accept all", "Please enable JavaScript.", "Maintenance tonight."],
    "advert": ["Advertisement", "Sponsored", "Buy now and save!", "Special offer"], "side": ["Related articles", "Most read", "Share this", "Tags", "Popular posts"],
    "form": ["Search", "Your email", "Name", "Send", "Subscribe to our newsletter"], "comments": ["Comments", "3 comments", "Reply", "Posted by guest", "Great article!", "Leave a comment"],
    "footer": ["© 2024", "All rights reserved.", "Privacy policy", "Terms of use", "Imprint"],
}


def _deal(rng: np.random.Generator, paragraphs: list[str]) -> tuple[str, str]:
    """One page of a random layout, and a mark that its main blocks carry."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]

    def element(spec: str, inner: str) -> str:
        tag, *names = spec.split()
        kind = "id" if rng.random() < 0.2 else "class"
        extra = f' {kind}="{pick(("-", " ", "_")).join(names)}"' if names else ""
        return f"<{tag}{extra}>{inner}</{tag}>"

    def phrase(kind: str) -> str:
        words = pick(paragraphs).split()
        own = " ".join(words[: int(rng.integers(1, 25))])
        return pick(SAID[kind]) if rng.random() < 0.45 else own

    def part(kind: str) -> str:
        n = int(rng.integers(1, 9 if kind in ("menu", "side", "comments") else 4))
        long = kind in ("comments", "side", "notice") and rng.random() < 0.5
        rows = [pick(paragraphs) if long and rng.random() < 0.5 else phrase(kind) for _ in range(n)]
        if kind in ("menu", "side", "footer") and rng.random() < 0.7:
            rows = [f'<a href="/{k}">{r}</a>' for k, r in enumerate(rows)]
        if kind == "form":
            rows = [f"<label>{r}</label><input name=x>" if rng.random() < 0.5 else f"<button>{r}</button>" for r in rows]
        shape = rng.random()
        inner = "<ul>" + "".join(f"<li>{r}</li>" for r in rows) + "</ul>" if shape < 0.4 else "".join(f"<{'p' if shape < 0.75 else 'div'}>{r}</{'p' if shape < 0.75 else 'div'}>" for r in rows)
        if rng.random() < 0.25:
            inner = rows[0]
        return element(pick(OTHER[kind]), inner)

    def text() -> str:
        rows = []
        if rng.random() < 0.8:
            rows.append(f"<h{int(rng.integers(1, 3))}>\x01{' '.join(pick(paragraphs).split()[:10])}</h1>")
        for _ in range(int(rng.integers(1, 10))):
            p, kind = pick(paragraphs), rng.random()
            p = " ".join(p.split()[: int(rng.integers(1, 80))]) if rng.random() < 0.4 else p
            if kind < 0.7:
                rows.append(f"<p>\x01{p}</p>")
            elif kind < 0.78:
                rows.append(f"<p><b>\x01{p}<br>")
            elif kind < 0.84:
                rows.append(f"<h2>\x01{' '.join(p.split()[:6])}</h2>")
            elif kind < 0.9:
                rows.append("<ul>" + "".join(f"<li>\x01{' '.join(pick(paragraphs).split()[:8])}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.95:
                rows.append(f"<blockquote>\x01{p}</blockquote>")
            else:
                rows.append(f"<pre>\x01{p}</pre>")
            if rng.random() < 0.06:
                rows.append(part(pick(("advert", "side", "notice"))))
        return "".join(rows)

    spec = pick(MAIN)
    main = element(spec, text())
    if spec == "div" or rng.random() < 0.3:
        main = element(pick(("div wrapper", "div container", "div page", "div row", "main", "div col", "body")), main)
    before = [part(k) for k in ("menu", "header", "notice", "advert", "side", "form") if rng.random() < 0.35]
    after = [part(k) for k in ("side", "comments", "form", "advert", "notice", "footer", "menu") if rng.random() < 0.4]
    rng.shuffle(before)
    page = "".join(before) + main + "".join(after)
    return f"<html><head><title>x</title></head><body>{page}" + ("</body></html>" if rng.random() < 0.9 else ""), "\x01"


def _teach(path: tuple[str, ...]) -> bool | None:
    """Label of a block whose path names it, None if it does not."""
    bad = {"nav", "header", "footer", "aside", "form"} | {f".{w}" for kinds in OTHER.values() for spec in kinds for w in spec.split()[1:]} - {".main", ".list", ".bottom"}
    if bad & set(path):
        return False
    return True if {"article", "main"} & set(path) else None


def train(pages: list[str], seed: int = 11) -> Labeller:
    """Fit the network to the given pages, as far as their markup labels them, and to layouts of their paragraphs."""
    rng = np.random.Generator(np.random.PCG64(seed))
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    paragraphs = []
    for page in pages:
        found = blocks(page)
        told = [_teach(b.path) for b in found]
        paragraphs += [" ".join(b.text.split()[:150]) for b, t in zip(found, told) if t]
        known = any(told)  # of a page with an article, what lies outside is not main text
        if known:
            rows.append((vectors(found), np.array([bool(t) for t in told])))
    paragraphs = [html.escape(p.replace("\x01", "")) for p in paragraphs] or ["some words of a paragraph that stands in for others."]
    while len(rows) < LAYOUTS:
        page, mark = _deal(rng, paragraphs)
        found = blocks(page)
        y = np.array([mark in b.text for b in found])
        for b in found:
            b.text = b.text.replace(mark, "") or "-"
        rows.append((vectors(found), y))
    net = Labeller.fresh(rng)
    slow, fast = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        order = order[np.argsort([len(rows[k][0]) // 8 for k in order], kind="stable")]  # like lengths together
        starts = np.arange(0, len(order), BATCH)
        for s in rng.permutation(starts):
            batch = [rows[k] for k in order[s : s + BATCH]]
            x, mask = _padded([r[0] for r in batch])
            y = np.zeros(mask.shape, bool)
            for k, r in enumerate(batch):
                y[k, : len(r[1])] = r[1]
            _, grads = net.gradients(x, mask, y)
            step += 1
            rate = RATE * (1 if epoch < EPOCHS - 2 else 0.3)
            for k, g in enumerate(grads):
                g = np.clip(g, -1, 1)
                slow[k] = 0.9 * slow[k] + 0.1 * g
                fast[k] = 0.99 * fast[k] + 0.01 * g * g
                net.weights[k] = net.weights[k] - rate * (slow[k] / (1 - 0.9**step)) / (np.sqrt(fast[k] / (1 - 0.99**step)) + 1e-8)
    return net


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Labeller:
    """Train on a bounded sample of ``pages`` (page_id, html), in one task."""
    chosen = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample).select(F.col("page_id").alias("own_id"))
    rows = pages.select("page_id", "html").join(F.broadcast(chosen), F.col("page_id") == F.col("own_id")).select("page_id", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        found = sorted(((i, h or "") for b in batches for i, h in zip(b.column("page_id").to_pylist(), b.column("html").to_pylist())))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps([w.astype(np.float32) for w in train([h for _, h in found]).weights])])], names=["net"])

    import pickle

    nets = rows.repartition(1).mapInArrow(run, "net binary").collect()
    return Labeller(pickle.loads(nets[0]["net"])) if nets else train([])


def extract(pages: DataFrame, sample: int = SAMPLE_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    net = fit(pages, sample)
    pages = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                found = [blocks(h) for h in b.column("html").to_pylist()]
                texts = [" ".join([x.text for x, main in zip(page, kept) if main]) for page, kept in zip(found, net.label(found))]
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
