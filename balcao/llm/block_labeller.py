"""HTML extraction by a recurrent block labeller.

A page is a sequence of leaf blocks. A block is read as a vector of its hashed tag path and hashed words, of its own shape (length,
linked share, punctuation) and of its place among the prose of the page. A bidirectional LSTM in numpy runs over the sequence, so
every block is judged in the context of the whole page, and labels it as main text or not.

The labels to learn from are weak: on a bounded sample of the pages, the element that holds the page's prose is main text, less what
lies in parts of another kind inside it. Each sample page is also learned with made-up surroundings and with class words that
mean nothing, so that pages of other layouts are understood from their structure.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.llm.blocks import Block, Element, Kind, leaves

#: Bounds of the training sample: pages, and blocks of a window that may begin anywhere in a page. They bound the fit only.
MAX_TRAINING_PAGES = 240
WINDOW_BLOCKS = 120
PATH_BUCKETS, WORD_BUCKETS, HIDDEN = 512, 32, 16
SHAPE = 10
INPUTS = PATH_BUCKETS + WORD_BUCKETS + SHAPE
EPOCHS, RATE, BATCH = 8, 0.01, 16
#: Blocks of a batch of pages that are labelled at a time.
BATCH_BLOCKS = 20_000
#: A block of so many words, or one that ends as a sentence, is prose.
PROSE_WORDS = 8

# Element names and class words whose content is not main text, those of reader comments, and those that hold main text.
OTHER = frozenset(
    "nav header footer aside form menu sidebar navbar navigation breadcrumb breadcrumbs ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies "
    "consent notice alert popup modal overlay comment comments reply replies discussion respond share sharing social related recommended recommendations newsletter "
    "subscribe signup login search toolbar pagination pager copyright legal disclaimer widget masthead topbar skip button dialog".split()
)
COMMENTS = frozenset("comment comments reply replies discussion respond".split())
MAIN = frozenset("article main content post entry story articlebody".split())
MAIN_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
LINES = HEADINGS | frozenset("p blockquote pre li dd dt td th figcaption".split())


def prose(block: Block) -> float:
    """Characters of running text outside links."""
    text = block.text
    if text[-1] in ".!?…。！？\"'»”" or text.count(" ") >= PROSE_WORDS - 1:
        return len(text) * (1 - block.linked)
    return 0.0


def other_kind(e: Element) -> bool:
    return e.tag in OTHER or not OTHER.isdisjoint(e.kind.names)


def holder(page: Sequence[Block], weights: Sequence[float], stop_at_main: bool) -> tuple[Element, ...]:
    """Path of the innermost element that holds half of the weight of its parent's; outside an article or main element, if any."""
    inside = [k for k, w in enumerate(weights) if w > 0]
    path: list[Element] = []
    while inside:
        total = sum(weights[k] for k in inside)
        share: dict[Element, float] = {}
        for k in inside:
            if len(page[k].path) > len(path):
                e = page[k].path[len(path)]
                share[e] = share.get(e, 0.0) + weights[k]
        best = max(share, key=share.get, default=None)
        if best is None or share[best] < total / 2 or best.tag in LINES:
            break
        inside = [k for k in inside if len(page[k].path) > len(path) and page[k].path[len(path)] is best]
        path.append(best)
        if stop_at_main and (best.tag in MAIN_TAGS or not MAIN.isdisjoint(best.kind.names)):
            break
    return tuple(path)


def weak_labels(page: Sequence[Block]) -> np.ndarray:
    """1 for blocks of the element that holds the page's prose, except parts of another kind; 0 for all else.

    A word of the list on an element that wraps the article itself says nothing about the article.
    """
    weights = [prose(b) for b in page]
    total = sum(weights)
    held: dict[Element, float] = {}
    wraps: set[Element] = set()
    for b, w in zip(page, weights, strict=True):
        for e in b.path:
            held[e] = held.get(e, 0.0) + w
        for k, e in enumerate(b.path):
            if e.tag in MAIN_TAGS or e.tag == "h1" and e is b.path[-1]:
                wraps.update(b.path[: k + 1])
    def strange(e: Element) -> bool:
        if not other_kind(e):
            return False
        whole = e.tag in MAIN_TAGS or e.tag in ("html", "body") or held[e] >= total / 2 and COMMENTS.isdisjoint(e.kind.names)
        return not (e in wraps and whole)

    bad = np.array([any(map(strange, b.path)) for b in page], bool)
    # A page with one article or main element says itself where its text is.
    outer = {next((e for e in b.path if e.tag in MAIN_TAGS), None) for b, x in zip(page, bad, strict=True) if not x} - {None}
    if len(outer) == 1:
        return np.array([not x and not outer.isdisjoint(b.path) for b, x in zip(page, bad, strict=True)], np.float32)
    if not any(w and not x for w, x in zip(weights, bad, strict=True)):
        bad = np.array([any(e.tag in OTHER for e in b.path) for b in page], bool)
    path = holder(page, [0.0 if x else w for w, x in zip(weights, bad, strict=True)], True)
    depth = len(path)
    if depth and path[-1].tag not in ("html", "body"):
        inside = np.array([len(b.path) >= depth and b.path[depth - 1] is path[-1] for b in page], bool)
        first = int(inside.argmax()) if inside.any() else 0
        # A title stands before its text, in the element around both.
        title = [k < first and bool(b.path) and b.path[-1].tag in ("h1", "h2") and b.path[: depth - 1] == path[:-1] for k, b in enumerate(page)]
        return ((inside | np.array(title, bool)) & ~bad).astype(np.float32)
    line = np.array([bool(b.path) and b.path[-1].tag in LINES and b.linked < 0.5 and (w > 0 or b.path[-1].tag != "li") for b, w in zip(page, weights, strict=True)], bool)
    return (line & ~bad).astype(np.float32)


class _Hashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h


_HASHES = _Hashes()
_hash = _HASHES.__getitem__


@lru_cache(maxsize=20_000)
def _buckets(kind: Kind) -> np.ndarray:
    return np.unique([_hash(name) % PATH_BUCKETS for name in (kind.tag, *kind.names)])


def vectors(page: Sequence[Block]) -> np.ndarray:
    """Inputs (blocks, INPUTS) of a page: hashed path, hashed words, shape of the block, its place among the page's prose."""
    x = np.zeros((len(page), INPUTS), np.float32)
    if not len(page):
        return x
    weights = [prose(b) for b in page]
    total = sum(weights) or 1.0
    home = holder(page, weights, False)
    around: dict[Element, float] = {}
    for b, w in zip(page, weights, strict=True):
        if len(b.path) > 1:
            around[b.path[-2]] = around.get(b.path[-2], 0.0) + w
    for i, (b, w) in enumerate(zip(page, weights, strict=True)):
        words = b.text.split(" ")
        for e in b.path:
            x[i, _buckets(e.kind)] = 1
        hashed = np.fromiter(map(_hash, words), np.int64, len(words)) % WORD_BUCKETS
        x[i, PATH_BUCKETS : PATH_BUCKETS + WORD_BUCKETS] = np.bincount(hashed, minlength=WORD_BUCKETS) / len(words)
        last = b.path[-1].tag if b.path else ""
        common = 0
        for e, h in zip(b.path, home, strict=False):
            if e is not h:
                break
            common += 1
        x[i, -SHAPE:] = (
            np.log1p(len(words)) / 5, b.linked, 1, w > 0, min(1.0, b.text.count(",") / len(words) * 5), last in HEADINGS, last == "p",
            common / len(home) if home else 0, around.get(b.path[-2], 0.0) / total if len(b.path) > 1 else 0, bool(home) and common == len(home),
        )
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _run(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States (time, pages, HIDDEN) of one direction; ``keep`` also gives what going back needs."""
    t, b, _ = x.shape
    inputs = (x.reshape(t * b, -1) @ wx).reshape(t, b, -1)
    h, c = np.zeros((b, HIDDEN), np.float32), np.zeros((b, HIDDEN), np.float32)
    out, tape = np.zeros((t, b, HIDDEN), np.float32), []
    for s in range(t):
        z = inputs[s] + h @ wh
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN] + (k == 1)) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[s][:, None]
        new = f * c + i * g
        th = np.tanh(new)
        if keep:
            tape.append((h, c, i, f, o, g, th, m))
        c = np.where(m, new, c)
        h = np.where(m, o * th, h)
        out[s] = h
    return out, tape


def _back(x: np.ndarray, wh: np.ndarray, tape: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and state weights."""
    t, b, _ = x.shape
    dz = np.zeros((t, b, 4 * HIDDEN), np.float32)
    dwh = np.zeros_like(wh)
    dh, dc = np.zeros((b, HIDDEN), np.float32), np.zeros((b, HIDDEN), np.float32)
    for s in range(t - 1, -1, -1):
        h, c, i, f, o, g, th, m = tape[s]
        dh = dh + dout[s]
        inner = (dc + dh * o * (1 - th * th)) * m
        dz[s] = np.concatenate((inner * g * i * (1 - i), inner * c * f * (1 - f), dh * m * th * o * (1 - o), inner * i * (1 - g * g)), 1)
        dwh += h.T @ dz[s]
        dh = dz[s] @ wh.T + dh * ~m
        dc = inner * f + dc * ~m
    return x.reshape(t * b, -1).T @ dz.reshape(t * b, -1), dwh


class Labeller:
    """Two LSTMs, forwards and backwards, and a logistic output over both states and the block's own inputs."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def fresh(cls, seed: int = 11) -> Labeller:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(0, 0.1, shape)).astype(np.float32)
        return cls({
            "fx": draw(INPUTS, 4 * HIDDEN), "fh": draw(HIDDEN, 4 * HIDDEN), "bx": draw(INPUTS, 4 * HIDDEN), "bh": draw(HIDDEN, 4 * HIDDEN),
            "out": draw(2 * HIDDEN, 1), "own": np.zeros((INPUTS, 1), np.float32),
        })

    @staticmethod
    def pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        longest = max(map(len, pages))
        x, mask = np.zeros((longest, len(pages), INPUTS), np.float32), np.zeros((longest, len(pages)), bool)
        for k, p in enumerate(pages):
            x[: len(p), k], mask[: len(p), k] = p, True
        return x, mask

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        w = self.weights
        ahead, tape_a = _run(x, w["fx"], w["fh"], mask, keep)
        behind, tape_b = _run(x[::-1], w["bx"], w["bh"], mask[::-1], keep)
        states = np.concatenate((ahead, behind[::-1]), 2)
        z = (states @ w["out"] + x @ w["own"])[..., 0]
        return z, states, tape_a, tape_b

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text."""
        x, mask = self.pad(pages)
        z = self.logits(x, mask)[0]
        return [z[: len(p), k] > 0 for k, p in enumerate(pages)]

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], seed: int = 5) -> Labeller:
        """Adam on the logistic loss of all blocks."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        by_length = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        batches = [by_length[k : k + BATCH] for k in range(0, len(pages), BATCH)]
        for _ in range(EPOCHS):
            for k in rng.permutation(len(batches)):
                x, mask = self.pad([pages[p] for p in batches[k]])
                y = np.zeros(mask.shape, np.float32)
                for j, p in enumerate(batches[k]):
                    y[: len(labels[p]), j] = labels[p]
                z, states, tape_a, tape_b = self.logits(x, mask, True)
                dz = (((_sigmoid(z) - y) * mask) / mask.sum())[..., None].astype(np.float32)
                w = self.weights
                dstates = dz @ w["out"].T
                grads = {"out": states.reshape(-1, 2 * HIDDEN).T @ dz.reshape(-1, 1), "own": x.reshape(-1, INPUTS).T @ dz.reshape(-1, 1)}
                grads["fx"], grads["fh"] = _back(x, w["fh"], tape_a, dstates[..., :HIDDEN])
                grads["bx"], grads["bh"] = _back(x[::-1], w["bh"], tape_b, dstates[::-1, :, HIDDEN:])
                step += 1
                for name, g in grads.items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    w[name] = (w[name] - RATE * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return self


def surrounded(page: Sequence[Block], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The main text of the page under another holder, with parts of other kinds around and inside, and their labels.

    The parts say short things of the page's own words, or, under names that tell, whole paragraphs of it. Half of the pages have class words without
    meaning, where the parts keep to links and short lines; wrappers may bear words of the list.
    """
    other, plain = sorted(OTHER), rng.random() < 0.5
    texts = [" ".join(b.text.split(" ")[: rng.integers(1, 25)]) for b in page] or ["menu"]
    element = lambda tag, *names: Element(Kind(tag, names))
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 4)))
    root = [element("html"), element("body")]
    if rng.random() < 0.3:
        root.append(element("div", word() if plain else str(rng.choice(["wrapper", "page", "container", "site", str(rng.choice(other))]))))

    def made(n: int, base: list[Element]) -> list[Block]:
        name = str(rng.choice(other))
        tag = name if name in ("nav", "header", "footer", "aside", "form", "menu", "dialog", "button") and rng.random() < 0.6 else str(rng.choice(["div", "section", "ul", "aside"]))
        names = () if tag == name and rng.random() < 0.5 else (word() if plain else name,)
        around = [*base, element(tag, *names)]
        inner = [("ul", "li"), ("p",), ("div", "p"), ("li",), ("h3",), ("label",), ()][rng.integers(7)]
        long = not plain and rng.random() < (0.7 if name in COMMENTS else 0.4)
        if long and name in COMMENTS:
            n = int(rng.integers(3, 30))
            inner = [("div", "p"), ("p",), ("ul", "li"), ("ul", "li", "p")][rng.integers(4)]
        linked = 1.0 if rng.random() < (0.7 if not plain else 0.85) else 0.0
        said = lambda: str(page[rng.integers(len(page))].text if long and page else rng.choice(texts))
        return [Block(said() or "x", tuple([*around, *map(element, inner)]), 0.0 if long else linked) for _ in range(n)]

    names = (word(),) if plain else ("content",)
    holding = [
        [element("article")], [element("main")], [element("main"), element("article")], [element("div", *names)], [element("section", *names)],
        [element("div", word() if plain else "post")], [element("div", *names), element("div", word())], [],
    ][rng.integers(8)]
    apart = len(holding) > 1 and rng.random() < 0.5
    middle: list[Block] = []
    truth: list[int] = []
    for b in (b for b, y in zip(page, labels, strict=True) if y):
        tail = [b.path[-1].tag] if b.path and b.path[-1].tag in LINES and rng.random() < 0.8 else [("h2",), ("blockquote", "p"), ("ul", "li"), ("pre",), ("div", "p"), ("p",)][rng.integers(6)]
        if apart and not middle:
            # The title stands in the element around that of the text.
            middle.append(Block(b.text, tuple([*root, *holding[:-1], element(str(rng.choice(["h1", "h2"])))]), b.linked))
        else:
            middle.append(Block(b.text, tuple([*root, *holding, *map(element, tail if holding or tail[0] != "div" else tail[1:])]), b.linked))
        truth.append(1)
        if rng.random() < 0.12 and not plain:
            extra = made(int(rng.integers(1, 4)), [*root, *holding])
            middle += extra
            truth += [0] * len(extra)
    before = [x for _ in range(rng.integers(0, 4)) for x in made(int(rng.integers(1, 8)), root)]
    after = [x for _ in range(rng.integers(0, 5)) for x in made(int(rng.integers(1, 10)), root)]
    return before + middle + after, np.array([0] * len(before) + truth + [0] * len(after), np.float32)


def examples(page: str, seed: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """(inputs, labels) of windows of the page as it is and with made-up surroundings; the inputs know the whole page."""
    own = leaves(page)
    if not own:
        return []
    rng = np.random.default_rng([seed, zlib.crc32(page.encode("utf-8", "surrogatepass"))])
    labels = weak_labels(own)
    out = []
    for blocks, y in ((own, labels), surrounded(own, labels, rng), surrounded(own, labels, rng)):
        if blocks:
            at = int(rng.integers(max(1, len(blocks) - WINDOW_BLOCKS + 1)))
            out.append((vectors(blocks)[at : at + WINDOW_BLOCKS], y[at : at + WINDOW_BLOCKS]))
    return out


def train(found: Sequence[tuple[np.ndarray, np.ndarray]]) -> Labeller:
    return Labeller.fresh().train([x for x, _ in found], [y for _, y in found])


def fit(pages: DataFrame, max_pages: int = MAX_TRAINING_PAGES, html_col: str = "html") -> Labeller | None:
    """Train on at most ``max_pages`` distinct pages with the lowest hashes of their html; None where no page has a block.

    The windows are cut and turned to inputs in tasks, so only a bounded number of bounded windows reaches the driver,
    however long the pages are.
    """
    texts = pages.where(F.octet_length(html_col) > 0).select(F.col(html_col).alias("html"))
    # Hashes choose first, so that no page is sorted.
    chosen = texts.select(F.xxhash64("html").alias("h")).distinct().orderBy("h").limit(max_pages)
    rows = texts.withColumn("h", F.xxhash64("html")).join(F.broadcast(chosen), "h").groupBy("h").agg(F.min("html").alias("html"))

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for h, html in zip(batch["h"], batch["html"], strict=True):
                found = examples(html)
                yield pd.DataFrame({
                    "h": [h] * len(found), "n": range(len(found)), "at": [np.flatnonzero(x).astype(np.int32).tobytes() for x, _ in found],
                    "value": [x[x != 0].astype(np.float32).tobytes() for x, _ in found], "y": [y.astype(np.int8).tobytes() for _, y in found],
                })

    kept = sorted(rows.mapInPandas(windows, "h long, n int, at binary, value binary, y binary").collect(), key=lambda r: (r["h"], r["n"]))
    found = []
    for r in kept:
        y = np.frombuffer(r["y"], np.int8).astype(np.float32)
        x = np.zeros((len(y), INPUTS), np.float32)
        x.ravel()[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["value"], np.float32)
        found.append((x, y))
    return train(found) if found else None


def extract_batch(model: Labeller, pages: list[str]) -> list[str]:
    """Main text of each page; pages of like length are labelled side by side."""
    blocks = [leaves(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if blocks[k]), key=lambda k: len(blocks[k]))
    at = 0
    while at < len(order):
        end, longest = at, 0
        while end < len(order) and (end == at or max(longest, len(blocks[order[end]])) * (end - at + 1) <= BATCH_BLOCKS):
            longest = max(longest, len(blocks[order[end]]))
            end += 1
        group = order[at:end]
        for k, kept in zip(group, model.label([vectors(blocks[k]) for k in group]), strict=True):
            out[k] = "\n".join(b.text for b, use in zip(blocks[k], kept, strict=True) if use)
        at = end
    return out


def extract(pages: DataFrame, max_pages: int = MAX_TRAINING_PAGES, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` and ``text``, the main text of the whole html.

    Blocks are joined in page order by a newline. A null or empty html, and a page without main text, give the empty text.
    Repeated rows and null ids each get a row. An input column ``text`` is replaced; all others pass through. Pages of any
    length are read whole; an empty table gives an empty result. Only the bounded training sample is exchanged.
    """
    fitted = fit(pages, max_pages, html_col)
    if fitted is None:
        return pages.withColumn("text", F.lit(""))
    weights = fitted.weights

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Labeller(weights)
        for htmls in batches:
            rows = htmls.tolist()
            yield pd.Series([t for k in range(0, len(rows), 500) for t in extract_batch(model, rows[k : k + 500])], dtype="str")

    return pages.withColumn("text", run(F.coalesce(F.col(html_col), F.lit(""))))
