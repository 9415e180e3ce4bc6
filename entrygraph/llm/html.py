"""Main text of web pages, by a recurrent labeller of blocks.

A page is read into its leaf blocks: stretches of text between block tags, each
with the path of tags that holds it. A bidirectional LSTM in numpy reads, block
by block, a vector of the path (tags and the words of class, id and role,
hashed), one of the words (hashed) and a few measures, and judges each block
with the whole page in view. Blocks that it takes for the article are the text.

It is fitted on invented pages (``site.invented``), as no table labels blocks:
PAGES of them, drawn by a seed, whatever the size of the input. Pages of a batch
are labelled together, those of like length side by side; no block is left out.

Defined cases: a null or empty page has no text; scripts, styles, templates and
titles hold no blocks; markup that is cut short or not closed is read as far as
it goes, tags more than DEEP inside others as part of these; a line break is
white space of its block; repeated rows give repeated
results; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from entrygraph.llm import site
from entrygraph.llm.common import arrow_map, arrow_schema

SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long"
BLOCKS = "page_id long, position long, path string, text string, p_main double, kept boolean"
#: Invented pages that the model is fitted on, and how.
PAGES, EPOCHS, GROUP, SEED, RATE = 1500, 6, 24, 11, 0.008
#: Share of blocks whose words are hidden while fitting, so that the markup and the neighbours must do.
HIDDEN = 0.4
#: Sizes: hashed features of paths and of words, their vectors, and a direction's state.
PATHS, WORDS, PATH_SIZE, WORD_SIZE, STATE, MEASURES = 8192, 32768, 20, 8, 20, 10
KEEP_FROM = 0.5
#: Open tags of a path; those further in count as their parent's, as in browsers.
DEEP = 512
#: Pages that are labelled at once, and paths whose features a worker keeps.
TOGETHER, KNOWN_PATHS = 64, 50_000

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
SILENT = frozenset("script style template title".split())
#: What a start tag closes, if it is open inside the nearest of the tags that bound it.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
_NAMES = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Reader(HTMLParser):
    """The blocks of a page: (path, text, characters of it in links); a path is a tuple of (tag, names)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[tuple, str, int]] = []
        self.open: list[tuple[str, str]] = []
        self.parts: list[str] = []
        self.at: tuple = ()
        self.linked = self.links = self.silent = 0
        self.title: list[str] = []

    def cut(self) -> None:
        """End the block that is open."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((self.at, text, self.linked))
            self.parts, self.linked = [], 0

    def pop(self, to: int) -> None:
        for tag, _ in self.open[to:]:
            self.links -= tag == "a"
            self.silent -= tag in SILENT
        del self.open[to:]

    def within(self, tags: tuple, bounds: tuple) -> int | None:
        """The outermost open one of ``tags`` inside the nearest of ``bounds``."""
        found = None
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i][0]
            if tag in bounds:
                break
            if tag in tags:
                found = i
        return found

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            if self.parts:
                self.parts.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self.cut()
            return
        if tag not in INLINE and tag not in SILENT:
            self.cut()
            if tag == "body" and self.silent:
                self.pop(0)
            inside = self.within(*CLOSES[tag]) if tag in CLOSES else self.within(("p",), ("button", "td", "th", "table", "div", "li", "section", "article", "blockquote"))
            if inside is not None:
                self.pop(inside)
        names = " ".join([v for k, v in attrs if v and k in ("class", "id", "role", "itemprop", "aria-label")])
        if len(self.open) < DEEP or tag in SILENT:
            self.open.append((tag, names))
            self.links += tag == "a"
            self.silent += tag in SILENT

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        if tag not in INLINE and tag not in SILENT:
            self.cut()
        for i in range(len(self.open) - 1, -1, -1):
            held = self.open[i][0]
            if held == tag:
                # an inline tag that ends late does not close the blocks in it
                if tag in INLINE and any(t not in INLINE for t, _ in self.open[i + 1 :]):
                    self.links -= tag == "a"
                    del self.open[i]
                else:
                    self.pop(i)
                return

    def handle_data(self, data):
        if self.silent:
            if self.open and self.open[-1][0] == "title":
                self.title.append(data)
            return
        if not self.parts:
            if data.isspace():
                return
            self.at = tuple(self.open)
        self.parts.append(data)
        if self.links:
            self.linked += len(data)


def read(html: str | None) -> tuple[list[tuple[tuple, str, int]], str]:
    """(blocks, title) of a page."""
    reader = Reader()
    reader.feed(html or "")
    reader.close()
    reader.cut()
    return reader.blocks, " ".join("".join(reader.title).split())


def _hashed(kind: str, name: str, size: int) -> int:
    return zlib.crc32(f"{kind}:{name}".encode("utf-8", "replace")) % size


_paths: dict[tuple, np.ndarray] = {}


def path_features(path: tuple) -> np.ndarray:
    """The hashed features of a path, each once."""
    if (out := _paths.get(path)) is None:
        tags = [t for t, _ in path if t not in INLINE] or ["none"]
        found = {_hashed("t", t, PATHS) for t, _ in path} | {_hashed("e", tags[-1], PATHS), _hashed("f", ">".join(tags[-2:]), PATHS)}
        for tag, names in path:
            words = [w.lower() for w in _NAMES.findall(names)]
            found |= {_hashed("c", w, PATHS) for w in words if len(w) > 1}
        out = np.array(sorted(found), np.int64)
        if len(_paths) >= KNOWN_PATHS:
            _paths.clear()
        _paths[path] = out
    return out


@dataclass
class Page:
    """A page as the model reads it: features of blocks laid end to end, with where each block's begin."""

    paths: np.ndarray
    path_cuts: np.ndarray
    words: np.ndarray
    word_cuts: np.ndarray
    measures: np.ndarray

    def __len__(self) -> int:
        return len(self.measures)


def encoded(blocks: list[tuple[tuple, str, int]], title: str) -> Page:
    paths, words, measures = [], [], np.zeros((len(blocks), MEASURES), np.float32)
    for i, (path, text, linked) in enumerate(blocks):
        paths.append(path_features(path))
        listed = text.lower().split()
        words.append([zlib.crc32(w.encode("utf-8", "replace")) % WORDS for w in dict.fromkeys(listed)])
        n = len(text)
        ends = text[-1] in ".!?:;…\"'»”)"
        marks = sum(map(text.count, ",.;:!?"))
        digits = sum(map(str.isdigit, text)) if n < 200 else 0
        measures[i] = (
            np.log1p(len(listed)) / 4, len(listed) < 4, min(1.0, linked / n), ends, min(1.0, 10 * marks / n), digits / n,
            text[0].isupper(), len(path) / 10, bool(title) and (title.startswith(text) or text.startswith(title)), i / (1 + len(blocks)),
        )
    joined = lambda xs: np.concatenate([np.asarray(x, np.int64) for x in xs]) if xs else np.zeros(0, np.int64)
    cuts = lambda xs: np.cumsum([0, *map(len, xs)])[:-1]
    return Page(joined(paths), cuts(paths), joined(words), cuts(words), measures)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Embeddings, two LSTMs and a logistic output; ``w`` has all weights by name."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = PATH_SIZE + WORD_SIZE + MEASURES
        self.w = {"path": rng.normal(0, 0.1, (PATHS, PATH_SIZE)), "word": np.zeros((WORDS, WORD_SIZE)), "out": rng.normal(0, 0.2, 2 * STATE), "bias": np.zeros(1)}
        for side in "fb":
            self.w[side + "x"] = rng.normal(0, size**-0.5, (size, 4 * STATE))
            self.w[side + "h"] = rng.normal(0, STATE**-0.5, (STATE, 4 * STATE))
            start = np.zeros(4 * STATE)
            start[STATE : 2 * STATE] = 1
            self.w[side + "b"] = start

    def vectors(self, pages: list[Page]) -> np.ndarray:
        """One vector a block, of all pages end to end: the sum over its path, the mean over its distinct words, the measures."""
        out = []
        for p in pages:
            each = np.diff(np.append(p.word_cuts, len(p.words)))[:, None]
            out.append(np.hstack([np.add.reduceat(self.w["path"][p.paths], p.path_cuts), np.add.reduceat(self.w["word"][p.words], p.word_cuts) / each, p.measures]))
        return np.concatenate(out)

    def run(self, side: str, x: np.ndarray, live: np.ndarray, keep: bool):
        """States after each step of (steps, pages, features); where a page is over its state stays. ``keep``: what gradients need."""
        steps, pages, _ = x.shape
        gates = x @ self.w[side + "x"] + self.w[side + "b"]
        h = c = np.zeros((pages, STATE))
        states, kept = np.zeros((steps, pages, STATE)), []
        order = range(steps) if side == "f" else range(steps - 1, -1, -1)
        for t in order:
            g = gates[t] + h @ self.w[side + "h"]
            s = _sigmoid(g[:, : 3 * STATE])
            i, f, o = s[:, :STATE], s[:, STATE : 2 * STATE], s[:, 2 * STATE :]
            z = np.tanh(g[:, 3 * STATE :])
            fresh = f * c + i * z
            tc = np.tanh(fresh)
            m = live[t][:, None]
            if keep:
                kept.append((t, i, f, o, z, c, tc, h, m))
            h, c = np.where(m, o * tc, h), np.where(m, fresh, c)
            states[t] = h
        return states, kept

    def back(self, side: str, kept: list, into: np.ndarray, x: np.ndarray, grads: dict) -> np.ndarray:
        """Gradients of one direction from those of its states; gives those of ``x``."""
        dgates = np.zeros((*x.shape[:2], 4 * STATE))
        dh = dc = np.zeros(into.shape[1:])
        wh = self.w[side + "h"]
        for t, i, f, o, z, c, tc, h, m in reversed(kept):
            dh = dh + into[t]
            do, dcell = dh * tc * m, (dc + dh * o * (1 - tc * tc)) * m
            d = np.hstack([dcell * z * i * (1 - i), dcell * c * f * (1 - f), do * o * (1 - o), dcell * i * (1 - z * z)])
            dgates[t] = d
            grads[side + "h"] += h.T @ d
            dh, dc = np.where(m, d @ wh.T, dh), np.where(m, dcell * f, dc)
        flat = dgates.reshape(-1, 4 * STATE)
        grads[side + "x"] += x.reshape(len(flat), -1).T @ flat
        grads[side + "b"] += flat.sum(0)
        return dgates @ self.w[side + "x"].T

    def laid(self, pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(steps, pages, features) of the blocks, which of them there are, and their places in end-to-end order."""
        sizes = np.array([len(p) for p in pages])
        live = np.arange(sizes.max())[:, None] < sizes
        x = np.zeros((*live.shape, PATH_SIZE + WORD_SIZE + MEASURES))
        x.transpose(1, 0, 2)[live.T] = self.vectors(pages)
        return x, live, sizes

    def predict(self, pages: list[Page]) -> list[np.ndarray]:
        """The probability of each block to be of the article, for each page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted([k for k, p in enumerate(pages) if len(p)], key=lambda k: len(pages[k]))
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            x, live, _ = self.laid([pages[k] for k in some])
            states = np.concatenate([self.run(side, x, live, False)[0] for side in "fb"], 2)
            p = _sigmoid(states @ self.w["out"] + self.w["bias"])
            for j, k in enumerate(some):
                out[k] = p[: len(pages[k]), j]
        return out

    def gradients(self, pages: list[Page], labels: list[np.ndarray], shown: np.ndarray) -> tuple[dict, float]:
        """Gradients of the mean log loss of all blocks, and the loss; ``shown`` is 0 for blocks whose words are hidden."""
        x, live, sizes = self.laid(pages)
        words = slice(PATH_SIZE, PATH_SIZE + WORD_SIZE)
        x.transpose(1, 0, 2)[live.T, words] *= shown[:, None]
        runs = {side: self.run(side, x, live, True) for side in "fb"}
        states = np.concatenate([runs["f"][0], runs["b"][0]], 2)
        p = _sigmoid(states @ self.w["out"] + self.w["bias"])
        y = np.zeros(live.shape)
        y.T[live.T] = np.concatenate(labels)
        n = sizes.sum()
        d = (p - y) * live / n
        grads = {k: np.zeros_like(v) for k, v in self.w.items()}
        grads["out"], grads["bias"] = np.einsum("tpk,tp->k", states, d), np.array([d.sum()])
        into = d[:, :, None] * self.w["out"]
        dx = sum(self.back(side, runs[side][1], into[:, :, k * STATE : (k + 1) * STATE], x, grads) for k, side in enumerate("fb"))
        flat = dx.transpose(1, 0, 2)[live.T]
        flat[:, words] *= shown[:, None]
        at = 0
        for page in pages:
            mine = flat[at : at + len(page)]
            at += len(page)
            np.add.at(grads["path"], page.paths, np.repeat(mine[:, :PATH_SIZE], np.diff(np.append(page.path_cuts, len(page.paths))), 0))
            each = np.diff(np.append(page.word_cuts, len(page.words)))
            np.add.at(grads["word"], page.words, np.repeat(mine[:, words] / each[:, None], each, 0))
        chosen = np.where(y > 0, p, 1 - p)[live]
        return grads, float(-np.log(np.maximum(chosen, 1e-12)).mean())

    def fit(self, pages: list[Page], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED) -> list[float]:
        """Adam over groups of pages of like length; gives the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        slow, fast = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        order = sorted([k for k, p in enumerate(pages) if len(p)], key=lambda k: len(pages[k]))
        groups = [order[i : i + GROUP] for i in range(0, len(order), GROUP)]
        losses, step = [], 0
        for epoch in range(epochs):
            total = 0.0
            rate = RATE * (1 - epoch / epochs) + 0.0005
            for g in rng.permutation(len(groups)).tolist():
                some = [pages[k] for k in groups[g]]
                shown = (rng.random(sum(map(len, some))) >= HIDDEN).astype(float)
                grads, loss = self.gradients(some, [labels[k] for k in groups[g]], shown)
                total += loss
                step += 1
                for k, d in grads.items():
                    d = np.clip(d, -1, 1)
                    slow[k] += 0.1 * (d - slow[k])
                    fast[k] += 0.002 * (d * d - fast[k])
                    self.w[k] -= rate * (slow[k] / (1 - 0.9**step)) / (np.sqrt(fast[k] / (1 - 0.998**step)) + 1e-8)
            losses.append(total / len(groups))
        return losses


def labelled(html: str) -> tuple[Page, np.ndarray]:
    """An invented page and whether each of its blocks is of the article, by the marks in the texts."""
    blocks, title = read(html)
    labels = np.array([float(site.MAIN in text) for _, text, _ in blocks])
    bare = [(path, re.sub(f"[{site.MAIN}{site.REST}]", "", text) or "x", linked) for path, text, linked in blocks]
    return encoded(bare, title), labels


@lru_cache(4)
def fitted(pages: int = PAGES, seed: int = SEED) -> Labeller:
    """The model, fitted once a process on ``pages`` invented pages."""
    read_in = [labelled(html) for html in site.invented(pages, seed)]
    model = Labeller(seed)
    model.fit([p for p, _ in read_in], [y for _, y in read_in], seed=seed)
    return model


def _labeller(docs: DataFrame, model: Labeller | None):
    """The model's weights, as every task gets them: about a megabyte, whatever the input."""
    return docs.sparkSession.sparkContext.broadcast({k: v.astype(np.float32) for k, v in (model or fitted()).w.items()})


def _judged(weights: dict, htmls: list[str | None]) -> list[tuple[list, np.ndarray]]:
    model = Labeller.__new__(Labeller)
    model.w = weights
    found = [read(h) for h in htmls]
    return list(zip([b for b, _ in found], model.predict([encoded(b, t) for b, t in found])))


def main_text(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """SCHEMA for each row of ``pages`` (page_id, url, html)."""
    weights, schema = _labeller(pages, model), arrow_schema(SCHEMA)

    def run(batches):
        for batch in batches:
            rows = []
            for blocks, p in _judged(weights.value, batch.column(2).to_pylist()):
                kept = [blocks[i][1] for i in np.flatnonzero(p >= KEEP_FROM).tolist()]
                text = "\n".join(kept).encode("utf-8", "replace").decode()
                rows.append((text, len(text), len(blocks), len(kept)))
            if rows:
                columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), list(schema)[2:])]
                yield pa.record_batch([batch.column(0), batch.column(1), *columns], schema=schema)

    return arrow_map(pages.select("page_id", "url", "html"), run, SCHEMA)


def blocks_of(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """One row a block of each page, kept or not, with its path and the probability that it is of the article."""
    weights, schema = _labeller(pages, model), arrow_schema(BLOCKS)

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows = [
                (k, i, ">".join(t for t, _ in path), text.encode("utf-8", "replace").decode(), float(q), bool(q >= KEEP_FROM))
                for k, (blocks, p) in zip(keys, _judged(weights.value, batch.column(1).to_pylist()))
                for i, ((path, text, _), q) in enumerate(zip(blocks, p))
            ]
            if rows:
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return arrow_map(pages.select("page_id", "html"), run, BLOCKS)
