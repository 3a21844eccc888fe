"""HTML extraction: a recurrent block labeller in numpy.

A page becomes its sequence of leaf blocks. Each block has a vector of hashed tag-path elements
(tags, and words of class, id and role), hashed words and a few shape measures; a bidirectional
LSTM reads the sequence in both directions, so every block is labelled knowing the whole page.
Blocks labelled as main text are joined in page order.

The labeller is trained when the query is built, on `TRAIN_PAGES` generated pages (`_page`) whose
blocks are labelled by construction: articles in many kinds of containers among menus, headers,
footers, sidebars, notices, adverts, forms and reader comments, with meaningless words, so it
learns structure rather than vocabulary. The set, the seed and so the weights are fixed; they are
small (under 100 kB) and travel with the map over the pages, which shuffles nothing.
"""

from __future__ import annotations

import functools
import math
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.html_blocks import WORD, Block, Element, blocks
from corvane.sources.tables import table

DIGIT = re.compile(r"[0-9]")
PATH_CELLS, WORD_CELLS, SHAPES = 128, 32, 6
INPUTS = PATH_CELLS + WORD_CELLS + SHAPES
HIDDEN = 20
TRAIN_PAGES, EPOCHS, BATCH = 900, 14, 32
#: Blocks whose vectors and hidden states exist at a time.
BATCH_BLOCKS = 20_000


# --- features ---------------------------------------------------------------------------------


@functools.lru_cache(maxsize=100_000)
def _cell(name: str) -> int:
    """The bit of a name; names that no training page can teach anything about have none."""
    return 1 << zlib.crc32(name.encode("utf-8", "replace")) % PATH_CELLS if name.removeprefix("in:") in _told() else 0


@functools.cache
def _told() -> frozenset[str]:
    names = " ".join(" ".join(x) for x in (CONTENT, SIDE, ADS, NOTICES, COMMENTS, MENUS, HEADS, FEET))
    return frozenset(WORD.findall(names)) | TAGS


@functools.lru_cache(maxsize=100_000)
def _places(mask: int) -> np.ndarray:
    return np.array([k for k in range(PATH_CELLS) if mask >> k & 1], np.int64)


def path_mask(path: Element | None) -> int:
    """Bits of the names of all elements of a path, each element adding its own to its parent's."""
    fresh = []
    while path is not None and path.mask is None:
        fresh.append(path)
        path = path.parent
    mask = 0 if path is None else path.mask
    for part in reversed(fresh):
        for name in part.names:
            mask |= _cell(name)
        part.mask = mask
    return mask


def _path_cells(path: Element | None) -> np.ndarray:
    """Every element of the path, and once more the innermost two apart."""
    mask = path_mask(path)
    for part in (path, path and path.parent):
        for name in part.names if part is not None else ():
            mask |= _cell(f"in:{name}")
    return _places(mask)


class _WordCells(dict):
    """word -> its cell, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "replace")) % WORD_CELLS
        return value


_word_cell = _WordCells().__getitem__


def vectors(page: list[Block], start: int = 0, stop: int | None = None) -> np.ndarray:
    """One row per block of the page's blocks [start, stop)."""
    stop = len(page) if stop is None else min(stop, len(page))
    out = np.zeros((max(0, stop - start), INPUTS), np.float32)
    for k in range(start, stop):
        block, row = page[k], out[k - start]
        row[_path_cells(block.path)] = 1.0
        words = block.text.lower().split()
        cells = np.fromiter(map(_word_cell, words), np.int64, len(words))
        row[PATH_CELLS : PATH_CELLS + WORD_CELLS] = np.bincount(cells, minlength=WORD_CELLS) / (4.0 * max(1, len(words)))
        n = len(block.text)
        row[-SHAPES:] = (
            min(8.0, math.log1p(len(words))) / 4,
            min(1.0, block.linked / n),
            float(block.text[-1] in ".!?…:;\"'”)"),
            min(1.0, len(DIGIT.findall(block.text)) / n),
            k / max(1, len(page) - 1),
            1.0,
        )
    return out


# --- the network ------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def init(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {}
    for way in ("f", "b"):
        model[f"{way}x"] = rng.normal(0, 0.15, (INPUTS, 4 * HIDDEN))
        model[f"{way}h"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
        model[f"{way}0"] = np.concatenate((np.ones(HIDDEN), np.zeros(3 * HIDDEN)))  # forget, in, out, new
    model["out"] = rng.normal(0, 0.15, 2 * HIDDEN)
    model["out0"] = np.zeros(1)
    return model


def _run(x: np.ndarray, mask: np.ndarray, model: dict[str, np.ndarray], way: str, keep: list | None = None, state: list | None = None) -> np.ndarray:
    """Hidden states (time, page, HIDDEN) of one direction; x and mask already turned for 'b'.

    Padding leaves the state as it is. keep collects what the backward pass needs. state, if given,
    holds [hidden, cell] to go on from, or nothing, and is left with those at the end.
    """
    steps, pages = x.shape[:2]
    ahead = x @ model[f"{way}x"] + model[f"{way}0"]
    h, c = state or (np.zeros((pages, HIDDEN), x.dtype), np.zeros((pages, HIDDEN), x.dtype))
    out = np.empty((steps, pages, HIDDEN), x.dtype)
    for t in range(steps):
        gates = ahead[t] + h @ model[f"{way}h"]
        s = _sigmoid(gates[:, : 3 * HIDDEN])
        forget, enter, leave = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
        new = np.tanh(gates[:, 3 * HIDDEN :])
        cell = forget * c + enter * new
        bent = np.tanh(cell)
        m = mask[t][:, None]
        if keep is not None:
            keep.append((h, c, forget, enter, leave, new, bent))
        h, c = np.where(m, leave * bent, h), np.where(m, cell, c)
        out[t] = h
    if state is not None:
        state[:] = h, c
    return out


def scores(x: np.ndarray, mask: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Logits (time, page) of a padded batch (time, page, INPUTS); pages are padded at their end.

    The backward direction reads the padding first, which leaves its state at zero.
    """
    forward = _run(x, mask, model, "f")
    backward = _run(x[::-1], mask[::-1], model, "b")[::-1]
    return forward @ model["out"][:HIDDEN] + backward @ model["out"][HIDDEN:] + model["out0"]


def _gradients(x: np.ndarray, mask: np.ndarray, y: np.ndarray, model: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    ways = {"f": (x, mask), "b": (x[::-1], mask[::-1])}
    kept: dict[str, list] = {"f": [], "b": []}
    hidden = {w: _run(a, m, model, w, kept[w]) for w, (a, m) in ways.items()}
    both = np.concatenate((hidden["f"], hidden["b"][::-1]), axis=2)
    error = np.where(mask, _sigmoid(both @ model["out"] + model["out0"]) - y, 0.0) / mask.sum()
    grads = {"out": np.tensordot(error, both, 2), "out0": np.array([error.sum()])}
    for k, (way, (inputs, masks)) in enumerate(ways.items()):
        given = error[..., None] * model["out"][k * HIDDEN : (k + 1) * HIDDEN]
        given = given if way == "f" else given[::-1]
        steps = len(inputs)
        gates = np.zeros((*inputs.shape[:2], 4 * HIDDEN))
        dh, dc = np.zeros_like(given[0]), np.zeros_like(given[0])
        recurrent = np.zeros_like(model[f"{way}h"])
        for t in range(steps - 1, -1, -1):
            h, c, forget, enter, leave, new, bent = kept[way][t]
            m = masks[t][:, None]
            dh = dh + given[t]
            through = np.where(m, dh, 0.0)
            dcell = np.where(m, dc, 0.0) + through * leave * (1 - bent**2)
            gates[t] = np.concatenate(
                (
                    dcell * c * forget * (1 - forget),
                    dcell * new * enter * (1 - enter),
                    through * bent * leave * (1 - leave),
                    dcell * enter * (1 - new**2),
                ),
                axis=1,
            )
            recurrent += h.T @ gates[t]
            dh = np.where(m, 0.0, dh) + gates[t] @ model[f"{way}h"].T
            dc = np.where(m, dcell * forget, dc)
        grads[f"{way}x"] = np.tensordot(inputs, gates, ((0, 1), (0, 1)))
        grads[f"{way}h"] = recurrent
        grads[f"{way}0"] = gates.sum(axis=(0, 1))
    return grads


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(time, page, INPUTS) and its mask."""
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((longest, len(pages)), bool)
    for k, page in enumerate(pages):
        x[: len(page), k] = page
        mask[: len(page), k] = True
    return x, mask


# --- training pages ---------------------------------------------------------------------------

# Tags of blocks and of what holds them.
TAGS = frozenset(
    "html body header footer nav main article section aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th pre blockquote figure figcaption form label button".split()
)
# The names that the generated pages draw from.
CONTENT = ("content", "post", "entry", "story", "article body", "main-content", "post-body", "text", "entry-content", "page-content")
SIDE = ("sidebar", "widget", "related", "side", "widget-area", "recommended", "trending", "popular posts", "tags")
ADS = ("ad", "ads", "advert", "banner", "promo", "sponsored", "ad-slot", "advertisement")
NOTICES = ("cookie", "notice", "cookie-banner", "consent", "alert", "popup", "newsletter", "subscribe", "modal")
COMMENTS = ("comments", "comment-list", "responses", "discussion", "disqus", "replies", "comment")
MENUS = ("menu", "nav", "navbar", "breadcrumb", "topnav", "links", "pagination", "share social")
HEADS = ("header", "site-header", "masthead", "top", "logo", "brand")
#: Names that tell nothing: of grids, wrappers and layouts.
NEUTRAL = (
    "container", "container-fluid", "row", "col", "col-md-8", "col-8", "wrap", "wrapper", "page", "inner", "outer", "root", "app", "layout", "grid", "cell", "box",
    "block", "region", "flex", "flex-1 p-6", "w-full", "body", "document", "node", "field", "panel", "card", "center", "left", "module", "section", "site",
)
FEET = ("footer", "site-footer", "copyright", "bottom", "legal", "colophon")


class _Page:
    """A page under construction: html text, and True for each block of main text."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.html: list[str] = []
        self.labels: list[bool] = []

    def words(self, low: int, high: int, end: str = "") -> str:
        rng = self.rng
        return " ".join("".join(rng.choices("abdeghilmnoprstuäéñ", k=rng.randint(1, 9))) for _ in range(rng.randint(low, high))).capitalize() + end

    def leaf(self, tag: str, text: str, main: bool, link: bool = False) -> None:
        rng = self.rng
        if link:
            text = f'<a href="/{rng.randint(1, 99)}">{text}</a>'
        elif rng.random() < 0.2:
            text = f"<b>{text}</b>" if rng.random() < 0.7 else f"<b>{text}<br>"
        shut = "" if tag in ("p", "li") and rng.random() < 0.15 else f"</{tag}>"
        self.html.append(f"<{tag}>{text}{shut}")
        self.labels.append(main)

    def sentence(self) -> str:
        text = self.words(*self.rng.choice(((1, 3), (4, 12), (10, 40), (30, 80))), end=self.rng.choice(("", ".", ".", "!", "?")))
        style = self.rng.random()
        return text.upper() if style < 0.05 else text.replace(" ", "*** ") if style < 0.1 else text

    def wrapped(self, inside, least: int = 0, most: int = 4, tags: tuple[str, ...] = ("div",) * 6 + ("section", "main")) -> None:
        """What is inside, in boxes without names or with such as tell nothing."""
        rng, shut = self.rng, []
        for _ in range(rng.randint(least, most)):
            tag, kind = rng.choice(tags), rng.random()
            hashed = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 7))) + str(rng.randint(1, 99))
            name = rng.choice(NEUTRAL) if kind < 0.5 else hashed if kind < 0.8 else ""
            self.html.append(f'<{tag} {rng.choice(("class", "class", "id"))}="{name}">' if name else f"<{tag}>")
            shut.append(f"</{tag}>")
        inside()
        self.html.extend(reversed(shut))

    def definitions(self, main: bool) -> None:
        self.html.append("<dl>")
        for _ in range(self.rng.randint(1, 4)):
            self.leaf("dt", self.words(1, 4), main)
            self.leaf("dd", self.sentence(), main)
        self.html.append("</dl>")

    def figures(self, main: bool) -> None:
        rng = self.rng
        columns = rng.randint(1, 3)
        self.html.append("<table>")
        for _ in range(rng.randint(1, 3)):
            self.html.append("<tr>")
            for _ in range(columns):
                self.leaf(rng.choice(("td", "td", "td", "th")), self.words(1, 4) if rng.random() < 0.7 else self.sentence(), main)
            self.html.append("</tr>")
        self.html.append("</table>")

    def illustration(self, main: bool) -> None:
        self.html.append('<figure><img src="x.png">')
        self.leaf("figcaption", self.words(1, 5) if self.rng.random() < 0.5 else self.sentence(), main)
        self.html.append("</figure>")

    def paragraphs(self, main: bool, low: int, high: int) -> None:
        for _ in range(self.rng.randint(low, high)):
            if main and self.rng.random() < 0.12:
                self.rng.choice((self.definitions, self.figures, self.illustration))(True)
                continue
            self.leaf(self.rng.choice(("p",) * 12 + ("h2", "h3", "blockquote", "div", "pre")), self.sentence(), main)
            if self.rng.random() < 0.06:
                self.listing(main, False)

    def listing(self, main: bool, link: bool) -> None:
        kind = self.rng.choice(("ul", "ul", "ol"))
        self.html.append(f"<{kind}>")
        for _ in range(self.rng.randint(1, 7)):
            self.leaf("li", self.words(1, 4) if link or self.rng.random() < 0.5 else self.sentence(), main, link)
        self.html.append(f"</{kind}>")

    def box(self, tag: str, names: tuple[str, ...], inside, named: float = 0.8) -> None:
        rng = self.rng
        name = rng.choice(names)
        mark = f' {rng.choice(("class", "class", "id"))}="{name}"' if rng.random() < named or tag in ("div", "section") else ""
        self.html.append(f"<{tag}{mark}>")
        deep = rng.random() < 0.2
        if deep:
            self.html.append("<div>")
        inside()
        if deep:
            self.html.append("</div>")
        self.html.append(f"</{tag}>")

    def menu(self) -> None:
        self.box(self.rng.choice(("nav", "nav", "div", "ul")), MENUS, lambda: self.listing(False, self.rng.random() < 0.9), 0.4)

    def head(self) -> None:
        def inside() -> None:
            self.leaf(self.rng.choice(("h1", "div", "p")), self.words(1, 5), False, self.rng.random() < 0.4)
            if self.rng.random() < 0.4:
                self.menu()

        self.box(self.rng.choice(("header", "header", "div")), HEADS, inside, 0.4)

    def foot(self) -> None:
        def inside() -> None:
            for _ in range(self.rng.randint(1, 3)):
                if self.rng.random() < 0.5:
                    self.html.append("&copy; " + self.sentence())
                    self.labels.append(False)
                    self.html.append("<hr>")
                else:
                    self.leaf("p", self.sentence(), False, self.rng.random() < 0.3)

        self.box(self.rng.choice(("footer", "footer", "div")), FEET, inside, 0.4)

    def side(self) -> None:
        def inside() -> None:
            self.leaf(self.rng.choice(("h3", "h4", "p")), self.words(1, 4), False)
            self.listing(False, True) if self.rng.random() < 0.5 else self.paragraphs(False, 1, 3)

        self.box(self.rng.choice(("aside", "aside", "div", "section")), SIDE, inside, 0.5)

    def advert(self) -> None:
        names = ADS if self.rng.random() < 0.6 else NOTICES

        def inside() -> None:
            if self.rng.random() < 0.6:
                self.html.append(self.sentence())
                self.labels.append(False)
            else:
                self.paragraphs(False, 1, 2)

        self.box(self.rng.choice(("div", "div", "section")), names, inside)

    def form(self) -> None:
        self.html.append("<form><label>" + self.words(1, 3) + '</label><input type="text">')
        self.html.append(f"<button>{self.words(1, 2)}</button></form>")
        self.labels.extend((False, False))

    def comments(self) -> None:
        def inside() -> None:
            self.leaf(self.rng.choice(("h2", "h3", "p")), self.words(1, 3), False)
            for _ in range(self.rng.randint(1, 4)):
                if self.rng.random() < 0.5:
                    self.box("div", COMMENTS, lambda: self.paragraphs(False, 1, 2))
                else:
                    self.paragraphs(False, 1, 2)

        self.box(self.rng.choice(("section", "div", "div", "ol")), COMMENTS, inside)

    def article(self) -> None:
        rng = self.rng

        def inside() -> None:
            if rng.random() < 0.8:
                self.leaf(rng.choice(("h1",) * 4 + ("h2",)), self.words(2, 12, rng.choice(("", "."))), True)
            for _ in range(rng.randint(1, 3)):
                self.paragraphs(True, rng.choice((0, 1, 2)), rng.choice((2, 5, 14)))
                if rng.random() < 0.2:
                    rng.choice((self.advert, self.advert, self.side, self.form, self.menu))()

        make = rng.random()
        if make < 0.12:  # nothing around it
            inside()
            return
        if make < 0.45:
            self.wrapped(inside, 1)
            return
        if make < 0.52:  # a page laid out as a table
            self.html.append("<table><tr><td>")
            self.listing(False, True)
            self.html.append("</td><td>")
            inside()
            self.html.append("</td></tr></table>")
            return
        tag = rng.choice(("article",) * 6 + ("main", "main", "div", "div", "section"))
        self.wrapped(lambda: self.box(tag, CONTENT, inside, 0.3), 0, 1)


def _plain(page: _Page) -> tuple[str, list[bool]]:
    """A page of text alone, as it is, in one element, or in lines."""
    rng = page.rng
    text = rng.choice((" ", "<br><br>")).join(page.words(5, 25, ".") for _ in range(rng.randint(2, 12)))
    tag = rng.choice(("", "pre", "p", "div", "td"))
    page.labels.append(True)
    whole = f"<{tag}>{text}</{tag}>" if tag else text
    return (f"<html><body>{whole}</body></html>" if rng.random() < 0.5 else whole), page.labels


def _page(seed: int) -> tuple[str, list[bool]]:
    page = _Page(seed)
    rng = page.rng
    if rng.random() < 0.05:
        return _plain(page)
    page.html.append("<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>")
    parts = [p for p, share in ((page.head, 0.5), (page.menu, 0.8), (page.advert, 0.6), (page.form, 0.15), (page.side, 0.2)) if rng.random() < share]
    if rng.random() < 0.3:
        rng.shuffle(parts)
    rest = [p for p, share in ((page.side, 0.3), (page.comments, 0.35), (page.advert, 0.3), (page.form, 0.15), (page.menu, 0.15)) if rng.random() < share]
    rng.shuffle(rest)
    if rng.random() < 0.2:  # little but the article
        parts, rest = parts[:1], rest[:1]
    whole = (*parts, *([page.article] if rng.random() < 0.97 else []), *rest, *([page.foot] if rng.random() < 0.8 else []))

    def inside() -> None:
        for part in whole:
            page.wrapped(part, 0, 1, ("div",)) if rng.random() < 0.25 else part()

    page.wrapped(inside, 0, 3) if rng.random() < 0.4 else inside()
    page.html.append("</body></html>")
    return "".join(page.html), page.labels


def training_set(pages: int = TRAIN_PAGES, seed: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    """(vectors, labels) of generated pages whose blocks come out as they were put in."""
    out = []
    for k in range(pages):
        text, labels = _page(seed * 1_000_003 + k)
        found = blocks(text)
        if found and len(found) == len(labels):
            out.append((vectors(found), np.array(labels, np.float32)))
    return out


@functools.lru_cache(maxsize=2)
def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = 11) -> dict[str, np.ndarray]:
    """Adam on batches of pages of similar length; float32 weights."""
    data = sorted(training_set(pages), key=lambda d: len(d[0]))
    batches = [data[k : k + BATCH] for k in range(0, len(data), BATCH)]
    ready = [(*padded([x for x, _ in b]), padded([y[:, None] for _, y in b])[0][..., 0]) for b in batches]
    model = init(seed)
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    order, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        rate = 0.02 * (1 - 0.9 * epoch / epochs)
        for k in order.permutation(len(ready)):
            step += 1
            for name, grad in _gradients(*ready[k], model).items():
                grad = np.clip(grad + 1e-5 * model[name], -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.99 * second[name] + 0.01 * grad**2
                model[name] = model[name] - rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in model.items()}


# --- extraction -------------------------------------------------------------------------------


def logits_of(pages: list[list[Block]], model: dict[str, np.ndarray], steps: int) -> np.ndarray:
    """Logits (time, page) of a group of pages, read `steps` blocks at a time.

    Vectors and hidden states exist for one stretch of blocks only; the state is carried from one to the
    next, forward and then backward, so the result is that of one piece and a page of any length fits.
    """
    longest = max(map(len, pages))
    out = np.full((longest, len(pages)), model["out0"][0], np.float32)
    starts, ready = range(0, longest, steps), {}

    def stretch(start: int) -> tuple[np.ndarray, np.ndarray]:
        size = min(steps, longest - start)
        x, mask = np.zeros((size, len(pages), INPUTS), np.float32), np.zeros((size, len(pages)), bool)
        for k, page in enumerate(pages):
            rows = vectors(page, start, start + size)
            x[: len(rows), k], mask[: len(rows), k] = rows, True
        return x, mask

    for way, order in (("f", starts), ("b", reversed(starts))):
        state: list = []
        for start in order:
            x, mask = ready.pop(start, None) or stretch(start)
            if len(starts) == 1 and way == "f":
                ready[start] = x, mask
            turn = slice(None, None, 1 if way == "f" else -1)
            hidden = _run(x[turn], mask[turn], model, way, None, state)[turn]
            part = model["out"][:HIDDEN] if way == "f" else model["out"][HIDDEN:]
            out[start : start + len(x)] += hidden @ part
    return out


def label_pages(pages: list[list[Block]], model: dict[str, np.ndarray], batch_blocks: int = BATCH_BLOCKS) -> list[np.ndarray]:
    """For each page, whether each of its blocks is main text; pages of like length go together."""
    labels = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
    while order:
        longest = len(pages[order[-1]])
        group = [order.pop() for _ in range(min(len(order), max(1, batch_blocks // longest)))]
        found = logits_of([pages[k] for k in group], model, max(1, batch_blocks // len(group))) > 0
        for column, k in enumerate(group):
            labels[k] = found[: len(pages[k]), column]
    return labels


def main_text(page: list[Block], labels: np.ndarray) -> str:
    return "\n".join(b.text for b, main in zip(page, labels, strict=True) if main)


def _extract(model: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                pages = [blocks(x or "") for x in part.column("html").to_pylist()]
                texts = [main_text(p, m) for p, m in zip(pages, label_pages(pages, model), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return run


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of `pages`.

    Null or empty html, and pages without main text, give an empty text. Repeated rows give equal
    texts. Markup may be unclosed, broken or deep, and pages of any length. Other columns are not looked at.
    """
    frame = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    return frame.mapInArrow(_extract(train()), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
