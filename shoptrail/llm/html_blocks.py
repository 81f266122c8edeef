"""Main text of web pages: a recurrent labeller over the sequence of their blocks.

A page becomes a sequence of leaf blocks, each with the tags (and the words of class, id and role) above it and its text.
A bidirectional LSTM in numpy reads a hashed vector of the path and of the words for every block and labels all
blocks of a page together. It is trained here, on a bounded sample of pages: markup with a stated meaning gives the labels,
and copies of the pages with renamed containers and foreign blocks teach it to use other names and the context.
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

from shoptrail.llm.common import prepare

SAMPLE_PAGES = 240
SAMPLE_CHARS = 100_000  # longer pages are not used for training
PATH_SIZE, WORD_SIZE, NUMBERS, HIDDEN = 256, 64, 6, 16
SIZE = PATH_SIZE + WORD_SIZE + NUMBERS
BATCH_BLOCKS = 4096

# A quotation mark opens a value only behind an equals sign; elsewhere it is a character like any other.
TAG = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
NAME = re.compile(r"[a-z]+")
# Tags of the markup language by their role here.
SKIPPED = frozenset("script style noscript template iframe svg canvas object head title textarea select option".split())
CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in SKIPPED}
INLINE = frozenset("""a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span
strike strong sub sup time tt u var wbr br img""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What markup says about its content, in tag names and in words of class, id and role.
ASIDE = frozenset("""nav menu header footer sidebar aside ad ads advert advertisement promo sponsor sponsored cookie consent
notice banner form comment comments reply share social related widget breadcrumb breadcrumbs popup modal subscribe newsletter
copyright login signup search toolbar""".split())
MAIN = frozenset("article main post entry story".split())
PARTS = "p p li h2 h3 blockquote td dd pre figcaption div section".split()


@dataclass
class Block:
    path: list[str]
    text: str
    link_share: float
    hashed: np.ndarray | None = None  # the words' vector, made once


def _words_of_tag(name: str, attributes: str) -> list[str]:
    words = [name]
    for m in ATTRIBUTE.finditer(attributes):
        words += NAME.findall(m[1].lower())
    return words


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page that have text. Inline tags do not end a block; unclosed tags are tolerated."""
    found, stack, parts, links, in_link, at = [], [], [], 0, 0, 0

    def close():
        nonlocal parts, links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            path = [w for _, words in stack for w in words]
            found.append(Block(path, text, min(1.0, links / len(text))))
        parts, links = [], 0

    def add(text: str):
        nonlocal links
        parts.append(text)
        if in_link:
            links += len(text.strip())

    while m := TAG.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in SKIPPED and not m[1]:
            if m[3].endswith("/") or name == "head" and not CLOSING["head"].search(page, at):
                continue  # an empty element, or a head whose end is left out
            end = CLOSING[name].search(page, at)
            if end and name != "option":
                at = end.end()
            else:  # an option ends where anything else begins, and so does what is never closed
                following = TAG.search(page, at)
                at = following.start() if following else len(page)
            continue
        if name in INLINE:
            if name == "a":
                in_link = 0 if m[1] else 1
            elif name == "br":
                parts.append(" ")
            continue
        close()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif name not in VOID:
            if name in ("p", "li") and stack and stack[-1][0] == name:
                stack.pop()
            elif stack and stack[-1][0] == "p":
                stack.pop()
            stack.append((name, _words_of_tag(name, m[3])))
    add(page[at:])
    close()
    return found


def markup_label(block: Block) -> int:
    """What the names above a block say; without any, running text without links is taken as main."""
    names = set(block.path)
    if names & ASIDE:
        return 0
    if names & MAIN:
        return 1
    return int(len(block.text.split()) >= 10 and block.link_share < 0.3)


def _bucket(word: str, size: int) -> int:
    return zlib.crc32(word.encode()) % size


_PATH_CACHE: dict[tuple, np.ndarray] = {}


def _path_vector(path: list[str]) -> np.ndarray:
    key = tuple(path)
    if key not in _PATH_CACHE:
        if len(_PATH_CACHE) > 50_000:
            _PATH_CACHE.clear()
        row = np.zeros(PATH_SIZE, np.float32)
        for word in set(path):
            row[_bucket(word, PATH_SIZE)] = 1
        _PATH_CACHE[key] = row
    return _PATH_CACHE[key]


def vectors(page: list[Block]) -> np.ndarray:
    """A row per block: names of the path, words (both hashed), lengths, links and the place on the page."""
    out = np.zeros((len(page), SIZE), np.float32)
    for k, b in enumerate(page):
        out[k, :PATH_SIZE] = _path_vector(b.path)
        n = b.text.count(" ") + 1
        if b.hashed is None:
            row = np.bincount(np.fromiter(map(hash_word, b.text.split()), np.int64, n), minlength=WORD_SIZE)
            b.hashed = (row / np.sqrt((row * row).sum())).astype(np.float32)
        out[k, PATH_SIZE : PATH_SIZE + WORD_SIZE] = b.hashed
        out[k, PATH_SIZE + WORD_SIZE :] = (
            min(n, 100) / 100, n >= 10, b.link_share, k / len(page), (len(page) - 1 - k) / len(page), b.text[-1] in ".!?")
    return out


def hash_word(word: str) -> int:
    return (len(word) * 7 + ord(word[0]) * 31 + ord(word[-1])) % WORD_SIZE


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """One LSTM layer in each direction and a logistic output per block."""

    def __init__(self, seed: int = 3):
        draw = np.random.default_rng(seed)
        scale = lambda a, b: draw.normal(0, 1 / np.sqrt(a), (a, b)).astype(np.float32)
        self.p = {"out": scale(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
        for side in "lr":
            self.p |= {f"x{side}": scale(SIZE, 4 * HIDDEN) / 2, f"h{side}": scale(HIDDEN, 4 * HIDDEN),
                       f"b{side}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"b{side}"][HIDDEN : 2 * HIDDEN] = 1

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, trace: list | None = None) -> np.ndarray:
        rows, steps, _ = x.shape
        inputs = x.reshape(rows * steps, SIZE) @ self.p[f"x{side}"] + self.p[f"b{side}"]
        inputs = inputs.reshape(rows, steps, 4 * HIDDEN)
        h, c = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
        out = np.zeros((rows, steps, HIDDEN), np.float32)
        for t in range(steps) if side == "l" else range(steps - 1, -1, -1):
            z = inputs[:, t] + h @ self.p[f"h{side}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            m = mask[:, t, None]
            if trace is not None:
                trace.append((t, h, c, i, f, o, g, np.tanh(new), m))
            c = np.where(m, new, c)
            h = np.where(m, o * np.tanh(new), h)
            out[:, t] = h
        return out

    def predict(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, "l"), self._run(x, mask, "r")], axis=2)
        return _sigmoid(both @ self.p["out"] + self.p["bias"])[:, :, 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        traces = {"l": [], "r": []}
        both = np.concatenate([self._run(x, mask, s, traces[s]) for s in "lr"], axis=2)
        p = _sigmoid(both @ self.p["out"] + self.p["bias"])[:, :, 0]
        err = ((p - y) * mask / mask.sum()).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"] = (both * err[:, :, None]).sum(axis=(0, 1))[:, None]
        g["bias"] = err.sum(keepdims=True)[0]
        for n, side in enumerate("lr"):
            top = err[:, :, None] * self.p["out"][n * HIDDEN : (n + 1) * HIDDEN, 0]
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            for t, h, c, i, f, o, gate, th, m in reversed(traces[side]):
                dh = dh + top[:, t]
                a, b = np.where(m, dh, 0), np.where(m, dc, 0)
                b = b + a * o * (1 - th * th)
                dz = np.concatenate([b * gate * i * (1 - i), b * c * f * (1 - f), a * th * o * (1 - o),
                                     b * i * (1 - gate * gate)], axis=1)
                dz_all[:, t] = dz
                g[f"h{side}"] += h.T @ dz
                dh = np.where(m, dz @ self.p[f"h{side}"].T, dh)
                dc = np.where(m, b * f, dc)
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            g[f"x{side}"] = x.reshape(-1, SIZE).T @ flat
            g[f"b{side}"] = flat.sum(axis=0)
        return g


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((len(pages), steps, SIZE), np.float32)
    mask = np.zeros((len(pages), steps), bool)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
        mask[k, : len(p)] = True
    return x, mask


def varied(page: list[Block], labels: list[int], other: list[Block], draw: np.random.Generator):
    """A copy of a page with renamed containers and, here and there, a foreign block under a telling name.

    In half of the copies nothing is named any more, so that place, words, links and the blocks around have to tell.
    """
    names = {}
    rename = draw.random() < 0.5
    nameless = draw.random() < 0.5
    main, aside = sorted(MAIN), sorted(ASIDE)
    out, marks = [], []
    for b, label in zip(page, labels):
        path = list(b.path)
        if rename:
            for k, w in enumerate(path):
                if w in MAIN or w in ASIDE:
                    pool = main if w in MAIN else aside
                    path[k] = names.setdefault(w, str(draw.choice(pool)))
        if nameless:
            path = ["div" if w in MAIN or w in ASIDE else w for w in path]
        elif label and draw.random() < 0.15:
            path = [*path[:-1], str(draw.choice(PARTS))]
        out.append(Block(path, b.text, b.link_share, b.hashed))
        marks.append(label)
        if other and not nameless and draw.random() < 0.15:
            guest = other[int(draw.integers(len(other)))]
            word = str(draw.choice(aside))
            base = path[:-1] if draw.random() < 0.5 else path[:2]
            inner = ["div", word] if draw.random() < 0.5 else [word]
            name = "p" if draw.random() < 0.5 else str(draw.choice(PARTS))
            out.append(Block([*base, *inner, name], guest.text, guest.link_share, guest.hashed))
            marks.append(0)
    return out, marks


def train(pages: list[str], rounds: int = 200, seed: int = 5) -> BiLstm:
    """Fit on the given pages and their variants with Adam. No pages give an untrained model."""
    draw, model = np.random.default_rng(seed), BiLstm()
    parsed = [p for p in (blocks(t) for t in pages) if p]
    if not parsed:
        return model
    marks = [[markup_label(b) for b in p] for p in parsed]
    for p in parsed:
        vectors(p)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    for step in range(1, rounds + 1):
        picked = [int(k) for k in draw.integers(0, len(parsed), 16)]
        made = [varied(parsed[k], marks[k], parsed[int(draw.integers(len(parsed)))], draw) for k in picked]
        x, mask = padded([vectors(b) for b, _ in made])
        y = np.zeros(mask.shape, np.float32)
        for k, (_, m) in enumerate(made):
            y[k, : len(m)] = m
        rate = 0.03 * (1 - 0.9 * step / rounds)
        for name, grad in model.gradients(x, mask, y).items():
            grad = np.clip(grad, -1, 1)
            first[name] = 0.9 * first[name] + 0.1 * grad
            second[name] = 0.999 * second[name] + 0.001 * grad * grad
            move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
            model.p[name] = (model.p[name] - rate * move).astype(np.float32)
    return model


def main_texts(model: BiLstm, pages: list[str | None]) -> list[str]:
    """The main text of every page; pages of similar length are read together."""
    parsed = [blocks(p) if p else [] for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if parsed[k]), key=lambda k: len(parsed[k]))
    at = 0
    while at < len(order):
        end, longest = at, 0
        while end < len(order) and (end == at or (end - at + 1) * len(parsed[order[end]]) <= BATCH_BLOCKS):
            end += 1
        group = order[at:end]
        keep = model.predict(*padded([vectors(parsed[k]) for k in group])) >= 0.5
        for row, k in zip(keep, group):
            out[k] = "\n".join(b.text for b, yes in zip(parsed[k], row) if yes)
        at = end
    return out


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> BiLstm:
    """Train on about ``sample`` pages, chosen by a hash of page_id and url; the only rows that reach the driver."""
    usable = pages.filter(F.col("html").isNotNull() & (F.length("html") <= SAMPLE_CHARS))
    every = max(1, usable.count() // sample)
    chosen = usable.filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(every)) == 0).select("page_id", "html")
    rows = sorted(((r["page_id"] is None, r["page_id"] or 0, r["html"]) for r in chosen.collect()))
    return train([r[2] for r in rows])


def extract(pages: DataFrame, model: BiLstm | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``; null or empty html gives an empty text. No shuffle."""
    spark = prepare(pages.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    shared = spark.sparkContext.broadcast((model or fit(rows)).p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = BiLstm()
        labeller.p = shared.value
        for batch in batches:
            texts = main_texts(labeller, batch.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
