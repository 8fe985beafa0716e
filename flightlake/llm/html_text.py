"""Main text of web pages by labelling blocks with a bidirectional LSTM.

A page becomes its sequence of leaf blocks (``html_blocks``).  Each block is a
vector: hashed elements of its tag path with their class and id words, hashed
words, and a few numbers (length, share of links, place).  One LSTM reads the
sequence forwards and one backwards, and a logistic unit on both states labels
every block as main text or not, so a block is judged in view of the whole page.

The network is trained here, in numpy, on at most ``TRAIN_PAGES`` pages of the
table that have html (those with the smallest hash of page id and url; at most
``TRAIN_PAGES * TRAIN_CHARS`` characters and ``TRAIN_BLOCKS`` blocks, never a part
of a page): pages with an article or main element are labelled by their own
elements, and each also lends its texts to two
made-up pages in which containers, names and order vary; where this gives fewer
than ``LEAST_EXAMPLES`` sequences, pages of made-up words are added.  All pages are
labelled by the trained network.  Only bounded samples and weights reach the
driver.

Null or empty html, and pages without main text, give an empty text.  Broken
markup is read as it stands; very long pages are one sequence, never cut.
Repeated rows are labelled each; null ids and urls pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm import words as W
from flightlake.llm.arrow import slices, strings
from flightlake.llm.html_blocks import Block, blocks
from flightlake.operators.sizing import sample_rows

TRAIN_PAGES = 160
TRAIN_CHARS = 60_000  # longer pages are chosen for training only where there are too few others
TRAIN_BLOCKS = 40_000  # of all training sequences together; a page that exceeds what is left is dropped
BATCH_BLOCKS = 16_384  # of a batch, padded
MADE_PAGES = 2
LEAST_EXAMPLES = 120  # pages made of made-up words are added up to here
EPOCHS = 8
BATCH = 16
RATE = 0.01
HIDDEN = 16
PATH_CELLS = 96
WORD_CELLS = 32
NUMBERS = 6
WIDTH = PATH_CELLS + WORD_CELLS + NUMBERS
# Elements of a path that are looked at: the outermost and the innermost.
PATH_ENDS = (8, 16)

# Elements and name words by which training pages are labelled (fixed values).
MAIN = {"article", "main"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "select", "button", "figure"}
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie consent disclaimer footer "
    "form header login menu nav navbar navigation newsletter notice pagination popup promo related search share sidebar "
    "signup social sponsor sponsored subscribe toolbar widget".split()
)
MAIN_SHAPES = ("article", "main", "div class=content", "div id=main", "section class=story", "div class='post body'", "div class=entry", "div role=main")
ASIDE_SHAPES = (
    "nav", "header", "footer", "aside", "form", "div class=sidebar", "div class=menu", "div class=ad", "div class='ad banner'",
    "div class=cookie-notice", "section id=comments", "div class=comments", "div class=breadcrumbs", "div class=related",
    "div class=share", "div class=newsletter", "ul class=nav", "div id=footer", "div class=promo", "div class=notice",
)
INSIDE_SHAPES = ("aside", "div class=ad", "div class=share", "section class=comments", "form", "div class=related", "nav")
_MARK = ""


# -- vectors ------------------------------------------------------------------


def _path_cells(path: tuple[str, ...]) -> list[int]:
    head, tail = PATH_ENDS
    seen = path if len(path) <= head + tail else path[:head] + path[-tail:]
    cells = [f"depth{min(len(path), 12)}", f"in {path[-1].split(' ')[0]}" if path else "in nothing"]
    for element in seen:
        name, *words = element.split(" ")
        cells += [name, *(f".{w}" for w in words)]
    return [zlib.crc32(c.encode()) % PATH_CELLS for c in set(cells)]


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """One row per block of all pages."""
    flat = [b for page in pages for b in page]
    out = np.zeros((len(flat), WIDTH), np.float32)
    if not flat:
        return out
    known: dict[tuple[str, ...], list[int]] = {}
    for i, block in enumerate(flat):
        cells = known.get(block.path)
        if cells is None:
            cells = known[block.path] = _path_cells(block.path)
        out[i, cells] = 1
    raw = [b.text.encode() for b in flat]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    data = W.LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    words = W.find_words(data, offsets)
    cell = (W.word_hashes(data, words) % np.uint64(WORD_CELLS)).astype(np.int64)
    count = np.diff(words.first)
    block_of = np.repeat(np.arange(len(flat)), count)
    bag = np.bincount(block_of * WORD_CELLS + cell, minlength=len(flat) * WORD_CELLS).reshape(-1, WORD_CELLS)
    out[:, PATH_CELLS : PATH_CELLS + WORD_CELLS] = bag / np.maximum(1, count)[:, None]
    place = np.concatenate([np.linspace(0, 1, len(p)) if len(p) > 1 else np.zeros(len(p)) for p in pages])
    chars = np.diff(offsets)
    out[:, -NUMBERS:] = np.stack(
        [
            np.log1p(chars) / 8, np.log1p(count) / 6, [b.linked for b in flat], place, 1 - place,
            [b.text[-1] in ".!?:;\"'" for b in flat],
        ],
        axis=1,
    )
    return out


# -- the network --------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    weights = {}
    for way in "fb":
        weights["x" + way] = rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, 4 * HIDDEN))
        weights["h" + way] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        weights["b" + way] = np.zeros(4 * HIDDEN)
        weights["b" + way][HIDDEN : 2 * HIDDEN] = 1  # remember at first
    weights["o"] = rng.normal(0, 0.3, 2 * HIDDEN)
    weights["bo"] = np.zeros(1)
    return weights


def _run(weights: dict, way: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States of one direction over (steps, pages, vector); masked steps pass the state on."""
    steps, pages, _ = x.shape
    inputs = x @ weights["x" + way] + weights["b" + way]
    h = np.zeros((pages, HIDDEN), inputs.dtype)
    c = np.zeros_like(h)
    states = np.zeros((steps, pages, HIDDEN), inputs.dtype)
    tape = []
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        gates = inputs[t] + h @ weights["h" + way]
        act = _sigmoid(gates[:, : 3 * HIDDEN])
        i, f, o = act[:, :HIDDEN], act[:, HIDDEN : 2 * HIDDEN], act[:, 2 * HIDDEN :]
        g = np.tanh(gates[:, 3 * HIDDEN :])
        on = mask[t][:, None]
        after = f * c + i * g
        shape = np.tanh(after)
        if keep:
            tape.append((t, h, c, i, f, o, g, shape, on))
        h = on * (o * shape) + (1 - on) * h
        c = on * after + (1 - on) * c
        states[t] = h
    return states, tape


def _back(weights: dict, way: str, x: np.ndarray, tape: list, above: np.ndarray, grads: dict) -> None:
    dh = np.zeros_like(above[0])
    dc = np.zeros_like(dh)
    for t, h, c, i, f, o, g, shape, on in reversed(tape):
        dh = dh + above[t]
        do = dh * on * shape
        da = dh * on * o * (1 - shape**2) + dc * on
        gates = np.concatenate([da * g * i * (1 - i), da * c * f * (1 - f), do * o * (1 - o), da * i * (1 - g**2)], axis=1)
        grads["x" + way] += x[t].T @ gates
        grads["h" + way] += h.T @ gates
        grads["b" + way] += gates.sum(0)
        dc = da * f + dc * (1 - on)
        dh = gates @ weights["h" + way].T + dh * (1 - on)


def _padded(rows: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(lengths)
    x = np.zeros((steps, len(lengths), WIDTH), rows.dtype)
    mask = np.zeros((steps, len(lengths)), rows.dtype)
    at = 0
    for k, n in enumerate(lengths):
        x[:n, k] = rows[at : at + n]
        mask[:n, k] = 1
        at += n
    return x, mask


def train(examples: list[tuple[np.ndarray, np.ndarray]], seed: int = 11) -> dict[str, np.ndarray]:
    """Weights after a few rounds of Adam over (vectors, labels) of pages."""
    rng = np.random.default_rng(seed)
    weights = new_weights(rng)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for chosen in _batches([examples[k] for k in order]):
            x, mask = _padded(np.concatenate([c[0] for c in chosen]).astype(np.float64), [len(c[1]) for c in chosen])
            y = np.zeros_like(mask)
            for k, (_, labels) in enumerate(chosen):
                y[: len(labels), k] = labels
            runs = {way: _run(weights, way, x, mask, True) for way in "fb"}
            both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
            delta = (_sigmoid(both @ weights["o"] + weights["bo"]) - y) * mask / mask.sum()
            grads = {k: np.zeros_like(v) for k, v in weights.items()}
            grads["o"] = np.einsum("tp,tph->h", delta, both)
            grads["bo"] = np.array([delta.sum()])
            above = delta[:, :, None] * weights["o"]
            _back(weights, "f", x, runs["f"][1], above[:, :, :HIDDEN], grads)
            _back(weights, "b", x, runs["b"][1], above[:, :, HIDDEN:], grads)
            step += 1
            for k, grad in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                weights[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in weights.items()}


def _batches(examples: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """Up to ``BATCH`` pages in a row, fewer where long pages would be padded beyond ``BATCH_BLOCKS``."""
    batch: list[tuple[np.ndarray, np.ndarray]] = []
    longest = 0
    for example in examples:
        longest = max(longest, len(example[1]))
        if batch and (len(batch) == BATCH or longest * (len(batch) + 1) > BATCH_BLOCKS):
            yield batch
            batch, longest = [], len(example[1])
        batch.append(example)
    if batch:
        yield batch


def label(weights: dict[str, np.ndarray], pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks of each page are main text."""
    out = [np.zeros(0, bool)] * len(pages)
    rows = vectors(pages)
    begins = np.concatenate([[0], np.cumsum([len(p) for p in pages])])
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    for group in _alike(order, [len(p) for p in pages]):
        lengths = [len(pages[k]) for k in group]
        x, mask = _padded(np.concatenate([rows[begins[k] : begins[k + 1]] for k in group]), lengths)
        both = np.concatenate([_run(weights, way, x, mask, False)[0] for way in "fb"], axis=2)
        main = (both @ weights["o"] + weights["bo"]) > 0
        for i, k in enumerate(group):
            out[k] = main[: lengths[i], i]
    return out


def _alike(order: list[int], lengths: list[int], most: int = 64) -> Iterator[list[int]]:
    """Groups of pages of similar length, so that little is padded."""
    group: list[int] = []
    for k in order:
        if group and (len(group) == most or lengths[k] > 1.3 * lengths[group[0]] + 4):
            yield group
            group = []
        group.append(k)
    if group:
        yield group


# -- training pages -----------------------------------------------------------


def own_labels(page: list[Block]) -> np.ndarray | None:
    """Labels by the page's elements; None if it has no main element."""
    found = []
    for block in page:
        names = [e.split(" ")[0] for e in block.path]
        words = {w for e in block.path for w in e.split(" ")[1:]}
        inside = any(n in MAIN for n in names)
        found.append(inside and not any(n in ASIDE for n in names) and not words & ASIDE_WORDS)
    return np.array(found) if any(found) else None


def _wrapped(shape: str, inner: str) -> str:
    return f"<{shape}>{inner}</{shape.split(' ')[0]}>"


def made_page(rng: random.Random, main: list[str], other: list[str]) -> str:
    """A page with other containers around the given texts; main blocks begin with a mark."""
    other = other or main

    def some(texts: list[str], low: int, high: int) -> list[str]:
        return [rng.choice(texts) for _ in range(rng.randint(low, high))]

    def aside(shape: str) -> str:
        texts = some(main if "comment" in shape and rng.random() < 0.7 else other, 1, 6)
        texts = [" ".join(t.split()[: rng.choice([3, 8, 40])]) for t in texts]
        form = rng.choice(["<p>{}</p>", "<li><a href=x>{}</a></li>", "<div>{}</div>", "<span>{}</span><br>"])
        inner = "".join(form.format(t) for t in texts)
        return _wrapped(shape, f"<ul>{inner}</ul>" if "<li>" in form else inner)

    body = [f"<h1>{_MARK}{main[0][:80]}</h1>"] if rng.random() < 0.7 else []
    for k, t in enumerate(main):
        kind = rng.choice(["p", "p", "p", "h2", "li", "blockquote", "div"]) if rng.random() < 0.3 else "p"
        body.append(f"<{kind}>{_MARK}{t}</{kind}>" if rng.random() < 0.9 else f"<p><b>{_MARK}{t}<br>")
        if rng.random() < 0.06:
            body.append(aside(rng.choice(INSIDE_SHAPES)))
    before = [aside(rng.choice(ASIDE_SHAPES)) for _ in range(rng.randint(0, 4))]
    after = [aside(rng.choice(ASIDE_SHAPES)) for _ in range(rng.randint(0, 4))]
    page = "".join(before) + _wrapped(rng.choice(MAIN_SHAPES), "".join(body)) + "".join(after)
    if rng.random() < 0.3:
        page = f"<div class=wrapper>{page}</div>"
    return f"<html><body>{page}</body></html>"


def examples(htmls: list[str], seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """(vectors, labels) of whole pages with a main element, and of pages made of their texts."""
    rng = random.Random(seed)
    out = []
    room = TRAIN_BLOCKS
    for source in htmls:
        page = blocks(source)
        labels = own_labels(page) if len(page) <= room else None
        if labels is None:
            continue
        main = [_escape(b.text) for b, y in zip(page, labels) if y]
        other = [_escape(b.text) for b, y in zip(page, labels) if not y]
        own = [(vectors([page]), labels.astype(np.float64)), *(_made_example(rng, main, other) for _ in range(MADE_PAGES))]
        blocks_used = sum(len(y) for _, y in own)
        if blocks_used <= room:
            out += own
            room -= blocks_used
    for _ in range(LEAST_EXAMPLES - len(out)):
        out.append(_made_example(rng, *plain_texts(rng)))
    return out


def _made_example(rng: random.Random, main: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray]:
    made = blocks(made_page(rng, main, other))
    marks = np.array([float(b.text.startswith(_MARK)) for b in made])
    return vectors([[Block(b.text.lstrip(_MARK) or " ", b.path, b.linked) for b in made]]), marks


def plain_texts(rng: random.Random) -> tuple[list[str], list[str]]:
    """Paragraphs and short notes of made-up words, where the table lends too few texts."""
    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choice(["lo", "mi", "ra", "te", "nu", "sk", "an"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high)))

    main = [". ".join(words(5, 15) for _ in range(rng.randint(1, 5))) + "." for _ in range(rng.randint(1, 12))]
    return main, [words(1, 8) for _ in range(rng.randint(3, 15))]


def _escape(text: str) -> str:
    return re.sub("[<&]", " ", text.replace(_MARK, ""))


# -- the operator -------------------------------------------------------------


def main_text(weights: dict[str, np.ndarray], htmls: list[str]) -> list[str]:
    pages = [blocks(h) for h in htmls]
    return ["\n".join(b.text for b, y in zip(page, main) if y) for page, main in zip(pages, label(weights, pages))]


def _extractor(weights: dict[str, np.ndarray], name: str, columns: list[str]):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, name):
            texts = pa.array(main_text(weights, strings(batch.column(name))), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), texts], names=[*columns, "text"])

    return extract


def fit(pages: DataFrame, html_column: str = "html") -> dict[str, np.ndarray]:
    """Train on a bounded sample of the pages, chosen by a hash."""
    return train(examples(training_pages(pages, html_column)))


def training_pages(pages: DataFrame, html_column: str = "html") -> list[str]:
    """At most ``TRAIN_PAGES`` pages with html; longer ones only where there are too few others, as many as the characters allow."""
    html = F.col(html_column)
    keyed = pages.select("page_id", "url", html.alias("_html"), F.length(html).alias("_length"))
    short = sample_rows(keyed.where(F.col("_length").between(1, TRAIN_CHARS)), TRAIN_PAGES, "page_id", "url")
    sample = [r[0] for r in short.select("_html").limit(TRAIN_PAGES).collect()]
    wanted = TRAIN_PAGES - len(sample)
    if not wanted:
        return sample
    # the keys first: the pages themselves are read only as far as the characters allow
    place = F.xxhash64("page_id", "url", "_html")
    long = keyed.where(F.col("_length") > TRAIN_CHARS).select("page_id", "url", "_length", place.alias("_place"))
    room, chosen = TRAIN_PAGES * TRAIN_CHARS - sum(map(len, sample)), {}
    for row in sample_rows(long, wanted, "page_id", "url", "_place").collect():
        if row["_place"] not in chosen and row["_length"] <= room and len(chosen) < wanted:
            chosen[row["_place"]] = row["_length"]
            room -= row["_length"]
    if chosen:
        found = keyed.where((F.col("_length") > TRAIN_CHARS) & place.isin(list(chosen))).groupBy(place.alias("_place")).agg(F.first("_html").alias("_html"))
        sample += [r["_html"] for r in found.orderBy("_place").collect()]
    return sample


def extract(pages: DataFrame, weights: dict[str, np.ndarray] | None = None, html_column: str = "html") -> DataFrame:
    """The columns of ``pages`` without the html, and ``text``: main blocks joined by line feeds."""
    weights = weights or fit(pages, html_column)
    columns = [c for c in pages.columns if c not in (html_column, "text")]
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in columns)
    slim = pages.select(*columns, html_column)
    return slim.mapInArrow(_extractor(weights, html_column, columns), f"{kinds}, text string" if columns else "text string")
