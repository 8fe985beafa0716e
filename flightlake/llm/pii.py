"""Personal data: fixed patterns, and a skip-chain conditional random field.

The patterns find emails, IP addresses, payment cards (Luhn) and phone numbers;
these spans always stay.  The field labels tokens (words with a digit or ``@``;
all others can only be text) with one of the kinds or none.  Its potentials are

* per token: weights of hashed shape, length and neighbour features,
* along the chain: a table over the labels of adjoining tokens,
* across the document: a table over the labels of distant tokens that are equal
  or similar (same letters and digits, same name before the ``@``, or same seven or
  more digits), each to the first that a pattern recognised, or to the first; and of the tokens of each run of adjoining
  numbers to the pattern's span that their joint digits repeat (a phone's also
  without its country code, down to the last seven; an address's by its four
  numbers), or to the first run with the same digits.  So ties grow with the
  text, not with its square.

Tokens under a pattern's span are fixed to its kind, and damped loopy message
passing, swept until no message of a document changes by more than ``SETTLED``
(``MOST_SWEEPS`` at most), spreads labels from there, so a number that a pattern recognised once is
recognised where it stands in another form.  A run of tokens becomes a new span
if its posterior favours a kind and at least one of its tokens is tied to a
recognised one, or if all its posteriors reach a higher limit, which is set per
kind so that at most ``UNTIED_ERROR`` of made look-alikes pass.  Documents in
which no pattern finds anything are searched like all others.

The weights are trained by pseudo-likelihood on about ``TRAIN_DOCS`` documents
(smallest hash of id and text, at most ``TRAIN_CHARS`` long) whose labels are the
patterns' spans.  Each is used a second time with its data repeated in other
forms beside numbers that only look alike, a third time with the data in those
forms only, and each token is seen once more without its own features.  ``MADE_DOCS`` short made-up texts join them, as small
tables hold few of the forms.
Every document is searched in full.

Null text counts as empty; repeated rows give repeated results; documents without
digits and ``@`` have no spans; an empty table gives an empty result.  Other
columns stay; a column named ``spans`` is replaced.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm.arrow import slices, strings
from flightlake.operators.sizing import sample_rows

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 6000
TRAIN_CHARS = 20_000
MADE_DOCS = 400
FEATURES = 4096
ROUNDS = 30
MOST_SWEEPS = 300  # messages that still change then are taken as they are
SETTLED = 1e-4  # largest change of a settled message
DAMPING = 0.3
STRONG = 0.5  # least posterior of a new token
UNTIED = 0.8  # least posterior of a run without a tie to a recognised token
UNTIED_ERROR = 0.005  # and the largest share of made look-alikes that may pass as one

# Patterns of the base spans (fixed values).
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# No match begins inside a run of digits, and a part takes its whole run.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_ACTIVE = re.compile(r"[0-9@]")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_GROUPS = re.compile(r"[0-9]+")
_LETTER = re.compile(r"[^\W\d_]")
_MOST_DIGITS = 19
_EDGES = " \t\r\n.,;:!?\"'<>[]{}|"

_SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]
)
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


# -- patterns -----------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their @ signs, so that long runs stay linear."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            out.append((start, end))
            at = text.find("@", end)
        else:
            end, at = max(end, at), text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = _NOT_DIGIT.sub("", match.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *match.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


# -- tokens and ties ----------------------------------------------------------


def active_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Tokens with a digit or an @ sign, found from these outward; every character is looked at a few times at most."""
    at = 0
    while (mark := _ACTIVE.search(text, at)) is not None:
        begin = max(at, 1 + max(text.rfind(c, at, mark.start()) for c in " \t\n\v\f\r"))
        blank = _BLANK.search(text, mark.end())
        at = blank.start() if blank else len(text)
        yield begin, at


def _shape(token: str) -> str:
    out = []
    for c in token[:40]:
        kind = "9" if c.isdigit() else "a" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


class Graph:
    """Tokens of several documents with their features and ties."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, int, int]] = []  # document, begin, end
        self.cells: list[list[int]] = []
        self.fixed: list[int] = []  # label under a pattern's span, or -1
        self.chain: list[tuple[int, int]] = []
        self.ties: list[tuple[int, int]] = []

    def add(self, number: int, text: str, base: list[tuple[str, int, int]]) -> None:
        cover = sorted((a, b, KINDS.index(k) + 1) for k, a, b in base)
        at = 0
        hub: dict[str, int] = {}
        runs: list[list[int]] = []  # adjoining tokens that may be parts of one number
        open_run = False
        previous = None
        first = len(self.spans)
        for begin, end in active_tokens(text):
            while at < len(cover) and cover[at][1] <= begin:
                at += 1
            label, k = -1, at
            while k < len(cover) and cover[k][0] < end and label < 0:
                if cover[k][1] > begin:
                    label = cover[k][2]
                k += 1
            node = len(self.spans)
            token = text[begin:end]
            self.spans.append((number, begin, end))
            self.fixed.append(label)
            self.cells.append(self._features(token, text, begin, end))
            if previous is not None and not text[previous:begin].strip("\x20\x09\x0a\x0b\x0c\x0d"):
                self.chain.append((node - 1, node))
            plain = "@" not in token and not _LETTER.search(token)
            if open_run and plain and begin - previous < 4 and not _LETTER.search(text, previous, begin):
                runs[-1].append(node)
            elif "@" not in token:
                runs.append([node])
            open_run = plain
            previous = end
            for key in _keys(token):
                if key in hub:
                    self.ties.append((hub[key], node))
                if key not in hub or self.fixed[hub[key]] <= 0 < label:
                    hub[key] = node
        self._run_features(runs, text)
        self._tie_runs(runs, self._anchors(text, base, first), text)

    def _anchors(self, text: str, base: list[tuple[str, int, int]], first: int) -> dict[tuple[str, ...], tuple[int, int]]:
        """The joint keys of the patterns' spans, each with the first and last token of a span that has it."""
        begins = [s[1] for s in self.spans[first:]]
        out: dict[tuple[str, ...], tuple[int, int]] = {}
        for kind, a, b in base:
            node = first + bisect_right(begins, a) - 1
            if self.fixed[node] == KINDS.index(kind) + 1:
                for key in _span_keys(kind, text[a:b]):
                    out.setdefault(key, (node, first + bisect_right(begins, b - 1) - 1))
        return out

    def _run_features(self, runs: list[list[int]], text: str) -> None:
        """What the tokens of a run are together: number of digits, and whether they pass the card test."""
        for run in runs:
            digits = "".join(g for n in run for g in _GROUPS.findall(text, *self.spans[n][1:]))
            names = [f"rd:{min(len(digits), 20)}:{min(len(run), 6)}", f"rl:{13 <= len(digits) <= _MOST_DIGITS and luhn(digits)}"]
            for n in run:
                self.cells[n] += [zlib.crc32(name.encode()) % FEATURES for name in names]

    def _tie_runs(self, runs: list[list[int]], anchors: dict[tuple[str, ...], tuple[int, int]], text: str) -> None:
        hub: dict[str, list[int]] = {}
        for run in runs:
            groups = [_GROUPS.findall(text, *self.spans[n][1:]) for n in run]
            if anchors:
                self._tie_windows(run, groups, anchors)
            digits = "".join(g for own in groups for g in own)
            if len(run) > 1 and 7 <= len(digits) <= _MOST_DIGITS:
                first = hub.setdefault(digits, run)
                if first is not run:
                    self.ties += [(first[min(k, len(first) - 1)], node) for k, node in enumerate(run)]

    def _tie_windows(self, run: list[int], groups: list[list[str]], anchors: dict[tuple[str, ...], tuple[int, int]]) -> None:
        """Tie the longest stretches of a run whose joint key a recognised span has."""
        i = 0
        while i < len(run):
            digits, parts, best, anchor = "", [], -1, (-1, -1)
            for j in range(i, len(run)):
                digits += "".join(groups[j])
                parts += groups[j]
                if len(digits) > _MOST_DIGITS + 3:
                    break
                for key in _number_keys(digits, parts):
                    if key in anchors:
                        best, anchor = j, anchors[key]
            self.ties += [(anchor[0], node) for node in run[i : best + 1] if not anchor[0] <= node <= anchor[1]]
            i = max(i, best) + 1

    @staticmethod
    def _features(token: str, text: str, begin: int, end: int) -> list[int]:
        digits = _NOT_DIGIT.sub("", token)
        groups = _GROUPS.findall(token)
        before = _TOKEN.search(text[max(0, begin - 40) : begin].rstrip()[::-1])
        after = _TOKEN.search(text[end : end + 40])
        names = [
            f"s:{_shape(token)}", f"d:{min(len(digits), 20) if len(groups) != 4 else ''}", f"n:{min(len(token), 30)}", f"l:{len(digits) >= 13 and luhn(digits)}",
            f"i:{bool(_IP.fullmatch(token.strip(_EDGES))) and all(_small(p) for p in token.strip(_EDGES).split('.'))}",
            f"@:{'@' in token}", f"+:{token[0] == '+'}", f"g:{len(groups) if len(groups) < 6 and all(map(_small, groups)) else ''}",
        ]
        word = before.group()[::-1] if before else ""
        context = [f"p:{_shape(word)}", f"w:{word.lower()}", f"f:{_shape(after.group()) if after else ''}"]
        own = [zlib.crc32(n.encode()) % FEATURES for n in names]
        return own + [zlib.crc32(n.encode()) % FEATURES for n in context]


def _keys(token: str) -> list[str]:
    """What a token has in common with those it is tied to; none if it says too little."""
    letters = "".join(c for c in token.lower() if c.isalnum() or c == "@")
    digits = _NOT_DIGIT.sub("", token)
    keys = []
    if len(letters) >= 5 and (len(digits) >= 4 or "@" in letters[1:-1]):
        keys.append(letters)
        if "@" in letters:
            keys.append(letters.partition("@")[0] + "@")
    if len(digits) >= 7 and digits != letters:
        keys.append(digits)
    return keys


def _number_keys(digits: str, parts: list[str]) -> list[tuple[str, ...]]:
    """The joint keys of adjoining digits: the number without leading zeros, and four parts as an address."""
    keys = []
    number = digits.lstrip("0")
    if 7 <= len(number) <= _MOST_DIGITS:
        keys.append(("number", number))
    if len(parts) == 4:
        keys.append(("ip", *(p.lstrip("0") for p in parts)))
    return keys


def _span_keys(kind: str, value: str) -> list[tuple[str, ...]]:
    """The joint keys by which a pattern's span is known again."""
    parts = _GROUPS.findall(value)
    digits = "".join(parts)
    if kind == "phone":
        return [("number", n) for k in range(len(digits) - 6) if len(n := digits[k:].lstrip("0")) >= 7]
    if kind == "card":
        return [("number", digits.lstrip("0"))]
    return [("ip", *(p.lstrip("0") for p in parts))] if kind == "ip" else []


# -- the field ----------------------------------------------------------------

LABELS = len(KINDS) + 1


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def _normal(x: np.ndarray) -> np.ndarray:
    return x - x.max(1, keepdims=True) - np.log(np.exp(x - x.max(1, keepdims=True)).sum(1, keepdims=True))


def _variant(kind: str, value: str, rng: random.Random) -> str:
    """The same data written in another way."""
    digits = _NOT_DIGIT.sub("", value)
    if kind == "email":
        return value.rsplit(".", 1)[0]
    if kind == "ip":
        return value.replace(".", rng.choice(["-", "_", ":", " "]))
    if kind == "card":
        return rng.choice(["-", " ", "_", ".", "  "]).join(digits[i : i + 4] for i in range(0, len(digits), 4)) if rng.random() < 0.7 else digits
    tail = re.sub(r"^\+[0-9]+[\x20.-]*", "", value)
    national = _NOT_DIGIT.sub("", tail)
    if len(national) < 7:
        tail, national = digits, digits[-10:]
    cut = [national[:-7], national[-7:-4], national[-4:]]
    return rng.choice([tail, tail, national, digits, rng.choice(" -.").join(c for c in cut if c), rng.choice(["1 ", "0 ", "0"]) + tail])


def made_texts(rng: random.Random, number: int) -> list[str]:
    """Short texts with data in the patterns' forms and plain numbers, so that small tables teach every kind too."""
    def word() -> str:
        return "".join(rng.choice(["lo", "mi", "ra", "te", "nu", "sk", "an"]) for _ in range(rng.randint(1, 3)))

    def digits(form: str) -> str:
        return "".join(str(rng.randint(0, 9)) if c == "#" else c for c in form)

    def card() -> str:
        body = digits("4" + "#" * rng.choice([14, 14, 14, 13, 12]))
        whole = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        return rng.choice(["", " ", "-"]).join(whole[i : i + 4] for i in range(0, len(whole), 4))

    def value() -> str:
        kind = rng.choice(KINDS)
        if kind == "email":
            return f"{word()}{rng.choice(['.', '', '_', digits('#')])}{word()}@{word()}.{rng.choice(['com', 'org', 'example.net'])}"
        if kind == "ip":
            top = rng.choice([9, 99, 255])
            return ".".join(str(rng.randint(0, top)) for _ in range(4))
        if kind == "card":
            return card()
        return digits(rng.choice(["+1 (###) ###-####", "+1 ### ### ####", "+1-###-###-####", "+1##########", "+44 20 #### ####", "+49 30 #######", "+33 # ## ## ## ##", "+##.###.###.###"]))

    out = []
    for _ in range(number):
        parts = [word() for _ in range(rng.randint(6, 20))]
        parts.insert(rng.randint(1, len(parts) - 1), value())
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(1, len(parts) - 1), digits(rng.choice(["#", "##", "19##", "20##.", "#,###", "#.#", "####", "(20##)", "###-####"])))
        out.append(" ".join(parts))
    return out


def with_repeats(text: str, base: list[tuple[str, int, int]], rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its data repeated in other forms, and with like-looking numbers that are no data."""
    spans = list(base)
    for kind, begin, end in base:
        value = _variant(kind, text[begin:end], rng)
        text += rng.choice([" and ", " again ", "\n", " or "])
        spans.append((kind, len(text), len(text) + len(value)))
        text += value + rng.choice(["", ".", ","])
        text += f" {rng.choice(_COUNTED)} {_like(value, rng)} " if rng.random() < 0.7 else f" {rng.randint(1, 99999)} "
    return text, spans


_COUNTED = ("item", "item", "item", "no", "order", "section", "id", "part")
_PLAIN = (
    "#", "##", "19##", "20##.", "(20##)", "#,###", "#.##", "####", "###-####", "20##-0#-1#", "0#/1#/20##", "1#:##:##", "#.#.#", "v#.##.#", "##########",
    "17########", "978##########", "################", "###.###.###.###", "3##.4##.9##.7##", "#### ####", "20## 20## 20##", "@", "@lomi##", "lo@", "$##,###.##",
    "#########", "##-####-##", "1.######", "### ###", "0x##ab##", "##### #####",
)


def _like(value: str, rng: random.Random) -> str:
    """Other digits in the same form, which are no card's."""
    while True:
        other = "".join(str(rng.randint(0, 9)) if c in "0123456789" else c for c in value if c != "@")
        digits = _NOT_DIGIT.sub("", other)
        if not (13 <= len(digits) <= _MOST_DIGITS and luhn(digits)):
            return other


def alone(text: str, base: list[tuple[str, int, int]], rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its data only in forms that no pattern finds, between plain numbers that are no data."""
    out, spans, at, size = [], [], 0, 0
    for kind, begin, end in sorted(base, key=lambda s: s[1]):
        if begin < at:
            continue
        value = _variant(kind, text[begin:end], rng)
        plain = _like(rng.choice(_PLAIN).replace("#", "0"), rng) if rng.random() < 0.7 else f"{rng.choice(_COUNTED)} {_like(value, rng)}"
        out += [text[at:begin], value, rng.choice([" and then ", ", ", " or "]), "lo ", plain, " mi "]
        size += begin - at
        if kind != "phone" or len(_NOT_DIGIT.sub("", value)) >= 9:
            spans.append((kind, size, size + len(value)))
        size += sum(map(len, out[-5:]))
        at = end
    return "".join([*out, text[at:]]), spans


def train(graph: Graph) -> dict[str, np.ndarray]:
    """Pseudo-likelihood weights: features (cell, label), chain and tie (label, label)."""
    weights = {"f": np.zeros((FEATURES, LABELS)), "b": np.zeros(LABELS), "c": np.zeros((LABELS, LABELS)), "t": np.zeros((LABELS, LABELS))}
    n = len(graph.spans)
    if not n:
        return weights
    fixed = np.array(graph.fixed)
    label = np.maximum(fixed, 0)
    # what is tied to recognised data but not under a span may be data: no label to learn from
    root = _tie_groups(n, np.array(graph.ties, np.int64).reshape(-1, 2))
    sure = ((fixed >= 0) | ~np.isin(root, root[fixed > 0]))[:, None]
    one = np.eye(LABELS)[label]
    before, after, tied = np.zeros((n, LABELS)), np.zeros((n, LABELS)), np.zeros((n, LABELS))
    for a, b in graph.chain:
        before[b] += one[a]
        after[a] += one[b]
    for a, b in graph.ties:
        tied[a] += one[b]
        tied[b] += one[a]
    owner = np.repeat(np.arange(n), [len(c) for c in graph.cells])
    cell = np.concatenate([np.array(c) for c in graph.cells])
    rate = 0.3
    squares = {k: np.zeros_like(v) for k, v in weights.items()}
    for _ in range(ROUNDS * 5):
        seen = np.zeros((n, LABELS))
        np.add.at(seen, owner, weights["f"][cell])
        rest = weights["b"] + before @ weights["c"] + after @ weights["c"].T + tied @ weights["t"]
        full, blind = sure * (_softmax(seen + rest) - one), sure * (_softmax(rest) - one)
        both = full + blind
        step = np.zeros_like(weights["f"])
        np.add.at(step, cell, full[owner])
        for k, grad in (
            ("f", step), ("b", both.sum(0)), ("c", before.T @ both + (after.T @ both).T), ("t", tied.T @ both),
        ):
            # steps by each weight's own history, as ties are rare beside tokens
            grad = grad + 0.05 * weights[k]
            squares[k] += grad**2
            weights[k] -= rate * grad / (np.sqrt(squares[k]) + 1e-6)
    weights["t"] = (weights["t"] + weights["t"].T) / 2
    return weights


def posteriors(graph: Graph, weights: dict[str, np.ndarray]) -> np.ndarray:
    """Label probabilities of every token by damped sum-product message passing."""
    n = len(graph.spans)
    unary = np.zeros((n, LABELS))
    if not n:
        return unary
    np.add.at(unary, np.repeat(np.arange(n), [len(c) for c in graph.cells]), weights["f"][np.concatenate([np.array(c) for c in graph.cells])])
    unary += weights["b"]
    fixed = np.array(graph.fixed)
    known = np.flatnonzero(fixed >= 0)
    unary[known] = -60.0
    unary[known, fixed[known]] = 0.0
    pairs = np.array(graph.chain + graph.ties, np.int64).reshape(-1, 2)
    table = np.concatenate([np.repeat(weights["c"][None], len(graph.chain), 0), np.repeat(weights["t"][None], len(graph.ties), 0)])
    # both directions of every edge: message from source to target
    source = np.concatenate([pairs[:, 0], pairs[:, 1]])
    target = np.concatenate([pairs[:, 1], pairs[:, 0]])
    tables = np.concatenate([table, table.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
    messages = np.zeros((len(source), LABELS))
    document = np.array([d for d, _, _ in graph.spans])[source]
    live = np.arange(len(source))  # edges of documents that are not settled
    for _ in range(MOST_SWEEPS):
        if not len(live):
            break
        belief = unary.copy()
        np.add.at(belief, target[live], messages[live])
        out = (belief[source[live]] - messages[back[live]])[:, :, None] + tables[live]
        peak = out.max(1)
        new = _normal(peak + np.log(np.exp(out - peak[:, None, :]).sum(1)))
        change = (1 - DAMPING) * (new - messages[live])
        messages[live] += change
        moving = np.unique(document[live][np.abs(change).max(1) > SETTLED])
        live = live[np.isin(document[live], moving)]
    belief = unary
    np.add.at(belief, target, messages)
    return _softmax(belief)


def new_spans(graph: Graph, chance: np.ndarray, texts: list[str], limits: np.ndarray) -> list[tuple[int, str, int, int]]:
    """(document, kind, begin, end) of runs of tokens that the field adds."""
    out = []
    for run, kind, tied, least in _runs(graph, chance):
        if tied or least >= limits[kind]:
            doc, begin, end = graph.spans[run[0]][0], graph.spans[run[0]][1], graph.spans[run[-1]][2]
            piece = texts[doc][begin:end]
            begin += len(piece) - len(piece.lstrip(_EDGES))
            end -= len(piece) - len(piece.rstrip(_EDGES))
            if begin < end:
                out.append((doc, KINDS[kind - 1], begin, end))
    return out


def _runs(graph: Graph, chance: np.ndarray) -> Iterator[tuple[list[int], int, bool, float]]:
    """Runs of adjoining tokens of one kind: tokens, label, whether tied to a recognised token, and least posterior."""
    label = chance.argmax(1)
    fixed = np.array(graph.fixed)
    free = (fixed < 0) & (label > 0) & (chance[np.arange(len(label)), label] >= STRONG)
    tied = np.zeros(len(label), bool)
    if graph.ties:
        root = _tie_groups(len(label), np.array(graph.ties))
        # a token is supported by a recognised token of its own group and kind
        known = set(zip(root[fixed > 0].tolist(), fixed[fixed > 0].tolist()))
        tied = np.array([(r, k) in known for r, k in zip(root.tolist(), label.tolist())])
    joined = {b for a, b in graph.chain if free[a] and free[b] and label[a] == label[b]}
    run: list[int] = []
    for node in [*np.flatnonzero(free).tolist(), -1]:
        if run and (node < 0 or node not in joined):
            kind = int(label[run[0]])
            yield run, kind, bool(tied[run].any()), float(chance[run, kind].min())
            run = []
        if node >= 0:
            run.append(node)


def untied_limits(weights: dict[str, np.ndarray], sources: list[str], rng: random.Random) -> np.ndarray:
    """Per label, the posterior that at most ``UNTIED_ERROR`` of the made look-alikes reach without a tie."""
    graph, true = Graph(), []
    for number, source in enumerate(sources):
        text, spans = alone(source, base_spans(source), rng)
        graph.add(number, text, [])
        for _, begin, end in graph.spans[len(true) :]:
            true.append(any(a < end and begin < b for _, a, b in spans))
    limits = np.full(LABELS, UNTIED)
    allowed = int(UNTIED_ERROR * true.count(False))
    scores = [(kind, least) for run, kind, _, least in _runs(graph, posteriors(graph, weights)) if not any(true[n] for n in run)]
    for kind in range(1, LABELS):
        wrong = sorted((p for k, p in scores if k == kind), reverse=True)
        if len(wrong) > allowed:
            limits[kind] = max(UNTIED, np.nextafter(wrong[allowed], 2))
    return limits


def _tie_groups(n: int, ties: np.ndarray) -> np.ndarray:
    """Smallest token that each token is tied to, directly or not (documents share none)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[ties[:, 0]], root[ties[:, 1]])
        after = root.copy()
        np.minimum.at(after, ties[:, 0], low)
        np.minimum.at(after, ties[:, 1], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def find(texts: list[str], weights: dict[str, np.ndarray]) -> list[list[tuple[str, int, int, bool]]]:
    """All spans of each text by kind, then begin."""
    graph = Graph()
    found: list[list[tuple[str, int, int, bool]]] = []
    for number, text in enumerate(texts):
        base = base_spans(text)
        found.append([(*s, True) for s in base])
        graph.add(number, text, base)
    if not graph.spans:
        return found
    limits = weights.get("u", np.full(LABELS, 2.0))  # beyond any posterior
    for doc, kind, begin, end in new_spans(graph, posteriors(graph, weights), texts, limits):
        found[doc].append((kind, begin, end, False))
    order = {k: i for i, k in enumerate(KINDS)}
    return [sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])) for spans in found]


# -- the operator -------------------------------------------------------------


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> dict[str, np.ndarray]:
    text = F.col(text_column)
    chosen = sample_rows(docs.select(id_column, text_column), TRAIN_DOCS, id_column, text_column)
    sample = chosen.where(text.rlike("[0-9@]") & (F.length(text) <= TRAIN_CHARS)).select(text).collect()
    graph = Graph()
    rng = random.Random(9)
    for number, source in enumerate([*(r[0] for r in sample), *made_texts(rng, MADE_DOCS)]):
        base = base_spans(source)
        graph.add(number, source, base)
        graph.add(number, *with_repeats(source, base, rng))
        graph.add(number, *alone(source, base, rng))
    weights = train(graph)
    return weights | {"u": untied_limits(weights, made_texts(rng, MADE_DOCS), rng)}


def _finder(weights: dict[str, np.ndarray], text: str, columns: list[str]):
    def spans_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = find(strings(batch.column(text)), weights)
            rows = [[dict(zip(("kind", "start", "end", "base"), s)) for s in spans] for spans in found]
            made = pa.array(rows, _SPAN_ARROW)
            yield pa.RecordBatch.from_arrays([made if c == "spans" else batch.column(c) for c in columns], names=columns)

    return spans_of


def find_pii(docs: DataFrame, weights: dict[str, np.ndarray] | None = None, text_column: str = "text") -> DataFrame:
    """The rows with ``spans``: kind, start and end (code points, end exclusive), and whether a pattern found it."""
    weights = weights or fit(docs, text_column=text_column)
    columns = [c for c in docs.columns if c != "spans"] + ["spans"]
    fields = [docs.schema[c] for c in columns[:-1]] + [T.StructField("spans", T.ArrayType(_SPAN))]
    return docs.mapInArrow(_finder(weights, text_column, columns), T.StructType(fields))


def _masker(weights: dict[str, np.ndarray], text: str):
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            found = find([t or "" for t in texts], weights)
            out = [t if not spans else masked(t, spans) for t, spans in zip(texts, found)]
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return mask


def masked(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with every span replaced by its kind in brackets; of spans that overlap the first names both."""
    out, at = [], 0
    for kind, begin, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= at:
            out += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, weights: dict[str, np.ndarray] | None = None, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with all spans masked in the text."""
    weights = weights or fit(docs, text_column=text_column)
    return docs.mapInArrow(_masker(weights, text_column), docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind of the base spans, their digest, and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [of(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
