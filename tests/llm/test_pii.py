import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from flightlake.llm import pii

SF = "/root/testdata/sf0.1"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else sum(map(int, str(2 * d))) for i, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def weights(spark):
    return pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_base_spans_against_the_patterns():
    random.seed(1)
    parts = ["a@b.c", "@", "x.y@", "@b", ".d", "é", " ", "-", "+1", "(", ")", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "256.1.1.1", "0001.2.3.4", "12", "555-2485", "\n", "a%b+c@d-e.f.g", "+49 30 1234567", "x", "@@", "1.2.3.4.5"]
    for _ in range(8000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 8)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_are_linear():
    assert pii.base_spans("a" * 300_000 + " @ " + "b" * 300_000 + "@x") == []


def test_long_runs_of_anything_are_linear():
    size = 1_000_000
    for run in ("a" * size, "\u4e2d" * size, "7" * size, "1." * (size // 2), "+1" + "(" * size, ("x" * 999 + " ") * (size // 1000)):
        began = time.perf_counter()
        spans = pii.base_spans(run + " me@example.org 8.8.8.8 end")
        tokens = list(pii.active_tokens(run + " me@example.org 8.8.8.8 end"))
        assert time.perf_counter() - began < 20
        assert ("email", len(run) + 1, len(run) + 15) in spans and ("ip", len(run) + 16, len(run) + 23) in spans
        assert tokens[-2:] == [(len(run) + 1, len(run) + 15), (len(run) + 16, len(run) + 23)]


def test_active_tokens_and_addresses_equal_their_patterns():
    random.seed(3)
    plain = re.compile(r"[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*")
    address = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(random.choice("a1.2@ \n\x0b\u00a0x9") for _ in range(random.randint(0, 40)))
        assert list(pii.active_tokens(text)) == [m.span() for m in plain.finditer(text)]
        assert [m.span() for m in pii._IP.finditer(text)] == [m.span() for m in address.finditer(text)]


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(3)
    graph = pii.Graph()
    graph.spans = [(0, i, i + 1) for i in range(5)]
    graph.cells = [[i] for i in range(5)]
    graph.fixed = [-1, 2, -1, -1, -1]
    graph.chain, graph.ties = [(0, 1), (2, 3)], [(1, 2), (1, 4)]
    w = {"f": rng.normal(size=(pii.FEATURES, 5)), "b": rng.normal(size=5), "c": rng.normal(size=(5, 5)), "t": rng.normal(size=(5, 5))}
    total = np.zeros((5, 5))
    for labels in itertools.product(range(5), repeat=5):
        if labels[1] != 2:
            continue
        energy = sum(w["f"][i, labels[i]] + w["b"][labels[i]] for i in (0, 2, 3, 4))
        energy += sum(w["c"][labels[a], labels[b]] for a, b in graph.chain) + sum(w["t"][labels[a], labels[b]] for a, b in graph.ties)
        for i, k in enumerate(labels):
            total[i, k] += np.exp(energy)
    want = total / total.sum(1, keepdims=True)
    assert np.allclose(pii.posteriors(graph, w), want, atol=1e-3)


def test_messages_reach_the_end_of_long_chains():
    n = 60
    graph = pii.Graph()
    graph.spans = [(0, i, i + 1) for i in range(n)]
    graph.cells = [[0] for _ in range(n)]
    graph.fixed = [2] + [-1] * (n - 1)
    graph.chain, graph.ties = [], [(i, i + 1) for i in range(n - 1)]
    table = 6 * np.eye(5)
    w = {"f": np.zeros((pii.FEATURES, 5)), "b": np.array([1e-3, 0, 0, 0, 0]), "c": np.zeros((5, 5)), "t": table}
    ahead = np.eye(5)[2]
    for _ in range(n - 1):
        ahead = (ahead @ np.exp(table)) * np.exp(w["b"])
        ahead /= ahead.sum()
    assert np.allclose(pii.posteriors(graph, w)[-1], ahead, atol=1e-2)


def test_repeats_are_tied_to_the_recognised_one():
    text = "call +1 (988) 555-2485 " + "or 555-2485 now " * 40
    graph = pii.Graph()
    graph.add(0, text, pii.base_spans(text))
    known = {n for n, k in enumerate(graph.fixed) if k > 0}
    tied = {b for a, b in graph.ties if a in known}
    assert len(tied - known) == 40


def test_repeats_in_another_form_are_added(weights):
    text = "call +1 (988) 555-2485 now. Later, 988 555-2485, or (988) 555-2485 again. Born 1999, item 4471, section 12."
    found = pii.find([text], weights)[0]
    base = [s[:3] for s in found if s[3]]
    added = [text[a:b] for _, a, b, known in found if not known]
    assert base == plain(text) and len(added) == 2 and all("555-2485" in t for t in added)
    lone = "Born 1999, item 4471 of 555-2485, section 12, (2019) and 4111111111111112."
    assert pii.find([lone], weights)[0] == []


@pytest.mark.parametrize("first, again", [
    ("+1 988 555 2485", "988-555-2485"),
    ("+1-988-555-2485", "988 555 2485"),
    ("+19885552485", "988-555-2485"),
    ("+44 20 7946 0958", "020 7946 0958"),
    ("+44 20 7946 0958", "02079460958"),
    ("4111 1111 1111 1111", "4111.1111.1111.1111"),
    ("4111-1111-1111-1111", "4111  1111  1111  1111"),
    ("8.8.8.8", "8-8-8-8"),
])
def test_joint_keys_tie_spaced_and_hyphenated_forms(weights, first, again):
    text = f"Write to {first} today. Later on it was {again} that they had. Born 1999, item 4471, section 12."
    begin = text.index(again)
    added = [(a, b) for _, a, b, known in pii.find([text], weights)[0] if not known]
    assert added == [(begin, begin + len(again))]


def test_documents_without_a_pattern_hit_are_searched(weights):
    for data in ("(988) 555-2485", "anna.lo@mailhost", "4111_1111_1111_1111", "4111.1111.1111.1111"):
        text = f"reach it by {data} any time, " * 2
        assert not pii.base_spans(text)
        assert [text[a:b] for _, a, b, _ in pii.find([text], weights)[0]] == [data, data]
    plain = "Born 1999, item 4471, section 12, (2019), 2019-03-04 12:30:11, order 1234567890, 4111111111111112, v1.20.3, $12,345.00 @ 3"
    assert pii.find([plain], weights)[0] == []


def test_query_columns_and_odd_rows(spark, weights):
    rows = [(1, None), (2, ""), (3, "mail a.b@c.de, host 10.0.0.1 card 4111-1111-1111-1111"), (3, "é 10.0.0.1"), (None, "+49 30 1234567")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS start")
    got = pii.digest(pii.find_pii(docs, weights)).collect()
    assert len(got) == 5
    for r, (doc_id, text) in zip(sorted(got, key=lambda r: (r["doc_id"] or 9, r["spans"])), sorted(rows, key=lambda r: (r[0] or 9, r[1] != rows[2][1]))):
        joined = ",".join(":".join(map(str, s)) for s in plain(text or ""))
        assert r["doc_id"] == doc_id and r["spans"] == joined and r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    masked = {r["text"] for r in pii.mask_pii(docs, weights).collect()}
    assert "mail [EMAIL], host [IP] card [CARD]" in masked and None in masked and "é [IP]" in masked
    assert pii.find_pii(docs.limit(0)).count() == 0
