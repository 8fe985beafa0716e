import hashlib
import random
import re

import pytest

from flightlake.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(len(w), width)
        for k in range(len(w) - size + 1):
            if size:
                windows.setdefault(tuple(w[k : k + size]), set()).add("" if item is None else str(item))
    sizes = {len(g) for g in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                names = windows.get(tuple(w[k : k + size]))
                if names:
                    hit.update(range(k, k + size))
                    found |= names
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def made(seed, letters=12, short=True):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(letters)] + ["é", "日本", "A1"]

    def some(least, most):
        return [random.choice(vocabulary) for _ in range(random.randint(least, most))]

    items = [(i, some(0 if short else 10, 40)) for i in range(40)]
    items += [(100, items[3][1]), (3, some(12, 15)), (None, some(11, 12)), (200, items[5][1] + items[6][1])]
    docs = []
    for i in range(150):
        parts = []
        for _ in range(random.randint(0, 5)):
            if random.random() < 0.4:
                source = random.choice(items)[1]
                a = random.randint(0, len(source))
                parts += source[a : a + random.randint(0, 30)]
            else:
                parts += some(0, 30) + ["unknown"] * random.randint(0, 2)
        docs.append((i, random.choice([" ", "-", "!\n"]).join(parts)))
    docs += [(500, None), (501, ""), (502, " -- "), (503, docs[5][1]), (503, docs[5][1]), (None, "w1 " * 3000)]
    return docs, [(i, None if w is None else ". ".join(w)) for i, w in items] + [(300, None), (301, ""), (302, "--")]


@pytest.mark.parametrize("seed,letters,short,size", [(1, 3, True, 1 << 20), (2, 40, False, 1 << 20), (3, 8, True, 300), (4, 400, False, 2000)])
def test_against_every_window(spark, monkeypatch, seed, letters, short, size):
    monkeypatch.setattr(D, "AUTOMATON_BYTES", size)
    monkeypatch.setattr(D, "PIECE_WORDS", 16 if size < 1000 else 4096)
    docs, items = made(seed, letters, short)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = D.digest(D.find_items(frame, spark.createDataFrame(items, "item_id long, text string")))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items, 10)


def test_longest_match_and_automaton():
    random.seed(0)
    items = tuple((str(i), " ".join(random.choice("abc") for _ in range(random.randint(1, 25)))) for i in range(30))
    known = D.Items(items, 4)
    assert len(known.automaton.size) <= 2 * sum(len(t.split()) for _, t in items) + 1
    text = [random.choice("abcd") for _ in range(400)]
    joined = [f" {t} " for _, t in items]
    _, sizes = known.automaton.stream([known.words.get(w.encode(), -1) for w in text])
    for i, size in enumerate(sizes):
        longest = next((k for k in range(i + 1, 0, -1) if any(f" {' '.join(text[i + 1 - k : i + 1])} " in t for t in joined)), 0)
        assert size == longest


def test_spans_are_cut(spark):
    item = "One two three four five six seven eight nine ten eleven"
    docs = [(1, f"Start, here: {item}! And many more words follow after the passage so that little of it is hit, é.", "x", 9, "q")]
    docs += [(2, item.upper(), None, 1, "q"), (3, "clean text", None, 2, "q"), (4, None, None, 3, "q")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, items string, LONGEST int, raw string")
    got = {r["doc_id"]: r for r in D.remove_items(frame, spark.createDataFrame([("a,b", item)], "item_id string, text string")).collect()}
    assert got[1]["text"] == "Start, here: ! And many more words follow after the passage so that little of it is hit, é."
    assert got[1]["items"] == ["a,b"] and got[1]["longest"] == 11 and [tuple(s) for s in got[1]["spans"]] == [(2, 11)]
    assert got[2]["text"] == "" and got[3]["text"] == "clean text" and got[4]["text"] is None and got[4]["raw"] == "q"


def test_empty_tables_and_long_words(spark):
    docs = spark.createDataFrame([(1, "x" * 300_000 + " b"), (2, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in D.digest(D.find_items(docs, none)).collect()] == [0, 0]
    long = spark.createDataFrame([(7, "X" * 300_000), (8, "y " * 50_000)], "item_id long, text string")
    got = {r["doc_id"]: r["n_hit"] for r in D.digest(D.find_items(docs, long)).collect()}
    assert got == {1: 1, 2: 0}
    assert D.find_items(docs.limit(0), long).count() == 0
