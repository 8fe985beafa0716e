import random
import re

import pytest

from flightlake.llm import ngram_join as J

WORD = re.compile("[^\x20\x09-\x0d]+")


def gram_set(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, size, percent):
    sets = [gram_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows)}


def family(base, copies, edits):
    for _ in range(copies):
        words = list(base)
        for _ in range(random.randint(0, edits)):
            at = random.randrange(len(words))
            kind = random.random()
            if kind < 0.5:
                words[at] = f"e{random.randint(0, 10**6)}"
            elif kind < 0.7:
                words.insert(at, "Extra")
            elif len(words) > 1:
                del words[at]
        yield " ".join(words)


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (1, 90), (2, 60)])
def test_against_all_pairs(spark, monkeypatch, size, percent):
    monkeypatch.setattr(J.B, "BUCKET_BYTES", 1 << 14)
    monkeypatch.setattr(J, "LONG_LIST", 6)
    random.seed(size * percent)
    texts = []
    for length in [2, 4, 6, 8, 9, 11, 15, 18, 20, 21, 22, 25, 33, 60, 150]:
        base = [f"w{random.randint(0, 10**5)}" for _ in range(length)]
        texts += family(base, 14, 3)
    passage = [f"p{i}" for i in range(30)]
    for _ in range(30):
        texts.append(" ".join(passage + [f"u{random.randint(0, 10**6)}" for _ in range(random.choice([1, 3, 40]))]))
    texts += ["a b", "A  b", "a b c", "a", "a a a a a a", "a a a", None, "", " \n "] + texts[:20]
    random.shuffle(texts)
    rows = [(i * 3 + 5, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(docs, size, percent).collect()}
    assert got == brute(rows, size, percent)


def test_boundary_follows_cost():
    assert J.choose_boundary({n: 5 for n in range(1, 60)}, 90) == 19
    assert J.choose_boundary({}, 90) == 0


def test_empty_and_odd_tables(spark):
    docs = spark.createDataFrame([(None, "x y z", 1), (3, None, 2), (3, "x y z", 2), (3, "q", 4)], "doc_id long, text string, n int")
    got = sorted(map(tuple, J.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == [(3, 0, 3), (3, 1, 3), (3, 1, 3), (None, 1, 3)]
    assert J.jaccard_components(docs.limit(0)).count() == 0
