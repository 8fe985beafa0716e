import hashlib
import random
import re
from collections import Counter

import pytest

from flightlake.llm import substring_dedup as S

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, width):
    words = {i: WORD.findall(t or "") for i, t in rows}
    seen = Counter(tuple(w[k : k + width]) for w in words.values() for k in range(len(w) - width + 1))
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k : k + width])] > 1:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def answer(frame):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in S.digest(frame).collect()}


@pytest.mark.parametrize("width", [4, 7, 35])
def test_against_every_window(spark, monkeypatch, width):
    monkeypatch.setattr(S.B, "BUCKET_BYTES", 1 << 12)
    random.seed(width)
    vocabulary = ["a", "b", "é", "日本", "x" * 50] + [f"w{i}" for i in range(200)]
    passages = [[random.choice(vocabulary) for _ in range(width + random.randint(-3, 30))] for _ in range(6)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(random.randint(0, 4)):
            if random.random() < 0.5:
                parts += random.choice(passages)
            else:
                parts += [random.choice(vocabulary) for _ in range(random.randint(0, 60))]
        rows.append((i, random.choice([" ", "\n", "\t\x0b"]).join(parts)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "a " * 100), (204, "b " * (width + 1)), (205, "a b " * 40), (206, "é " * width)]
    rows += [(i + 300, t) for i, t in rows[:10]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answer(S.remove_repeats(docs, width)) == brute(rows, width)


def test_other_columns_and_empty_tables(spark):
    schema = "n_words string, doc_id long, text string, block string, data double"
    docs = spark.createDataFrame([("q", 1, "a b c a b c", "z", 1.5), (None, None, None, None, None)], schema)
    got = {r["doc_id"]: r for r in S.remove_repeats(docs, 3).collect()}
    assert got[1]["n_removed"] == 6 and got[1]["kept_text"] == "" and got[1]["block"] == "z" and got[1]["data"] == 1.5
    assert [tuple(x) for x in got[1]["repeats"]] == [(0, 6)]
    assert got[None]["n_words"] == 0 and got[None]["text"] is None
    assert S.remove_repeats(docs.limit(0), 3).count() == 0
