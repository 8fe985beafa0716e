import math
import random
from collections import Counter

import numpy as np
import pytest

from flightlake.llm import bpe, lm_score as L


def brute(rows, target):
    coder = bpe.load_tokenizer(bpe.tokenizer_path())
    ids = [coder.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    grams = [list(zip([L.START] + i[:-1], i)) for i in ids]

    def counts(chosen):
        pair, before, one = Counter(), Counter(), Counter()
        for k in chosen:
            for v, w in grams[k]:
                pair[v, w] += 1
                before[v] += 1
                one[w] += 1
        return pair, before, one

    targets = [k for k, (d, _) in enumerate(rows) if d in target]
    size_t, size_b = sum(len(ids[k]) for k in targets), sum(map(len, ids))
    scale = size_t / size_b if size_t else 1.0
    out = []
    for k, (doc_id, _) in enumerate(rows):
        if not ids[k]:
            out.append((doc_id, 0, None, None))
            continue
        both = []
        for chosen, share in ((targets, 1.0), (range(len(rows)), scale)):
            rest = [c for c in chosen if c != k]
            pair, before, one = counts(rest)
            total = sum(len(ids[c]) for c in rest) * share
            loss = 0.0
            for v, w in grams[k]:
                uni = (one[w] * share + 1) / (total + L.VOCABULARY)
                loss -= math.log((pair[v, w] * share + L.PRIOR * uni) / (before[v] * share + L.PRIOR))
            both.append(loss / len(ids[k]))
        out.append((doc_id, len(ids[k]), *both))
    return out


def compare(got, want):
    key = lambda r: (str(r[0]), r[1], round(r[2] or 0, 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        if w[2] is None:
            assert g[2] is g[3] is g[4] is None
        else:
            assert np.allclose(g[2:4], w[2:4], atol=1e-9) and math.isclose(g[4], w[2] - w[3], abs_tol=1e-9)


def test_against_counts_in_memory(spark, monkeypatch):
    monkeypatch.setattr(L.B, "BUCKET_BYTES", 700)
    monkeypatch.setattr(L.B, "BLOCK_BYTES", 900)
    rng = random.Random(3)
    good, bad = ["the", "river", "flows", "calm", "é"], ["BUY", "now", "!!", "cheap", "the"]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "solo"), (5, "the same id again"), (None, "the river"), (None, "the river")]
    target = [(i,) for i in range(60) if i % 3] + [(4,), (4,), (None,), (999,)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS block", "1 AS score").repartition(3)
    got = L.score(docs, spark.createDataFrame(target, "doc_id long"))
    wanted = {t for (t,) in target if t is not None}
    compare([tuple(r) for r in got.collect()], brute(rows, wanted))


@pytest.mark.parametrize("rows", [[(1, "a b"), (2, None)], []])
def test_without_targets(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    compare([tuple(r) for r in L.score(docs, none).collect()], brute(rows, set()))


def test_packed_integers():
    rng = np.random.default_rng(1)
    for values in (np.zeros(0, np.int64), np.array([7]), rng.integers(0, 1 << 32, 500)):
        assert (L.unpack(L.pack(values)) == values).all()
        assert (L.unpack(L.pack(np.sort(values), True), True) == np.sort(values)).all()


def test_texts_are_encoded_once(monkeypatch):
    import pyarrow as pa

    texts = ["the river flows", None, "", "BUY now now now", "the river flows", "é!! <|endoftext|> the"]
    rows = list(enumerate(texts))
    turn = L._ids(bpe.tokenizer_path())
    data = L.B.zstandard.ZstdCompressor().compress(
        L.B.stream_bytes(turn(pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in rows], "text": texts})))
    )
    want = brute(rows, {0, 4})

    def refuse(path):
        raise AssertionError("a text is encoded again")

    monkeypatch.setattr(bpe, "encoder", refuse)
    block = {"block": [7], "data": [data], "chosen": [[0, 4]]}
    (sent,) = L._send(2)(iter([pa.RecordBatch.from_pydict(block)]))
    tables = [t for t in (pa.Table.from_batches([sent]).filter(pa.compute.equal(sent["bucket"], k)) for k in range(2)) if len(t)]
    ones = {f.split(" ")[0]: np.zeros(L.VOCABULARY) for f in L._ONES.split(", ")[1:]}
    totals = []
    for table in tables:
        totals += L._totals(table).select(["bucket", "target", "every"]).to_pylist()
        counted = L._ones(table)
        for name, values in ones.items():
            values[counted["id"].to_numpy()] += counted[name].to_numpy()
    (got,) = L._score(2, ones)(iter([pa.RecordBatch.from_pydict(block | {"totals": [totals]})]))
    compare([tuple(r.values()) for r in got.to_pylist()], want)


def test_runs_of_values():
    rng = np.random.default_rng(5)
    for values in (np.zeros(0, np.int64), np.array([9]), rng.integers(0, 4, 300), rng.integers(0, 1 << 32, 257), np.full(64, (1 << 32) - 1)):
        order, first = L.runs(values)
        assert order.tolist() == np.argsort(values, kind="stable").tolist()
        want, count = np.unique(values, return_counts=True)
        assert first[-1] == len(values) and (values[order[first[:-1]]] == want).all() and (np.diff(first) == count).all()
