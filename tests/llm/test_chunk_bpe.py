import hashlib
import random

import numpy as np
import pytest

from flightlake.llm import bpe, chunk_bpe as C

PATH = bpe.tokenizer_path()
PARTS = ["'", "s", "re", "ll", " ", "  ", "\n", "\t ", "ab", "B", "éà", "12", "!?", "日本", "🙂", "　", "\U000105c0", "<|endoftext|>", "word", " the", "xyz" * 40, " \n\n  "]


def random_texts(rng, count, passages, parts=PARTS):
    out = []
    for _ in range(count):
        pieces = []
        for _ in range(rng.randint(0, 5)):
            pieces.append(rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice(parts) for _ in range(rng.randint(0, 60))))
        out.append("".join(pieces))
    return out


@pytest.fixture()
def small_chunks(monkeypatch):
    monkeypatch.setattr(C, "MEAN", 24)
    monkeypatch.setattr(C, "LEAST", 4)
    monkeypatch.setattr(C, "MOST", 90)
    monkeypatch.setattr(C, "ROLL", 6)


def test_joins_are_repaired_whatever_is_known(small_chunks):
    rng = random.Random(8)
    library = bpe.load_tokenizer(PATH)
    tool = C.assembler(PATH)
    for _ in range(25):
        passages = ["".join(rng.choice(PARTS) for _ in range(80)) for _ in range(3)]
        texts = random_texts(rng, 30, passages) + ["", " ", "x" * 500, "é" * 300 + " ", "<|endoftext|>" * 20]
        chunks = C.Chunks(texts)
        known = {}
        for a, b, key in zip(chunks.begins.tolist(), chunks.ends.tolist(), chunks.keys):
            if rng.random() < 0.5:
                known[key.tobytes()] = np.array(library.encode(chunks.joined[a:b], add_special_tokens=False).ids, np.uint32)
        got = tool.encode(chunks, list(range(len(texts))), known)
        assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [tool.decode(g) for g in got] == [library.decode(g.tolist(), skip_special_tokens=False) for g in got]


def test_equal_passages_are_cut_alike():
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(8000))
    chunks = C.Chunks(["some start " + passage, passage, "é" * 700 + passage])
    keys = [set(k.tobytes() for k in chunks.keys[a:b]) for a, b in zip(chunks.first, chunks.first[1:])]
    assert len(keys[0] & keys[1] & keys[2]) >= 8


def test_against_the_library(spark, small_chunks, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(C.B, "BUCKET_BYTES", 4000)
    rng = random.Random(4)
    passages = ["".join(rng.choice(PARTS) for _ in range(60)) for _ in range(4)]
    rows = list(enumerate(random_texts(rng, 60, passages)))
    rows += [(100, None), (101, ""), (102, passages[0]), (102, passages[0]), (None, passages[1] + "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS block", "'k' AS keys").repartition(3)
    docs = C.materialize(docs, "test")
    encoded = C.encode(docs)
    assert encoded.columns == ["doc_id", "text", "block", "keys", "ids", "decoded"]
    library = bpe.load_tokenizer(PATH)
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted((tuple(r) for r in C.digest(encoded).collect()), key=str) == sorted(want, key=str)
    assert C.encode(docs.limit(0)).count() == 0


def test_shared_chunks_are_encoded_once(spark):
    import pyarrow as pa

    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    tables = []
    for block, text in enumerate([passage, passage + " tail", "other " * 50]):
        chunks = C.Chunks([text])
        keys, twice, _ = C.B.distinct(chunks.keys)
        rows = C.B.key_rows(block, keys, twice, 1)
        tables.append(pa.Table.from_batches(list(C.B.emitted(rows, C.B.KEY_NAMES, C.B.KEY_TYPES))))
    states = {r["block"]: np.frombuffer(r["bits"], np.uint8) for r in C._owners(pa.concat_tables(tables)).to_pylist()}
    assert (states[0] == 1).sum() == (states[1] == 2).sum() > 3
    assert (states[2] == 1).sum() == 0 or len(C.Chunks(["other " * 50]).keys) > 1


def test_many_texts_are_decoded_at_once():
    rng = np.random.default_rng(9)
    tool = C.assembler(PATH)
    library = bpe.load_tokenizer(PATH)
    whole = library.encode("é 日本 🙂 plain words", add_special_tokens=False).ids
    cases = [(whole, [0, 0, len(whole), len(whole)]), (whole, range(len(whole) + 1)), ([], [0]), ([], [0, 0, 0])]
    cases += [(rng.integers(0, 50257, 40), [0, 13, 13, 40]) for _ in range(50)]
    for ids, bounds in cases:
        ids, bounds = np.array(ids, np.uint32), np.array(bounds)
        got = tool.decode_texts(ids, bounds)
        got.validate(full=True)
        want = [library.decode(ids[a:b].tolist(), skip_special_tokens=False) for a, b in zip(bounds, bounds[1:])]
        assert got.to_pylist() == want == [tool.decode(ids[a:b]) for a, b in zip(bounds, bounds[1:])]


@pytest.mark.parametrize("width", [1, 2, 6, 7, 16])
def test_rolling_hash_is_that_of_each_window(width):
    values = np.random.default_rng(width).integers(0, 1 << 63, 40, dtype=np.uint64)
    base = 0x9E3779B97F4A7C15
    got = C.rolling_hash(values, width, base).tolist()
    want = [sum(int(v) * base**j for j, v in enumerate(values[i : i + width])) % (1 << 64) for i in range(41 - width)]
    assert got == want and len(C.rolling_hash(values[: width - 1], width, base)) == 0
