import random
import zlib

import numpy as np

from flightlake.llm import bpe, packing

TOKENIZER = bpe.tokenizer_path()


def naive_best_fit(lengths, window):
    rooms, out = [], []
    for length in lengths:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= length]
        room, i = min(fits) if fits else (window, len(rooms))
        if not fits:
            rooms.append(window)
        out.append((room, length))
        rooms[i] -= length
    return len(rooms), sorted(rooms), out


def test_tree_finds_the_tightest_window():
    random.seed(3)
    for window in (7, 16, 100):
        lengths = sorted((random.randint(1, window) for _ in range(400)), reverse=True)
        windows, offsets = packing.best_fit(lengths, window)
        count, rooms, _ = naive_best_fit(lengths, window)
        used = np.bincount(windows, weights=lengths)
        assert len(used) == count and sorted((window - used).astype(int)) == rooms
        for w in range(count):
            spans = sorted((o, n) for o, n, x in zip(offsets, lengths, windows) if x == w)
            assert [o for o, _ in spans] == list(np.cumsum([0] + [n for _, n in spans])[:-1])


def test_pieces_agree_with_the_library():
    random.seed(5)
    alphabet = ["'", "s", "re", "ll", " ", "  ", "\n", "\t", "a", "B", "é", "1", "!", "日", "🙂", "　", "\U000105c0", "<|endoftext|>"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    coder = bpe.PieceEncoder(TOKENIZER)
    ids, bounds = coder.encode(texts)
    want = [e.ids for e in coder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


def test_code_point_classes_agree_with_the_pre_tokenizer():
    pre = bpe.load_tokenizer(TOKENIZER).pre_tokenizer
    table = bpe.code_point_classes()
    for code in [*range(33, 0x3400), *range(0xA000, 0xD800, 7), *range(0xE000, 0x20000, 11)]:
        kind = table[code]
        if kind == bpe.UNKNOWN:
            continue
        c = chr(code)
        ends = {e for _, (_, e) in pre.pre_tokenize_str(f"a{c}1{c}!")}
        if 1 not in ends:
            got = bpe.LETTER
        elif 2 not in ends:
            got = bpe.NUMBER
        elif 4 not in ends:
            got = bpe.OTHER
        else:
            got = bpe.BLANK
        assert got == kind or code == 39, hex(code)


def test_pack_covers_every_id_once(spark):
    coder = bpe.load_tokenizer(TOKENIZER)
    rows = [(1, "hello world " * 900, "x"), (2, None, "x"), (3, "", "x"), (4, "a b c", None), (4, "a b c", None), (5, "zz " * 50, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    got = [r.asDict() for r in packing.pack(docs, window=64).collect()]
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text, _ in rows:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[doc_id], key=lambda r: r["start"])
        if doc_id == 4:
            assert len(pieces) == 2 and all(p["start"] == 0 for p in pieces)
            pieces = pieces[:1]
        assert [p["start"] for p in pieces] == list(np.cumsum([0] + [p["length"] for p in pieces])[:-1])
        for p in pieces:
            part = np.asarray(ids[p["start"] : p["start"] + p["length"]], "<u4")
            assert p["ids_crc32"] == zlib.crc32(part.tobytes()) and p["doc_tokens"] == len(ids)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == list(np.cumsum([0] + [n for _, n in spans])[:-1])
        assert sum(n for _, n in spans) <= 64


def test_pieces_of_one_id_or_none_are_spread_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 100)
    docs = spark.range(900).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7L ELSE id END AS doc_id", "repeat('a b ', CAST(1 + id % 5 AS INT)) AS text"
    )
    got = packing.pack(docs, window=64).collect()
    assert len(got) == 900
    assert sum(r["doc_id"] is None for r in got) == sum(r["doc_id"] == 7 for r in got) == 300
    groups = np.unique([r["sequence_id"] >> 32 for r in got], return_counts=True)[1]
    assert len(groups) == 9 and groups.max() < 200


def test_pack_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs).count() == 0


def test_pieces_met_again_are_kept(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 100)
    coder = bpe.PieceEncoder(TOKENIZER)
    library = bpe.load_tokenizer(TOKENIZER)
    often = " often" + "".join(f" w{chr(97 + k)}é" for k in range(10))
    for k in range(60):
        text = often + "".join(f" x{chr(97 + k % 26)}{chr(97 + j)}{'yz' * (k // 26)}" for j in range(15))
        ids, _ = coder.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(coder.keys) <= 100
        if not k:
            first = coder.calls
    assert coder.calls == first + 59 * 15  # only what is new
