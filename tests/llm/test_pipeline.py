import random
import re

import corpus_pipeline as P
from flightlake.llm import bpe, pii
from tests.llm.test_ngram_join import brute as near_groups
from tests.llm.test_packing import naive_best_fit
from tests.llm.test_quality import base as base_counts
from tests.llm.test_substring_dedup import WORD

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def documents():
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("lo", "mi", "ra", "te", "nu") for b in ("sa", "den", "mor", "lik", "vu", "po")]

    def prose(n):
        return " ".join((rng.choice(words).title() if k % 9 == 0 else rng.choice(words)) + ("." if k % 9 == 8 else "") for k in range(n))

    texts = [prose(rng.randint(30, 120)) for _ in range(260)]
    for i in range(12):  # near copies
        copy = texts[i].split()
        copy[3] = "changed"
        texts.append(" ".join(copy) if len(copy) > 60 else texts[i])
    passage = prose(45)
    texts += [prose(40) + " " + passage + " " + prose(40) for _ in range(4)]
    texts += [prose(40) + " write to a.b@mail.example.com or call +1 (988) 555-2485, later 988 555-2485. " + prose(30)]
    texts += [" | ".join(prose(40).split()), " ".join(w + "%%%" for w in prose(50).split()), "x y " * 40, "short", "", None]
    return [(i, t, "en", "s1", len(t or ""), f"e{i}") for i, t in enumerate(texts)]


def test_stages_against_brute_force(spark):
    docs = spark.createDataFrame(documents(), COLUMNS).repartition(3)
    stages = dict(P.STAGES)

    good = P.materialize(stages["quality rules"](spark, docs, ""), "test")
    assert good.columns == docs.columns
    rows = {r["doc_id"]: r for r in good.collect()}
    clean = [i for i, t, *_ in documents()[:277] if not base_counts(t)[-1]]
    assert set(clean) <= set(rows) and not {277, 278} & set(rows) - {277}
    assert all(not base_counts(r["text"])[-1] for r in rows.values())
    assert not any("%%%" in r["text"] or " | " in r["text"] for r in rows.values())

    single = P.materialize(stages["near duplicates"](spark, good, ""), "test")
    assert single.columns == docs.columns
    groups = near_groups([(i, r["text"]) for i, r in sorted(rows.items())], 5, 80)
    assert {r["doc_id"]: r for r in single.collect()} == {i: rows[i] for i in rows if groups[i][1] == i}
    assert single.count() < good.count()

    cleaned = P.materialize(stages["substring dedup"](spark, single, ""), "test")
    assert cleaned.columns == docs.columns
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    seen = {}
    for i, t in before.items():
        w = WORD.findall(t)
        for k in range(len(w) - 34):
            seen.setdefault(tuple(w[k : k + 35]), []).append((i, k))
    gone = {}
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                gone.setdefault(i, set()).update(range(k, k + 35))
    after = {r["doc_id"]: r for r in cleaned.collect()}
    assert len(gone) == 4
    for i, t in before.items():
        want = t if i not in gone else " ".join(w for k, w in enumerate(WORD.findall(t)) if k not in gone[i])
        assert after[i]["text"] == want and after[i]["n_chars"] == len(want) and after[i]["extra"] == f"e{i}"

    hidden = P.materialize(stages["personal data"](spark, cleaned, ""), "test")
    assert hidden.columns == docs.columns
    masked = {r["doc_id"]: r["text"] for r in hidden.collect()}
    touched = [i for i in masked if masked[i] != after[i]["text"]]
    assert len(touched) == 1 and re.search(r"write to \[EMAIL\] or call \[PHONE\], later (\[PHONE\]|988 555-2485)\.", masked[touched[0]])
    assert not any(pii.base_spans(t) for t in masked.values())

    packed = [r.asDict() for r in stages["packing"](spark, hidden, "").collect()]
    coder = bpe.load_tokenizer(bpe.tokenizer_path())
    sizes = {i: len(coder.encode(t, add_special_tokens=False).ids) + 1 for i, t in masked.items()}
    total = {}
    for r in packed:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == sizes
    pieces = sorted((r["length"] for r in packed), reverse=True)
    assert len({r["sequence_id"] for r in packed}) == naive_best_fit(pieces, 2048)[0]


def test_repeats_in_other_forms_are_masked(spark):
    forms = ["988 555 2485", "988-555-2485", "(988) 555-2485"]
    rng = random.Random(3)
    rows = [(i, f"river stone call +1 (988) 555-{2400 + i} garden light walk item {rng.randint(1, 999)} house", None, None, 0, "") for i in range(60)]
    rows += [(100 + i, f"call +1 (988) 555-2485 now, later on {f} or so", None, None, 0, "") for i, f in enumerate(forms)]
    hidden = dict(P.STAGES)["personal data"](spark, spark.createDataFrame(rows, COLUMNS), "")
    got = {r["doc_id"]: r["text"] for r in hidden.collect()}
    assert all(got[100 + i] == "call [PHONE] now, later on [PHONE] or so" for i in range(len(forms)))


def test_empty_documents(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, ""), "test")
    assert docs.count() == 0


def test_null_and_repeated_rows_pass_through(spark):
    rows = [(1, None, None, None, None, None), (None, "a b c " * 9, "en", None, 3, "x"), (None, "a b c " * 9, "en", None, 3, "x"), (7, " ", "", "", 1, "")]
    docs = spark.createDataFrame(rows, COLUMNS)
    names = [n for n, _ in P.STAGES]
    for name, left in (("near duplicates", 3), ("substring dedup", 4), ("personal data", 4)):
        out = P.STAGES[names.index(name)][1](spark, docs, "")
        assert out.count() == left and out.columns == docs.columns
