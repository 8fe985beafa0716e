"""What workers remember, and how many files (and so processes) small tables take."""

import numpy as np
import pytest

from flightlake.llm import components, quality
from flightlake.llm import words as W


@pytest.fixture
def many_partitions(spark):
    """Shuffles that stay as many partitions as they are."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def counting(monkeypatch, module):
    """(label, number of files) of each table that ``module`` writes."""
    files, write = [], module.materialize

    def counted(df, label):
        out = write(df, label)
        files.append((label, len(out.inputFiles())))
        return out

    monkeypatch.setattr(module, "materialize", counted)
    return files


def test_hashes_of_long_texts_leave_no_long_tables():
    base = 0x1234567890ABCDEF
    values = np.random.default_rng(3).integers(0, 1 << 63, 400_000, dtype=np.uint64)
    begins = np.array([0, 1, 65_535, 65_536, 131_073, 399_990, 400_000])
    ends = np.minimum(begins + 9, len(values))
    mask = (1 << 64) - 1
    wanted = []
    for a, b in zip(begins.tolist(), ends.tolist()):
        h = sum(int(values[i]) * pow(base, i - a, 1 << 64) for i in range(a, b))
        wanted.append((h + (b - a) * 0x9FB21C651E98DF25) & mask)
    assert W.spans_hash(values, begins, ends, base).tolist() == W.mix(np.array(wanted, np.uint64)).tolist()
    assert sum(t.nbytes for k, t in W._powers.items() if k[0] == base) < 2 << 20


def test_rounds_of_few_links_are_few_files(many_partitions, monkeypatch):
    files = counting(monkeypatch, components)
    links = many_partitions.range(400).selectExpr("id AS u", "id + (id % 3) AS v")
    found = components.connected(links)
    roots = {r["node"]: r["root"] for r in found.collect()}
    least = list(range(402))
    for i in range(400):
        a, b = least[i], least[i + i % 3]
        least = [min(a, b) if x in (a, b) else x for x in least]
    assert roots == {n: least[n] for n in roots} and {i for i in range(400) if i % 3} <= set(roots)
    assert len(files) > 1 and max(n for _, n in files[1:]) == 1
    assert found.rdd.getNumPartitions() <= 2


def test_estimates_are_few_files(many_partitions, monkeypatch):
    cores = many_partitions.sparkContext.defaultParallelism
    files = counting(monkeypatch, quality)
    text = "F.concat_ws(' ', transform(sequence(1, 30 + id % 20), x -> concat('w', x * (id + 7) % 61)))".removeprefix("F.")
    docs = many_partitions.range(900).selectExpr("id AS doc_id", f"{text} AS text", "concat('l', id % 60) AS lang", "concat('s', id % 3) AS source")
    assert quality.judge_documents(docs).count() == 900
    small = [n for label, n in files if label in ("estimate", "family")]
    assert len(small) > 5 and max(small) <= cores
