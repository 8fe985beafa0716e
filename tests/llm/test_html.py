import random
import time

import numpy as np
import pytest

from flightlake.llm import html_text as H
from flightlake.llm.html_blocks import blocks

SF = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_broken_and_odd_markup():
    assert texts("") == [] and texts("plain &amp; text") == ["plain & text"]
    assert texts("<p>a <b>b</b>\n c<p>d<br>e</p>f") == ["a b c", "d e", "f"]
    assert texts('<script>var a="</p>";</script><style>p{}</style><title>t</title><p>x') == ["x"]
    assert texts("<script>never closed <p>x") == []
    assert texts('<p title="a>b">x</p><a href=\'>\'>y</a>') == ["x", "y"]
    assert texts("<!-- <p>no</p> --><!doctype html>yes<!-- open") == ["yes"]
    assert texts("a < b &lt;p&gt; &am") == ["a < b <p> &am"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert [b.path for b in blocks('<div class="x y1" id=z><p><i>a</p></div>b')] == [("div x y 1 z", "p"), ()]
    assert [round(b.linked, 1) for b in blocks("<p><a>abcd</a>efgh</p><p>x</p>")] == [0.5, 0.0]
    assert texts("<p>a" * 3 + "<") == ["a", "a", "a<"]


def test_tags_that_are_never_closed_take_linear_time():
    count = 200_000
    for page, found in (("<div>x" * count, count), ("<font>x<hr>" * count, count), ("</b></i></div>x" * count, count), ("<b><div><i>" * count + "</b>x</i>" * count, 1)):
        began = time.perf_counter()
        assert len(blocks(page)) == found
        assert time.perf_counter() - began < 30
    deep = blocks("".join(f"<div id=n{i}>" for i in range(100)) + "x")[0].path
    assert len(deep) == 64 and deep[0] == "div n 0" and deep[31] == "div n 31" and deep[32] == "div n 68" and deep[-1] == "div n 99"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    weights = H.new_weights(rng)
    x, mask = H._padded(rng.normal(size=(9, H.WIDTH)), [5, 4])
    above = rng.normal(size=(5, 2, H.HIDDEN)) * mask[:, :, None]
    for way in "fb":
        states, tape = H._run(weights, way, x, mask, True)
        grads = {k: np.zeros_like(v) for k, v in weights.items()}
        H._back(weights, way, x, tape, above, grads)
        for key, at in (("x" + way, (3, 7)), ("h" + way, (2, 40)), ("b" + way, (50,))):
            total = []
            for sign in (1, -1):
                weights[key][at] += sign * 1e-5
                total.append((H._run(weights, way, x, mask, False)[0] * above).sum())
                weights[key][at] -= sign * 1e-5
            assert np.isclose((total[0] - total[1]) / 2e-5, grads[key][at], rtol=1e-4, atol=1e-6)


@pytest.fixture(scope="module")
def weights(spark):
    return H.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_held_out_made_pages(spark, weights):
    pages = [r[0] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 2000").limit(120).select("html").collect()]
    rng = random.Random(77)
    right = total = 0
    for page in pages:
        own = blocks(page)
        labels = H.own_labels(own)
        main = [H._escape(b.text) for b, y in zip(own, labels) if y][:20]
        other = [H._escape(b.text) for b, y in zip(own, labels) if not y]
        made = blocks(H.made_page(rng, main, other))
        want = np.array([b.text.startswith(H._MARK) for b in made])
        got = H.label(weights, [[H.Block(b.text.lstrip(H._MARK) or " ", b.path, b.linked) for b in made]])[0]
        right += (got == want).sum()
        total += len(want)
    assert right / total > 0.98


def test_given_pages(spark, weights):
    """Articles of the table: everything between the first heading and the footer."""
    rows = H.extract(spark.read.parquet(f"{SF}/pages.parquet"), weights).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inside = pages[r["page_id"]].partition("<article>")[2].partition("</article>")[0].partition("<footer")[0]
        assert r["text"] == "\n".join(texts(inside))


def test_training_pages_are_drawn_among_usable_ones(spark):
    page = "<nav>menu</nav><article><p>" + "text of the story. " * 8 + "</p></article>"
    rows = [(i, "n", None) for i in range(2000)] + [(5000 + i, "u", page) for i in range(20)]
    rows += [(6000 + i, "u", page * (H.TRAIN_CHARS // len(page) + 1) + str(i)) for i in range(3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = H.training_pages(frame)
    assert sorted(got) == sorted(r[2] for r in rows if r[2])
    assert len(H.training_pages(frame.where("page_id >= 6000"))) == 3


def test_training_sequences_are_whole_pages():
    menu = "".join(f"<li><a href=x>entry {i}</a>" for i in range(70))
    story = "".join(f"<p>Line {i} of the story, and it goes on for a while.</p>" for i in range(40))
    page = f"<ul>{menu}</ul><article>{story}</article><footer>imprint</footer>"
    (rows, labels), *made = H.examples([page])[: 1 + H.MADE_PAGES]
    assert len(labels) == len(rows) == 111 and labels.sum() == 40
    assert all(y.sum() >= 40 for _, y in made)
    without = H.examples([f"<ul>{menu}</ul><p>short"])
    assert len(without) == H.LEAST_EXAMPLES and not any(len(y) == 71 for _, y in without)
    many = H.examples([f"<article>{story * 300}</article>", page])
    assert sum(len(y) for _, y in many[:3]) <= H.TRAIN_BLOCKS and len(many[0][1]) == 111


def test_no_untrained_weights(spark):
    page = "<html><body><nav><ul><li><a href=x>home</a><li><a href=x>help</a></ul></nav><article>{}</article><footer>imprint</footer></body></html>"
    story = ["The river rose in the night and the old bridge did not hold.", "By noon the whole town had come to look at it."]
    html = page.format("".join(f"<p>{t}</p>" for t in story))
    long = spark.createDataFrame([(1, "u", None), (2, "u", "")], "page_id long, url string, html string")
    assert H.main_text(H.fit(long), [html]) == ["\n".join(story)]


def test_odd_rows(spark, weights):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<nav>menu</nav>"), (2, "u", "<p" * 50), (3, "v", "<div>" * 3000 + "deep")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS `a b`")
    got = H.extract(frame, weights)
    assert got.columns == ["page_id", "url", "a b", "text"] and got.count() == 5
    assert {r["text"] for r in got.where("page_id = 1").collect()} == {""}
    assert H.extract(frame.limit(0)).count() == 0
