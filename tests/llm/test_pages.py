import re

import numpy as np
import pytest
from tests_support import documents

from quarry.llm import pages as P
from quarry.llm.registry import QUERIES


def test_leaves_of_broken_markup():
    got = P.leaves("<div class='ad x'>A &amp; B<p>one<b>two<br>three<p>four</div><ul><li>x<li><a href='>'>y</a></ul><script>var t='</p>';</script>&copy; z<!-- c --> end < 3")
    assert [(x.path, x.text) for x in got] == [
        (("<div", "ad", "x"), "A & B"), (("<div", "ad", "x", "<p"), "onetwo three"), (("<div", "ad", "x", "<p"), "four"),
        (("<ul", "<li"), "x"), (("<ul", "<li", "<a"), "y"), ((), "© z end < 3")]
    assert P.leaves(None) == [] == P.leaves("") == P.leaves("<p> </p>")
    assert P.leaves("<p>" + "<b " * 50)[0].path == ("<p",)


@pytest.mark.parametrize("html", [
    "<html><head><title>T</title><body>A<p>B</p></body></html>",
    "<html><head><meta charset=x><title>T</title><div>A</div><p>B</p>",
    "<svg class='i' viewBox='0 0 1 1'/>A<p>B</p>",
    "<math/>A<p>B</p>",
    "<svg data-x='a>b'/>A<p>B</p><svg><title>T</svg>",
    "<svg><title/><svg><path/></svg>T<style/></svg>A<p>B</p>",
    "<object data=x>A<p>B</p>",
    "<canvas id=x>A<p>B</p><canvas id=y>T</canvas>",
    "<noscript>A<p>B</p>",
    "<div><template>A</div><p>B</p>",
    "<iframe src=x />A<p>B</p><iframe src=y></iframe>",
    "<title-bar>A</title-bar><p>B</p>",
    "<object-x>A</object-x><p>B</p>",
    "<header-x>A</header-x><p>B</p>",
    "<object>T<object>T</object>T</object>A<p>B</p>",
    "<object>A<!-- </object> --><p>B</p><script>'</object>'</script>",
    "A<p>B</p><script>T",
    "A<p>B</p><style>T<p>T",
    "A<p>B</p><title>T",
    "A<p>B</p><textarea>T<p>T",
    "<script>'<svg>'</script foo>A<svg>T</svg ><p>B</p>"])
def test_elements_without_end_tag_cut_nothing_else(html):
    assert [b.text for b in P.leaves(html)] == ["A", "B"]


def test_backpropagation_equals_differences():
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 3, 8])
    z, u, target = rng.normal(size=(8, 4 * P.CELLS)), rng.normal(size=(P.CELLS, 4 * P.CELLS)) * .3, rng.normal(size=(8, P.CELLS))
    for way in P._steps(first):
        keep = []
        P._lstm(z, way, u, keep)
        dz, du = P._lstm_back(target, keep, u)
        for a, g in ((z, dz), (u, du)):
            for _ in range(12):
                k = tuple(rng.integers(s) for s in a.shape)
                old, e = a[k], 1e-5
                a[k] = old + e
                up = (P._lstm(z, way, u) * target).sum()
                a[k] = old - e
                down = (P._lstm(z, way, u) * target).sum()
                a[k] = old
                assert abs((up - down) / (2 * e) - g[k]) < 1e-5


def article(html):
    """What the given pages' one layout says, by plain patterns."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1])
    texts = (" ".join(P.entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_query_on_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    want = {p["page_id"]: article(p["html"]) for p in documents(spark, "pages", sf)}
    rows = QUERIES["op7_extract_main_text"](spark, sf).collect()
    assert sum(r["text"] == want[r["page_id"]] for r in rows) / len(rows) >= 0.99 and all(r["n_chars"] == len(r["text"]) for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    return P.train([p["html"] for p in documents(spark, "pages", "/root/testdata/sf0.01")])


def test_unlike_layouts(model):
    rng = np.random.default_rng(99)
    texts = [f"Some words stand here, number {k}, and they go on for a while until the end." for k in range(30)]
    right = total = 0
    for _ in range(100):
        blocks, labels = P.made_page(rng, texts, ["Home", "About us", "Read more", "Share this"])
        p = P.label_blocks(model, blocks, np.array([0, len(blocks)]))
        right += int(((p >= .5) == np.array(labels)).sum())
        total += len(labels)
    assert right / total > 0.95
    page = ("<html><body><header><div class='logo'>Site</div></header><div class='cookie-notice'>We use cookies, accept them.</div>"
            "<div class='post-content'><h1>A title</h1><p>The first paragraph has a few words, as they do.</p><p>The second goes on, and on.</p></div>"
            "<section class='comments'><div class='comment'><p>I disagree with all of this, really.</p></div></section><aside><p>Related things to read.</p></aside>"
            "<form><label>Your mail</label><button>Send</button></form><footer>&copy; us</footer></body></html>")
    blocks = P.leaves(page)
    p = P.label_blocks(model, blocks, np.array([0, len(blocks)]))
    assert [b.text for b, y in zip(blocks, p, strict=True) if y >= .5] == ["A title", "The first paragraph has a few words, as they do.", "The second goes on, and on."]


def test_edge_rows(spark, model):
    rows = [(1, None, "u"), (2, "", "u"), (3, "<article><p>A b c, d e.</p></article>", "u"), (3, "<article><p>A b c, d e.</p></article>", "u"), (None, "plain", "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = P.extract_main_text(df, model).collect()
    assert len(out) == 5 and [r["text"] for r in out[:2]] == ["", ""] and out[2] == out[3] and set(out[0].asDict()) == {"page_id", "text", "n_chars"}
    assert P.extract_main_text(df.limit(0), P.learn(df.limit(0))).collect() == []
