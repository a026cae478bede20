"""Selector engine and page extraction."""
from pyspark.sql import functions as F

from quarry.operators import html as H
from quarry.operators.extract import (ATTR, LAST_TEXT, MAP, Field, Spec, book_cards, book_details, extract,
                                      information_table, sitemap_extract)

PRODUCT = """<html><head><meta name="description" content=" Meta text "><title>T</title></head><body>
<ul class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/b">Books</a></li><li><a href="/p"> Poetry </a></li>
<li class="active">Item</li></ul>
<article class="product_page"><div class="product_main"><h1>A Light &amp; Attic</h1><p class="price_color">£51.77</p>
<p class="instock availability">In stock (22 available)</p><p class="star-rating Three"></p></div>
<div id="product_description"><h2>Product Description</h2></div><p>It's hard.</p>
<table class="table table-striped"><tr><th>UPC</th><td>a897</td></tr><tr><th>Product Type</th><td>Books</td></tr>
<tr><th>Tax</th><td>£0.00</td></tr><tr><th>Number of reviews</th><td>0</td></tr><tr><th></th><td>skip</td></tr>
<tr><th>Tax</th><td>£1.00</td></tr><tr><th>Nothing</th></tr></table></article></body></html>"""

LISTING = """<html><body><ol class="row">
<li><article class="product_pod"><p class="star-rating One"></p><h3><a href="a/b/book_1.html" title="Full Title">Short...</a></h3>
<div class="product_price"><p class="price_color">£10.00</p><p class="instock availability">In stock</p></div></article></li>
<li><article class="product_pod"><h3><a href="book_2.html">Second</a></h3><p class="price_color">£2</p></article></li>
</ol><ul class="pager"><li class="next"><a href="page-2.html">next</a></li></ul></body></html>"""


def test_selectors():
    root = H.parse(PRODUCT)
    assert H.text_first(root, (".product_main h1",)) == "A Light & Attic"
    assert H.text_first(root, ("#product_description + p",)) == "It's hard."
    assert [H.collapse(e.text()) for e in H.select(root, ".breadcrumb li:nth-last-child(2) a")] == ["Poetry"]
    assert H.text_first(root, ("table.table-striped tr:nth-child(2) td",)) == "Books"
    assert H.attribute_first(root, ("meta[name='description']",), "content") == "Meta text"
    assert len(H.select(root, "tr > th, tr > td")) == 13
    assert H.select(root, "p[class*='star']")[0].get("class") == "star-rating Three"


def test_information_table_last_wins():
    info = information_table(H.parse(PRODUCT), ("table.table-striped tr", ".product_page table tr"))
    assert info == {"upc": "a897", "product type": "Books", "tax": "£1.00", "number of reviews": "0"}


def test_unclosed_paragraphs_and_script():
    root = H.parse('<script>var x="</p>";</script><article><p><b>one<br><p>two</p></article>')
    assert [H.collapse(p.text()) for p in H.select(root, "article p")] == ["one", "two"]


def test_book_extraction_jobs(spark):
    pages = spark.createDataFrame([(1, "http://s/cat/page-1.html", LISTING), (2, "http://s/p/x.html", PRODUCT)],
                                  "page_id long, url string, html string")
    d = {r.page_id: r for r in book_details(pages).collect()}
    assert d[1].ready is False and d[1].title is None
    r = d[2]
    assert (r.title, r.price, r.rating, r.product_type, r.tax, r.review_count, r.category) == \
        ("A Light & Attic", "£51.77", 3, "Books", "£1.00", "0", "Poetry")
    assert r.description == "It's hard."
    cards = book_cards(pages.withColumnRenamed("page_id", "page").withColumn("crawl_id", F.lit(0)))
    got = [(c.title, c.card_url, c.rating, c.products_on_page, c.has_next) for c in cards.orderBy("position").collect()]
    assert got == [("Full Title", "http://s/cat/a/b/book_1.html", 1, 2, True),
                   ("Second", "http://s/cat/book_2.html", None, 2, True)]


def test_spec_kinds_and_sitemap(spark):
    html = '<nav><ul><li><a href="/a">A</a></li><li><a href="/b"> </a></li></ul></nav><h1>H</h1>'
    pages = spark.createDataFrame([(1, "https://h.example/x/y?q=1", html), (2, "https://h.example/a", "<title>Linked</title>")],
                                  "page_id long, url string, html string")
    spec = Spec(fields=(Field("last", ("nav a",), LAST_TEXT), Field("first_href", ("nav a",), ATTR, "href", True),
                        Field("info", ("table tr",), MAP)))
    r = {x.page_id: x for x in extract(pages, spec).collect()}[1]
    assert (r.last, r.first_href, r.info) == ("A", "https://h.example/a", {})
    sitemap = {"selectors": [
        {"id": "link", "type": "SelectorLink", "multiple": True, "parentSelectors": ["_root"], "selector": "nav a"},
        {"id": "t", "type": "SelectorText", "parentSelectors": ["link"], "selector": "title"},
        {"id": "h", "type": "SelectorText", "parentSelectors": ["_root"], "selector": "h1"}]}
    rows = sorted((x.link_href, x.t, x.h) for x in sitemap_extract(pages, sitemap).where("page_id = 1").collect())
    assert rows == [("https://h.example/a", "Linked", "H"), ("https://h.example/b", None, "H")]
