from urllib.parse import urljoin

from pyspark.sql import functions as F

from quarry.operators.markup import absolute

BASES = ["http://a/b/c/d;p?q", "https://shop.example/list/page-2.html#top", "http://host", "http://host?x=1", "https://h.example:8080/a/b/"]
LINKS = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "g;x?y#s", "", ".", "./", "..", "../", "../g", "../..", "../../",
         "../../g", "../../../g", "../../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g;x=1/../y",
         "g?y/./x", "g?y/../x", "g#s/./x", "g#s/../x", "/list?page=2", "/a/./b/../c", "é/ü?ß", "page-3.html", "mailto:a@b.example", "https://other.example/x?y#z",
         "//cdn.example/i.png"]


def test_links_resolve_like_the_standard_library(spark):
    rows = [(b, x, urljoin(b, x)) for b in BASES for x in LINKS]
    df = spark.createDataFrame(rows, "base string, link string, want string")
    got = df.select("*", absolute(F.col("link"), F.col("base")).alias("got")).collect()
    # The library keeps the fragment of the page for an empty link, a browser does not.
    wrong = [tuple(r) for r in got if r["got"] != (r["want"] if r["link"] else r["want"].split("#")[0])]
    assert not wrong


def test_null_links_null_bases_and_white_space(spark):
    rows = [(None, "http://h/a"), ("x", None), ("/x", None), (" ../x\n", "http://h/a/b")]
    df = spark.createDataFrame(rows, "link string, base string")
    got = [r[0] for r in df.select(absolute(F.col("link"), F.col("base"))).collect()]
    assert got == [None, "x", "/x", "http://h/x"]
    assert df.limit(0).select(absolute(F.col("link"), F.col("base"))).collect() == []
