"""Crawl prefix and repeated pages against a sequential loop, with one crawl that holds a third of all pages."""
import random

from pyspark.sql import functions as F

from quarry.operators import crawl as C

SCHEMA = "crawl_id long, page long, signature string, failed boolean, empty boolean, has_next boolean"


def sequential(pages, mode, max_pages=None):
    """pages: page -> row.  The loop over page numbers from 1."""
    kept, seen, page = [], set(), 1
    while page in pages and (max_pages is None or page <= max_pages):
        signature, failed, empty, has_next = pages[page]
        if failed or empty or (mode == "cars" and signature in seen):
            break
        seen.add(signature)
        kept.append(page)
        if mode == "books" and not has_next:
            break
        page += 1
    return kept


def crawls():
    rng = random.Random(11)
    out = {}
    for crawl in [*range(60), None]:
        length = rng.choice([1, 2, 5, 61, 62, 63, 124, 200, 400])
        pages = {p: (f"s{rng.randrange(40 * length)}", rng.random() < 0.002, rng.random() < 0.002, rng.random() > 0.004) for p in range(1, length + 1)}
        for gone in rng.sample(sorted(pages), rng.choice([0, 0, 1])):
            del pages[gone]
        out[crawl] = pages
    # A third of all pages, full over more than two levels of segments, then a gap.
    n = 62 * 62 + 62 * 3 + 5
    out[99] = {p: (f"u{p}", False, False, True) for p in range(1, n + 40) if p != n}
    out[100] = {p: (f"u{p}", False, False, True) for p in range(1, 62 * 62 + 1)}
    out[101] = {0: ("x", False, False, True), 2: ("y", False, False, True)}
    return out


def test_prefix_equals_the_sequential_loop(spark):
    made = crawls()
    rows = [(c, p, *r) for c, pages in made.items() for p, r in pages.items()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    marked = C.repeated_pages(df, usable=~F.col("failed") & ~F.col("empty"))
    for mode, pages, cap in (("cars", marked, None), ("books", df, None), ("books", df, 62), ("cars", marked, 3000)):
        got = sorted((-1 if r.crawl_id is None else r.crawl_id, r.page) for r in C.crawl_prefix(pages, mode, max_pages=cap).collect())
        want = sorted((-1 if c is None else c, p) for c, ps in made.items() for p in sequential({k: v for k, v in ps.items() if k >= 1}, mode, cap))
        assert got == want
    assert max(p for c, p in ((r.crawl_id, r.page) for r in C.crawl_prefix(df, "books").collect()) if c == 99) == 62 * 62 + 62 * 3 + 4


def test_no_window_over_a_crawl(spark):
    df = spark.createDataFrame([(1, 1, "a", False, False, True)], SCHEMA)
    marked = C.repeated_pages(df)
    for out in (marked, C.crawl_prefix(marked, "cars"), C.crawl_prefix(df, "books")):
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_repeats_with_nulls_and_pages_held_twice(spark):
    rows = [(1, 1, None, False, False, True), (1, 2, None, False, False, True), (1, 2, "b", False, False, True), (1, 2, "b", False, False, True),
            (None, 1, "a", False, False, True), (None, 3, "a", False, False, True), (2, 1, "c", True, False, True), (2, 2, "c", False, False, True)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r.crawl_id), r.page, str(r.signature), r.repeated) for r in C.repeated_pages(df, usable=~F.col("failed")).collect())
    assert got == sorted([("1", 1, "None", False), ("1", 2, "None", True), ("1", 2, "b", False), ("1", 2, "b", False),
                          ("None", 1, "a", False), ("None", 3, "a", True), ("2", 1, "c", False), ("2", 2, "c", False)])
    assert sorted(r.page for r in C.crawl_prefix(df.where("crawl_id = 1").withColumn("repeated", F.lit(False)), "cars").collect()) == [1, 2, 2, 2]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.crawl_prefix(C.repeated_pages(df), "cars").collect() == []
    assert C.crawl_prefix(df, "books").collect() == []
