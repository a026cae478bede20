"""Dedup, crawl, aggregates, enrichment and upsert on small hand-made frames."""
import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from quarry.operators import aggregates as A
from quarry.operators import crawl as C
from quarry.operators.dedup import dedup_clean, dedup_raw
from quarry.operators.enrich import enrich_listing
from quarry.operators.upsert import StoredTable, empty_table, merge


def test_dedup_clean_and_raw(spark):
    rows = [(1, "HTTP://A/x", "t", 1.0), (2, "http://a/X ", "t2", 2.0), (3, None, "T ", 5.0),
            (4, "", "t", 5.0), (5, " ", "t", 5.0), (6, None, "u", None)]
    df = spark.createDataFrame(rows, "ordinal long, url string, title string, price double")
    clean = sorted(r.ordinal for r in dedup_clean(df, ("title", "price")).collect())
    assert clean == [1, 3, 6]          # url casefolded; blank urls fall back to (title, price)
    raw = sorted(r.ordinal for r in dedup_raw(df, ("title", "price")).collect())
    assert raw == [1, 2, 3, 4, 5, 6]   # raw keys are case sensitive, ' ' is a url


def test_dedup_stable_under_repartition(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("ordinal"), (F.col("id") % 37).cast("string").alias("url"))
    a = sorted(r.ordinal for r in dedup_clean(df, ()).collect())
    b = sorted(r.ordinal for r in dedup_clean(df.repartition(13), ()).collect())
    assert a == b == list(range(37))


def _pages(spark, rows):
    return spark.createDataFrame(rows, "crawl_id string, page long, signature string, failed boolean, "
                                       "empty boolean, has_next boolean")


def test_crawl_prefix_cars_and_books(spark):
    rows = [("c", 1, "a", False, False, True), ("c", 2, "b", False, False, True), ("c", 3, "a", False, False, True),
            ("c", 4, "d", False, False, False), ("c", 5, "e", False, False, True),
            ("k", 1, "x", False, False, True), ("k", 2, "y", True, False, True), ("k", 3, "z", False, False, True)]
    pages = C.repeated_pages(_pages(spark, rows), usable=~F.col("failed") & ~F.col("empty"))
    cars = sorted((r.crawl_id, r.page) for r in C.crawl_prefix(pages, "cars").collect())
    assert cars == [("c", 1), ("c", 2), ("k", 1)]
    strict = sorted((r.crawl_id, r.page) for r in C.crawl_prefix(pages, "cars", strict=True).collect())
    assert strict == [("c", 1), ("c", 2), ("c", 4), ("c", 5), ("k", 1), ("k", 3)]
    books = sorted((r.crawl_id, r.page) for r in C.crawl_prefix(pages, "books").collect())
    assert books == [("c", 1), ("c", 2), ("c", 3), ("c", 4), ("k", 1)]


def test_signature_order_insensitive(spark):
    cards = spark.createDataFrame([("c", 1, "u1"), ("c", 1, "u2"), ("c", 2, "u2"), ("c", 2, "u1"), ("c", 3, "u1")],
                                  "crawl_id string, page long, v string")
    sig = {r.page: r.signature for r in C.page_signatures(cards, F.col("v")).collect()}
    assert sig[1] == sig[2] != sig[3]


def test_histogram_and_quantiles(spark):
    df = spark.createDataFrame([(float(x), "g" if x < 8 else "h") for x in range(10)], "x double, g string")
    h = {r.bin: r["count"] for r in A.histogram(df, "x", 5).collect()}
    assert h == {0: 2, 1: 2, 2: 2, 3: 2, 4: 2}
    one = A.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 5).collect()
    assert [(r.bin, r["count"]) for r in one] == [(0, 2)]
    box = {r.g: r for r in A.box_stats(df, "g", "x").collect()}
    assert (box["g"].q1, box["g"].median, box["g"].q3) == (1.75, 3.5, 5.25)
    assert (box["h"].q1, box["h"].median, box["h"].q3, box["h"].n) == (8.25, 8.5, 8.75, 2)


def test_quantiles_hot_group_spread(spark):
    # one group holds almost every row; result must equal the exact quantiles
    import numpy as np
    vals = [float((i * 7919) % 1000) for i in range(5000)]
    df = spark.createDataFrame([("hot", v) for v in vals] + [("cold", 1.0)], "g string, v double")
    q = {r.g: r for r in A.box_stats(df, "g", "v").collect()}
    exp = np.quantile(np.array(vals), [0.25, 0.5, 0.75])
    assert [q["hot"].q1, q["hot"].median, q["hot"].q3] == list(exp)


def test_value_counts_and_shares(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string")
    vc = [(r.value, r["count"]) for r in A.value_counts(df, "v").collect()]
    assert vc == [("a", 2), ("Non renseigné", 1), ("b", 1)]
    sh = {r.value: r.share for r in A.shares(df, "v").collect()}
    assert sh["a"] == 0.5


def test_ordered_limit_rules(spark):
    df = spark.range(10).withColumnRenamed("id", "id")
    assert A.ordered_limit(df, "id", 0).count() == 0
    assert A.ordered_limit(df, "id", None).count() == 10
    try:
        A.ordered_limit(df, "id", -1)
        raise AssertionError("negative limit accepted")
    except ValueError:
        pass


def test_enrich_listing(spark):
    cards = spark.createDataFrame(
        [(1, "u1", "card", "£1", "", "2"), (2, None, "nourl", "£2", "x", "1"), (3, "u2", "c2", "£3", "y", None)],
        "ordinal long, url string, title string, price string, availability string, rating string")
    details = spark.createDataFrame(
        [(1, "u1", "detail", "", "", "5", "desc", "Books", "£0", "3", "Poetry", "In stock (3)", True),
         (2, "u2", "ignored", "£9", "z", "4", "d2", "T", "£1", "1", "C", "In", False)],
        "ordinal long, url string, title string, price string, availability string, rating string, description string,"
        " product_type string, tax string, review_count string, category string, info_availability string, ready boolean")
    for c in ("description", "product_type", "tax", "review_count", "category"):
        cards = cards.withColumn(c, F.lit(None).cast("string"))
    out = {r.ordinal: r for r in enrich_listing(cards, details).collect()}
    assert (out[1].title, out[1].price, out[1].availability, out[1].rating) == ("detail", "£1", "In stock (3)", "5")
    assert out[1].category == "Poetry" and out[2].title == "nourl" and out[3].title == "c2"
    assert out[3].description is None


def _batch(spark, rows):
    return spark.createDataFrame(rows, "ordinal long, title string, price string, url string, category string")


def test_upsert_semantics_and_idempotence(spark, tmp_root):
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    b1 = _batch(spark, [(0, "A", "£1", "http://x/1", "c"), (1, "B", "£2", None, "c"), (2, "A2", "£3", "http://x/1", "c")])
    s1 = merge(empty_table(spark, "books"), b1, "books", t0)
    rows = {r.title: r for r in s1.collect()}
    assert set(rows) == {"A2", "B"}                       # last row of a key wins
    assert rows["A2"].id < rows["B"].id                    # id order = first appearance
    b2 = _batch(spark, [(0, "B", None, None, "c"), (1, "C", "£5", "http://x/9", "d")])
    s2 = merge(s1, b2, "books", t1)
    r2 = {r.title: r for r in s2.collect()}
    assert r2["B"].price is None and r2["B"].id == rows["B"].id and r2["B"].created_at == t0
    assert r2["B"].updated_at == t1 and r2["C"].id > max(r.id for r in rows.values())
    s3 = merge(s2, b2, "books", t1)                        # replaying a batch changes nothing
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(s3) == key(s2)


def test_upsert_strict_rejects(spark):
    bad = _batch(spark, [(0, "  ", "£1", None, "c")])
    try:
        merge(empty_table(spark, "books"), bad, "books", dt.datetime(2026, 1, 1))
        raise AssertionError("blank title accepted")
    except ValueError:
        pass


def test_stored_table(spark, tmp_root):
    table = StoredTable(spark, f"{tmp_root}/books", "books")
    assert table.read().count() == 0
    assert table.upsert(_batch(spark, []), dt.datetime(2026, 1, 1)) == 0
    assert table.upsert(_batch(spark, [(0, "A", "£1", "u", "c"), (1, "B", "2", None, "c")]),
                        dt.datetime(2026, 1, 1)) == 2
    assert table.upsert(_batch(spark, [(0, "A", "£7", "u", "c")]), dt.datetime(2026, 1, 2)) == 1
    got = {r.title: r.price for r in table.read().collect()}
    assert got == {"A": 7.0, "B": 2.0}


def test_upsert_ids_unique_with_tied_order(spark, tmp_root):
    rows = [(n % 3, f"T{n}", "1", None, "c") for n in range(40)]
    table = StoredTable(spark, f"{tmp_root}/t", "books", rows_per_part=7)
    table.upsert(_batch(spark, rows), dt.datetime(2026, 1, 1))
    table.upsert(_batch(spark, [(0, f"U{n}", "1", None, "c") for n in range(5)]), dt.datetime(2026, 1, 2))
    assert sorted(r.id for r in table.read().collect()) == list(range(1, 46))


def _parts(root):
    """Ranges of ids and the files they hold."""
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in pathlib.Path(root, "rows").glob("part=*")}


def test_upsert_overwrites_the_ranges_its_keys_lie_in(spark, tmp_root):
    table = StoredTable(spark, f"{tmp_root}/t", "books", rows_per_part=8)
    table.upsert(_batch(spark, [(n, f"T{n}", "1", None, "c") for n in range(30)]), dt.datetime(2026, 1, 1))
    first = _parts(table.root)
    assert set(first) == {f"part={n}" for n in range(4)}                   # ranges grow in number, not in size
    assert table.upsert(_batch(spark, [(0, "T3", "9", None, "c")]), dt.datetime(2026, 1, 2)) == 1
    second = _parts(table.root)
    assert [p for p in sorted(first) if first[p] != second[p]] == ["part=0"]
    table.upsert(_batch(spark, [(n, f"U{n}", "1", None, "c") for n in range(5)]), dt.datetime(2026, 1, 3))
    third = _parts(table.root)
    assert [p for p in sorted(third) if third[p] != second.get(p)] == ["part=3", "part=4"]
    rows = table.read().collect()
    assert sorted(r.id for r in rows) == list(range(1, 36))
    assert {r.title: r.price for r in rows if r.title[0] == "T"} == {f"T{n}": 9.0 if n == 3 else 1.0 for n in range(30)}


def test_upsert_survives_a_write_that_dies(spark, tmp_root, monkeypatch):
    table = StoredTable(spark, f"{tmp_root}/t", "books", rows_per_part=8)
    table.upsert(_batch(spark, [(n, f"T{n}", "1", None, "c") for n in range(20)]), dt.datetime(2026, 1, 1))
    before = sorted(tuple(r) for r in table.read().collect())
    changed = StoredTable._changed

    def die(self, last, batch_time):
        rows = changed(self, last, batch_time)
        return rows.where(F.when(F.col("id") == 3, F.raise_error(F.lit("lost")).cast("boolean")).otherwise(F.lit(True)))
    batch = _batch(spark, [(0, "T2", "9", None, "c"), (1, "T15", "9", None, "c"), (2, "N", "9", None, "c")])
    with monkeypatch.context() as m:
        m.setattr(StoredTable, "_changed", die)
        with pytest.raises(Exception, match="lost"):
            table.upsert(batch, dt.datetime(2026, 1, 2))
    assert sorted(tuple(r) for r in table.read().collect()) == before
    assert table.upsert(batch, dt.datetime(2026, 1, 2)) == 3 and table.read().count() == 21


def test_a_batch_is_merged_once(spark, tmp_root):
    table = StoredTable(spark, f"{tmp_root}/t", "books")
    rows = _batch(spark, [(0, "A", "1", None, "c"), (1, " ", "2", None, "c")])
    assert table.upsert(rows, dt.datetime(2026, 1, 1), strict=False, batch_id=5) == 1
    assert table.upsert(rows, dt.datetime(2026, 1, 2), strict=False, batch_id=5) == 0
    assert table.upsert(rows, dt.datetime(2026, 1, 2), strict=False, batch_id=4) == 1   # an earlier number may come later
    assert table.rejected().count() == 2 and table.read().count() == 1


def test_upsert_keeps_rejected_rows(spark, tmp_root):
    table = StoredTable(spark, f"{tmp_root}/t", "books")
    rows = _batch(spark, [(0, "A", "1", None, "c"), (1, " ", "2", None, "c")])
    assert table.rejected() is None
    try:
        table.upsert(rows, dt.datetime(2026, 1, 1))
        raise AssertionError("blank title accepted")
    except ValueError:
        pass
    assert table.read().isEmpty() and table.rejected() is None and table.upsert(rows, dt.datetime(2026, 1, 1), strict=False) == 1
    assert [r.violations for r in table.rejected().collect()] == [["title_required"]]


def test_missing_page_ends_the_prefix(spark):
    rows = [("c", 1, "a", False, False, True), ("c", 3, "b", False, False, True), ("d", 2, "a", False, False, True)]
    pages = C.repeated_pages(_pages(spark, rows))
    assert [(r.crawl_id, r.page) for r in C.crawl_prefix(pages, "cars").collect()] == [("c", 1)]
    assert [r.crawl_id for r in C.first_page_failed(pages).collect()] == ["d"]
    plan = C.crawl_prefix(pages, "cars")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange REPARTITION") <= 1


def test_box_stats_with_a_hot_value(spark):
    import numpy as np
    vals = [5.0] * 3000 + [float(i) for i in range(3000)]
    df = spark.createDataFrame([("g", v) for v in vals] + [(None, 1.0), ("g", None)], "g string, v double")
    row, = A.box_stats(df, "g", "v").collect()
    assert [row.q1, row.median, row.q3] == list(np.quantile(vals, [0.25, 0.5, 0.75]))
    assert (row.n, row.outliers) == (6000, sum(v > row.upper_fence or v < row.lower_fence for v in vals))


def test_positions_follow_the_order(spark):
    from quarry.operators.ordering import with_position
    df = spark.range(0, 5000, numPartitions=7).withColumn("k", (F.col("id") * 7919) % 5000)
    assert [r.k for r in with_position(df, [F.col("k")], "n").orderBy("n").collect()] == list(range(5000))


def test_kpi_average_has_no_grouping(spark):
    from quarry.functions.fmt import one_decimal
    assert [r[0] for r in spark.createDataFrame([(1234.56,), (0.25,), (None,)], "x double").select(one_decimal("x")).collect()] == ["1234.6", "0.2", "—"]
