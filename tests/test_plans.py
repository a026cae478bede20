"""Cleaning plans, stream == batch, runs, and the oracle check of every
registered query on the smallest driver tables."""
import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from quarry import schema as S
from quarry.plans import bindings as B
from quarry.plans import catalog
from quarry.plans.clean import clean_books, clean_cars


def test_clean_books_idempotent_on_typed(spark):
    raw = B.raw_books(spark, SF_SMALL)
    once = clean_books(raw)
    twice = clean_books(once)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(once) == key(twice)


def test_clean_cars_ranges(spark):
    out = clean_cars(B.raw_cars(spark, SF_SMALL), max_year=2027)
    bad = out.where((F.col("year") < 1886) | (F.col("year") > 2027) | (F.col("price") < 0)
                    | (F.col("source_page") < 1)).count()
    assert bad == 0 and out.count() > 0


def test_stream_equals_batch(spark, tmp_root):
    from quarry.operators.upsert import StoredTable
    from quarry.streaming.ingest import batch_equivalent, ingest
    raw = B.raw_books(spark, SF_SMALL)
    raw.write.parquet(f"{tmp_root}/drop")
    t = dt.datetime(2026, 8, 18)
    ingest(spark, "books", f"{tmp_root}/drop", S.RAW_BOOK_SCHEMA, f"{tmp_root}/work", f"{tmp_root}/table",
           batch_time=t)
    assert ingest(spark, "books", f"{tmp_root}/drop", S.RAW_BOOK_SCHEMA, f"{tmp_root}/work",
                  f"{tmp_root}/table", batch_time=t) == 0          # nothing new: no-op
    stored = StoredTable(spark, f"{tmp_root}/table", "books").read()
    from quarry.operators.upsert import empty_table, merge
    expected = merge(empty_table(spark, "books"), batch_equivalent(raw, "books"), "books", t, strict=False)
    key = lambda df: sorted(tuple(r) for r in df.drop("id").collect())
    assert key(stored) == key(expected)


def _key(df):
    return sorted(tuple(r) for r in df.drop("id").collect())


def test_stream_loses_nothing_when_it_dies_between_stage_and_merge(spark, tmp_root):
    from quarry.operators.upsert import StoredTable
    from quarry.streaming.ingest import ingest, stage
    raw = B.raw_books(spark, SF_SMALL)
    t = dt.datetime(2026, 8, 18)
    for name, die in (("plain", False), ("died", True)):
        root = f"{tmp_root}/{name}"
        for n in range(2):
            raw.where(F.col("ordinal") % 2 == n).write.mode("append").parquet(f"{root}/drop")
            if die:  # the process ends after staging; the next call must merge what it left
                stage(spark, "books", f"{root}/drop", S.RAW_BOOK_SCHEMA, f"{root}/work/staging", f"{root}/work/checkpoint")
            else:
                ingest(spark, "books", f"{root}/drop", S.RAW_BOOK_SCHEMA, f"{root}/work", f"{root}/table", batch_time=t)
        ingest(spark, "books", f"{root}/drop", S.RAW_BOOK_SCHEMA, f"{root}/work", f"{root}/table", batch_time=t)
    stored = [StoredTable(spark, f"{tmp_root}/{n}/table", "books") for n in ("plain", "died")]
    assert _key(stored[0].read()) == _key(stored[1].read()) != []
    bad = [sorted(r.ordinal for r in s.rejected().collect()) for s in stored]
    assert bad[0] == bad[1] and len(set(bad[0])) == len(bad[0]) > 0


def test_stream_merges_again_when_it_dies_before_the_mark(spark, tmp_root, monkeypatch):
    from quarry.operators.upsert import StoredTable
    from quarry.streaming.ingest import ingest
    raw = B.raw_books(spark, SF_SMALL)
    raw.write.parquet(f"{tmp_root}/drop")
    args = (spark, "books", f"{tmp_root}/drop", S.RAW_BOOK_SCHEMA, f"{tmp_root}/work", f"{tmp_root}/table")

    def die(self, batch_id):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(StoredTable, "_mark", die)
        with pytest.raises(OSError):
            ingest(*args)
    table = StoredTable(spark, f"{tmp_root}/table", "books")
    assert table.merged().isEmpty()
    once, bad = sorted(tuple(r) for r in table.read().collect()), table.rejected().count()
    n = ingest(*args)
    assert n > 0 and ingest(*args) == 0 and table.merged().count() == 1
    assert sorted(tuple(r) for r in table.read().collect()) == once and table.rejected().count() == bad


def test_stream_without_files_merges_nothing(spark, tmp_root):
    from quarry.streaming.ingest import ingest
    B.raw_books(spark, SF_SMALL).limit(0).coalesce(1).write.parquet(f"{tmp_root}/drop")
    assert ingest(spark, "books", f"{tmp_root}/drop", S.RAW_BOOK_SCHEMA, f"{tmp_root}/work", f"{tmp_root}/table") == 0


def test_run_validation(spark):
    from quarry.plans.runs import validate
    with pytest.raises(ValueError):
        validate("books", 51)
    with pytest.raises(ValueError):
        validate("cars", 0)
    with pytest.raises(ValueError):
        validate("boats", 1)


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


ORACLE = sorted(catalog.oracle_sql())
SLOW = {"a3_csv_fallback", "a4_json_auto", "a11_csv_sink"}


@pytest.mark.parametrize("name", [n for n in ORACLE if n not in SLOW])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in B.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = catalog.REGISTRY[name].run(spark, SF_SMALL)
    cur = con.execute(catalog.REGISTRY[name].sql)
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    sorder = [sdf.columns.index(ocols[i]) for i in order]
    got = sorted((tuple(_norm(r[i]) for i in sorder) for r in sdf.collect()), key=repr)
    exp = sorted((tuple(_norm(r[i]) for i in order) for r in cur.fetchall()), key=repr)
    assert got == exp


def test_dashboard_bundles(spark):
    from quarry.plans.dashboard import books_bundle, cars_bundle
    books = clean_books(B.raw_books(spark, SF_SMALL)).drop("ordinal")
    bundle = books_bundle(books)
    kpi = bundle["kpis"].first()
    n = bundle["filtered"].count()
    assert kpi.total_books == n > 0
    assert sum(r["count"] for r in bundle["category_counts"].collect()) == n
    assert abs(sum(r.share for r in bundle["availability_shares"].collect()) - 1.0) < 1e-9
    assert bundle["price_box"].count() > 0 and bundle["rating_histogram"].count() > 0
    cars = cars_bundle(clean_cars(B.raw_cars(spark, SF_SMALL), max_year=2027).drop("ordinal"))
    assert cars["top_brands"].count() <= 20 and cars["kpis"].first().total_ads == cars["filtered"].count()
