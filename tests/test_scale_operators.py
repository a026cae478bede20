"""Clustered listings, pruned key matching, quantile sketches, thinned scatters and counts from footers."""
import datetime as dt
import glob
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quarry.operators import aggregates as A
from quarry.operators import upsert as U
from quarry.operators.keyfilter import key_filter
from quarry.operators.layout import list_rows, write_clustered
from quarry.sources.files import footer_count


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_clustered_listing_opens_few_row_groups(spark, tmp_root):
    rng = random.Random(2)
    rows = [(i, rng.choice("FOP"), rng.choice([None, "1-URGENT", "2-HIGH", "3-MEDIUM", "4-LOW", "5-NONE"]), rng.random() * 1000, dt.date(2026, 1, 1) + dt.timedelta(rng.randrange(300)), rng.random() < 0.5)
            for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, status string, priority string, price double, day date, open boolean")
    columns = ("status", "priority", "price")
    path = write_clustered(df.repartition(4), f"{tmp_root}/clustered", columns, row_group_rows=200)
    table = spark.read.parquet(path)
    out = list_rows(table, {"status": "O", "priority": "3-MEDIUM", "day": None}, "id")
    assert [r.id for r in out.collect()] == [r[0] for r in rows if r[1] == "O" and r[2] == "3-MEDIUM"]
    assert "EqualTo(status,O)" in _plan(out) and table.columns == df.columns
    groups = hit = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            bounds = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            groups += 1
            hit += all(b.has_min_max and b.min <= v <= b.max for b, v in ((bounds["status"], "O"), (bounds["priority"], "3-MEDIUM")))
    assert groups >= 100 and hit < groups / 5
    assert [r.id for r in list_rows(table, {"status": "F"}, "id", 3).collect()] == [r[0] for r in rows if r[1] == "F"][:3]
    empty = write_clustered(df.limit(0), f"{tmp_root}/empty", ("day", "open"))
    assert spark.read.schema(df.schema).parquet(empty).count() == 0


def test_key_filter_loses_no_key_and_passes_few_others(spark):
    for n in (0, 1, 5000):
        keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"))
        test = key_filter(keys, "k")
        probe = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
        passed = {r.k for r in probe.where(test(F.col("k"))).collect()}
        assert {f"k{i}" for i in range(n)} <= passed and None not in passed
        assert len(passed) - n < 0.02 * 40_000


def test_unmatched_target_rows_never_shuffle(spark):
    target = spark.range(30_000).select(F.concat(F.lit("t"), "id").alias("source_key"))
    batch = spark.createDataFrame([("t5",), ("t5",), ("new",), (None,)], "source_key string")
    out = U.match_keys(target, batch, unique=True)
    plan = _plan(out)
    # The rows that pass have no exchange of their own (the filter's words are a subquery); the others meet the batch.
    apart, near = plan[plan.index("Union"):].split("SortMergeJoin")
    assert "hashpartitioning(_t_key" not in apart and "hashpartitioning(source_key" not in apart and "hashpartitioning(_t_key" in near
    got = {r.source_key: (r.in_target, r.in_batch) for r in out.collect() if r.in_batch}
    assert got == {"t5": (True, True), "new": (False, True)}
    assert out.count() == 30_002
    twice = U.match_keys(target.unionByName(target), batch)
    assert twice.count() == 30_002


def test_merge_leaves_unmatched_rows_as_they_are(spark):
    batch = lambda rows: spark.createDataFrame(rows, "ordinal long, title string, price string, url string")
    first = U.merge(U.empty_table(spark, "books"), batch([(i, f"b{i}", "£1", f"http://x/{i}") for i in range(50)]), "books", dt.datetime(2026, 1, 1))
    then = U.merge(first, batch([(0, "b7", "£9", "http://x/7"), (1, "n", "£2", "http://x/n")]), "books", dt.datetime(2026, 1, 2))
    rows = {r.title: r for r in then.collect()}
    assert len(rows) == 51 and rows["b7"].price == 9.0 and rows["b7"].updated_at > rows["b7"].created_at
    assert rows["n"].id == 51 and {r.id for r in rows.values()} == set(range(1, 52))
    assert all(rows[f"b{i}"].updated_at == dt.datetime(2026, 1, 1) for i in range(50) if i != 7)


def test_sketched_quartiles_are_near(spark):
    rng = random.Random(3)
    values = {"hot": [5.0] * 4000 + [rng.gauss(0, 10) for _ in range(6000)], "one": [3.5], "two": [1.0, 2.0]}
    rows = [(g, v) for g, vs in values.items() for v in vs] + [(None, 1.0), ("hot", None), ("hot", float("nan"))]
    out = A.box_sketch(spark.createDataFrame(rows, "g string, v double"), "g", "v", 0.02)
    assert _plan(out).count("Exchange") == 1
    for r in out.collect():
        vs = sorted(values[r.g])
        assert (r.n, r.minimum, r.maximum) == (len(vs), vs[0], vs[-1])
        for q, p in ((r.q1, 0.25), (r.median, 0.5), (r.q3, 0.75)):
            slack = 0.02 * len(vs) + 1
            assert sum(v < q for v in vs) <= p * len(vs) + slack and sum(v <= q for v in vs) >= p * len(vs) - slack
        assert abs(r.upper_fence - (r.q3 + 1.5 * (r.q3 - r.q1))) < 1e-9


def test_a_thinned_scatter_is_bounded_and_counts_all(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 1.0, rng.random() * 50]), rng.random() * 9, f"e{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, x double, y double, note string")
    got = A.scatter_thinned(df, "x", "y", "id", 6, ("note", "absent")).collect()
    assert len(got) <= 36 and sum(r["count"] for r in got) == sum(r[1] is not None for r in rows)
    there = {(x, y, note) for _, x, y, note in rows}
    assert all((r.x, r.y, r.note) in there for r in got) and got[0].asDict().keys() == {"x_cell", "y_cell", "x", "y", "note", "count"}
    flat = A.scatter_thinned(spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 3.0)], "id long, x double, y double"), "x", "y", "id").collect()
    assert [(r.x_cell, r.y_cell, r["count"]) for r in flat] == [(0, 0, 2)]
    assert A.scatter_thinned(df.limit(0), "x", "y", "id").collect() == []


def test_rows_are_counted_from_footers(spark, tmp_root):
    spark.range(0, 1234, numPartitions=3).write.parquet(f"{tmp_root}/t")
    out = footer_count(spark, f"{tmp_root}/t")
    assert "PushedAggregation: [COUNT(*)]" in _plan(out) and out.first()[0] == 1234


def test_aligned_histogram_counts_every_value_once(spark):
    rng = random.Random(6)
    sets = [[rng.gauss(0, 300) for _ in range(3000)] + [-256.0, 0.0, 256.0, 512.0, -0.0], [1e9 + i / 8 for i in range(100)], [7.25], [0.0, 0.0],
            [-1.0, 1.0], [2.0 ** -40, 3.0], [float(i) for i in range(1, 6)] * 3]
    for values in sets:
        for bins in (2, 5, 25):
            rows = [(v,) for v in values] + [(None,), (float("nan"),), (float("inf"),)]
            got = A.histogram_aligned(spark.createDataFrame(rows, "v double"), "v", bins).collect()
            width = got[0].upper - got[0].lower
            assert sum(r["count"] for r in got) == len(values) and got[-1].bin < bins and got[0].bin == 0
            assert [r["count"] for r in got] == [sum(r.lower <= v < r.upper for v in values) for r in got]
            assert all(r.lower / width == int(r.lower / width) for r in got)
            if min(values) < max(values):
                assert max(values) // (width / 2) - min(values) // (width / 2) >= bins
    assert A.histogram_aligned(spark.createDataFrame([], "v double"), "v", 5).collect() == []
