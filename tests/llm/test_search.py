import math
import random

from tests_support import SF, documents

from quarry.llm import search
from quarry.llm.registry import QUERIES

LONG = 2**63 - 1


def brute(rows, every=100, k=10):
    """rows: (id, vector); queries that repeat an id with other components are ranked apart."""
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(1024 * x) for x in v)]
    out, seen = [], set()
    for i, q in usable:
        if i % every or (i, tuple(q)) in seen:
            continue
        seen.add((i, tuple(q)))
        scores = sorted((-max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(q, v, strict=True)))), j) for j, v in usable if j != i and len(v) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in df.collect())


def test_query_equals_brute_force(spark):
    assert found(QUERIES["op13_exact_top_k"](spark, SF)) == brute([(r["vec_id"], r["embedding"]) for r in documents(spark, "embeddings")])


def test_groups_shares_and_blocks(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(19)]) for i in range(700)]
    df = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<float>, Share int").repartition(6)
    got = search.exact_top_k(df, df.filter("vec_id % 10 = 0"), group_queries=9, share_rows=40)
    assert found(got) == brute(rows, 10)


def test_bad_vectors_lengths_repeats_and_giants(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0]), (200, []), (300, None), (400, [nan, 1.0]), (500, [None, 1.0]), (600, [inf, 0.0]), (None, [1.0, 1.0]),
            (1, [0.25, -3.0]), (2, [0.25, -3.0]), (2, [0.25, -3.0]), (3, [1e30, 1e30]), (4, [-1e200, 7.0]), (5, [4.0]), (6, []), (7, [1e307, 1e308]), (-100, [0.5, 0.5]),
            (700, [1.0, 0.0]), (700, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(search.exact_top_k(df, df.filter("vec_id % 100 = 0")))
    assert got == brute(rows)


def test_a_third_of_all_rows_are_one_vector(spark):
    rows = [(i, [0.5, -0.25, 0.125]) if i % 3 else (i, [i / 7.0, 1.0, -i / 9.0]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(search.exact_top_k(df, df.filter("vec_id % 100 = 0"))) == brute(rows)


def test_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    assert search.exact_top_k(df.limit(0), df).collect() == []
    assert search.exact_top_k(df, df.limit(0)).collect() == []
    assert search.exact_top_k(df, df).collect() == []
