import numpy as np
from tests_support import documents

from quarry.llm import quality as Q
from quarry.llm.registry import QUERIES


def test_linear_time_identity_equals_all_pairs():
    rng = np.random.default_rng(0)
    m = Q.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, Q.FACTORS)), None, None)
    row, feature, value = np.repeat([0, 2], 7), rng.permutation(50)[:14], rng.normal(size=14)
    got, _ = m.score(row, feature, value, 3)
    for r in range(3):
        f, v = feature[row == r], value[row == r]
        want = 0.3 + m.weights[f] @ v + sum(m.factors[f[i]] @ m.factors[f[j]] * v[i] * v[j] for i in range(len(f)) for j in range(i))
        assert abs(got[r] - want) < 1e-9


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    label = {r["doc_id"]: r["quality"] for r in documents(spark, "labels", sf)}
    rows = QUERIES["op4_quality"](spark, sf).collect()
    held = [(r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    bad = [p for p, y in held if y == 0]
    good = [p for p, y in held if y == 1]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert bad.count(0) / len(bad) > 0.9 and good.count(1) / len(good) > 0.97


def test_edge_rows(spark):
    rows = [(1, None, None, "x"), (2, "", 0, "x"), (3, "word " * 50, 250, "x"), (3, "word " * 50, 250, "x"), (None, "### %%%", 7, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, score string")
    labels = spark.createDataFrame([(3, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    out = sorted((r["doc_id"] or 0, r["score"], r["predicted"]) for r in Q.score_quality(docs, Q.learn(docs, labels)).collect())
    assert len(out) == 5 and out[-1] == out[-2] and all(0 <= s <= 1 for _, s, _ in out)
    empty = docs.limit(0)
    assert Q.score_quality(empty, Q.learn(empty, labels)).collect() == []
