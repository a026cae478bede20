import random
import re

import numpy as np
import pyarrow as pa

from quarry.llm import decontam as D
from quarry.llm.registry import QUERIES
from tests_support import SF, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(i or "")
    sizes = {len(w) for w in windows}
    for t in docs:
        w = words(t)
        hit, found = [False] * len(w), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                got = windows.get(tuple(w[k:k + size]))
                if got:
                    found |= got
                    hit[k:k + size] = [True] * size
        yield len(w), sum(hit), sorted(found)


def scanned(docs, items):
    schema = pa.schema([("text", pa.string()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("contaminated", pa.bool_())])
    batch = pa.RecordBatch.from_pylist([{"text": t, "n_words": 0, "n_hit": 0, "items": [], "spans": None, "contaminated": False} for t in docs], schema)
    out = pa.Table.from_batches(D._scan(iter([batch]), D.phrase_block(items), "text", schema)).to_pylist()
    return [(r["n_words"], r["n_hit"], r["items"]) for r in out], out


def test_index_searches_and_locates_like_a_scan():
    rng = np.random.default_rng(3)
    seq = np.concatenate([rng.integers(1, 4, 500), np.tile([2, 3], 80), [0]])
    index = D.FMIndex(seq, 4)
    for _ in range(60):
        k = int(rng.integers(1, 7))
        phrase = rng.integers(1, 4, k)
        lo, hi = index.search(np.concatenate([np.zeros(10 - k, int), phrase])[None], np.array([k]))
        want = [p for p in range(len(seq) - k + 1) if (seq[p:p + k] == phrase).all()]
        assert sorted(index.locate(np.arange(lo[0], hi[0]))) == want


def test_small_cases_equal_brute_force():
    rng = random.Random(5)
    vocab = ["a", "b", "C", "dé", "9x"]
    for _ in range(40):
        items = [(str(i), " ".join(rng.choices(vocab, k=rng.choice([0, 1, 2, 5, 10, 14])))) for i in range(rng.choice([0, 3, 12]))]
        docs = [None, "", "--"] + [rng.choice([" ", ", "]).join(rng.choices(vocab + ["zz", "q"], k=rng.randrange(60))) for _ in range(12)]
        if items:
            docs.append("x " + items[0][1].upper() + "; " + items[-1][1])
        assert scanned(docs, items)[0] == list(brute(docs, items))


def test_spans_cut_from_text():
    assert D.without_spans("One two, three four!", [(1, 3)]) == "One   four!"
    assert D.without_spans(None, []) == ""


def test_query_equals_brute_force(spark):
    docs = documents(spark, "documents")
    items = [(str(r["item_id"]), r["text"]) for r in documents(spark, "benchmark")]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in QUERIES["op1_decontaminate"](spark, SF).collect()}
    want = {d["doc_id"]: (n, h, len(i), h > 0) for d, (n, h, i) in zip(docs, brute([d["text"] for d in docs], items), strict=True)}
    assert got == want and any(w[3] for w in want.values())


def test_blocks_merge_and_edge_rows(spark):
    docs = spark.createDataFrame([(1, "A b c d", "x"), (1, "A b c d", "y"), (None, None, None)], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(1, "a b"), (2, "c D"), (2, "c D"), (None, ""), (4, None)], "item_id long, text string")
    for size in (1, 1 << 20):
        rows = sorted((r["doc_id"] or 0, r["n_hit"], tuple(r["items"]), len(r["spans"])) for r in D.decontaminate(docs, bench, block_bytes=size).collect())
        assert [r[:3] for r in rows] == [(0, 0, ()), (1, 4, ("1", "2")), (1, 4, ("1", "2"))]
    assert not any(r["contaminated"] for r in D.decontaminate(docs, bench.limit(0)).collect())
