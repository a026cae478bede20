import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tests_support import SF, documents

from quarry.llm import suffix as S
from quarry.llm.registry import QUERIES


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(x[i:i + length] for x in raw for i in range(len(x) - length + 1))
    for x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        yield len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def test_sorted_groups_equal_a_dictionary():
    rng = np.random.default_rng(1)
    for length in (20, 33, 47, 64):
        raw = np.concatenate([np.tile(rng.integers(0, 3, 90), 3), np.zeros(150, int), rng.integers(0, 2, 200)]).astype(np.uint8)
        starts = np.arange(len(raw) - length + 1)
        group = np.sort(rng.integers(0, 3, len(starts)))
        keys = [(g, raw[s:s + length].tobytes()) for g, s in zip(group, starts, strict=True)]
        count = Counter(keys)
        assert S.repeated_suffixes(raw, starts, group, length).tolist() == [count[k] > 1 for k in keys]


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    part = rng.integers(97, 100, 400).astype(np.uint8)
    raw = np.concatenate([rng.integers(97, 123, 77).astype(np.uint8), part, rng.integers(97, 123, 50).astype(np.uint8), part])
    _, first, n, anchor, _ = S.anchored(raw, np.array([0, len(raw)]), 60)
    owner = np.repeat(anchor, n)
    assert n.sum() == len(raw) - 59 and (np.diff(first) == n[:-1]).all()
    assert (owner[77:77 + 341] == owner[527:527 + 341]).all()


@pytest.mark.parametrize("hot", [0, 20000])
def test_rows_equal_brute_force(spark, hot):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randrange(1, 7)))
    passage = " ".join(word() for _ in range(60))
    texts = [None, "", "short", "x" * 500, "ab" * 150 + "é" * 90, passage]
    for _ in range(40):
        own = " ".join(word() for _ in range(rng.randrange(120)))
        cut = rng.randrange(len(passage))
        texts.append(own + rng.choice(["", passage, passage[cut:], passage[:cut]]) + word())
    texts += [texts[10], texts[11] + "!", texts[12].replace("a", "b", 1)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(3, "x" * 500, "repeat"), (None, texts[9], "no id"), (None, None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string").repartition(3)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                 for r in S.remove_repeats(df, length=64, hot_classes=hot).collect())
    want = sorted((i if i is not None else -1, *b) for (i, _, _), b in zip(rows, brute([t for _, t, _ in rows], 64), strict=True))
    assert got == want


def test_query_equals_brute_force(spark):
    docs = documents(spark, "documents")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES["op2_suffix_dedup"](spark, SF).collect()}
    want = dict(zip([d["doc_id"] for d in docs], brute([d["text"] for d in docs], 200), strict=True))
    assert got == want and any(w[1] for w in want.values())


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
