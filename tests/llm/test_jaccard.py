import random
import re

import numpy as np
from tests_support import SF, documents

from quarry.llm import jaccard as J
from quarry.llm.registry import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=4):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(find(i), []).append(key)
    top = lambda keys: min((k for k in keys if k is not None), default=None)
    return [(key, len(x), top(least[find(i)]) if x else key) for i, ((key, _), x) in enumerate(zip(rows, sets, strict=True))]


def made(seed, groups=12, size=14, length=90):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts = ["", None, "one", "One", "two words", "two  WORDS", "a b c d", "a b c d e"]
    shared = rng.choices(vocab, k=60)
    for _ in range(groups):
        base = rng.choices(vocab, k=rng.randrange(8, length)) + (shared if rng.random() < .5 else [])
        for _ in range(rng.randrange(1, size)):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts.append(" ".join(copy) + rng.choice(["", " ", "\nend"]))
    rng.shuffle(texts)
    return list(enumerate(texts))


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string").repartition(4)
    out = J.jaccard_components(df).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=key) == sorted(brute(rows), key=key)
    return out


def test_small_cases_equal_brute_force(spark):
    out = check(spark, made(1))
    assert sum(r["kept"] for r in out) < len(out)


def test_frequent_tokens_as_pairs_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "RARE_DF", 2)
    monkeypatch.setattr(J, "KNOWN_DF", 2)
    monkeypatch.setattr(J, "BLOCK", 3)
    check(spark, made(2, groups=6, size=30))


def test_block_links_equal_all_pairs():
    rng = np.random.default_rng(4)
    x = [np.unique(rng.integers(0, 60, 40)) for _ in range(20)]
    assert J._overlaps(x[:9], x[9:], columns=7).tolist() == [[len(np.intersect1d(a, b)) for b in x[9:]] for a in x[:9]]


def test_few_frequent_tokens_known(spark, monkeypatch):
    monkeypatch.setattr(J, "FREQUENT_TOKENS", 40)
    monkeypatch.setattr(J, "KNOWN_DF", 2)
    monkeypatch.setattr(J, "RARE_DF", 4)
    check(spark, made(3))


def test_similar_sets_share_an_entry():
    rng = np.random.default_rng(0)
    for trial in range(300):
        n = int(rng.integers(2, 300))
        x = np.unique(rng.integers(1, 1 << 62, n).astype(np.uint64) * np.uint64(4))
        drop = int(len(x) * rng.random() * 0.16)
        y = np.unique(np.concatenate([np.delete(x, rng.choice(len(x), drop, replace=False)), rng.integers(1, 1 << 62, int(rng.random() * 0.05 * len(x))).astype(np.uint64)]))
        common = len(np.intersect1d(x, y))
        if len(y) < 2 or 100 * common < 85 * (len(x) + len(y) - common):
            continue
        cls = lambda t: np.where(J.mix(t) % np.uint64(10) < np.uint64(trial % 11), 9, 1).astype(np.uint8)
        sigs = [J.signatures(r, len(t), cls(r), 85, 8) for t in (x, y) for r in [J._region(t, 85)]]
        least = 1 if sigs[0][1] and sigs[1][1] else min(J.SHARED, -(-85 * min(len(x), len(y)) // 100))
        assert len(np.intersect1d(sigs[0][0], sigs[1][0])) >= least


def test_nulls_repeats_and_empty_table(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, None), (2, "")]
    check(spark, rows)
    assert J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_brute_force(spark):
    docs = documents(spark, "documents")
    got = {r["doc_id"]: (r["doc_id"], r["n_shingles"], r["component_id"]) for r in QUERIES["op6_jaccard_join"](spark, SF).collect()}
    assert sorted(got.values()) == sorted(brute([(d["doc_id"], d["text"]) for d in docs]))
