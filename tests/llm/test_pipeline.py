import re
from collections import defaultdict

import test_decontam
import test_jaccard
from tests_support import SF, documents

import corpus_pipeline as C

SIZE = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame([(10**9, "12 34", "en", "src1", 5), (10**9 + 1, None, None, None, None)], docs.schema)
    docs = docs.unionByName(junk)
    assert [name for name, _ in C.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing"]
    kept, columns = {}, docs.columns
    for k, (name, stage) in enumerate(C.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = docs.collect()
        ids = sorted(r["doc_id"] for r in kept[name])
        text = {i: r["text"] for i, r in before.items()}
        if k < 4:
            assert docs.columns == columns and all(r == before[r["doc_id"]] for r in kept[name])
        if name == "language ID":
            assert set(before) - set(ids) == {10**9, 10**9 + 1}
        elif name == "exact dedup":
            first = {}
            for i in sorted(text):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text[i]), i)
            assert ids == sorted(first.values())
        elif name == "n-gram Jaccard join":
            assert ids == sorted(i for i, _, c in five_word_components(sorted(text.items())) if i == c)
        elif name == "benchmark decontamination":
            items = [(str(r["item_id"]), r["text"]) for r in documents(spark, "benchmark")]
            hits = test_decontam.brute([text[i] for i in sorted(text)], items)
            assert ids == [i for i, (_, n, _) in zip(sorted(text), hits, strict=True) if not n]
        else:
            assert ids == sorted(before)
            check_mix(kept[name], before)


def five_word_components(rows):
    whole = test_jaccard.shingles
    try:
        test_jaccard.shingles = lambda t: whole(t, 5)
        return test_jaccard.brute(rows, 80)
    finally:
        test_jaccard.shingles = whole


def targets(sizes):
    """sizes by source: the contract's shares, worked out by hand."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    held = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in held)
        total = sum(weight[s] for s in sizes if s not in held)
        share = {s: 2 * sizes[s] if s in held else left * weight[s] / total for s in sizes}
        more = {s for s in sizes if s not in held and share[s] > 2 * sizes[s]}
        if not more:
            return share
        held |= more


def check_mix(rows, before):
    sizes, taken = defaultdict(int), defaultdict(int)
    longest = defaultdict(int)
    for r in rows:
        assert r["size"] == len(SIZE.findall(before[r["doc_id"]]["text"] or "")) and r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        s = before[r["doc_id"]]["source"]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        longest[s] = max(longest[s], r["size"])
    want = targets(sizes)
    for r in rows:
        s = before[r["doc_id"]]["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
    assert all(abs(taken[s] - want[s]) <= longest[s] + 1e-6 for s in sizes)
