"""The operators made of DataFrame functions: exact dedup, mixing, chat formatting."""

import hashlib
import re

import test_pipeline
from tests_support import SF, documents

from quarry.llm import chat, exact, mixing
from quarry.llm.registry import QUERIES


def test_exact_dedup_edge_rows(spark):
    rows = [(5, "a  b", 1), (3, "a\tb", 2), (3, "a\tb", 3), (None, "a b", 4), (9, None, 5), (8, "", 6), (7, " ", 7), (1, "own", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    out = sorted(exact.exact_dedup(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect(), key=str)
    text = {(i, t): re.sub(r"[ \t]+", " ", t or "") for i, t, _ in rows}
    assert sum(r["kept"] for r in out) == 4 and all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in out} == {(5, 3, 4), (3, 3, 4), (None, 3, 4), (9, 8, 2), (8, 8, 2), (7, 7, 1), (1, 1, 1)}
    assert {r["text_sha256"] for r in out} == {hashlib.sha256(t.encode()).hexdigest() for t in text.values()}
    assert exact.exact_dedup(df.limit(0)).collect() == []


def test_filter_joined_by_bucket_beyond_its_bound(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    small, large = (sorted(map(tuple, exact.exact_dedup(docs, broadcast_bytes=b).drop("text").collect())) for b in (1 << 20, 0))
    assert small == large


def test_no_exchange_holds_a_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for bound in (1 << 20, 0):
        found = exact.exact_dedup(docs, broadcast_bytes=bound)
        assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert "text#" not in found._jdf.queryExecution().executedPlan().toString()


def test_rows_that_stay(spark):
    schema = "doc_id long, text string, __row string, GONE long"
    rows = [(1, "a  b", "x", 1), (0, "a b", "y", 2), (0, "a\tb", "z", 3), (None, "a b", "n", 4), (None, "own", "m", 5), (None, "own", "m", 5), (2, None, "e", 6), (3, "", "f", 7), (4, "alone", "g", 8)]
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = sorted((str(r["doc_id"]), r["text"]) for r in exact.without_copies(df).collect())
    assert len(got) == 4 and ("2", None) in got and ("4", "alone") in got and ("None", "own") in got and got[0][0] == "0"
    assert exact.without_copies(df).columns == df.columns
    assert exact.without_copies(df.limit(0)).collect() == []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = exact.exact_dedup(docs).filter("kept").select("doc_id")
    assert sorted(r[0] for r in exact.without_copies(docs).select("doc_id").collect()) == sorted(r[0] for r in kept.collect())


def test_mix_with_clashing_names(spark):
    df = spark.createDataFrame([(k, "w " * k, "ab"[k % 2], 1, 2, 3, 4) for k in range(40)], "doc_id long, text string, source string, Size int, source_rows int, weight int, rank int")
    out = mixing.mix_sources(df)
    assert [c for c in out.columns if c in ("source_rows", "weight", "rank")] == ["source_rows", "weight", "rank"] and "Size" not in out.columns
    plain = mixing.mix_sources(df.select("doc_id", "text", "source"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect()))


def test_mix_edge_rows(spark):
    rows = [(k, "w " * (k % 7), ["b", "a", None, "é"][k % 4], 1) for k in range(200)] + [(None, "x y", "a", 1), (None, "x y", "a", 1), (500, None, "zero", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    out = mixing.mix_sources(df).collect()
    before = {r[0]: {"text": r[1], "source": r[2]} for r in rows}
    assert len(out) == len(rows)
    sizes, taken = {}, {}
    for r in out:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert r["taken"] <= 2 * r["size"] and r["size"] == len(test_pipeline.SIZE.findall(before[r["doc_id"]]["text"] or ""))
    want = test_pipeline.targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 7 for s in sizes) and want["zero"] == 0
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix_sources(df.repartition(3)).collect()))
    assert mixing.mix_sources(df.limit(0)).collect() == []


def test_balance_with_two_margins(spark):
    cells = spark.createDataFrame([("a", "x", 10.0), ("a", "y", 30.0), ("b", "x", 20.0), ("b", "y", 40.0)], "s string, l string, size double")
    margins = {"s": spark.createDataFrame([("a", 50.0), ("b", 50.0)], "s string, target double"), "l": spark.createDataFrame([("x", 40.0), ("y", 60.0)], "l string, target double")}
    got = {(r["s"], r["l"]): r["rate"] for r in mixing.balance(cells, margins).collect()}
    tokens = {(r["s"], r["l"]): r["size"] * got[r["s"], r["l"]] for r in cells.collect()}
    assert abs(tokens["a", "x"] + tokens["a", "y"] - 50) < 1e-6 and abs(tokens["a", "x"] + tokens["b", "x"] - 40) < 1e-6
    # Exponentially tilted: the cross ratio of the rates is 1.
    assert abs(got["a", "x"] * got["b", "y"] / got["a", "y"] / got["b", "x"] - 1) < 1e-6


def test_mix_query_meets_the_contract(spark):
    rows = QUERIES["op8_mix_sources"](spark, SF).collect()
    test_pipeline.check_mix(rows, {d["doc_id"]: d for d in documents(spark, "documents")})


def test_chat_edge_rows_and_segments(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 3, "ann", "so"), (1, None, None, "last"), (2, 0, "system", "alone"), (None, 0, "ann", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {(r["conv_id"], r["participant"], r["segment"]): r for r in chat.rotate_perspectives(df).collect()}
    assert set(out) == {(1, "ann", 0), (1, "bob", 0), (1, "unknown", 0), (None, "ann", 0)}
    ann = out[1, "ann", 0]
    assert ann["rendered"] == ("<|im_start|>system\ns<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n"
                               "<|im_start|>assistant\nso<|im_end|>\n<|im_start|>user name=unknown\nlast<|im_end|>\n")
    assert [ann["rendered"][m["start"]:m["end"]] for m in ann["mask"]] == ["hi < |im_end|><|im_end|>", "so<|im_end|>"]
    assert ann["n_chars"] == len(ann["rendered"]) and ann["n_masked"] == sum(m["end"] - m["start"] for m in ann["mask"])
    cut = chat.rotate_perspectives(df, segment_turns=2).filter("conv_id = 1 and participant = 'ann'").orderBy("segment").collect()
    assert "".join(r["rendered"] for r in cut) == ann["rendered"] and [r["n_turns"] for r in cut] == [2, 2, 1]
    assert chat.rotate_perspectives(df.limit(0)).collect() == []
