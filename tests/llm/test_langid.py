import itertools
import zlib

import numpy as np
from tests_support import documents

from quarry.llm import langid as G
from quarry.llm.registry import QUERIES


def test_forward_backward_equals_enumeration(monkeypatch):
    monkeypatch.setattr(G, "CHUNK", 3)
    rng = np.random.default_rng(0)
    scores, turns = rng.normal(size=(15, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 0, 1, 8, 8, 15])
    got = G.posteriors(scores, first, turns)
    for a, b in zip(first[:-1], first[1:], strict=True):
        want = np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=int(b - a)):
            if path:
                start = np.log(np.exp(turns[:, path[0]]).mean())
                s = start + sum(scores[a + t, y] for t, y in enumerate(path)) + sum(turns[x, y] for x, y in itertools.pairwise(path))
                want[np.arange(b - a), path] += np.exp(s)
        if b > a:
            assert np.allclose(got[a:b], want / want.sum(axis=1, keepdims=True))


def test_switched_text_is_labelled_by_word():
    en, de = "the house of the rising sun and that was in the end".split(), "das ist ein haus und der hund geht nicht nach oben".split()
    rng = np.random.default_rng(1)
    model = G.train([(lang, " ".join(rng.choice(words, 60))) for lang, words in (("en", en), ("de", de)) for _ in range(30)], sequences=600)
    text = " ".join(en[:8] + de[:8])
    raw = np.frombuffer(text.encode(), np.uint8)
    _, _, _, p = G._tag(raw, np.array([0, len(raw)]), model)
    assert [model.langs[k] for k in p.argmax(axis=1)] == ["en"] * 8 + ["de"] * 8
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_edge_rows(spark):
    rows = [(1, None, "en", "x"), (2, "", "en", "x"), (3, "12 -- → 9", "de", "x"), (4, "the and of", None, "x"), (4, "the and of", None, "x"), (None, "the", "en", "x"), (5, "语言", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"] > 0) for r in G.identify(docs, G.train([("en", "the and of it"), ("de", "und der die")], sequences=100), spans=True).collect()))
    assert [g[1] for g in got] == ["en", "und", "und", "und", "en", "en"] + [got[-1][1]] and got[-1][2]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert G.identify(empty, G.learn(empty)).collect() == []
    assert G.identify(docs, G.learn(empty)).filter("lang_pred <> 'und'").count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {d["doc_id"]: d["lang"] for d in documents(spark, "documents", sf)}
    rows = QUERIES["op10_language_id"](spark, sf).collect()
    assert len(rows) == len(lang) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.98


def test_a_language_that_was_not_learnt_is_told_by_its_deviation(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    for unknown in ("es", "en"):
        passages = G.sample_passages(docs.filter(docs["lang"] != unknown))
        out = G.identify(docs, G.train(passages), fit=G.familiarity(passages)).collect()
        far = [r["deviation"] < -12 for r in out if r["lang"] == unknown]
        near = [r["deviation"] < -12 for r in out if r["lang"] != unknown]
        assert sum(far) > 0.97 * len(far) and sum(near) < 0.01 * len(near)


def test_a_text_in_two_learnt_languages_is_no_stranger(spark):
    rows = [r for r in documents(spark, "documents", "/root/testdata/sf0.01") if r["text"] and len(r["text"]) > 600]
    halves = {x: [r["text"][:500] for r in rows if r["lang"] == x][:20] for x in ("en", "de", "fr")}
    switched = [a + " " + b for x, y in (("en", "de"), ("fr", "en")) for a, b in zip(halves[x], halves[y], strict=False)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    passages = G.sample_passages(docs)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(switched)], "doc_id long, text string")
    out = G.identify(df, G.train(passages), fit=G.familiarity(passages)).collect()
    assert all(r["deviation"] > -12 for r in out)


def test_every_language_is_learnt(spark):
    rows = [(i, f"w{i % 230}a w{i % 230}b w{i % 230}c", f"l{i % 230}") for i in range(1380)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len({x for x, _ in G.sample_passages(docs)}) == 230
    assert len(G.sample_passages(docs, most_rows=460)) <= 460
    empty = G.familiarity([])
    assert [r["deviation"] for r in G.identify(docs.limit(1), G.train([]), fit=empty).collect()] == [0.0]
