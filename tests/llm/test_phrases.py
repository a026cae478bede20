import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from tests_support import SF, documents

from quarry.llm import phrases
from quarry.llm.registry import QUERIES


def brute(rows, least=30, first=2000):
    """rows: (lang, text)."""
    counts, out = defaultdict(Counter), []
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[i:i + k])] += 1
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {p[i:i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 80 * f[p[i:i + k]]}
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_query_equals_brute_force(spark):
    got = found(QUERIES["op12_collocations"](spark, SF))
    assert got and got == brute([(r["lang"], r["text"]) for r in documents(spark, "documents")])


def test_small_vocabulary_ties_nulls_and_clashing_columns(spark):
    rng = random.Random(5)
    words = ["a", "B", "é", "É", "a", "en", "x-y", " "]
    gaps = [" ", " ", " ", "\t ", ", ", ".", "\n", "\r\n", "?!"]
    text = lambda n: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))
    rows = [(rng.choice(["en", "a", None, "und"]), rng.choice([None, "", " \t", text(5), text(60), text(60)])) for _ in range(200)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, n long, W1 long").repartition(4)
    for least, first in ((2, 2000), (30, 7), (1, 2000)):
        assert found(phrases.collocations(df, least=least, first=first)) == brute(rows, least, first)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([("en", "a b c d e")] * 40, "lang string, text string")
    assert found(phrases.collocations(df)) == brute([("en", "a b c d e")] * 40)
    assert phrases.collocations(df.limit(0)).collect() == []


def test_long_texts_in_parts_give_the_same_windows():
    rng = random.Random(3)
    body = "".join(rng.choice(["ab", "c", "deé", "\t", "  ", " ", " ", ",", "\n"]) + rng.choice([" ", ""]) for _ in range(3000)).encode()
    raw = np.frombuffer(body, np.uint8)

    def windows(parts):
        out = Counter()
        for lo, own, end in parts:
            _, _, _, hashes, _, joined, mine = phrases._slice_words(raw[lo:end], np.array([0, end - lo]), np.zeros(1, np.uint64), 0, own - lo)
            for i in np.flatnonzero(mine).tolist():
                window = [int(hashes[i])]
                while len(window) < phrases.ORDER and joined[i + len(window) - 1]:
                    window.append(int(hashes[i + len(window)]))
                out[tuple(window)] += 1
        return out

    want = windows([(0, len(raw), len(raw))])
    for limit in (1, 7, 64, 1000):
        parts = list(phrases._parts(raw, limit))
        assert parts[0][0] == 0 and parts[-1][1] == len(raw) and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
        assert windows(parts) == want


def test_a_text_of_many_megabytes_is_counted_whole(spark):
    text = "alpha beta gamma, " * 400_000 + "delta"
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en"], "text": [text, "beta"]})
    counts = Counter()
    for out in phrases._count_words(iter([batch])):
        for w, n in zip(out.column("word").to_pylist(), out.column("n").to_pylist(), strict=True):
            counts[w] += n
    assert counts == {"alpha": 400_000, "beta": 400_001, "gamma": 400_000, "delta": 1}
