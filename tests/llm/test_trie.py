import hashlib
import zlib
from collections import defaultdict

from tests_support import SF, documents

from quarry.llm import trie
from quarry.llm.registry import QUERIES


def rebuilt(rows):
    """rows: (conv, turn, role, text); turns of one number must have one content."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [m[2:] for m in sorted(v, key=lambda m: m[:2])] for c, v in own.items()}
    opening = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[:opening[c]] + v[opening[c]:] for c, v in own.items()}


def brute(paths):
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += children[p] == 0
        if p:
            saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode())
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    ends = {p: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p)))).encode()).hexdigest() for p, m in members.items()}
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], ends[p]) for p, m in members.items())


def found(df):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                   r["saved_tokens"], r["ends_sha256"]) for r in df.collect())


def whole(df, **ranges):
    return trie.prefix_trie(trie.share_openings(trie.turn_sequences(df)), **ranges)


def test_query_equals_brute_force(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in documents(spark, "conversations")]
    assert found(QUERIES["op11_prefix_trie"](spark, SF)) == brute(rebuilt(rows))


def made(n):
    """Few words and many shared openings: a third of all conversations are equal, some are very long."""
    rows = []
    for c in range(n):
        length = 300 if c % 37 == 0 else 1 + c * 7 % 11
        for t in range(length):
            rows.append((c, t, "user" if t % 2 else None, "same é" if c % 3 == 0 else f"{c * (t + 1) % 3}" if t < 6 or c % 37 else "long"))
    return rows


def test_ranges_of_any_size(spark):
    rows = made(150)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    want = brute(rebuilt(rows))
    for ranges in ({}, {"range_turns": 40, "range_paths": 2}, {"range_turns": 40, "range_paths": 3, "last_paths": 4}):
        assert found(whole(df, **ranges)) == want


def test_nulls_negatives_turnless_and_clashing_columns(spark):
    rows = [(None, 1, "u", "x"), (1, None, None, None), (1, 1, "u", "b"), (-3, 0, "u", "a"), (-5, 0, "u", "neg"), (0, 0, "u", "zero"),
            (7, 0, "u", "own"), (2**63 - 1, 0, "u", "last"), (-2**63, 3, "u", "least")]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "conv_id long, turn long, role string, text string, path long, C long")
    # c - c % 5 in SQL goes towards zero, for negative ids too.
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((r or "", x or ""))
    paths = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        paths[c] = own.get(donor, [])[:h] + v[h:]
    assert any(not p for p in paths.values())
    assert found(whole(df)) == brute(paths)


def test_repeated_rows_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(0, 0, "u", "a"), (0, 0, "u", "a"), (0, 1, "u", "b")], schema)
    assert found(whole(df)) == brute(rebuilt([tuple(r) for r in df.collect()]))
    assert whole(spark.createDataFrame([], schema)).collect() == []
