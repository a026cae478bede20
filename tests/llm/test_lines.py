import random
import time

from quarry.llm import lines as L

BLANK = " \t\n\v\f\r"


def brute(rows, n_lines, n_words):
    """rows: (key, text) in key order.  Every run that is enough, of any length, against all earlier places."""
    split = [[(i, x.strip(BLANK)) for i, x in enumerate(text.split("\n")) if x.strip(BLANK)] if text else [] for _, text in rows]

    def enough(run):
        return len(run) >= n_lines or sum(len([w for w in x.split() if w]) for x in run) >= n_words
    places = {}
    for d, filled in enumerate(split):
        found = False
        for a in range(len(filled)):
            for b in range(a + 1, len(filled) + 1):
                run = tuple(x for _, x in filled[a:b])
                if enough(run):
                    found = True
                    places.setdefault(run, []).append((d, a))
        if filled and not found:
            places.setdefault(("whole", tuple(x for _, x in filled)), []).append((d, 0))
    gone = [set() for _ in rows]
    for run, at in places.items():
        n = len(run[1]) if run[0] == "whole" else len(run)
        d0, a0 = at[0]
        for d, a in at[1:]:
            if d != d0 or a >= a0 + n:
                gone[d] |= {split[d][i][0] for i in range(a, a + n)}
    out = []
    for (_, text), filled, g in zip(rows, split, gone, strict=True):
        whole = text.split("\n") if text else []
        runs = sum(i in g and not (n and filled[n - 1][0] in g) for n, (i, _) in enumerate(filled))
        out.append((len(whole), len(g), runs, "\n".join(x for i, x in enumerate(whole) if i not in g)))
    return out


def test_rows_equal_brute_force(spark):
    rng = random.Random(7)
    vocab = ["a", "b ", " c", "", "dé", "e\t", "f f", "g g  g", "one two three four"]
    rows = [(i, rng.choice([None, "", "\n", "a\n\n", "a", "b\nc", " a\nb"]) if i % 6 == 0 else "\n".join(rng.choices(vocab, k=rng.randrange(12)))) for i in range(80)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, later int").repartition(3)
    for n_lines, n_words in ((3, 8), (3, 4), (1, 99), (2, 99), (4, 5), (5, 99)):
        got = sorted(((r["doc_id"], (r["n_lines"], r["n_deleted"], r["n_runs"], r["kept_text"]))
                      for r in L.drop_repeated_lines(df, n_lines=n_lines, n_words=n_words).collect()))
        assert [g for _, g in got] == brute(rows, n_lines, n_words), (n_lines, n_words)


def test_long_lines_short_copies_and_earliest_runs(spark):
    long = "one two three four five six seven eight"
    rows = [(1, "x\n" + long + "\ny"), (2, "other\n" + long + "\nend"), (3, "a\nb"), (4, "a\n b"), (5, "a\nb\nc"), (6, "\n".join("A" * 6)),
            (7, "p q r s\nt u v w\nz"), (8, "k\np q r s\nt u v w\nl")]
    got = {r["doc_id"]: r["kept_text"] for r in L.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # A long line goes alone, a short row only as a copy, three of six equal lines are the earliest run.
    assert got == {1: rows[0][1], 2: "other\nend", 3: "a\nb", 4: "", 5: "a\nb\nc", 6: "A\nA\nA", 7: rows[6][1], 8: "k\nl"}


def test_null_keys_repeats_and_empty_table(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "x\na\nb\nc"), (None, None)]
    got = sorted((r["doc_id"] or 9, r["n_deleted"]) for r in L.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 0), (1, 0), (9, 0), (9, 3)]
    assert L.drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_common_lines_sent_out_or_shuffled(spark, monkeypatch):
    rows = [(i, f"own {i}\na line of eight words or a few more of them\nlast {i % 7}") for i in range(400)] + [(900, "\n".join("ab" * 300))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = lambda found: sorted((r["doc_id"], r["n_deleted"], r["kept_text"]) for r in found.collect())
    expect = order(L.drop_repeated_lines(df))
    # The long line, and with it the last one where an earlier row ends alike.
    assert sum(n for _, n, _ in expect[:400]) == 399 + 393 and [x[1:] for x in expect[400:]] == [(596, "a\nb\na\nb")]
    # The same where no key is common enough to be sent out.
    whole = L.join_counted
    monkeypatch.setattr(L, "join_counted", lambda rows, sums, on: whole(rows, sums, on, share=1))
    assert order(L.drop_repeated_lines(df)) == expect


def test_very_long_text(spark):
    text = "\n".join(f"line {i} of a text with many more lines than others" for i in range(200_000))
    df = spark.createDataFrame([(1, text), (2, "head\n" + text)], "doc_id long, text string")
    before = time.time()
    got = {r["doc_id"]: (r["n_lines"], r["n_deleted"], r["n_runs"]) for r in L.drop_repeated_lines(df).drop("kept_text").collect()}
    assert got == {1: (200_000, 0, 0), 2: (200_001, 200_000, 1)} and time.time() - before < 120
