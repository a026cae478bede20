"""Phrase collocations by top-order marginalisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import byte_set, checked_broadcast, lower_ascii, mix, prefix_hashes, span_hashes, text_slices, word_hashes, word_spans
from quarry.session import materialize

#: Words of the longest phrase; windows have as many columns.
ORDER = 4
#: Bytes of one part of a long text, and words that a task counts before it sends them on.
PART_BYTES, HELD_WORDS = 2 << 20, 4 << 20
#: Bits of the filters that name words and pairs which may be frequent: so many a row, within these bounds.
FILTER_ROW_BITS, FILTER_BITS = 32, (1 << 20, 1 << 28)
FILTER_ROW = 32768

_CUT = byte_set((0x0A, 0x0D)) | np.isin(np.arange(256), [ord(c) for c in ".,;:!?"])
_WORD = ~(_CUT | byte_set((0x20, 0x20), (0x09, 0x09)))
_GAP = byte_set((0x20, 0x20), (0x09, 0x09))


# -- words of texts ---------------------------------------------------------------------------------

def _parts(raw: np.ndarray, limit: int) -> Iterator[tuple[int, int, int]]:
    """(start, own end, end) of the parts of one text: words that start before the own end belong to the
    part, those after it only continue its windows.  Parts end at a gap or cut, never in a word."""
    n, lo = len(raw), 0
    while lo < n:
        own = end = n
        at, step = lo + limit, 4096
        while at < n:
            gaps = np.flatnonzero(~_WORD[raw[at:at + step]])
            if len(gaps):
                own = at + int(gaps[0]) + 1
                break
            at += step
        step = 4096
        while own < n:
            # The next words are read along, up to a cut.
            ahead = raw[own:own + step]
            cuts = np.flatnonzero(_CUT[ahead])
            inside = _WORD[ahead]
            starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
            if len(cuts) or len(starts) > ORDER or own + step >= n:
                end = own + min([len(ahead), *cuts[:1].tolist(), *starts[ORDER:ORDER + 1].tolist()])
                break
            step *= 2
        yield lo, own, end
        lo = own


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of slices of texts: the languages of the batch; the slice's bytes; each word's start, end, hash with its language and
    row of the batch; whether the next word stands in the same piece; whether the word belongs to the slice."""
    for batch in batches:
        langs = batch.column("lang")
        names = langs.unique().to_pylist()
        seed = dict(zip(names, word_hashes(names).tolist(), strict=True))
        # A language's name may also be a word: its seed must not be that word's hash.
        seeds = mix(np.array([seed[x] for x in langs.to_pylist()], np.uint64) * np.uint64(0xA24BAED4963EE407))
        at = 0
        for rows, raw, offsets in text_slices(batch, "text", PART_BYTES):
            mine = seeds[at:at + rows.num_rows]
            if len(raw) <= 2 * PART_BYTES:
                yield langs, *_slice_words(raw, offsets, mine, at, len(raw))
            else:
                for lo, own, end in _parts(raw, PART_BYTES):
                    yield langs, *_slice_words(raw[lo:end], np.array([0, end - lo], np.int64), mine, at, own - lo)
            at += rows.num_rows


def _slice_words(raw: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, at: int, own: int) -> tuple[np.ndarray, ...]:
    raw = lower_ascii(raw)
    starts, ends, first = word_spans(_WORD[raw], offsets)
    row = np.repeat(np.arange(len(seeds)), np.diff(first))
    hashes = mix(span_hashes(prefix_hashes(raw), starts, ends) ^ seeds[row])
    # Between two words of a piece there are only gaps.
    cuts = np.concatenate([[0], np.cumsum(_CUT[raw])])
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (row[1:] == row[:-1]) & (cuts[starts[1:]] == cuts[ends[:-1]])
    return raw, starts, ends, hashes, row + at, joined, starts < own


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, h, word, n) of every slice."""
    for langs, raw, starts, ends, hashes, row, _, own in _words(batches):
        h, first, n = np.unique(hashes[own], return_index=True, return_counts=True)
        first = np.flatnonzero(own)[first]
        length = ends[first] - starts[first]
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        data = raw[np.repeat(starts[first] - offsets[:-1], length) + np.arange(offsets[-1])]
        words = pa.LargeStringArray.from_buffers(len(h), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(row[first])), pa.array(h.view(np.int64)), words, pa.array(n, pa.int64())], names=["lang", "h", "word", "n"])


class _Filter:
    """Hashes that may be frequent: a bit of a bitmap is set for each that is, by its top bits."""

    def __init__(self, words: np.ndarray, bits: int) -> None:
        self.words, self.shift = words, np.uint64(64 - bits)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        cell = h >> self.shift
        return (self.words[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _frequent_words(batches: Iterator[pa.RecordBatch], words: _Filter) -> Iterator[tuple]:
    """Languages, rows and hashes; whether the next word continues the piece and both may be frequent; own words."""
    for langs, _, _, _, hashes, row, joined, own in _words(batches):
        good = words(hashes)
        joined = joined & good
        joined[:-1] &= good[1:]
        yield langs, row, hashes, joined, own


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


def _count_pairs(batches: Iterator[pa.RecordBatch], words: _Filter) -> Iterator[pa.RecordBatch]:
    """(p, n): hashes of pairs of neighbours that may both be frequent."""
    held: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        p, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), pa.array(n, pa.int64())], names=["p", "n"])

    for _, _, hashes, joined, own in _frequent_words(batches, words):
        at = np.flatnonzero(joined & own)
        held.append(_pair_hash(hashes[at], hashes[at + 1]))
        if sum(map(len, held)) >= HELD_WORDS:
            yield counted()
    if held:
        yield counted()


def _count_windows(batches: Iterator[pa.RecordBatch], words: _Filter, pairs: _Filter) -> Iterator[pa.RecordBatch]:
    """(lang, w1 .. w4, n): longest windows of pairs that may be frequent, padded with nulls."""
    for langs, row, hashes, joined, own in _frequent_words(batches, words):
        at = np.flatnonzero(joined)
        joined[at] = pairs(_pair_hash(hashes[at], hashes[at + 1]))
        at = np.flatnonzero(joined & own)
        window = np.zeros((len(at), ORDER), np.uint64)
        length = np.ones(len(at), np.int64)
        window[:, 0] = hashes[at]
        going = np.ones(len(at), bool)
        for k in range(1, ORDER):
            going &= joined[np.minimum(at + k - 1, len(joined) - 1)]
            window[going, k] = hashes[at[going] + k]
            length += going
        order = np.lexsort((*window.T[::-1], length))
        window, length, row_of = window[order], length[order], row[at][order]
        new = np.ones(len(at), bool)
        new[1:] = (window[1:] != window[:-1]).any(axis=1) | (length[1:] != length[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(at)))
        columns = [pa.array(window[first, k].view(np.int64), pa.int64(), mask=length[first] <= k) for k in range(ORDER)]
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(row_of[first])), *columns, pa.array(n, pa.int64())], names=["lang", *WINDOW, "n"])


WINDOW = tuple(f"w{k + 1}" for k in range(ORDER))


# -- frequent words and pairs -------------------------------------------------------------------------

def _bitmap(hashes: DataFrame, column: str) -> _Filter:
    """The filter of a written table's hashes.  Its size goes with their number and is bounded; where the bound
    holds it back, more pass it, which costs work and changes no result."""
    rows = hashes.count()
    bits = int(np.clip(np.ceil(np.log2(max(1, rows) * FILTER_ROW_BITS)), np.log2(FILTER_BITS[0]), np.log2(FILTER_BITS[1])))
    cell = F.shiftrightunsigned(F.col(column), 64 - bits)
    made = hashes.select(cell.alias("cell")).groupBy(F.expr(f"cell div {FILTER_ROW}").alias("row")).agg(F.expr(f"bitmap_construct_agg(cell % {FILTER_ROW})").alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in made.toLocalIterator():
        out[r["row"] * FILTER_ROW // 8:(r["row"] + 1) * FILTER_ROW // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return _Filter(out, bits)


def _vocabulary(rows: DataFrame) -> DataFrame:
    """(lang, h, word, n) over all texts."""
    vocabulary = materialize(
        rows.mapInArrow(_count_words, "lang string, h long, word string, n long").groupBy("lang", "h", "word").agg(F.sum("n").alias("n")), "vocabulary")
    if vocabulary.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").limit(1).count():
        raise ArithmeticError("two words of the corpus have one 64-bit hash")
    return vocabulary


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30) -> tuple[DataFrame, DataFrame]:
    """(phrases, vocabulary).  Phrases: lang, words (hashes), f for every phrase of 1 to 4 words that occurs ``least`` times or
    more in its language.  Vocabulary: lang, h, word, n for every word.

    Texts are cut into pieces and words in tasks (long texts in parts that read the next words along).  The
    window that starts at a word has the next three words of its piece as columns, padded with nulls at the
    piece's end and from the first pair on that is known to be rarer than ``least``, since no phrase to be counted
    holds one.  Only these longest windows are counted; ROLLUP over their columns sums the shorter phrases.
    Rare words and pairs are known by two filters of bounded size, made of sums over all texts; a rare one
    that passes costs work and changes no count.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    vocabulary = _vocabulary(rows)
    frequent = vocabulary.filter(F.col("n") >= least)
    words = spark.sparkContext.broadcast(_bitmap(frequent.select("h"), "h"))
    pairs = rows.mapInArrow(lambda b: _count_pairs(b, words.value), "p long, n long").groupBy("p").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    pairs = spark.sparkContext.broadcast(_bitmap(materialize(pairs.select("p"), "frequent-pairs"), "p"))
    windows = rows.mapInArrow(lambda b: _count_windows(b, words.value, pairs.value), "lang string, " + ", ".join(f"{w} long" for w in WINDOW) + ", n long")
    windows = materialize(windows.groupBy("lang", *WINDOW).agg(F.sum("n").alias("n")), "windows")
    # The longest phrases are counted already; ROLLUP sums windows that begin alike.  grouping_id has a bit for each column
    # that is summed away, and the last column that is left must be a word.
    shorter = WINDOW[:-1]
    summed = windows.rollup("lang", *shorter).agg(F.sum("n").alias("f"), F.grouping_id().alias("g")).filter(F.col("f") >= least)
    level = F.coalesce(*[F.when((F.col("g") == (1 << (len(shorter) - k)) - 1) & F.col(WINDOW[k - 1]).isNotNull(), k) for k in range(2, ORDER)])
    longer = summed.withColumn("k", level).filter("k IS NOT NULL").select("lang", F.slice(F.array(*shorter), F.lit(1), F.col("k")).alias("words"), "f")
    whole = windows.filter((F.col("n") >= least) & F.col(WINDOW[-1]).isNotNull()).select("lang", F.array(*WINDOW).alias("words"), F.col("n").alias("f"))
    longer = longer.unionByName(whole)
    phrases = longer.unionByName(frequent.select("lang", F.array("h").alias("words"), F.col("n").alias("f")))
    return materialize(phrases, "phrases"), vocabulary


# -- collocations -------------------------------------------------------------------------------------

def _exact(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, scale: int = 2_000_000,
                 absorb: tuple[int, int] = (80, 100), first: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``first`` collocations by score, a (both descending), phrase.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and at spaces and tabs into words.
    A phrase of 2 to 4 words that occurs a >= ``least`` times is scored at its weakest cut: with l and r the
    occurrences of its two parts, the score is the least floor(``scale`` * a / (l + r)), at the smallest cut
    of equals.  A phrase inside a longer candidate with ``absorb[1]`` * f(longer) >= ``absorb[0]`` * a is dropped.
    Products are decimals of 38 digits.  n counts all words of the language.  A null language is ``und``, a null
    text is empty, repeated rows count again, other columns are left out, an empty table gives an empty one.
    """
    phrases, vocabulary = phrase_counts(docs, text, lang, least)
    n_words = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    parts = phrases.select("words", "f")
    found = phrases.filter(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"))
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "*", F.slice("words", F.lit(1), F.col("k")).alias("left"), F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    side = lambda name, f: parts.select(F.col("words").alias(name), F.col("f").alias(f))
    cuts = cuts.join(side("left", "l"), "left").join(side("right", "r"), "right")
    score = F.expr(f"cast({scale} as decimal(38,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(38,0))")
    weakest = cuts.withColumn("score", score).groupBy("lang", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = [(k, j) for k in range(2, ORDER) for j in range(1, ORDER - k + 2)]
    inside = F.array(*[F.when(F.size("words") >= F.greatest(F.lit(j + k - 1), F.lit(k + 1)), F.slice("words", j, k)) for k, j in spans])
    longer = found.filter(F.size("words") > 2).select("a", F.explode(inside).alias("words")).filter("words IS NOT NULL")
    longer = longer.groupBy("words").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, "words", "left").filter(
        F.col("longer").isNull() | (_exact(F.col("longer")) * absorb[1] < _exact(F.col("a")) * absorb[0]))

    kept = materialize(kept.select("lang", "words", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score")), "collocations")
    names = vocabulary.filter(F.col("n") >= least).select(F.col("h").alias("w"), "word")
    named = kept.select("words", F.posexplode("words").alias("at", "w")).join(names, "w")
    named = named.groupBy("words").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = kept.join(named, "words").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")).cast("long")).filter(F.col("rank") <= first)
    return ranked.join(checked_broadcast(materialize(n_words, "language-words"), 64), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
