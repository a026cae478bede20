"""Benchmark decontamination by an FM-index over each shard of documents.

A task indexes the shard it reads: it keeps the stretches of words that could hold a benchmark
phrase at all, sorts their suffixes, takes the Burrows-Wheeler transform and answers ranks from a
wavelet matrix.  Every test phrase is searched backwards, all phrases of a block at once; occurrences
are located by walking back to sampled suffix positions.  Hits are merged into spans by document.
No document leaves its task, so nothing shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import (ALNUM, lower_ascii, prefix_hashes, runs, span_hashes, text_slices, without,
                               word_spans)
from quarry.session import materialize

#: Words of a window, and a suffix position in so many is sampled.
WINDOW, SAMPLE = 10, 8
OUTPUT = ("n_words", "n_hit", "items", "spans", "contaminated")


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit plane with running counts for each bit of the symbols."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.planes = []
        for b in range(bits - 1, -1, -1):
            plane = (seq >> b) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(plane, out=ones[1:])
            zeros = len(seq) - int(ones[-1])
            self.planes.append((b, ones, zeros))
            seq = np.concatenate([seq[plane == 0], seq[plane == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``at``, for arrays of both."""
        lo, hi = np.zeros_like(at), at
        for b, ones, zeros in self.planes:
            set_ = (symbol >> b) & 1 == 1
            lo, hi = (np.where(set_, zeros + ones[x], x - ones[x]) for x in (lo, hi))
        return hi - lo

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for b, ones, zeros in self.planes:
            set_ = ones[at + 1] - ones[at]
            out |= set_.astype(out.dtype) << b
            at = np.where(set_ == 1, zeros + ones[at], at - ones[at])
        return out


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the length that is compared until every rank is its own."""
    n = len(seq)
    _, rank = np.unique(seq, return_inverse=True)
    rank, step = rank.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step or None] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Backward search and location over a sequence of symbols; 0 ends the sequence and is unique."""

    def __init__(self, seq: np.ndarray, symbols: int):
        order = suffix_array(seq)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols))])
        self.tree = WaveletMatrix(seq[order - 1], max(1, int(symbols - 1).bit_length()))
        marked = order % SAMPLE == 0
        self.marked = np.concatenate([[0], np.cumsum(marked)])
        self.sampled = order[marked]
        self.n = len(seq)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the suffixes that begin with each phrase; a row of ``phrases`` is right-aligned."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(1, phrases.shape[1] + 1):
            on = np.flatnonzero((k <= lengths) & (lo < hi))
            if not len(on):
                break
            c = phrases[on, -k]
            lo[on] = self.first[c] + self.tree.rank(c, lo[on])
            hi[on] = self.first[c] + self.tree.rank(c, hi[on])
        return lo, np.maximum(hi, lo)

    def locate(self, at: np.ndarray) -> np.ndarray:
        out, steps, on = np.empty(len(at), np.int64), 0, np.arange(len(at))
        at = at.copy()
        while len(on):
            here = self.marked[at[on] + 1] > self.marked[at[on]]
            done = on[here]
            out[done] = self.sampled[self.marked[at[done]]] + steps
            on = on[~here]
            c = self.tree.access(at[on])
            at[on] = self.first[c] + self.tree.rank(c, at[on])
            steps += 1
        return out


@dataclass
class Phrases:
    """A block of test phrases: words by rank of their hash (from 2 on), windows, and their items."""
    words: np.ndarray          # sorted hashes of the block's words
    windows: np.ndarray        # (n, WINDOW) of symbols, right-aligned
    lengths: np.ndarray
    pair_window: np.ndarray    # (window, item) pairs, by window
    pair_item: np.ndarray
    items: list[str]
    shortest: list[tuple[int, np.ndarray]]  # (least run, words that count for it as flags)


def phrase_block(rows: list) -> Phrases:
    """Windows of the items (item id as text, text): each 10 consecutive words, or a shorter item's all."""
    batch = pa.RecordBatch.from_arrays([pa.array([t or "" for _, t in rows], pa.string())], ["t"])
    hashes: list[np.ndarray] = []
    for _, raw, offsets in text_slices(batch, "t"):
        low = lower_ascii(raw)
        starts, ends, first = word_spans(ALNUM[low], offsets)
        h = span_hashes(prefix_hashes(low), starts, ends)
        hashes += [h[first[i]:first[i + 1]] for i in range(len(first) - 1)]
    words = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
    found: dict[bytes, int] = {}
    windows, lengths, pairs = [], [], set()
    short = {}
    for (item, _), h in zip(rows, hashes, strict=True):
        symbols = np.searchsorted(words, h).astype(np.int64) + 2
        size = min(WINDOW, len(h))
        if size:
            short.setdefault(size, np.zeros(len(words), bool))[symbols - 2] = True
        for k in range(len(h) - size + 1 if size else 0):
            w = symbols[k:k + size]
            at = found.setdefault(w.tobytes(), len(windows))
            if at == len(windows):
                windows.append(np.concatenate([np.zeros(WINDOW - size, np.int64), w]))
                lengths.append(size)
            pairs.add((at, item))
    items = sorted({i for _, i in pairs})
    number = {x: k for k, x in enumerate(items)}
    pairs = sorted((w, number[i]) for w, i in pairs)
    return Phrases(words, np.array(windows, np.int64).reshape(-1, WINDOW), np.array(lengths, np.int64),
                   np.array([w for w, _ in pairs], np.int64), np.array([i for _, i in pairs], np.int64), items, sorted(short.items()))


def _symbols(words: np.ndarray, hashes: np.ndarray, bits: int = 18) -> np.ndarray:
    """Symbol of each hash, 1 for words that no phrase has; a small table of low bits turns most away."""
    maybe = np.zeros(1 << bits, bool)
    low = np.uint64((1 << bits) - 1)
    maybe[(words & low).astype(np.int64)] = True
    out = np.ones(len(hashes), np.int64)
    on = np.flatnonzero(maybe[(hashes & low).astype(np.int64)])
    at = np.searchsorted(words, hashes[on])
    same = words[np.minimum(at, len(words) - 1)] == hashes[on] if len(words) else np.zeros(len(on), bool)
    out[on[same]] = at[same] + 2
    return out


def shard_hits(symbols: np.ndarray, first: np.ndarray, block: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hit words as flags, and (row, item) pairs.  ``first``: each row's first word, n + 1 of them."""
    hit = np.zeros(len(symbols), bool)
    none = np.zeros(0, np.int64)
    if not len(block.windows) or not len(symbols):
        return hit, none, none
    keep = np.zeros(len(symbols), bool)
    begins = np.zeros(len(symbols) + 1, bool)
    begins[first] = True
    for size, flags in block.shortest:
        inside = np.concatenate([[False, False], flags])[symbols]
        edge = inside & (begins[:-1] | ~np.concatenate([[False], inside[:-1]]))
        starts = np.flatnonzero(edge)
        run = np.cumsum(edge) - 1
        length = np.bincount(run[inside], minlength=len(starts))
        keep |= inside & (length[run] >= size if len(starts) else False)
    at = np.flatnonzero(keep)
    if not len(at):
        return hit, none, none
    # A kept stretch ends where a word is left out or a row begins: symbol 1 stands there.
    gap = np.concatenate([[True], (np.diff(at) > 1) | begins[at[1:]]])
    place = np.arange(len(at)) + np.cumsum(gap) - 1
    seq = np.ones(place[-1] + 2, np.int64)
    seq[place] = symbols[at]
    seq[-1] = 0
    origin = np.zeros(len(seq), np.int64)
    origin[place] = at
    index = FMIndex(seq, len(block.words) + 2)
    lo, hi = index.search(block.windows, block.lengths)
    found = np.flatnonzero(hi > lo)
    counts = (hi - lo)[found]
    total = int(counts.sum())
    if not total:
        return hit, none, none
    window = np.repeat(found, counts)
    ranks = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo[found], counts)
    begin = origin[index.locate(ranks)]
    cover = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + block.lengths[window], -1)
    hit = np.cumsum(cover[:-1]) > 0
    row = np.searchsorted(first, begin, side="right") - 1
    rows_windows = np.unique(np.stack([row, window], 1), axis=0)
    # Each found (row, window) pair becomes one pair for each item that has the window.
    a, b = (np.searchsorted(block.pair_window, rows_windows[:, 1], side=s) for s in ("left", "right"))
    each = b - a
    rows = np.repeat(rows_windows[:, 0], each)
    items = block.pair_item[np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(a, each)]
    both = np.unique(np.stack([rows, items], 1), axis=0) if len(rows) else np.zeros((0, 2), np.int64)
    return hit, both[:, 0], both[:, 1]


def _scan(batches: Iterator[pa.RecordBatch], block: Phrases, text: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, text):
            low = lower_ascii(raw)
            starts, ends, first = word_spans(ALNUM[low], offsets)
            symbols = _symbols(block.words, span_hashes(prefix_hashes(low), starts, ends))
            hit, in_row, item = shard_hits(symbols, first, block)
            n_words, n_hit, items, spans = [], [], [], []
            pair = np.searchsorted(in_row, np.arange(rows.num_rows + 1))
            old_items, old_spans = rows.column("items").to_pylist(), rows.column("spans").to_pylist()
            any_hit = np.add.reduceat(np.concatenate([hit, [False]]).astype(np.int64), first[:-1]) if len(first) > 1 else []
            for k in range(rows.num_rows):
                a, b = first[k], first[k + 1]
                n_words.append(int(b - a))
                found = [] if a == b or not any_hit[k] else list(zip(*(x.tolist() for x in runs(hit[a:b])), strict=True))
                if found and old_spans[k]:
                    found = _union(found + [(s["start"], s["end"]) for s in old_spans[k]])
                elif old_spans[k]:
                    found = [(s["start"], s["end"]) for s in old_spans[k]]
                spans.append([{"start": s, "end": e} for s, e in found])
                n_hit.append(sum(e - s for s, e in found))
                items.append(sorted({*old_items[k], *(block.items[i] for i in item[pair[k]:pair[k + 1]])}))
            put = {"n_words": n_words, "n_hit": n_hit, "items": items, "spans": spans, "contaminated": [n > 0 for n in n_hit]}
            yield pa.RecordBatch.from_arrays(
                [pa.array(put[f.name], f.type) if f.name in put else rows.column(f.name).cast(f.type) for f in schema], schema=schema)


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with n_words, n_hit, items, spans (of word positions, [start, end)) and contaminated.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A window is 10 consecutive
    words of an item, or all words of a shorter one.  A word inside any occurrence of a window is hit;
    spans are the maximal runs of hit words; items lists, sorted as strings, the items with windows
    that occur.

    The benchmark is read in blocks of at most ``block_bytes`` of text (or one item), each sent to the
    tasks in turn, so tasks and driver hold one block whatever the benchmark's size; spans of several
    blocks are merged.  Null texts have no words, null item ids count as an empty string, repeated
    items count once.  Input columns named like the output columns are replaced, others pass through.
    An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    docs = without(docs, *OUTPUT)
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    out = docs.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                      F.expr("cast(array() as array<string>)").alias("items"),
                      F.lit(None).cast(span).alias("spans"), F.lit(False).alias("contaminated"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def scan(rows: DataFrame, chunk: list) -> DataFrame:
        sent = spark.sparkContext.broadcast(phrase_block(chunk))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _scan(batches, sent.value, text, arrow)
        return rows.mapInArrow(run, schema)

    chunk, size, first = [], 0, True
    source = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")), F.coalesce(F.col(item_text), F.lit("")))
    for row in source.toLocalIterator():
        if chunk and size + len(row[1]) * 4 > block_bytes:
            out, chunk, size = materialize(scan(out, chunk), "decontam"), [], 0
        chunk.append((row[0], row[1]))
        size += len(row[1]) * 4
    return scan(out, chunk)


def items_digest(items):
    """Lowercase hex SHA-256 of the comma-joined item ids."""
    return F.sha2(F.array_join(items, ","), 256)


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str:
    """``text`` without the given runs of words, each replaced by one space."""
    if not text:
        return ""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(ALNUM[lower_ascii(raw)], np.array([0, len(raw)]))
    out, at = [], 0
    for s, e in spans:
        out += [raw[at:starts[s]].tobytes(), b" "]
        at = ends[e - 1]
    return b"".join([*out, raw[at:].tobytes()]).decode()
