"""Removal of line runs that occur earlier in the corpus, by winnowing over line hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACED, join_counted, mix, prefix_hashes, sha256_hex, span_hashes, text_key, text_slices, word_spans
from quarry.session import materialize

#: A repeated run is deleted from so many lines, or so many words, on.
LINES, WORDS = 3, 8

OUTPUT = ("n_lines", "n_deleted", "n_runs", "kept_text", "kept_sha256")
_NEWLINE = 10
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def trimmed_lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Whole lines (start, end without line feed) and their hashes without outer white space; each
    row's first line.  Blank lines have hash 0.  A row has a line more than line feeds, an empty one none."""
    feeds = np.flatnonzero(raw == _NEWLINE)
    full = np.flatnonzero(np.diff(offsets) > 0)
    starts = np.concatenate([offsets[full], feeds + 1])
    owner = np.concatenate([full, np.searchsorted(offsets, feeds, side="right") - 1])
    by = np.lexsort((starts, owner))
    starts, owner = starts[by], owner[by]
    last = np.append(owner[1:] != owner[:-1], True)[:len(owner)]
    ends = np.where(last, offsets[owner + 1], np.append(starts[1:], 0)[:len(owner)] - 1)
    solid = np.flatnonzero(~_BLANK[raw])
    a = np.searchsorted(solid, starts)
    b = np.searchsorted(solid, ends)
    filled = a < b
    sums = prefix_hashes(raw)
    hashes = np.zeros(len(starts), np.uint64)
    if filled.any():
        hashes[filled] = span_hashes(sums, solid[a[filled]], solid[b[filled] - 1] + 1) | np.uint64(1)
    return starts, ends, hashes, np.searchsorted(owner, np.arange(len(offsets)))


def least_runs(words: np.ndarray, first: np.ndarray, n_lines: int, n_words: int) -> tuple[np.ndarray, ...]:
    """First and last line of every least run, and whether it stands for a whole short row.

    A run is enough with ``n_lines`` lines or ``n_words`` words.  Of each line, the shortest run that is
    enough from it on and the shortest up to it are taken, so any repeated run that is enough is the
    union of least ones.  A row without any is one run whole.  ``first``: each row's first line (n + 1).
    """
    n = len(words)
    at = np.arange(n)
    row = np.searchsorted(first, at, side="right") - 1
    upto = np.concatenate([[0], np.cumsum(words)])
    last = np.minimum(at + n_lines - 1, np.searchsorted(upto, upto[:-1] + n_words) - 1)
    start = np.maximum(at - n_lines + 1, np.searchsorted(upto, upto[1:] - n_words, side="right") - 1)
    onward, back = last < first[row + 1], start >= first[row]
    lo = np.concatenate([at[onward], start[back]])
    hi = np.concatenate([last[onward], at[back]])
    short = np.flatnonzero((np.diff(first) > 0) & (np.bincount(row[lo], minlength=len(first) - 1) == 0))
    pairs = np.unique(np.stack([lo, hi]), axis=1)
    whole = np.zeros(pairs.shape[1] + len(short), bool)
    whole[pairs.shape[1]:] = True
    return np.concatenate([pairs[0], first[short]]), np.concatenate([pairs[1], first[short + 1] - 1]), whole


def _positions(batches: Iterator[pa.RecordBatch], n_lines: int, n_words: int) -> Iterator[pa.RecordBatch]:
    """A row for each selected line: its number among the lines with text, its fingerprint, and the
    runs both ways around it that selected it (first, last, hash of all lines)."""
    run_type = pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("h", pa.int64())])
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, "__text"):
            starts, ends, hashes, first = trimmed_lines(raw, offsets)
            filled = np.flatnonzero(hashes)
            first = np.searchsorted(filled, first)
            h = hashes[filled]
            word_starts, _, _ = word_spans(SPACED[raw], offsets)
            words = np.searchsorted(word_starts, ends[filled]) - np.searchsorted(word_starts, starts[filled])
            lo, hi, whole = least_runs(words, first, n_lines, n_words)
            # The least line hash of each run is selected; of equal ones the last.
            selected, least = lo.copy(), np.full(len(lo), np.iinfo(np.uint64).max)
            content = whole.astype(np.uint64)
            for i in range(n_lines if len(lo) else 0):
                at = np.minimum(lo + i, hi)
                inside = lo + i <= hi
                mixed = mix(h[at])
                better = inside & (mixed <= least)
                selected[better], least[better] = at[better], mixed[better]
                content = np.where(inside, mix(content * np.uint64(0xD6E8FEB86659FD93) + h[at]), content)
            by = np.lexsort((hi, lo, selected))
            lo, hi, selected, least, content = lo[by], hi[by], selected[by], least[by], content[by]
            heads = np.flatnonzero(np.append(True, selected[1:] != selected[:-1])[:len(selected)])
            row = np.searchsorted(first, selected, side="right") - 1
            base = first[row]
            runs = pa.StructArray.from_arrays(
                [pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32)), pa.array(content.view(np.int64))], fields=list(run_type))
            took = rows.select(["__id", "__th"]).take(pa.array(row[heads], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*took.columns, pa.array((selected - base)[heads].astype(np.int32)), pa.array(least[heads].view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.append(heads, len(selected)).astype(np.int32)), runs)],
                names=["__id", "__th", "at", "fp", "runs"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, "__text"):
            starts, ends, hashes, first = trimmed_lines(raw, offsets)
            put: list[list] = [[], [], [], [], []]
            for k, later in enumerate(rows.column("later").to_pylist()):
                a, b = int(first[k]), int(first[k + 1])
                gone, n_runs = np.zeros(b - a, bool), 0
                if later:
                    filled = np.flatnonzero(hashes[a:b])
                    cover = np.zeros(len(filled) + 1, np.int64)
                    np.add.at(cover, [run["lo"] for run in later], 1)
                    np.add.at(cover, [run["hi"] + 1 for run in later], -1)
                    inside = np.cumsum(cover[:-1]) > 0
                    gone[filled[inside]] = True
                    n_runs = int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum())
                text = b"\n".join(raw[s:e].tobytes() for s, e in zip(starts[a:b][~gone].tolist(), ends[a:b][~gone].tolist(), strict=True))
                for column, value in zip(put, (b - a, int(gone.sum()), n_runs, text.decode(), sha256_hex(text)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [rows.column("key"), *[pa.array(x, pa.int64()) for x in put[:3]], *[pa.array(x, pa.string()) for x in put[3:]]], names=["key", *OUTPUT])


def drop_repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", n_lines: int = LINES, n_words: int = WORDS) -> DataFrame:
    """Key, n_lines, n_deleted, n_runs, kept_text and kept_sha256 for each row.

    Lines are compared without outer white space; blank ones are kept and do not part a run.  Guaranteed
    to go is every run of ``n_lines`` lines or ``n_words`` words or more (one long line is one) that occurs at an
    earlier place (by key, null last, then line), and every row without such a run whose lines are those
    of an earlier row.  Places in a row that overlap the earliest one do not count, so that one stays; of
    every line, some occurrence stays.

    The windows are the least runs that are enough, onward from each line and back from it; each selects its
    least line hash, and selected positions keep the runs around them.  Positions join by fingerprint and the
    lines that their runs reach both ways; overlapping matches extend to whole runs.  Common lines do not
    shuffle; texts shuffle once, when the runs come to their rows.

    A null or empty text has no lines; a line feed at the end is followed by an empty line.  Rows that
    repeat key and text count as one place, so they are treated alike.  Extra columns are left out.  An
    empty table gives an empty one.
    """
    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__id"), text_key(text).alias("__th"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = f"__id {id_type}, __th long, at int, fp long, runs array<struct<lo: int, hi: int, h: long>>"
    positions = materialize(rows.mapInArrow(lambda b: _positions(b, n_lines, n_words), schema), "line-positions")
    reached = positions.select("__id", "__th", "fp", F.explode("runs").alias("run")).select("__id", "__th", "fp", "run.*")
    # Sums before the shuffle take care of common lines.
    place = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__th").alias("th"), F.col("lo"))
    earliest = materialize(reached.groupBy("fp", "h").agg(F.min(place).alias("earliest"), F.max(place).alias("latest"), F.count(F.lit(1)).alias("k"))
                           .filter("earliest <> latest").select("fp", "h", "earliest", "k"), "earliest-lines")
    same_row = F.col("__id").eqNullSafe(F.col("earliest.id")) & (F.col("__th") == F.col("earliest.th"))
    apart = ~same_row | (F.col("lo") > F.col("earliest.lo") + F.col("hi") - F.col("lo"))
    later = (join_counted(reached, earliest, ["fp", "h"]).filter(apart)
             .groupBy("__id", "__th").agg(F.collect_set(F.struct("lo", "hi")).alias("later")))
    later = materialize(later, "later-runs").select(F.col("__id").alias("__i"), F.col("__th").alias("__t"), "later")
    # Runs grow with the corpus, so at every size the texts shuffle once, to the runs of their row.
    return (rows.join(later.hint("merge"), F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__t")), "left")
            .select(F.col("__id").alias("key"), "__text", "later")
            .mapInArrow(_kept, f"key {id_type}, n_lines long, n_deleted long, n_runs long, kept_text string, kept_sha256 string")
            .withColumnRenamed("key", key))
