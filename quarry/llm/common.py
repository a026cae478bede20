"""Helpers shared by the corpus operators: tables, size-checked joins, Arrow slices, byte hashing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A join side is broadcast only if its rows, counted beforehand, fit in so many bytes.
BROADCAST_BYTES = 16 << 20
#: Bytes of text that a task works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without input columns that the operator's own columns replace (any letter case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def checked_broadcast(side: DataFrame, row_bytes: int, bound: int = BROADCAST_BYTES) -> DataFrame:
    """``side`` (a written table, cheap to count) with a broadcast hint if it is small; beyond the
    bound it is left to a shuffled join, whose skewed partitions AQE splits."""
    return F.broadcast(side) if side.count() * row_bytes <= bound else side


def join_counted(rows: DataFrame, sums: DataFrame, on: list[str], count: str = "k", share: int = 100_000) -> DataFrame:
    """``rows`` joined with a written table of one row per key, whose ``count`` says how many rows have it.

    Keys with over 1 in ``share`` of the rows are at most ``share`` keys, whatever the data: these are
    broadcast, and their rows do not shuffle.  No key of the shuffled join has more rows than that.
    """
    bar = max(64, (sums.agg(F.sum(count)).first()[0] or 0) // share)
    hot = sums.filter(F.col(count) > bar).drop(count)
    rest = sums.filter(F.col(count) <= bar).drop(count)
    return (rows.join(F.broadcast(hot), on)
            .unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(rest, on)))


def text_key(text: str = "text") -> Column:
    """With the id, tells rows apart whose ids are null or repeat; equal only for equal rows."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# -- bytes of a text column ---------------------------------------------------------------------

def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of consecutive rows with at most ``limit`` bytes of text, or one row.

    A null text counts as empty.  ``offsets`` has one entry more than there are rows.
    """
    at = batch.schema.get_field_index(column)
    texts = batch.column(at)
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type):
        width = np.int64
    else:
        texts, width = texts.cast(pa.string()), np.int32
    n = len(texts)
    if not n:
        return
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=width)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield batch.slice(lo, hi - lo), raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    upper = (raw >= 65) & (raw <= 90)
    return raw + (upper.view(np.uint8) << 5)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: Bytes of words [^\x20\x09-\x0D]+ and of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (letters, digits, all beyond ASCII).
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def word_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` bytes, none across rows, and each row's first word (n + 1)."""
    n = len(inside)
    if not n:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(offsets), np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets[offsets < n]] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    first[n] = True
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """Running polynomial sums (mod 2**64), from which ``span_hashes`` gets the hash of any span."""
    n = len(raw)
    power, _ = _power_tables(n + 1)
    out = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[:n], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = _power_tables(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashes of single words, equal to ``span_hashes`` of the same bytes in a text."""
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if raw else ends
    return span_hashes(prefix_hashes(np.frombuffer(b"".join(raw), np.uint8)), starts, ends)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8) if flags.dtype == bool else flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text, modulo 3, is 1 (never for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
