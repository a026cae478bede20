"""Quality of documents by a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.llm.common import (ALNUM, SPACED, byte_set, held_out, lower_ascii, mix, prefix_hashes, span_hashes, text_slices, without,
                               word_spans)

#: Hashed features of words and of symbol runs, dense features after them, and factors.
HASHED, FACTORS = 1 << 15, 8
DENSE = ("log_bytes", "log_words", "mean_word", "distinct_words", "top_word", "distinct_pairs", "symbols", "digits", "capitals",
         "spaces", "beyond_ascii", "log_lines", "distinct_lines", "word_bytes", "log_n_chars", "no_n_chars")
OUTPUT = ("score", "predicted")
_SYMBOL = ~(byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF), (0x09, 0x0D)) | byte_set((0x20, 0x20)))


def _distinct(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, one place and count of each distinct value of each row, and the number of them by row."""
    key = mix(value + mix(row.astype(np.uint64)))
    _, place, count = np.unique(key, return_index=True, return_counts=True)
    return row[place], place, count, np.bincount(row[place], minlength=n)


def features(raw: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse entries (row, feature, value) of whole texts, and their dense features.

    The value of a word is the logarithm of its count, scaled to a unit vector by row.
    """
    n = len(offsets) - 1
    low = lower_ascii(raw)
    sums = prefix_hashes(low)
    size = np.diff(offsets).astype(float)
    part = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets]) / np.maximum(size, 1)

    starts, ends, first = word_spans(ALNUM[low], offsets)
    row = np.repeat(np.arange(n), np.diff(first))
    hashes = span_hashes(sums, starts, ends)
    words = np.diff(first).astype(float)
    of, place, count, distinct = _distinct(row, hashes, n)
    top = np.zeros(n)
    np.maximum.at(top, of, count)
    same = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
    pairs = mix(hashes[:-1][same] * np.uint64(3) + hashes[1:][same]) if len(row) else hashes
    pair_row = row[1:][same] if len(row) else row
    n_pairs = np.bincount(pair_row, minlength=n)
    distinct_pairs = _distinct(pair_row, pairs, n)[3]

    marks, mark_ends, mark_first = word_spans(_SYMBOL[low], offsets)
    mark_row = np.repeat(np.arange(n), np.diff(mark_first))
    mark_of, mark_place, mark_count, _ = _distinct(mark_row, span_hashes(sums, marks, mark_ends), n)

    lines, line_ends, line_first = word_spans(low != 10, offsets)
    line_row = np.repeat(np.arange(n), np.diff(line_first))
    line_count = np.diff(line_first)
    distinct_lines = _distinct(line_row, span_hashes(sums, lines, line_ends), n)[3]
    spaced = np.diff(word_spans(SPACED[low], offsets)[2])

    entry_row = np.concatenate([of, mark_of])
    hashed = np.concatenate([hashes[place], mix(span_hashes(sums, marks, mark_ends)[mark_place] + np.uint64(1))])
    value = np.log1p(np.concatenate([count, mark_count]))
    value /= np.sqrt(np.bincount(entry_row, weights=value * value, minlength=n))[entry_row]
    some = lambda x, y: x / np.maximum(y, 1)
    known = np.isfinite(n_chars)
    dense = np.stack([
        np.log1p(size), np.log1p(words), some(np.bincount(row, weights=ends - starts, minlength=n), words),
        some(distinct, words), some(top, words), some(distinct_pairs, n_pairs), part(_SYMBOL[raw]), part((raw >= 48) & (raw <= 57)),
        part((raw >= 65) & (raw <= 90)), part(~SPACED[raw]), part(raw >= 0x80), np.log1p(line_count), some(distinct_lines, line_count),
        some(size, spaced), np.where(known, np.log1p(np.maximum(np.where(known, n_chars, 0), 0)), 0.0), (~known).astype(float)], 1)
    return entry_row, (hashed % np.uint64(HASHED)).astype(np.int64), value, dense


@dataclass
class Machine:
    bias: float
    weights: np.ndarray   # (HASHED + dense,)
    factors: np.ndarray   # (HASHED + dense, FACTORS)
    mean: np.ndarray
    scale: np.ndarray

    def entries(self, row, feature, value, dense):
        """All entries of the rows: the sparse ones and the dense ones, standardised and clipped."""
        n = len(dense)
        z = np.clip((dense - self.mean) / self.scale, -4, 4) / 2
        return (np.concatenate([row, np.repeat(np.arange(n), z.shape[1])]),
                np.concatenate([feature, np.tile(HASHED + np.arange(z.shape[1]), n)]), np.concatenate([value, z.ravel()]))

    def score(self, row, feature, value, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds and the rows' factor sums.  All pairwise interactions of a row, in linear time:
        half of (square of the sum - sum of the squares), by factor."""
        out = self.bias + np.bincount(row, weights=self.weights[feature] * value, minlength=n)
        sums = np.empty((n, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            x = self.factors[feature, f] * value
            sums[:, f] = np.bincount(row, weights=x, minlength=n)
            out += (sums[:, f] ** 2 - np.bincount(row, weights=x * x, minlength=n)) / 2
        return out, sums


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], epochs: int = 12, batch: int = 128, rate: float = 0.05, decay: float = 1e-4, seed: int = 3) -> Machine:
    """A machine learnt by adaptive gradient steps from (features, values, dense features, label) rows."""
    size = HASHED + len(DENSE)
    rng = np.random.default_rng(seed)
    dense = np.array([r[2] for r in rows]).reshape(-1, len(DENSE))
    label = np.array([r[3] for r in rows], float)
    spread = dense.std(axis=0) if len(rows) else np.ones(len(DENSE))
    machine = Machine(0.0, np.zeros(size), rng.normal(0, 0.02, (size, FACTORS)),
                      dense.mean(axis=0) if len(rows) else np.zeros(len(DENSE)), np.where(spread > 1e-9, spread, 1.0))
    if not len(rows):
        return machine
    share = label.mean()
    machine.bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    squares = [np.full(size, 1e-8), np.full((size, FACTORS), 1e-8)]
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            each = [len(rows[i][0]) for i in at]
            entry = machine.entries(np.repeat(np.arange(len(at)), each), np.concatenate([rows[i][0] for i in at]),
                                    np.concatenate([rows[i][1] for i in at]), dense[at])
            row, feature, value = entry
            odds, sums = machine.score(row, feature, value, len(at))
            slope = (sigmoid(odds) - label[at]) / len(at)
            touched, where = np.unique(feature, return_inverse=True)
            gx = slope[row] * value
            machine.bias -= rate * slope.sum()
            g = np.bincount(where, weights=gx) + decay * machine.weights[touched]
            squares[0][touched] += g * g
            machine.weights[touched] -= rate * g / np.sqrt(squares[0][touched])
            for f in range(FACTORS):
                v = machine.factors[feature, f]
                g = np.bincount(where, weights=gx * (sums[row, f] - v * value)) + decay * machine.factors[touched, f]
                squares[1][touched, f] += g * g
                machine.factors[touched, f] -= rate * g / np.sqrt(squares[1][touched, f])
    return machine


def _chars(rows: pa.RecordBatch, n_chars: str | None) -> np.ndarray:
    if n_chars is None:
        return np.full(rows.num_rows, np.nan)
    return rows.column(n_chars).cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)


def _featurised(batches: Iterator[pa.RecordBatch], text: str, n_chars: str | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, text):
            row, feature, value, dense = features(raw, offsets, _chars(rows, n_chars))
            by = np.argsort(row, kind="stable")
            cut = pa.array(np.searchsorted(row[by], np.arange(rows.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(cut, pa.array(feature[by].astype(np.int32))), pa.ListArray.from_arrays(cut, pa.array(value[by].astype(np.float32))),
                 pa.array(list(dense), pa.list_(pa.float64())), rows.column("label").cast(pa.int32())], names=["f", "v", "d", "label"])


def _scored(batches: Iterator[pa.RecordBatch], machine: Machine, text: str, n_chars: str | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, text):
            entry = machine.entries(*features(raw, offsets, _chars(rows, n_chars)))
            score = sigmoid(machine.score(*entry, rows.num_rows)[0])
            put = {"score": score, "predicted": (score >= 0.5).astype(np.int32)}
            yield pa.RecordBatch.from_arrays([pa.array(put[f.name], f.type) if f.name in put else rows.column(f.name).cast(f.type) for f in schema], schema=schema)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", n_chars: str | None = "n_chars", most_rows: int = 6000) -> Machine:
    """A machine learnt from a bounded sample: the ``most_rows`` labelled rows that come first by a hash
    of their key, with whole texts.  Held-out rows and null keys or labels are never read for learning."""
    sample = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
              .select(F.col(key).alias("__key"), F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("__key"), "__key", "label").limit(most_rows))
    extra = [n_chars] if n_chars else []
    # At most most_rows rows of two numbers: small enough to broadcast whatever the tables' size.
    rows = docs.select(key, text, *extra).join(F.broadcast(sample), F.col(key) == F.col("__key")).select(text, "label", *extra)
    got = rows.mapInArrow(lambda b: _featurised(b, text, n_chars), "f array<int>, v array<float>, d array<double>, label int").toArrow()
    flat = [(np.array(f, np.int64), np.array(v, float), np.array(d), int(y > 0)) for f, v, d, y in zip(
        *[got.column(c).to_pylist() for c in ("f", "v", "d", "label")], strict=True)]
    flat.sort(key=lambda r: (len(r[0]), r[3], r[2].tolist()))  # the same order whatever the tasks' order
    return train(flat)


def score_quality(docs: DataFrame, machine: Machine, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with score (probability that the quality label is 1) and predicted (1 from 0.5 on).

    Scores depend on the whole text and on ``n_chars`` alone.  A null text counts as empty; an empty text
    has no words and is scored by its structure; a null n_chars is a feature of its own.  A machine
    learnt from no row scores 0.5.  Input columns named like the output columns are replaced, others
    pass through; equal rows score alike.
    """
    docs = without(docs, *OUTPUT)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in
                           docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema])
    arrow = to_arrow_schema(schema)
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    return docs.mapInArrow(lambda b: _scored(b, sent.value, text, n_chars, arrow), schema)
