"""Removal of repeated byte strings by sorting the suffixes that could repeat.

Every window of ``length`` bytes is owned by an anchor, the least-hashed gram in it, so equal windows
have equal anchors at equal places.  Windows of one anchor are one record; only records whose anchor
occurs twice go on.  Equal records form a class and are kept once; of anchors with several classes the
bytes are fetched, and their windows are ordered as suffixes: multikey quicksort by eight bytes at a
time to a shallow depth, then blind tries for groups with long common prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import mix, prefix_hashes, runs, sha256_hex, span_hashes, text_key, text_slices
from quarry.session import materialize

#: Bytes of an anchor's gram, bytes to which quicksort goes, bytes of records sorted at a time.
GRAM, SHALLOW, UNIT_BYTES = 32, 32, 2 << 20
OUTPUT = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")
_DOC = ("__id", "__th")


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def anchored(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows, anchor hash and content hash of the records of a slice."""
    if len(raw) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    sums = prefix_hashes(raw)
    gram = min(GRAM, length)
    at = np.arange(len(raw) - gram + 1)
    grams = span_hashes(sums, at, at + gram)
    # The leftmost of the least hashes: 32 bits of hash, then the place.
    owner = _sliding_min((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), length - gram + 1) & np.uint64(0xFFFFFFFF)
    starts = np.arange(len(owner))
    row = np.searchsorted(offsets, starts, side="right") - 1
    whole = starts + length <= offsets[row + 1]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
    fresh &= whole
    first = np.flatnonzero(fresh)
    # Whole windows of a row come before its cut ones, so a record ends before the next or the first cut window.
    stop = np.append(first[1:], len(owner))
    last = np.minimum(stop, offsets[row[first] + 1] - length + 1) if len(first) else stop[:0]
    anchor = owner[first].astype(np.int64)
    content = mix(span_hashes(sums, first, last - 1 + length) + (anchor - first).astype(np.uint64))
    return row[first], first, last - first, grams[anchor].view(np.int64), content.view(np.int64)


def _records(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, "__text", 2 << 20):
            row, first, windows, anchor, content = anchored(raw, offsets, length)
            took = rows.select(list(_DOC)).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*took.columns, pa.array(first - offsets[row], pa.int64()), pa.array(windows.astype(np.int32)), pa.array(anchor), pa.array(content)],
                names=["__id", "__th", "s", "n", "h", "c"])


def _cut(batches: Iterator[pa.RecordBatch], length: int, hashes: bool) -> Iterator[pa.RecordBatch]:
    """The wanted records' bytes (x), or two hashes of each of their windows (u, v)."""
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, "__text", 2 << 20):
            wanted = rows.column("wanted")
            flat = wanted.flatten()
            s, n, h, c = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("s", "n", "h", "c"))
            each = wanted.value_lengths().to_numpy(zero_copy_only=False)
            begin = s + np.repeat(offsets[:-1], each)
            if not hashes:
                x = pa.array([raw[b:b + k + length - 1].tobytes() for b, k in zip(begin.tolist(), n.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(c, pa.int64()), pa.array(n, pa.int32()), x], names=["h", "c", "n", "x"])
                continue
            k = np.repeat(np.arange(len(n)), n)
            j = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
            sums = prefix_hashes(raw)
            u = span_hashes(sums, begin[k] + j, begin[k] + j + length)
            halves = span_hashes(sums, begin[k] + j, begin[k] + j + length // 2)
            v = mix(u + halves * np.uint64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[k], pa.int64()), pa.array(c[k], pa.int64()), pa.array(j, pa.int32()), pa.array(u.view(np.int64)), pa.array(v.view(np.int64))],
                names=["h", "c", "j", "u", "v"])


def repeated_suffixes(raw: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes of ``raw`` at ``starts``, to ``length`` bytes, equal another of their group.

    Deep-shallow sorting of all groups at once.  Shallow: a multikey quicksort whose keys are eight
    bytes.  Deep: in each group that is left, a blind trie branches where members first differ from
    the first member, skipping what they share; its leaves are equal strings.
    """
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(raw) + 1, 8), (1, 1))

    def word(at: np.ndarray, depth) -> np.ndarray:
        left = length - depth
        w = np.ascontiguousarray(words[at + depth]).view(">u8").ravel().astype(np.uint64)
        if np.any(left < 8):
            w = w >> (np.uint64(8) * np.maximum(0, 8 - left).astype(np.uint64))
        return w

    out = np.zeros(len(starts), bool)
    on = np.arange(len(starts))
    depth = 0
    group = group.copy()

    def split(on: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Members in order, without those alone; their new group; the order taken."""
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        number = np.cumsum(new) - 1
        size = np.bincount(number, minlength=1)
        keep = size[number] > 1
        return on[order][keep], number[keep], order[keep]

    while depth < min(SHALLOW, length) and len(on):
        on, g, _ = split(on, group[on], word(starts[on], np.int64(depth)))
        group[on] = g
        depth += 8
    at = np.full(len(starts), depth)
    while len(on):
        g = group[on]
        head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        lead = np.repeat(starts[on[head]], np.diff(np.append(head, len(on))))
        differ = np.full(len(on), length)
        value = np.zeros(len(on), np.uint64)
        same = np.arange(len(on))
        d = at[on].copy()
        while len(same):
            live = d[same] < length
            same = same[live]
            a, b = word(starts[on[same]], d[same]), word(lead[same], d[same])
            unlike = a != b
            hit = same[unlike]
            differ[hit], value[hit] = d[hit], a[unlike]
            same = same[~unlike]
            d[same] += 8
        equal = differ >= length
        count = np.bincount(g, weights=equal, minlength=1)
        out[on[equal & (count[g] > 1)]] = True
        rest = np.flatnonzero(~equal)
        kept, new, order = split(on[rest], g[rest], differ[rest], value[rest])
        at[kept] = differ[rest][order] + 8
        on = kept
        group[on] = new
    return out


def _sorted_units(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows (lo, hi) of the records; records come by anchor, and units end where anchors do."""
    held: list[pa.RecordBatch] = []

    def solve(rows: pa.Table) -> pa.RecordBatch:
        h, c, n = (rows.column(k).to_numpy() for k in ("h", "c", "n"))
        texts = rows.column("x").combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.chunk(0)
        _, offs, data = texts.buffers()
        offsets = np.frombuffer(offs, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
        k = np.repeat(np.arange(len(n)), n)
        j = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))[k]
        found = repeated_suffixes(raw, (offsets[:-1] - offsets[0])[k] + j, group, length)
        # Runs of repeated windows, none across records.
        flags = np.zeros(len(k) + len(n), bool)
        flags[np.arange(len(k)) + k] = found
        a, b = runs(flags)
        base = np.concatenate([[0], np.cumsum(n + 1)])
        record = np.searchsorted(base, a, side="right") - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(h[record], pa.int64()), pa.array(c[record], pa.int64()), pa.array((a - base[record]).astype(np.int32)),
             pa.array((b - 1 - base[record]).astype(np.int32))], names=["h", "c", "lo", "hi"])

    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column("x").nbytes
        while size > UNIT_BYTES:
            rows = pa.Table.from_batches(held).combine_chunks()
            h = rows.column("h").to_numpy()
            lengths = np.cumsum(rows.column("n").to_numpy() + length - 1)
            cuts = np.flatnonzero(h[1:] != h[:-1]) + 1
            if not len(cuts):
                break
            at = cuts[max(0, int(np.searchsorted(lengths[cuts - 1], UNIT_BYTES, side="right")) - 1)]
            yield solve(rows.slice(0, int(at)))
            held = [b for b in rows.slice(int(at)).to_batches() if b.num_rows]
            size = sum(b.column("x").nbytes for b in held)
    if held:
        yield solve(pa.Table.from_batches(held).combine_chunks())


def _removed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, "__text"):
            found = rows.column("found").to_pylist()
            put: list[list] = [[], [], [], []]
            spans = []
            for k, windows in enumerate(found):
                doc = raw[offsets[k]:offsets[k + 1]]
                if windows:
                    cover = np.zeros(len(doc) + 1, np.int64)
                    np.add.at(cover, [w["lo"] for w in windows], 1)
                    np.add.at(cover, [w["hi"] + length for w in windows], -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    a, b = runs(gone)
                    kept = doc[~gone].tobytes()
                else:
                    a = b = np.zeros(0, np.int64)
                    kept = doc.tobytes()
                for column, value in zip(put, (len(doc), int((b - a).sum()), len(a), sha256_hex(kept)), strict=True):
                    column.append(value)
                spans.append([{"start": s, "end": e} for s, e in zip(a.tolist(), b.tolist(), strict=True)])
            n = [pa.array(x, pa.int64()) for x in put[:3]]
            removed = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([rows.column("key"), *n, pa.array(put[3], pa.string()), removed],
                                             names=["key", *OUTPUT])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = 200,
                   hot_classes: int = 20000) -> DataFrame:
    """Key, n_bytes, n_removed, n_spans, kept_sha256 and removed (spans [start, end) of bytes) per row.

    Texts are UTF-8 bytes; every byte covered by a string of ``length`` bytes that also starts anywhere
    else is removed, judged on the input.  Texts shorter than ``length`` keep all.  A null text counts
    as empty.  Rows that repeat key and text repeat each other's strings; null keys are rows like any
    other.  Extra columns are left out, whatever their names.  An empty table gives an empty one.

    An anchor with more than ``hot_classes`` different records (one common passage between ever
    different neighbours) is not sorted in one task: its windows are counted by two 64-bit hashes
    instead, with sums before the shuffle.  All else about copies is decided by counts of classes.
    """
    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__id"), text_key(text).alias("__th"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    records = materialize(rows.mapInArrow(
        lambda b: _records(b, length), f"__id {id_type}, __th long, s long, n int, h long, c long"), "anchors")
    # Sums are written before they are joined, so that AQE can split the join's hot anchors.
    again = materialize(records.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("h"), "again")
    records = materialize(records.join(again, "h", "left_semi"), "repeated-anchors")

    first = F.min(F.struct("__id", "__th", "s", "n"))
    classes = materialize(records.groupBy("h", "c").agg(F.count(F.lit(1)).alias("many"), first.alias("at")), "classes")
    several = materialize(classes.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "several")
    wanted = materialize(classes.join(several, "h").select("h", "c", "k", "at.*"), "wanted")

    def bytes_of(some: DataFrame, schema: str, hashes: bool) -> DataFrame:
        by_doc = some.groupBy(*_DOC).agg(F.collect_list(F.struct("s", "n", "h", "c")).alias("wanted"))
        return _with_doc(rows, by_doc, "inner").select("__text", "wanted").mapInArrow(lambda b: _cut(b, length, hashes), schema)

    cold = (bytes_of(wanted.filter(f"k <= {hot_classes}"), "h long, c long, n int, x binary", False)
            .repartition("h").sortWithinPartitions("h", "c")
            .mapInArrow(lambda b: _sorted_units(b, length), "h long, c long, lo int, hi int"))
    windows = bytes_of(wanted.filter(f"k > {hot_classes}"), "h long, c long, j int, u long, v long", True)
    twice = windows.groupBy("u", "v").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("u", "v")
    hot = windows.join(twice, ["u", "v"], "left_semi").select("h", "c", F.col("j").alias("lo"), F.col("j").alias("hi"))
    copies = classes.filter("many > 1").select("h", "c", F.lit(0).alias("lo"), (F.col("at.n") - 1).alias("hi"))
    single = classes.filter("many = 1").select("h", "c")
    found = copies.unionByName(cold.unionByName(hot).join(single, ["h", "c"], "left_semi"))
    spans = (records.select(*_DOC, "s", "h", "c").join(found, ["h", "c"])
             .groupBy(*_DOC).agg(F.collect_list(F.struct((F.col("s") + F.col("lo")).alias("lo"), (F.col("s") + F.col("hi")).alias("hi"))).alias("found")))
    return _with_doc(rows, spans, "left").select(F.col("__id").alias("key"), "__text", "found").mapInArrow(
        lambda b: _removed(b, length),
        f"key {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start: long, end: long>>"
    ).withColumnRenamed("key", key)


def _with_doc(rows: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """``rows`` joined by document; a null id equals a null id."""
    side = side.select(F.col("__id").alias("__i"), F.col("__th").alias("__t"), *[c for c in side.columns if c not in _DOC])
    return rows.join(side, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__t")), how)
