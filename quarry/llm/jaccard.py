"""Jaccard self-join on word shingles with token-combination prefixes, and its connected components.

The tokens of a document are its distinct shingles.  Two sets that are similar enough share a token
among their first few in any common order, so only these prefixes are indexed.  The order takes rare
tokens first.  Rare tokens are indexed alone; where a prefix reaches frequent tokens it is
extended and they are indexed as pairs, of which similar sets must share one as well.  Documents with
equal sets are one node.  Members of an index entry are verified against its least node first; what
that does not join is verified pair by pair, so no link is lost and no group of copies is squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (SPACED, checked_broadcast, join_counted, lower_ascii, mix, prefix_hashes, span_hashes, text_key, text_slices,
                               word_spans)
from quarry.llm.components import connected_components
from quarry.session import materialize

#: Tokens with hashes in the first half come first in the order; their frequencies are counted.
SLICE = np.uint64(1 << 63)
#: Tokens in at least so many documents are told apart by frequency, the others count as rarest.
KNOWN_DF = 9
#: Those known, sent to all tasks, are at most so many; beyond, only the more frequent are known.
FREQUENT_TOKENS = 4_000_000
#: Tokens in more documents than this are indexed as pairs.
RARE_DF = 256
#: Members of an index entry that are paired in one task.
BLOCK = 256
#: Bytes of text that a task works on at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Tokens that a task makes entries of at a time; a longer document is a slice of its own.
SLICE_TOKENS = 1 << 17
#: Prefixes are so long that similar sets share this many tokens of them, or all of a smaller overlap.
SHARED = 3


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text: ``k`` words, or all of fewer."""
    low = lower_ascii(raw)
    starts, ends, first = word_spans(SPACED[low], offsets)
    words = span_hashes(prefix_hashes(low), starts, ends)
    n = len(words)
    factors = [np.uint64(0xD6E8FEB86659FD93 + 2 * i) for i in range(k)]
    grams = np.zeros(max(0, n - k + 1), np.uint64)
    for i in range(k if len(grams) else 0):
        grams = mix(grams * factors[i] + words[i:i + len(grams)])
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            sets.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            h = np.zeros(1, np.uint64)
            for i in range(b - a):
                h = mix(h * factors[i] + words[a + i])
            sets.append(mix(h + np.uint64(b - a)))
        else:
            sets.append(grams[:0])
    return sets


def _pairs_in(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any set similar to it."""
    return -(-percent * n // 100)


def _size_classes(n: int, percent: int) -> range:
    """Binary size classes of the sets that can be similar to one of ``n``."""
    return range((-(-percent * n // 100)).bit_length(), (100 * n // percent).bit_length() + 1)


def _buckets(size_class: int, percent: int) -> int:
    return max(1, (100 - percent) * (1 << (size_class - 1)) // 300)


def _region(tokens: np.ndarray, percent: int) -> np.ndarray:
    """What the longest prefix can be taken from, whatever the frequencies: the slice, or more by hash."""
    n = len(tokens)
    if n < 2:
        return tokens[:0]
    most = n - _pairs_in(n, percent) + max(SHARED, 1 + max(_buckets(z, percent) for z in _size_classes(n, percent)))
    return tokens[:max(int(np.searchsorted(tokens, SLICE)), min(n, most))]


def _nodes(sets: list[np.ndarray]) -> list[bytes | None]:
    """Two hashes of each whole set; none for an empty one."""
    return [np.array([x.sum(dtype=np.uint64), mix(x + np.uint64(len(x))).sum(dtype=np.uint64)]).tobytes() if len(x) else None for x in sets]


def _sets(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Size and node of each document, and the tokens that its prefixes are taken from."""
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, "__text", SLICE_BYTES):
            sets = shingle_sets(raw, offsets, k)
            regions = [_region(x, percent) for x in sets]
            ends = np.cumsum([0, *(len(x) for x in regions)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("__id"), rows.column("__th"), pa.array([len(x) for x in sets], pa.int64()), pa.array(_nodes(sets), pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(regions).view(np.int64)))],
                names=["__id", "__th", "n", "node", "region"])


def signatures(region: np.ndarray, size: int, classes: np.ndarray, percent: int, rare_class: int) -> tuple[np.ndarray, bool]:
    """Index entries of one document, and whether its prefix was extended for frequent tokens.

    ``classes``: 0 for tokens that are not known as frequent, else the binary logarithm of their
    count.  Unless both are extended, similar sets have ``SHARED`` entries in common (or all of a
    smaller overlap); else one at least."""
    order = np.lexsort((region, classes, region >= SLICE))
    region, classes = region[order], classes[order]
    least = size - _pairs_in(size, percent)
    rare = classes <= rare_class
    short = min(size, least + min(SHARED, _pairs_in(size, percent)))
    if rare[:short].all():
        return mix(region[:short]), False
    out = []
    for z in _size_classes(size, percent):
        buckets = _buckets(z, percent)
        upto = min(size, least + max(SHARED, buckets + 1))
        out.append(mix(region[:upto][rare[:upto]]))
        often = region[:upto][~rare[:upto]]
        bucket = mix(often + np.uint64(z)) % np.uint64(buckets)
        # Pairs within a bucket: with one shared token more than buckets, a bucket has two of them.
        by = np.argsort(bucket, kind="stable")
        often, bucket = often[by], bucket[by]
        for gap in range(1, len(often)):
            same = bucket[gap:] == bucket[:-gap]
            if not same.any():
                break
            a, b = often[:-gap][same], often[gap:][same]
            out.append(mix(mix(np.minimum(a, b) + np.uint64(z)) + np.maximum(a, b)))
    return np.unique(np.concatenate(out)), True


def _entries(batches: Iterator[pa.RecordBatch], frequent: tuple[np.ndarray, np.ndarray], percent: int, rare_class: int) -> Iterator[pa.RecordBatch]:
    tokens, classes = frequent
    low = np.uint64((1 << 20) - 1)
    maybe = np.zeros(1 << 20, bool)
    maybe[(tokens & low).astype(np.int64)] = True
    for batch in batches:
        size, node, lists = batch.column("n").to_numpy(), batch.column("node"), batch.column("region")
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        lo = 0
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_TOKENS, side="right")) - 1)
            whole, ends = flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            its = np.zeros(len(whole), np.uint8)
            on = np.flatnonzero(maybe[(whole & low).astype(np.int64)])
            if len(on):
                at = np.minimum(np.searchsorted(tokens, whole[on]), len(tokens) - 1)
                its[on] = np.where(tokens[at] == whole[on], classes[at], 0)
            found = [signatures(whole[a:b], n, its[a:b], percent, rare_class)
                     for n, a, b in zip(size[lo:hi].tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            row = np.repeat(np.arange(lo, hi), [len(x) for x, _ in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([x for x, _ in found]).view(np.int64)), node.take(pa.array(row)), pa.array(size[row]),
                 pa.array(np.array([e for _, e in found], bool)[row - lo])], names=["sig", "node", "n", "ext"])
            lo = hi


def _whole(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, raw, offsets in text_slices(batch, "__text", SLICE_BYTES):
            sets = shingle_sets(raw, offsets, k)
            yield pa.RecordBatch.from_arrays([rows.column("node"), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["node", "tokens"])


def _overlaps(x: list[np.ndarray], y: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections of the sets of ``x`` with those of ``y``, as matrix products."""
    out = np.zeros((len(x), len(y)), np.float32)
    shared = np.intersect1d(np.concatenate(x), np.concatenate(y)) if x and y else np.zeros(0, np.int64)
    if not len(shared):
        return out

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row, flat = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        same = shared[at] == flat
        order = np.argsort(at[same], kind="stable")
        return row[same][order], at[same][order]
    sides = [places(x), places(y)]
    for lo in range(0, len(shared), columns):
        parts = []
        for (row, at), n in zip(sides, out.shape, strict=True):
            a, b = np.searchsorted(at, [lo, lo + columns])
            part = np.zeros((n, min(columns, len(shared) - lo)), np.float32)
            part[row[a:b], at[a:b] - lo] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links that tie together the roots of a pair of blocks (side 0 and 1, or side 0 with itself)."""
    node, root = table.column("node").to_pylist(), table.column("root").to_pylist()
    tokens = [np.array(t, np.int64) for t in table.column("tokens").to_pylist()]
    side = table.column("side").to_numpy()
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    size = np.array([len(t) for t in tokens], float)
    common = _overlaps([tokens[i] for i in left], [tokens[i] for i in right])
    linked = 100 * common >= percent * (size[left][:, None] + size[right][None] - common)
    up: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        while x in up:
            x = up[x]
        return x
    a, b = [], []
    for i, j in zip(*(side_[k].tolist() for side_, k in zip((left, right), np.nonzero(linked), strict=True)), strict=True):
        p, q = top(root[i]), top(root[j])
        if p != q:
            up[p] = q
            a.append(node[i])
            b.append(node[j])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _fits(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 4, percent: int = 85) -> DataFrame:
    """Key, __th, n_shingles, component_id and kept for each row.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a set has the distinct shingles of ``k`` words, or
    the whole sequence of fewer.  Two documents link when 100 * intersection >= percent * union.
    component_id is the smallest key reachable by links, the document's own included (null keys last);
    kept marks the one document of its component that stays.  A null or empty text has an empty set and links with
    nothing, itself kept.  Rows that repeat key and text are all marked alike.  Extra columns are left
    out, whatever their names.  An empty table gives an empty one.
    """
    spark = docs.sparkSession
    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__id"), text_key(text).alias("__th"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    # Texts are cut into shingles once; what prefixes are taken from, about half of the tokens, is written with the sets.
    sets = materialize(rows.mapInArrow(lambda b: _sets(b, k, percent), f"__id {id_type}, __th long, n long, node binary, region array<long>"), "sets")
    regions, sets = sets.filter("n > 1").select("n", "node", "region"), sets.drop("region")

    # The first document of each set, with sums before the shuffle: exact copies meet nowhere else.
    place = lambda: F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__th").alias("th"))
    first = materialize(sets.filter("n > 0").groupBy("node").agg(F.min(place()).alias("doc"), F.count(F.lit(1)).alias("k")), "first-documents")

    # Frequencies of the tokens that prefixes are taken from, over all documents.
    counts = regions.select(F.explode("region").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    classes = materialize(counts.filter(F.col("df") >= KNOWN_DF).select("token", F.ceil(F.log2("df")).cast("int").alias("class")), "token-classes")
    least, total = 64, 0
    for c, number in sorted(((r["class"], r["count"]) for r in classes.groupBy("class").count().collect()), reverse=True):
        total += number
        if total > FREQUENT_TOKENS:
            break
        least = c
    got = classes.filter(F.col("class") >= least).toArrow()
    tokens = got.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    frequent = spark.sparkContext.broadcast((tokens[order], got.column("class").to_numpy().astype(np.uint8)[order]))
    rare_class = max(int(RARE_DF).bit_length() - 1, least - 1 if least < 64 else 0)
    # Entries are made twice: once to count members, with sums before the shuffle, and once to keep those
    # that have two, so that the many entries of one member are never written.
    made = regions.mapInArrow(lambda b: _entries(b, frequent.value, percent, rare_class), "sig long, node binary, n long, ext boolean")
    met = materialize(made.groupBy("sig").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("sig"), "met")
    entries = materialize(made.join(met, "sig", "left_semi").distinct(), "entries")

    def sharing(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with as many common entries as similar sets have."""
        enough = F.least(F.lit(SHARED), F.ceil(F.least("an", "bn") * percent / 100))
        counted = pairs.filter(_fits(F.col("an"), F.col("bn"), percent)).groupBy("a", "b", "an", "bn", "both").agg(F.count(F.lit(1)).alias("shared"))
        return counted.filter(F.col("both") | (F.col("shared") >= enough)).select("a", "b")

    # First every member of an entry with the entry's least node; hot entries do not shuffle.
    hubs = materialize(entries.groupBy("sig").agg(F.min(F.struct("node", "n", "ext")).alias("hub"), F.count(F.lit(1)).alias("members"))
                       .filter("members > 1").select("sig", "members", "hub.*"), "hubs")
    hubs = hubs.select("sig", "members", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("ext").alias("bext"))
    star = sharing(join_counted(entries, hubs, ["sig"], "members").filter("node <> b")
                   .select(F.col("node").alias("a"), "b", F.col("n").alias("an"), "bn", (F.col("ext") & F.col("bext")).alias("both")))
    star = _verified(materialize(star, "star-pairs"), rows, first, k, percent)
    links = star.filter("linked").select("a", "b")
    roots = materialize(connected_components(links), "star-components")

    # Then, in entries that hold several components still, every pair across them.  Entries of up to
    # BLOCK members are joined with themselves; larger ones, which only frequent tokens have, mostly
    # hold the same members and are put together first, then compared block by block.
    rooted = materialize(entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted-entries")
    open_ = materialize(rooted.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members"))
                        .filter("lo <> hi"), "open")
    small = materialize(rooted.join(open_.filter(F.col("members") <= BLOCK).select("sig"), "sig"), "small-entries")
    one = small.select("sig", "node", "n", "ext", "root")
    two = small.select("sig", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("ext").alias("bext"), F.col("root").alias("broot"))
    across = (one.join(two, "sig").filter((F.col("node") > F.col("b")) & (F.col("root") != F.col("broot")) & _fits(F.col("n"), F.col("bn"), percent))
              .select(F.col("node").alias("a"), "b", F.col("n").alias("an"), "bn", (F.col("ext") & F.col("bext")).alias("both")))
    across = sharing(across).join(star.select("a", "b"), ["a", "b"], "left_anti")
    more = _verified(materialize(across, "cross-pairs"), rows, first, k, percent).filter("linked").select("a", "b")
    large = _linked_in_blocks(join_counted(rooted, open_.filter(F.col("members") > BLOCK).select("sig", "members"), ["sig"], "members"), rows, first, k, percent)
    every = materialize(links.unionByName(more).unionByName(large), "all-links")
    roots = connected_components(every)

    # Component ids: the least key of all documents of all nodes of a component.
    rooted = materialize(first.withColumnRenamed("k", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "node-roots")
    leasts = materialize(rooted.groupBy("root").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("k")), "root-documents")
    named = materialize(join_counted(rooted, leasts, ["root"]).select("node", "least", F.col("copies").alias("k")), "named-nodes")
    out = join_counted(sets.filter("n > 0"), named, ["node"]).unionByName(sets.filter("n = 0"), allowMissingColumns=True)
    return out.select(
        F.col("__id").alias(key), "__th", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least.id")).otherwise(F.col("__id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("least") == place()).otherwise(True).alias("kept"))


def _whole_sets(nodes: DataFrame, rows: DataFrame, first: DataFrame, k: int) -> DataFrame:
    """(node, tokens): the whole sets of the given nodes, from the first document of each."""
    docs = materialize(first.join(nodes.distinct(), "node").select("node", F.col("doc.id").alias("__i"), F.col("doc.th").alias("__t")), "pair-documents")
    docs = checked_broadcast(docs, 64)
    texts = rows.join(docs, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__t"))).select("node", "__text")
    return materialize(texts.mapInArrow(lambda b: _whole(b, k), "node binary, tokens array<long>").dropDuplicates(["node"]), "pair-sets")


def _verified(pairs: DataFrame, rows: DataFrame, first: DataFrame, k: int, percent: int) -> DataFrame:
    """``pairs`` of nodes (a, b) with ``linked``, from their whole sets."""
    whole = _whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")), rows, first, k)
    both = (pairs.join(whole.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a")
            .join(whole.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    linked = 100 * common >= percent * (F.size("x") + F.size("y") - common)
    return materialize(both.select("a", "b", linked.alias("linked")), "verified")


def _linked_in_blocks(entries: DataFrame, rows: DataFrame, first: DataFrame, k: int, percent: int) -> DataFrame:
    """Links that tie the roots of large entries (sig, node, root) together.

    Entries that share members form a crowd.  Its members are dealt by hash into blocks, and each pair
    of blocks is one task's: matrix products give all overlaps, and only links that tie further roots
    together come back.
    """
    entries = materialize(entries.select("sig", "node", "root"), "large-entries")
    if entries.isEmpty():
        return entries.select(F.col("node").alias("a"), F.col("node").alias("b"))
    least = materialize(entries.groupBy("sig").agg(F.min("node").alias("b")), "large-least")
    crowds = materialize(connected_components(entries.join(least, "sig").select(F.col("node").alias("a"), "b").distinct()), "crowds")
    members = entries.select("node", "root").distinct().join(crowds.select("node", F.col("root").alias("crowd")), "node")
    sizes = members.groupBy("crowd").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    members = materialize(members.join(sizes.select("crowd", blocks.alias("blocks")), "crowd"), "crowd-members")
    whole = _whole_sets(members.select("node"), rows, first, k)
    members = members.join(whole, "node").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    left = members.select("crowd", "node", "root", "tokens", F.lit(0).alias("side"), F.col("block").alias("i"),
                          F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"))
    right = members.filter("block > 0").select("crowd", "node", "root", "tokens", F.lit(1).alias("side"),
                                               F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i"), F.col("block").alias("j"))
    return (left.unionByName(right).groupBy("crowd", "i", "j").applyInArrow(lambda t: _block_links(t, percent), "a binary, b binary"))
