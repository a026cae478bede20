"""Prefix trie of conversations by truncation peeling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import checked_broadcast, mix
from quarry.session import materialize

#: Turns that a task peels at a time, and the least number of paths among them.
RANGE_TURNS, RANGE_PATHS = 1 << 18, 64
#: So many open paths or fewer are peeled to the end by one task; more are peeled by ranges again.
LAST_PATHS = 20_000
#: Ids in one piece of an ends list.
PACK_IDS = 1024

_TURNS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_EVENT = (("depth", pa.int32()), ("n", pa.int64()), ("conv", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()))
_NODE = (("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
         ("k1", pa.int64()), ("k2", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()))
_OUT = pa.schema([*_NODE, ("path", _TURNS), ("bytes", pa.list_(pa.int64())), *[(f"e_{name}", pa.list_(kind)) for name, kind in _EVENT]])
_DDL = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
        "k1 long, k2 long, p1 long, p2 long, path array<struct<a:long,b:long>>, bytes array<long>, "
        "e_depth array<int>, e_n array<long>, e_conv array<long>, e_children array<long>, e_leaves array<long>, e_saved array<long>, e_ends array<string>")
_NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- paths ----------------------------------------------------------------------------------------

class _Paths:
    """Consecutive paths (turn hashes, bytes of texts) in trie order."""

    def __init__(self, a: np.ndarray, b: np.ndarray, size: np.ndarray, lengths: np.ndarray) -> None:
        self.a, self.b, self.size, self.lengths = a, b, size, lengths
        self.off = np.concatenate([[0], np.cumsum(lengths)])

    def adjacent(self) -> np.ndarray:
        """Turns that each path shares with the one before it; -1 for the first."""
        n = self.lengths
        least = np.minimum(n[1:], n[:-1])
        seg = np.repeat(np.arange(1, len(n)), least)
        j = np.arange(len(seg)) - np.repeat(np.cumsum(least) - least, least)
        x, y = self.off[seg] + j, self.off[seg - 1] + j
        bad = np.flatnonzero((self.a[x] != self.a[y]) | (self.b[x] != self.b[y]))
        out = np.concatenate([[-1], least])
        which, first = np.unique(seg[bad], return_index=True)
        out[which] = j[bad[first]]
        return out

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of every prefix, at its last turn."""
        at = (np.arange(len(self.a)) - np.repeat(self.off[:-1], self.lengths)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out = []
        for x in (self.a, self.b):
            run = np.bitwise_xor.accumulate(mix(x.view(np.uint64) + at)) if len(x) else x.view(np.uint64)
            before = np.concatenate([np.zeros(1, np.uint64), run])[self.off[:-1]]
            out.append((run ^ np.repeat(before, self.lengths)).view(np.int64))
        return out[0], out[1]


class _RangeMin:
    """Least value of any range of an array."""

    def __init__(self, x: np.ndarray) -> None:
        self.levels = [x]
        step = 1
        while 2 * step <= len(x):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of positions lo to hi, both included, lo <= hi."""
        level = np.frexp((hi - lo + 1).astype(float))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            x = self.levels[k]
            out[at] = np.minimum(x[lo[at]], x[hi[at] - (1 << int(k)) + 1])
        return out


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Values and lengths of a list column."""
    return column.flatten(), np.diff(column.offsets.to_numpy()).astype(np.int64)


# -- peeling ----------------------------------------------------------------------------------------

def _peel(paths: _Paths, events: dict[str, np.ndarray], closed: bool) -> Iterator[pa.RecordBatch]:
    """Nodes of a range of paths, from the deepest turn to the root.

    ``events``: what is known of nodes before peeling: item (its path), depth, n, conv, children, leaves, saved,
    ends; a path that ends is one event.  At each depth the paths that end there join the nodes that
    survive from below, all are grouped by their first ``depth`` turns, and the groups lose their last turn.
    Unless the range is ``closed``, nodes on its first and last path may have members in other ranges;
    these paths come out as rows with ``path`` and with what the range adds to each of their nodes.
    """
    m = len(paths.lengths)
    lcp = paths.adjacent()
    least = _RangeMin(lcp)
    key1, key2 = paths.keys()
    head = np.minimum.accumulate(np.concatenate([[paths.lengths[0]], lcp[1:]]))
    tail = np.minimum.accumulate(np.concatenate([[paths.lengths[-1]], lcp[:0:-1]]))[::-1]
    by = np.lexsort((events["item"], -events["depth"]))
    events = {k: v[by] for k, v in events.items()}
    deepest = int(events["depth"][0])
    upto = np.searchsorted(-events["depth"], -np.arange(deepest, -1, -1), side="right")
    none = np.zeros(0, np.int64)
    live = dict.fromkeys(("rep", "n", "conv", "children", "leaves", "saved"), none) | {"ends": np.zeros(0, object)}
    found: list[pa.RecordBatch] = []
    edges: list[list[tuple]] = [[], []]
    began = 0
    for step, depth in enumerate(range(deepest, -1, -1)):
        ended = slice(began, int(upto[step]))
        began = ended.stop
        below = len(live["rep"])
        now = {"rep": np.concatenate([live["rep"], events["item"][ended]]), "children": np.concatenate([np.ones(below, np.int64), events["children"][ended]])}
        now |= {k: np.concatenate([live[k], events[k][ended]]) for k in ("n", "conv", "leaves", "saved")}
        now["ends"] = np.concatenate([np.full(below, None, object), events["ends"][ended]])
        if not len(now["rep"]):
            live = {k: v[:0] for k, v in live.items()}
            continue
        order = np.argsort(now["rep"], kind="stable")
        rep = now["rep"][order]
        new = np.ones(len(rep), bool)
        apart = np.flatnonzero(rep[1:] != rep[:-1])
        new[1:] = False
        new[apart + 1] = least(rep[apart] + 1, rep[apart + 1]) < depth
        first = np.flatnonzero(new)
        group = np.empty(len(rep), np.int64)
        group[order] = np.cumsum(new) - 1
        node = {"rep": rep[first], "conv": np.minimum.reduceat(now["conv"][order], first)}
        node |= {k: np.add.reduceat(now[k][order], first) for k in ("n", "children", "leaves", "saved")}
        node["ends"] = np.full(len(first), None, object)
        has = np.flatnonzero(now["ends"] != None)  # noqa: E711
        node["ends"][group[has]] = now["ends"][has]
        on_first = (head[node["rep"]] >= depth) & (not closed)
        on_last = (tail[node["rep"]] >= depth) & (not closed) & ~on_first
        inner = ~(on_first | on_last)
        size = paths.size[paths.off[node["rep"]] + depth - 1] if depth else np.zeros(len(first), np.int64)
        at = (paths.off[node["rep"]] + depth - 1)
        keys = (key1[at], key2[at]) if depth else (np.zeros(len(first), np.int64),) * 2
        if below:
            mine = group[:below]
            found.append(_nodes(live, depth + 1, np.where(inner, node["conv"], 0)[mine], ~inner[mine], keys[0][mine], keys[1][mine]))
        for side, flags in enumerate((on_first, on_last)):
            edges[side] += [(depth, *[int(node[k][i]) for k in ("n", "conv", "children", "leaves", "saved")], node["ends"][i]) for i in np.flatnonzero(flags)]
        node["leaves"] = np.where(node["children"] == 0, 1, node["leaves"])
        node["saved"] = node["saved"] + (node["n"] - 1) * size
        live = {k: v[inner] for k, v in node.items()}
        live["k1"], live["k2"] = keys[0][inner], keys[1][inner]
        if len(found) >= 256 or sum(map(len, found)) > 50_000:
            yield from found
            found = []
    if closed:
        found.append(_nodes(live, 0, np.zeros(1, np.int64), np.ones(1, bool), *[np.zeros(1, np.int64)] * 2))
    yield from found
    for item, side in zip((0, m - 1), edges, strict=True):
        if side:
            yield _edge(paths, item, side)


def _nodes(live: dict, depth: int, parent: np.ndarray, unknown: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> pa.RecordBatch:
    n = len(live["rep"])
    ends = [_NO_ENDS if e is None else e for e in live["ends"]]
    columns = [live["conv"], np.full(n, depth, np.int64), pa.array(parent, pa.int64(), mask=unknown), live["n"], live["children"], live["leaves"], live["saved"],
               pa.array(ends, pa.string()), live["k1"], live["k2"], p1, p2]
    columns = [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(columns + [pa.nulls(n, f.type) for f in list(_OUT)[len(_NODE):]], schema=_OUT)


def _edge(paths: _Paths, item: int, side: list[tuple]) -> pa.RecordBatch:
    at = slice(int(paths.off[item]), int(paths.off[item + 1]))
    path = [{"a": int(a), "b": int(b)} for a, b in zip(paths.a[at], paths.b[at], strict=True)]
    values = [path, paths.size[at].tolist(), *[list(x) for x in zip(*side, strict=True)]]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(1, kind) for _, kind in _NODE] + [pa.array([v], f.type) for v, f in zip(values, list(_OUT)[len(_NODE):], strict=True)], schema=_OUT)


def _chunks(items: Iterator[tuple], closed: bool, most: int, least: int) -> Iterator[pa.RecordBatch]:
    """Items (turn hashes a and b, bytes, events) in trie order, peeled in ranges of ``most`` turns and ``least`` paths or more."""
    held: list[tuple] = []
    turns = 0
    for item in items:
        held.append(item)
        turns += len(item[0])
        if not closed and turns >= most and len(held) >= least:
            yield from _peel_items(held, closed)
            held, turns = [], 0
    if held:
        yield from _peel_items(held, closed)


def _peel_items(items: list[tuple], closed: bool) -> Iterator[pa.RecordBatch]:
    paths = _Paths(*[np.concatenate([x[k] for x in items]) for k in range(3)], np.array([len(x[0]) for x in items], np.int64))
    flat = [(i, *e) for i, x in enumerate(items) for e in x[3]]
    columns = list(zip(*flat, strict=True))
    events = {k: np.array(c, np.int64) for k, c in zip(("item", "depth", "n", "conv", "children", "leaves", "saved"), columns[:7], strict=True)}
    events["ends"] = np.empty(len(flat), object)
    events["ends"][:] = columns[7]
    yield from _peel(paths, events, closed)


def _batch_paths(batch: pa.RecordBatch) -> _Paths:
    turns, lengths = _lists(batch.column("path"))
    size, _ = _lists(batch.column("bytes"))
    return _Paths(turns.field(0).to_numpy(zero_copy_only=False), turns.field(1).to_numpy(zero_copy_only=False), size.to_numpy(zero_copy_only=False), lengths)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours with one path become a row: its least id, their number and the list of their ids."""
    for batch in batches:
        if not batch.num_rows:
            continue
        paths = _batch_paths(batch)
        n = paths.lengths
        same = np.concatenate([[False], (paths.adjacent()[1:] == n[1:]) & (n[1:] == n[:-1])])
        run = np.flatnonzero(~same)
        place = np.arange(len(n)) - run[np.cumsum(~same) - 1]
        first = np.flatnonzero(place % PACK_IDS == 0)
        conv = batch.column("c").to_pylist()
        ends = [*first[1:].tolist(), len(conv)]
        ids = [",".join(map(str, conv[a:b])) for a, b in zip(first.tolist(), ends, strict=True)]
        took = batch.take(pa.array(first))
        yield pa.RecordBatch.from_arrays(
            [took.column("path"), took.column("bytes"), took.column("c"), pa.array(np.diff([*first, len(conv)]), pa.int64()), pa.array(ids, pa.string())],
            names=["path", "bytes", "c", "n", "ids"])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Items of sorted packs; the ids of equal paths are hashed as they come."""
    held: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        paths = _batch_paths(batch)
        off = paths.off.tolist()
        for i, (conv, n, ids) in enumerate(zip(batch.column("c").to_pylist(), batch.column("n").to_pylist(), batch.column("ids").to_pylist(), strict=True)):
            a, b = paths.a[off[i]:off[i + 1]], paths.b[off[i]:off[i + 1]]
            if held and np.array_equal(held[0], a) and np.array_equal(held[1], b):
                held[5].update(b"," + ids.encode())
                held = (*held[:4], held[4] + n, held[5])
                continue
            if held:
                yield _class(held)
            held = (a, b, paths.size[off[i]:off[i + 1]], conv, n, hashlib.sha256(ids.encode()))
    if held:
        yield _class(held)


def _class(held: tuple) -> tuple:
    a, b, size, conv, n, digest = held
    return a, b, size, [(len(a), n, conv, 0, 0, 0, digest.hexdigest())]


def _open_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        if not batch.num_rows:
            continue
        paths = _batch_paths(batch)
        off = paths.off.tolist()
        events = zip(*[batch.column(f"e_{name}").to_pylist() for name, _ in _EVENT], strict=True)
        for i, lists in enumerate(events):
            at = slice(off[i], off[i + 1])
            yield paths.a[at], paths.b[at], paths.size[at], list(zip(*lists, strict=True))


# -- conversations ------------------------------------------------------------------------------------

def turn_sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(c, turns): every conversation's turns in order, each as two 64-bit hashes of role and text and the
    text's bytes.  A null role or text is empty; a null turn comes first; turns of one number follow each
    other in an order that their content fixes; rows without conversation id take no part."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("t"), F.xxhash64(F.lit(1), *said).alias("a"), F.xxhash64(F.lit(2), *said).alias("b"),
        F.octet_length(said[1]).cast("long").alias("size"))
    return rows.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("t", "a", "b", "size"))).alias("turns"))


def share_openings(sequences: DataFrame, every: int = 5, most: int = 8) -> DataFrame:
    """Rebuilt conversations: c's first h turns are those of conversation c - c % ``every`` (none if it is absent),
    the rest its own; h is crc32(c as text) % (``most`` + 1).  Donors' openings are at most ``most`` turns, so
    the join carries little."""
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(most + 1)).cast("int")
    donors = sequences.filter(F.col("c") % every == 0).select(F.col("c").alias("donor"), F.slice("turns", 1, most).alias("opening"))
    nothing = F.slice("turns", 1, 0)
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    both = sequences.join(donors, (F.col("c") - F.col("c") % every) == F.col("donor"), "left")
    return both.select("c", F.concat(F.slice(F.coalesce("opening", nothing), F.lit(1), h), own).alias("turns"))


def prefix_trie(sequences: DataFrame, range_turns: int = RANGE_TURNS, range_paths: int = RANGE_PATHS, last_paths: int = LAST_PATHS) -> DataFrame:
    """Nodes of the prefix trie of ``sequences`` (c, turns as of ``turn_sequences``): conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    A node is a distinct sequence of first ``depth`` turns, a conversation without turns ends at the root, and
    an empty table has no node.  Conversations are ranged by their turns, so equal openings are neighbours
    whatever their number, and every range is peeled from its deepest turn: those that end at a depth join
    the nodes that survive from below, the last turn goes, what is equal now is grouped, and counts,
    leaves and saved bytes are summed on the way.  A range decides all its nodes but those on its
    first and last path; these few open paths are ranged and peeled again, at last by one task.  Equal
    conversations become one row for each 1,024 of a task before the ranges are peeled; their ids are
    hashed in ascending order as a stream.

    A task holds a range of ``range_turns`` turns, of 24 bytes each without their text; the turns of one conversation
    come as one row.  Sequences are told apart by 128 bits a turn.
    """
    spark = sequences.sparkSession
    rows = materialize(sequences.select(
        "c", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"))).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("bytes")), "conversations")
    ddl = "path array<struct<a:long,b:long>>, bytes array<long>, c long, n long, ids string"
    packs = materialize(rows.repartitionByRange("path", "c").sortWithinPartitions("path", "c").mapInArrow(_packs, ddl), "equal-conversations")
    rounds = [materialize(packs.repartitionByRange("path").sortWithinPartitions("path", "c").mapInArrow(lambda b: _chunks(_classes(b), False, range_turns, range_paths), _DDL), "peeled")]
    while True:
        opened = rounds[-1].filter("path IS NOT NULL").select("path", "bytes", *[f"e_{name}" for name, _ in _EVENT])
        few = opened.count() <= last_paths
        dealt = opened.coalesce(1) if few else opened.repartitionByRange("path")
        rounds.append(materialize(dealt.sortWithinPartitions("path").mapInArrow(lambda b, few=few: _chunks(_open_paths(b), few, range_turns, range_paths), _DDL), "peeled-again"))
        if few:
            break
    nodes = rounds[0]
    for more in rounds[1:]:
        nodes = nodes.unionByName(more)
    nodes = nodes.filter("path IS NULL").select(*[name for name, _ in _NODE])
    late = rounds[1]
    for more in rounds[2:]:
        late = late.unionByName(more)
    late = late.filter("path IS NULL").select((F.col("depth") + 1).alias("__d"), F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("conv_id").alias("__conv"))
    # Nodes whose parent lay on an open path learn its smallest member now; a parent's children may be many, the open paths are few.
    known = nodes.filter("parent_conv_id IS NOT NULL OR depth = 0")
    asked = nodes.filter("parent_conv_id IS NULL AND depth > 0")
    told = asked.join(checked_broadcast(materialize(late, "open-parents"), 40), (F.col("depth") == F.col("__d")) & (F.col("p1") == F.col("__k1")) & (F.col("p2") == F.col("__k2")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return known.select(*columns).unionByName(told.withColumn("parent_conv_id", F.col("__conv")).select(*columns))
