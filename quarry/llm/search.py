"""Exact top-k inner-product search by columnar branch and bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Components that are accumulated before candidates are compacted, and candidates in one columnar block.
DIMENSIONS, BLOCK_ROWS = 8, 4096
#: Doubles hold whole numbers below this exactly.
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


class _Queries:
    """Queries of one group and length, with the best that each has met so far."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, columns: np.ndarray, k: int) -> None:
        self.ids, self.keys, self.columns, self.k = ids, keys, columns, k
        self.big = _largest(columns)
        self.bar = np.full(len(ids), -np.inf)
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]

    def meet(self, ids: np.ndarray, columns: np.ndarray) -> None:
        for lo in range(0, len(ids), BLOCK_ROWS):
            at = slice(lo, lo + BLOCK_ROWS)
            if len(columns) * self.big * _largest(columns[:, at]) < _EXACT:
                self._bounded(ids[at], columns[:, at])
            else:
                self._whole_numbers(ids[at], columns[:, at])

    def _bounded(self, ids: np.ndarray, c: np.ndarray) -> None:
        """Sums below 2**53, exact in doubles.  Components come block by block, those of most mass in the candidates first.
        After a block a candidate's score is at most its sum so far plus the product of both vectors'
        remaining lengths (Cauchy-Schwarz), and at least that sum less it.  The k-th best lower bound, or the
        k-th best score of earlier blocks, is the query's bar: candidates whose upper bound is below it go."""
        order = np.argsort(-(c * c).sum(axis=1), kind="stable")
        c, q = np.ascontiguousarray(c[order]), self.columns[order]
        dims, n = c.shape
        cuts = [0, *range(DIMENSIONS, dims, DIMENSIONS), dims]
        rest_q, rest_c = (np.sqrt(np.concatenate([np.cumsum((x * x)[::-1], axis=0)[::-1], np.zeros((1, x.shape[1]))])) for x in (q, c))
        # The first block is one product for all queries; after it each query has its own columns.
        opening = q[:cuts[1]].T @ c[:cuts[1]]
        for i, key in enumerate(self.ids):
            alive = np.flatnonzero(ids != key)
            sums = opening[i, alive]
            for lo, hi in zip(cuts[1:], [*cuts[2:], dims], strict=True):
                # Roots are rounded, so the reach is widened.
                reach = rest_q[lo, i] * rest_c[lo, alive] * (1 + 1e-9) + 1e-6
                if len(alive) > self.k:
                    least = sums - reach
                    self.bar[i] = max(self.bar[i], np.partition(least, len(least) - self.k)[len(least) - self.k])
                stay = sums + reach >= self.bar[i]
                if not stay.all():
                    alive, sums = alive[stay], sums[stay]
                if lo < hi and len(alive):
                    sums = sums + q[lo:hi, i] @ (c[lo:hi] if len(alive) == n else c[lo:hi, alive])
            if len(alive):
                top = np.lexsort((ids[alive], -sums))[:self.k]
                self._keep(i, zip((-sums[top]).astype(np.int64).tolist(), ids[alive[top]].tolist(), strict=True))

    def _whole_numbers(self, ids: np.ndarray, c: np.ndarray) -> None:
        """The same where sums may pass 2**53: Python's whole numbers without bounds; scores beyond a long are its ends."""
        candidates = [[int(v) for v in x] for x in c.T]
        for i, query in enumerate([int(v) for v in x] for x in self.columns.T):
            scores = ((max(-_LONG - 1, min(_LONG, sum(a * b for a, b in zip(query, x, strict=True)))), j) for x, j in zip(candidates, ids.tolist(), strict=True) if j != self.ids[i])
            self._keep(i, ((-s, j) for s, j in scores))

    def _keep(self, i: int, found: Iterator[tuple[int, int]]) -> None:
        """Pairs of (score less than zero, id)."""
        self.best[i] = sorted([*self.best[i], *found])[:self.k]
        if len(self.best[i]) == self.k:
            self.bar[i] = max(self.bar[i], -self.best[i][-1][0])

    def rows(self) -> pa.RecordBatch:
        flat = [(int(q), int(key), j, -s) for q, key, best in zip(self.ids, self.keys, self.best, strict=True) for s, j in best]
        columns = list(zip(*flat, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["query_id", "query_key", "vec_id", "score"])


def _largest(columns: np.ndarray) -> int:
    return int(np.abs(columns).max()) if columns.size else 0


def _columns(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Components of vectors of one length, one row for each component: floor(scale * x), as doubles."""
    whole = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
    return np.ascontiguousarray(whole.reshape(len(column), dims).T)


def _search(batches: Iterator[pa.RecordBatch], k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, share, length and kind: the queries of a tile, then its candidates."""
    tile: tuple | None = None
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    queries: _Queries | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        head = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "share", "dims", "kind")])
        edges = [0, *(np.flatnonzero((head[:, 1:] != head[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:], strict=False):
            *now, kind = head[:, lo].tolist()
            if tuple(now) != tile:
                if queries:
                    yield queries.rows()
                tile, waiting, queries = tuple(now), [], None
            part = batch.slice(lo, hi - lo)
            ids, columns = part.column("id").to_numpy(), _columns(part.column("vector"), now[2], scale)
            if kind == 0:
                waiting.append((ids, part.column("key").to_numpy(), columns))
                continue
            if waiting:
                queries = _Queries(*[np.concatenate(x, axis=-1) for x in zip(*waiting, strict=True)], k)
                waiting = []
            if queries:
                queries.meet(ids, columns)
    if queries:
        yield queries.rows()


def _usable(table: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x * float(scale)) < F.lit(float("inf"))))
    return rows.filter(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("dims", F.size("vector"))


def exact_top_k(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024,
                group_queries: int = 4096, share_rows: int = 1 << 16) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the ``k`` rows of ``vectors`` with the highest inner product of
    floor(``scale`` * x), the smaller id first among equals; all, if there are fewer.

    Queries are dealt into groups of about ``group_queries``, candidates into shares of about ``share_rows`` (at least as many
    shares as the session has shuffle partitions), and each group meets each share once.  A tile's task holds its
    group and takes the candidates as they come, in columnar blocks; a bar that a query has reached holds
    for later blocks.  No side is sent or held whole, and candidates are dealt by row number, so that
    neither equal vectors nor equal ids make a task larger.  A tile hands on ``k`` rows for a query; a
    ranking by query keeps the first ``k`` of them.

    A row with the query's own id is no candidate.  Vectors that are null, or hold a null, NaN, infinity or a component
    whose multiple is infinite, take no part, nor do rows without id; vectors of different lengths are not compared; candidates that
    repeat an id or a row are results of their own.  Queries that repeat an id with other components
    are asked and ranked apart, equal ones once.  Scores beyond a long are its ends.  Extra columns
    are left out, empty tables give an empty one.
    """
    asked = _usable(queries, key, vector, scale).withColumn("key", F.xxhash64("vector")).dropDuplicates(["id", "key"])
    there = _usable(vectors, key, vector, scale)
    groups = max(1, -(-asked.count() // group_queries))
    shares = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-there.count() // share_rows))
    deal = lambda n, c: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(c)
    tiles = asked.select("id", "key", "vector", "dims", F.lit(0).alias("kind"), F.pmod(F.xxhash64("id", "key"), F.lit(groups)).cast("int").alias("group"), deal(shares, "share"))
    tiles = tiles.unionByName(there.withColumn("share", F.pmod(F.monotonically_increasing_id(), F.lit(shares)).cast("int")).select(
        "id", F.lit(0).cast("long").alias("key"), "vector", "dims", F.lit(1).alias("kind"), deal(groups, "group"), "share"))
    found = (tiles.repartition("group", "share").sortWithinPartitions("group", "share", "dims", "kind")
             .mapInArrow(lambda b: _search(b, k, scale), "query_id long, query_key long, vec_id long, score long"))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
