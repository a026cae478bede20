"""Tables laid out for filtered listings (B5, F1): clustered files whose
row-group bounds let the reader skip what a filter cannot match."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .aggregates import ordered_limit
from .filters import equality_filter


def _number(df: DataFrame, column: str) -> Column:
    """A number that grows with the column: texts by their first seven bytes."""
    kind, col = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(col, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("double")
    if isinstance(kind, T.BooleanType):
        return col.cast("int").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def cluster_key(df: DataFrame, columns: Sequence[str], bits: int = 5) -> Column:
    """Z-order (Morton) key of ``columns``: each is ranked into 2**``bits``
    classes of about equal size (one aggregate finds the bounds; NULL is class
    0), and the classes' bits take turns, so neighbours in the key are near
    in every column."""
    numbers = {c: _number(df, c) for c in columns}
    steps = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    found = df.agg(*[F.percentile_approx(n, steps, 10_000).alias(f"c{i}") for i, n in enumerate(numbers.values())]).first()
    ranks = []
    for i, n in enumerate(numbers.values()):
        bounds = sorted({b for b in found[f"c{i}"] or [] if b is not None})
        rank = reduce(lambda x, y: x + y, [F.coalesce((n >= F.lit(b)).cast("int"), F.lit(0)) for b in bounds], F.lit(0))
        # Few classes are spread over all bits, so that their order shows in the first of them.
        ranks.append(F.floor(rank * F.lit(1 << bits) / F.lit(len(bounds) + 1)).cast("int"))
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, rank in enumerate(ranks):
            key = key + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(ranks) + place)
    return key


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], row_group_rows: int = 1_000_000, bits: int = 5,
                    then: Sequence[str] = (), mode: str = "errorifexists") -> str:
    """Write ``df`` as Parquet, ranged and sorted by the cluster key of
    ``columns`` and then by ``then``; row groups hold up to ``row_group_rows``
    rows.  The key is not stored."""
    key = "__cluster"
    ranged = df.withColumn(key, cluster_key(df, columns, bits))
    order = [key, *columns, *then]
    (ranged.repartitionByRange(*order).sortWithinPartitions(*order).drop(key)
     .write.mode(mode).option("parquet.block.row.count.limit", str(row_group_rows)).parquet(path))
    return path


def list_rows(table: DataFrame, values: Mapping[str, object], order_by: str, limit: int | None = None) -> DataFrame:
    """B5 + F1: rows equal to ``values`` in order.  On a clustered table the
    pushed filters skip the row groups whose bounds exclude a value."""
    return ordered_limit(equality_filter(table, values), order_by, limit)
