"""Dashboard aggregates (D1-D11) and ordered results (F1, F2).

All aggregates are hash aggregates with a partial (map-side) phase; global
values needed per row (histogram bounds, share totals) are scalar
subqueries, never a cross join or an un-partitioned window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.numbers import analytics_for
from ..session import materialize


def _type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """D1."""
    return df.agg(F.count(F.lit(1)).alias(name))


def book_metrics(df: DataFrame) -> DataFrame:
    """Total rows, avg/min/max price, avg review count (H5 numbers;
    missing, malformed and non-finite values ignored)."""
    price = analytics_for(_type(df, "price"), F.col("price"))
    reviews = analytics_for(_type(df, "review_count"), F.col("review_count"))
    return df.agg(
        F.count(F.lit(1)).alias("total_books"),
        F.avg(price).alias("average_price"),
        F.min(price).alias("minimum_price"),
        F.max(price).alias("maximum_price"),
        F.avg(reviews).alias("average_reviews"),
    )


def car_metrics(df: DataFrame) -> DataFrame:
    """D3: total ads, avg/min/max price, avg mileage."""
    price = analytics_for(_type(df, "price"), F.col("price"))
    mileage = analytics_for(_type(df, "mileage"), F.col("mileage"))
    return df.agg(
        F.count(F.lit(1)).alias("total_ads"),
        F.avg(price).alias("average_price"),
        F.min(price).alias("minimum_price"),
        F.max(price).alias("maximum_price"),
        F.avg(mileage).alias("average_mileage"),
    )


def value_counts(df: DataFrame, column: str | Column, name: str = "value",
                 missing_label: str | None = S.MISSING_LABEL) -> DataFrame:
    """Count per value (NULLs in the missing bucket), count descending,
    ties by value."""
    col = F.col(column) if isinstance(column, str) else column
    if missing_label is not None:
        col = F.coalesce(col.cast("string"), F.lit(missing_label))
    return (df.groupBy(col.alias(name)).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(name)))


def top_k(df: DataFrame, column: str | Column, k: int = S.TOP_BRANDS, name: str = "value") -> DataFrame:
    """The ``k`` most frequent values (TakeOrderedAndProject)."""
    return value_counts(df, column, name).limit(k)


def counts_by_key(df: DataFrame, column: str | Column, name: str = "key",
                  cast: str = "bigint") -> DataFrame:
    """Count per non-NULL key, ordered by key."""
    col = F.col(column) if isinstance(column, str) else column
    return (df.where(col.isNotNull()).groupBy(col.cast(cast).alias(name))
              .agg(F.count(F.lit(1)).alias("count")).orderBy(name))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram with ``bins`` bins over [min, max]; the last
    bin is closed; a constant column gives one bin.  Output: bin, lower,
    upper, count (empty bins omitted)."""
    values = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull()
                                                                     & ~F.isnan("x"))
    lo = values.select(F.min("x")).scalar()
    hi = values.select(F.max("x")).scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).cast("int")
    counted = values.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    lower = F.when(hi == lo, lo).otherwise(lo + F.col("bin") * width)
    upper = F.when(hi == lo, hi).otherwise(lo + (F.col("bin") + 1) * width)
    return counted.select("bin", lower.alias("lower"), upper.alias("upper"), "count").orderBy("bin")


#: Classes of one octave in a first pass: 2 ** OCTAVE_BITS.
OCTAVE_BITS = 12


def histogram_aligned(df: DataFrame, column: str, bins: int) -> DataFrame:
    """D8 with even edges, in one scan: at most ``bins`` bins of the smallest
    power-of-two width that covers all values, edges at multiples of it.
    Output: bin (from 0), lower, upper (open), count; empty bins are omitted,
    NULL, NaN and infinities left out.

    Tasks count fine classes, 4,096 to an octave, each with its bounds; a few
    thousand sums shuffle.  Power-of-two grids nest, so the final width is
    found from these sums and they are counted again by it.  Only where all
    values lie in a range far narrower than they are large do the classes
    not resolve it; then one more scan counts by the width itself.
    """
    if bins < 2:
        raise ValueError("zero is an edge of every grid: bins must be 2 or more")
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where(F.abs("x") < F.lit(float("inf")))
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.abs("x"))) - OCTAVE_BITS)
    octave = F.when(F.col("x") == 0, F.lit(None)).otherwise(step)
    fine = materialize(values.groupBy(octave.alias("step"), F.coalesce(F.floor(F.col("x") / octave), F.lit(0)).alias("class"))
                       .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi")), "fine-classes")
    bounds = fine.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max(F.when(F.col("lo") < F.col("hi"), F.col("step"))).alias("step")).first()
    if bounds["lo"] is None:
        return fine.select(F.col("class").cast("int").alias("bin"), F.col("lo").alias("lower"), F.col("hi").alias("upper"), F.col("c").alias("count"))
    power = -1074 if bounds["lo"] == bounds["hi"] else math.floor(math.log2((bounds["hi"] - bounds["lo"]) / bins)) - 1
    power = max(power, math.floor(math.log2(max(abs(bounds["lo"]), abs(bounds["hi"]), 2.0 ** -900))) - 50)
    first = lambda v: math.floor(v / 2.0 ** power)
    while first(bounds["hi"]) - first(bounds["lo"]) >= bins:
        power += 1
    width = 2.0 ** power
    if bounds["step"] is not None and bounds["step"] > width:
        fine = values.select(F.col("x").alias("lo"), F.lit(1).cast("long").alias("c"))
    place = (F.floor(F.col("lo") / F.lit(width)) - F.lit(first(bounds["lo"]))).cast("int")
    counted = fine.groupBy(place.alias("bin")).agg(F.sum("c").alias("count"))
    lower = (F.col("bin") + F.lit(float(first(bounds["lo"])))) * F.lit(width)
    return counted.select("bin", lower.alias("lower"), (lower + F.lit(width)).alias("upper"), "count").orderBy("bin")


def ranked_values(df: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct values by group (g, v) with their count ``c``, the number of the
    group's values ``before`` them and in all (``n``).

    Equal values are counted first (map-side), so a value or a group that holds
    a third of all rows is a third of nothing after one shuffle of sums.
    Distinct values are range-partitioned by (g, v) and written once; counts
    run on in each partition and are shifted by those of the (partition, group)
    blocks before it.
    """
    values = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = values.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    here = Window.partitionBy("pid", "g").orderBy("v")
    ranged = materialize(counts.repartitionByRange("g", "v").withColumn("pid", F.spark_partition_id())
                         .withColumn("before", F.sum("c").over(here) - F.col("c")), "value-counts")
    blocks = ranged.groupBy("pid", "g").agg(F.sum("c").alias("_sum"))
    whole = Window.partitionBy("g")
    blocks = blocks.select("pid", F.col("g").alias("_g"), F.sum("_sum").over(whole).alias("n"),
                           (F.sum("_sum").over(whole.orderBy("pid")) - F.col("_sum")).alias("_shift"))
    same = (ranged["pid"] == blocks["pid"]) & ranged["g"].eqNullSafe(blocks["_g"])
    return ranged.join(blocks, same).select("g", "v", "c", "n", (F.col("before") + F.col("_shift")).alias("before"))


def _quantile(q: float) -> Column:
    """Linear interpolation between the values at the ranks around q * (n - 1), as an aggregate over ``ranked_values``."""
    place = F.lit(q) * (F.col("n") - 1)
    at = lambda rank: F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("c")), F.col("v")))
    low, high = at(F.floor(place)), at(F.ceil(place))
    return low + (high - low) * F.max(place - F.floor(place))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group n, min, q1, median, q3, max, 1.5·IQR fences and the
    number of values outside them (exact quartiles, linear interpolation).
    NULL groups are left out."""
    ranked = materialize(ranked_values(df.where(F.col(group).isNotNull()), group, value), "ranked-values")
    stats = ranked.groupBy("g").agg(_quantile(0.25).alias("q1"), _quantile(0.5).alias("median"), _quantile(0.75).alias("q3"),
                                    F.max("n").alias("n"), F.min("v").alias("minimum"), F.max("v").alias("maximum"))
    iqr = F.col("q3") - F.col("q1")
    stats = materialize(stats.withColumns({"lower_fence": F.col("q1") - 1.5 * iqr, "upper_fence": F.col("q3") + 1.5 * iqr}), "boxes")
    outside = F.when((F.col("v") < F.col("lower_fence")) | (F.col("v") > F.col("upper_fence")), F.col("c")).otherwise(0)
    outliers = (ranked.join(stats.select("g", "lower_fence", "upper_fence"), "g").groupBy("g").agg(F.sum(outside).alias("outliers")))
    return stats.join(outliers, "g").select(F.col("g").alias(group), "q1", "median", "q3", "lower_fence", "upper_fence",
                                            "n", "minimum", "maximum", "outliers")


#: Normalised rank error of a sketch of size k, 99 of 100 times: RANK_ERROR[0] / k ** RANK_ERROR[1].
RANK_ERROR = (2.296, 0.9723)


def box_sketch(df: DataFrame, group: str, value: str, rank_error: float = 0.01) -> DataFrame:
    """D9 in one pass: n, minimum, maximum, quartiles and 1.5·IQR fences per
    group from mergeable quantile sketches.

    Every task sketches its rows and one small row for each group shuffles.
    A quartile's rank is within ``rank_error`` of its place; the sketch is
    three times as exact as that nearly always holds.  NULL groups, NULLs and
    NaN are left out.
    """
    k = max(8, min(65_535, int((3 * RANK_ERROR[0] / rank_error) ** (1 / RANK_ERROR[1])) + 1))
    v = F.col(value).cast("double")
    rows = df.select(F.col(group).alias("g"), v.alias("v")).where(F.col("g").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
    stats = rows.groupBy("g").agg(F.kll_sketch_agg_double("v", F.lit(k)).alias("_s"), F.count(F.lit(1)).alias("n"),
                                  F.min("v").alias("minimum"), F.max("v").alias("maximum"))
    at = lambda q: F.kll_sketch_get_quantile_double("_s", F.lit(q))
    stats = stats.select("*", at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return stats.select(F.col("g").alias(group), "q1", "median", "q3", (F.col("q1") - 1.5 * iqr).alias("lower_fence"),
                        (F.col("q3") + 1.5 * iqr).alias("upper_fence"), "n", "minimum", "maximum")


def shares(df: DataFrame, column: str | Column, name: str = "value") -> DataFrame:
    """Value counts with their share of the total (pie slices)."""
    counts = value_counts(df, column, name)
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("count") / total)


def scatter_extract(df: DataFrame, x: str, y: str, extra: Sequence[str] = ()) -> DataFrame:
    """Rows with both coordinates present."""
    present = [c for c in extra if c in df.columns]
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y, *present)


def scatter_thinned(df: DataFrame, x: str, y: str, key: str, cells: int = 100, extra: Sequence[str] = ()) -> DataFrame:
    """D11, bounded: one row for each cell of a ``cells`` by ``cells`` grid over
    both ranges, the point whose key's hash is least, with the number of
    points (``count``) it stands for.

    At most ``cells`` squared rows come out of any table, and every point with
    both coordinates is counted.  Of equal keys the least point stands.
    """
    present = [c for c in extra if c in df.columns and c not in (x, y)]
    points = scatter_extract(df.select(F.col(key).alias("_key"), x, y, *present), x, y, ["_key", *present])
    place = []
    for axis in (x, y):
        v = F.col(axis).cast("double")
        lo, hi = (points.select(f(v)).scalar() for f in (F.min, F.max))
        place.append(F.when(lo == hi, F.lit(0)).otherwise(F.least(F.floor((v - lo) / ((hi - lo) / F.lit(float(cells)))), F.lit(cells - 1))).cast("int"))
    point = F.struct(x, y, *present)
    order = F.struct(F.md5(F.coalesce(F.col("_key").cast("string"), F.lit(""))), F.col(x), F.col(y), *present)
    thin = points.groupBy(place[0].alias("x_cell"), place[1].alias("y_cell")).agg(F.min_by(point, order).alias("_p"), F.count(F.lit(1)).alias("count"))
    return thin.select("x_cell", "y_cell", *[F.col(f"_p.`{c}`").alias(c) for c in (x, y, *present)], "count")


def ordered_limit(df: DataFrame, order_by: Sequence[str] | str = "id", limit: int | None = None) -> DataFrame:
    """ORDER BY [LIMIT n]; None = all, 0 = none, negative -> error."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    out = df.orderBy(*cols)
    if limit is None:
        return out
    if int(limit) < 0:
        raise ValueError("limit must not be negative")
    return out.limit(int(limit))
