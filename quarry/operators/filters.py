"""Row filters and derived filter columns.

Every predicate is a plain Column expression so that Catalyst can push it
into the Parquet scan, whatever the number of options.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .. import schema as S


def _and(conds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, conds) if conds else None


def equality_filter(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Conjunctive equality; ``None`` means no predicate on that column."""
    cond = _and([F.col(c) == F.lit(v) for c, v in values.items() if v is not None])
    return df if cond is None else df.filter(cond)


def analysis_category(df: DataFrame, fallthrough_blank: bool = False) -> Column:
    """Category, else product_type.  ``fallthrough_blank`` also skips ''
    (the list filter's ``category or product_type``)."""
    category = F.col("category")
    if fallthrough_blank:
        category = F.nullif(category, F.lit(""))
    return F.coalesce(category, F.col("product_type"))


def _member(col: Column, selected: Iterable | None, dtype: T.DataType | None = None) -> Column | None:
    if selected is None:
        return None
    choices = list(selected)
    if not choices:
        return None
    non_null = [v for v in choices if v is not None]
    if dtype is not None:
        non_null = [F.lit(v).cast(dtype) for v in non_null]
    cond = col.isin(*non_null) if non_null else F.lit(False)
    if len(non_null) != len(choices):
        cond = cond | col.isNull()
    return F.coalesce(cond, F.lit(False))


def multi_select(df: DataFrame, selections: Mapping[str, Iterable | None],
                 derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Per column value-in-set; ``None`` or an empty set selects all.
    NULL rows only match when the caller put ``None`` in the set."""
    derived = dict(derived or {})
    conds = []
    for name, selected in selections.items():
        col = derived.get(name, F.col(name))
        cond = _member(col, selected)
        if cond is not None:
            conds.append(cond)
    cond = _and(conds)
    return df if cond is None else df.filter(cond)


def filter_books(df: DataFrame, categories=None, product_types=None, availabilities=None,
                 ratings=None) -> DataFrame:
    """B6 for books: category uses ``category or product_type``."""
    return multi_select(
        df,
        {"_category": categories, "product_type": product_types,
         "availability": availabilities, "rating": ratings},
        derived={"_category": analysis_category(df, fallthrough_blank=True)},
    )


def filter_cars(df: DataFrame, brands=None, years=None, regions=None, transmissions=None) -> DataFrame:
    """B6 for cars."""
    return multi_select(df, {"brand": brands, "year": years, "region": regions,
                             "transmission": transmissions})


def option_list(df: DataFrame, column: str | Column, name: str = "option") -> DataFrame:
    """Sorted distinct non-NULL values."""
    col = F.col(column) if isinstance(column, str) else column
    return df.select(col.alias(name)).where(F.col(name).isNotNull()).distinct().orderBy(name)


def dashboard_filter(df: DataFrame, columns: Sequence[str],
                     selections: Mapping[str, Sequence | None] | None = None) -> DataFrame:
    """The default selection of each filter is *all non-NULL options*, so
    rows NULL in a filtered column drop out; an empty selection (no options
    or cleared by the user) skips the filter.

    One aggregate counts the non-NULL values of the filters left at their
    default; a default filter with any option is then a plain ``IS NOT NULL``
    and one without options is no filter.  Pass a written table: it is read
    for the counts and again by the result.  Explicit selections are IN lists
    of any size, compared in the column's own type.
    """
    selections = dict(selections or {})
    defaults = [c for c in columns if isinstance(selections.get(c, "all"), str) and selections.get(c, "all") == "all"]
    found = df.agg(*[F.count(F.col(c)).alias(c) for c in defaults]).first() if defaults else {}
    conds = []
    for column in columns:
        if column in defaults:
            if found[column]:
                conds.append(F.col(column).isNotNull())
        elif selections[column]:
            conds.append(_member(F.col(column), selections[column], df.schema[column].dataType))
    cond = _and(conds)
    return df if cond is None else df.where(cond)


def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows NULL in any of ``subset``."""
    return df.na.drop(subset=list(subset))


def null_outside(col: Column, low=None, high=None) -> Column:
    """Keep the value when inside [low, high], else NULL (value, not row)."""
    cond = F.lit(True)
    if low is not None:
        cond = cond & (col >= F.lit(low))
    if high is not None:
        cond = cond & (col <= F.lit(high))
    return F.when(col.isNull() | cond, col)


def missing_bucket(col: Column, label: str = S.MISSING_LABEL) -> Column:
    """NULL -> 'Non renseigné'."""
    return F.coalesce(col.cast("string"), F.lit(label))


def preview(df: DataFrame, order_by: str = "ordinal", n: int = S.PREVIEW_ROWS, total: int | None = None) -> DataFrame:
    """First ``n`` rows in order plus the total row count: ``total`` if it
    is known (``footer_count`` of a stored table), else a scalar subquery."""
    rows = df.select(F.count(F.lit(1))).scalar() if total is None else F.lit(total).cast("bigint")
    return df.orderBy(order_by).limit(n).withColumn("total_rows", rows)


def page_ready(html: Column, ready_patterns: Sequence[str]) -> Column:
    """A page is usable when one of the ready markers matches."""
    cond = None
    for pattern in ready_patterns:
        c = html.rlike(pattern)
        cond = c if cond is None else (cond | c)
    return F.coalesce(cond, F.lit(False))
