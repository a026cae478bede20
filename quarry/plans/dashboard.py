"""Dashboard datasets (the read -> filter -> summarise entry point).

One call builds every dataset the two dashboards show from the stored or
cleaned table: numeric coercion (H7), derived category (B11), default
filters (B7), KPIs (D2/D3), counts (D4/D6/D7), histograms (D8), box
statistics (D9), shares (D10) and the scatter extract (D11).  The prepared
table is written once to the shared folder because all datasets read it; the
filters are predicates on its scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import schema as S
from ..functions.numbers import coerce_numeric, is_numeric_type
from ..operators import aggregates as A
from ..operators.columns import ensure_columns
from ..operators.filters import analysis_category, dashboard_filter, drop_null
from ..session import materialize


def _coerce(df: DataFrame, columns) -> DataFrame:
    cols = {}
    for c in columns:
        if c in df.columns and not is_numeric_type(df.schema[c].dataType):
            cols[c] = coerce_numeric(F.nullif(F.col(c).cast("string"), F.lit("")))
    return df.withColumns(cols) if cols else df


def books_bundle(stored: DataFrame, selections: Mapping | None = None) -> dict[str, DataFrame]:
    df = ensure_columns(_coerce(stored, ("price", "rating", "review_count")),
                        ("category", "product_type", "availability"))
    df = df.withColumn("analysis_category", analysis_category(df))
    df = materialize(df, "dashboard")
    filtered = dashboard_filter(df, ["analysis_category", "availability", "rating"], selections)
    return {
        "filtered": filtered,
        "kpis": A.book_metrics(filtered),
        "category_counts": A.value_counts(filtered, "analysis_category"),
        "rating_histogram": A.histogram(drop_null(filtered, ["rating"]), "rating", S.RATING_BINS),
        "availability_shares": A.shares(filtered, "availability"),
        "price_box": A.box_stats(drop_null(filtered, ["price"]), "analysis_category", "price"),
    }


def cars_bundle(stored: DataFrame, selections: Mapping | None = None) -> dict[str, DataFrame]:
    df = ensure_columns(_coerce(stored, ("year", "price", "mileage")), ("brand", "region", "transmission"))
    df = materialize(df, "dashboard")
    filtered = dashboard_filter(df, ["brand", "year", "region", "transmission"], selections)
    return {
        "filtered": filtered,
        "kpis": A.car_metrics(filtered),
        "top_brands": A.top_k(filtered, "brand", S.TOP_BRANDS),
        "year_counts": A.counts_by_key(filtered, "year"),
        "mileage_histogram": A.histogram(drop_null(filtered, ["mileage"]), "mileage", S.MILEAGE_BINS),
        "scatter": A.scatter_extract(filtered, "mileage", "price", ("brand", "model", "year", "region")),
        "transmission_shares": A.shares(filtered, "transmission"),
    }


def as_rows(bundle: Mapping[str, DataFrame]) -> DataFrame:
    """The bundle's summaries (all but the filtered table) as one table: dataset and its rows as JSON."""
    parts = [df.select(F.lit(name).alias("dataset"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))
             for name, df in bundle.items() if name != "filtered"]
    return reduce(DataFrame.unionByName, parts)
