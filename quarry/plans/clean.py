"""Cleaning plans (U2 books, U3 cars): one projection of Column expressions
followed by one keep-first de-duplication (the only shuffle)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import numbers as N
from ..functions import text as X
from ..operators.columns import canonical_projection, ensure_columns
from ..operators.dedup import dedup_clean
from ..operators.filters import null_outside


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def clean_books_rows(raw: DataFrame) -> DataFrame:
    """Row-level part of U2 (no shuffle): B1 -> H1 -> H13 -> H3 -> B9 -> H14
    -> H4 -> B9.  Keeps ``ordinal``."""
    df = ensure_columns(raw, S.BOOK_COLUMNS)
    types = _types(df)
    text = {c: X.clean_text(c) for c in ("title", "availability", "description", "product_type",
                                         "category", "url")}
    df = df.withColumns(text)
    # folded once, in a layer of its own, for all the markers that look at it
    df = df.withColumns({"__availability": X.folded("availability"), "__rating": X.folded("rating")})
    rating_type = types["rating"]
    rating = (X.rating_from_number("rating") if N.is_numeric_type(rating_type)
              else X.rating_from_text("rating", F.col("__rating")))
    cols = {
        "availability": X.availability("availability", F.col("__availability")),
        "price": null_outside(N.decimal_for(types["price"], "price"), low=0),
        "tax": null_outside(N.decimal_for(types["tax"], "tax"), low=0),
        "rating": rating,
    }
    for c in ("products_on_page", "review_count", "source_page"):
        cols[c] = null_outside(N.integer_for(types[c], c), low=0)
    return df.withColumns(cols).drop("__availability", "__rating")


def clean_books(raw: DataFrame, order: str = "ordinal") -> DataFrame:
    """Typed, de-duplicated books in the fixed column order (+ ordinal)."""
    rows = clean_books_rows(raw)
    rows = dedup_clean(rows, ("title", "price"), order)
    return canonical_projection(rows, (order,) + S.BOOK_COLUMNS)


def clean_cars_rows(raw: DataFrame, max_year: int | None = None) -> DataFrame:
    """Row-level part of U3: B1 -> H1 -> H16 -> H17 -> H18 -> H4 -> B9.

    ``max_year`` defaults to next year, as the reference computes it; pass it
    explicitly for reproducible results.
    """
    max_year = max_year if max_year is not None else _dt.date.today().year + 1
    df = ensure_columns(raw, S.CAR_COLUMNS)
    types = _types(df)
    df = df.withColumns({c: X.clean_text(c) for c in ("brand", "model", "transmission", "region", "url")})
    df = df.withColumn("__transmission", X.folded("transmission"))
    cols = {
        "brand": X.brand("brand"),
        "transmission": X.transmission("transmission", F.col("__transmission")),
        "region": X.title_case("region"),
        "year": null_outside(N.integer_for(types["year"], "year"), S.MIN_CAR_YEAR, max_year),
        "price": null_outside(N.integer_for(types["price"], "price"), low=0),
        "mileage": null_outside(N.integer_for(types["mileage"], "mileage"), low=0),
        "source_page": null_outside(N.integer_for(types["source_page"], "source_page"), low=1),
    }
    return df.withColumns(cols).drop("__transmission")


def clean_cars(raw: DataFrame, max_year: int | None = None, order: str = "ordinal") -> DataFrame:
    """Typed, de-duplicated car ads in the fixed column order (+ ordinal)."""
    rows = clean_cars_rows(raw, max_year)
    rows = dedup_clean(rows, ("brand", "model", "year", "price", "mileage"), order)
    return canonical_projection(rows, (order,) + S.CAR_COLUMNS)


CLEANERS = {"books": clean_books, "cars": clean_cars}
