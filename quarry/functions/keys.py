"""Stable content keys (H11, H12) and Python-compatible value rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .text import fold_ascii, storage_text


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def render(col, dtype: T.DataType | None = None) -> Column:
    """Value -> text the way ``str(value)`` prints it for the types used here.

    Integers print as digits; integral doubles below 1e16 as ``N.0``; other
    doubles use Spark's shortest repr, which equals Python's in [1e-3, 1e7).
    """
    value = _c(col)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        integral = (F.abs(value) < F.lit(1e16)) & (value == F.floor(value))
        return F.when(integral, F.concat(value.cast("bigint").cast("string"), F.lit(".0"))) \
                .otherwise(value.cast("string"))
    if isinstance(dtype, T.BooleanType):
        return F.when(value, F.lit("True")).when(~value, F.lit("False"))
    return value.cast("string")


def key_text(*parts: Column) -> Column:
    """The unfolded key text: each part as storage text (or ''), joined with '|'."""
    return F.concat_ws("|", *[F.coalesce(storage_text(p), F.lit("")) for p in parts])


def hash_key(text: Column) -> Column:
    """Fold the joined key text and hash it.  Folding the joined text equals
    joining the folded parts ('|' is ASCII and a starter, so NFKD never
    reorders across it) and needs one fold per key instead of one per part."""
    return F.sha2(fold_ascii(text), 256)


def canonical_key(*parts: Column) -> Column:
    """Each part as storage text (or ''), NFKD folded to lower-case ASCII,
    joined with '|', SHA-256 hex."""
    return hash_key(key_text(*parts))


def _truthy_text(col) -> Column:
    """``value or ...`` for text: NULL and '' fall through."""
    value = _c(col)
    return value.isNotNull() & (value.cast("string") != "")


def book_source_key(df: DataFrame) -> Column:
    """H12 (books): explicit key, else ('book-url', url), else
    ('book', title, category or product_type)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    url = storage_text("url")
    category = F.when(_truthy_text("category"), render("category", types.get("category"))) \
                .otherwise(render("product_type", types.get("product_type")))
    derived = hash_key(F.when(url.isNotNull(), key_text(F.lit("book-url"), url))
                        .otherwise(key_text(F.lit("book"), storage_text("title"), category)))
    explicit = storage_text("source_key") if "source_key" in types else F.lit(None).cast("string")
    return F.coalesce(explicit, derived)


def car_source_key(df: DataFrame) -> Column:
    """H12 (cars): explicit key, else ('car-url', url), else
    ('car', brand, model, year, price, mileage, region)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    url = storage_text("url")
    parts = [render(c, types.get(c)) for c in ("model", "year", "price", "mileage", "region")]
    derived = hash_key(F.when(url.isNotNull(), key_text(F.lit("car-url"), url))
                        .otherwise(key_text(F.lit("car"), storage_text("brand"), *parts)))
    explicit = storage_text("source_key") if "source_key" in types else F.lit(None).cast("string")
    return F.coalesce(explicit, derived)
