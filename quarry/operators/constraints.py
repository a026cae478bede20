"""Integrity rules of the stored tables (B10) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S


def _blank(col: Column) -> Column:
    return col.isNull() | (F.length(F.trim(col)) == 0)


def _below(col: Column, low) -> Column:
    return F.coalesce(col < F.lit(low), F.lit(False))


def _outside(col: Column, low, high) -> Column:
    return F.coalesce((col < F.lit(low)) | (col > F.lit(high)), F.lit(False))


def rules(source: str) -> dict[str, Column]:
    """Rule name -> *violation* condition (True = broken)."""
    c = F.col
    if source == "books":
        return {
            "title_required": _blank(c("title")),
            "price_negative": _below(c("price"), 0),
            "products_on_page_negative": _below(c("products_on_page"), 0),
            "rating_range": _outside(c("rating"), 0, S.MAX_RATING),
            "review_count_negative": _below(c("review_count"), 0),
            "tax_negative": _below(c("tax"), 0),
            "source_page_below_one": _below(c("source_page"), 1),
        }
    if source == "cars":
        return {
            "brand_required": _blank(c("brand")),
            "year_range": _outside(c("year"), S.MIN_CAR_YEAR, S.MAX_STORED_CAR_YEAR),
            "price_negative": _below(c("price"), 0),
            "mileage_negative": _below(c("mileage"), 0),
            "source_page_below_one": _below(c("source_page"), 1),
        }
    raise ValueError(f"unknown source {source!r}")


def violations(df: DataFrame, source: str, name: str = "violations") -> DataFrame:
    """Rows with the array of broken rule names (empty array = valid)."""
    broken = [F.when(cond, F.lit(rule)) for rule, cond in rules(source).items()]
    return df.withColumn(name, F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Lenient mode: (valid rows, quarantined rows with their violations)."""
    checked = violations(df, source)
    valid = checked.where(F.size("violations") == 0).drop("violations")
    bad = checked.where(F.size("violations") > 0)
    return valid, bad


def assert_valid(df: DataFrame, source: str) -> None:
    """Strict mode: raise before anything is written when any row breaks a
    rule (one aggregate job; nothing is collected but the count)."""
    conds = list(rules(source).values())
    any_bad = conds[0]
    for cond in conds[1:]:
        any_bad = any_bad | cond
    broken = df.where(any_bad).limit(1).count()
    if broken:
        raise ValueError(f"{source}: batch breaks an integrity rule; nothing written")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The unique-key rule: key values held by several rows, with their number (one sum by key)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
