"""Keep-first de-duplication.

Row order is semantic, so every raw table carries an ``ordinal``.  Keep-first
is ``row_number() over (partition by key order by ordinal) = 1``; Catalyst
plans it with a *partial* ``WindowGroupLimit`` before the shuffle, so a hot
key (say a third of all rows with no URL and the same fallback fields)
is cut to one row per map task before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import render

_KEY = "__dedup_key"
_RANK = "__dedup_rank"


def dedup_first(df: DataFrame, key: Column, order: str = "ordinal") -> DataFrame:
    """Keep the first row (by ``order``) of every ``key`` value."""
    w = Window.partitionBy(_KEY).orderBy(F.col(order).asc())
    return (df.withColumn(_KEY, key)
              .withColumn(_RANK, F.row_number().over(w))
              .where(F.col(_RANK) == 1)
              .drop(_KEY, _RANK))


def _caseless(text: Column) -> Column:
    """Lower case in which sharp s equals ss."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def clean_dedup_key(df: DataFrame, fallback_columns: Sequence[str], url: str = "url") -> Column:
    """E1 key: ('url', casefolded stripped url) when the url is non-blank,
    else ('fallback', folded fallback fields)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    url_key = _caseless(F.regexp_replace(F.col(url).cast("string"), r"(?U)^\s+|\s+$", ""))
    has_url = F.coalesce(url_key != "", F.lit(False))
    parts = [F.coalesce(_caseless(F.regexp_replace(render(c, types.get(c)), r"(?U)^\s+|\s+$", "")), F.lit(""))
             for c in fallback_columns]
    return F.when(has_url, F.struct(F.lit("url").alias("kind"), F.array(url_key).alias("parts"))) \
            .otherwise(F.struct(F.lit("fallback").alias("kind"), F.array(*parts).alias("parts")))


def raw_dedup_key(df: DataFrame, fallback_columns: Sequence[str], url: str = "url") -> Column:
    """E2 key: ('url', stripped url) when the url is a non-empty string (case
    sensitive), else the raw fallback tuple (NULLs equal each other)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    raw_url = F.col(url).cast("string")
    has_url = F.coalesce(raw_url != "", F.lit(False))
    stripped = F.regexp_replace(raw_url, r"(?U)^\s+|\s+$", "")
    parts = [render(c, types.get(c)) for c in fallback_columns]
    return F.when(has_url, F.struct(F.lit("url").alias("kind"), F.array(stripped).alias("parts"))) \
            .otherwise(F.struct(F.lit("fields").alias("kind"), F.array(*parts).alias("parts")))


def dedup_clean(df: DataFrame, fallback_columns: Sequence[str], order: str = "ordinal") -> DataFrame:
    """Cleaned-table de-duplication."""
    return dedup_first(df, clean_dedup_key(df, fallback_columns), order)


def dedup_raw(df: DataFrame, fallback_columns: Sequence[str], order: str = "ordinal") -> DataFrame:
    """Raw-record de-duplication."""
    return dedup_first(df, raw_dedup_key(df, fallback_columns), order)
