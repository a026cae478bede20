"""Listing x detail enrichment.

One card row joins at most one detail row by URL.  Detail values replace
card values only when present; description, product type, tax, review count
and category come from the detail only; availability has a third fallback,
the detail's information table.  Details whose page was not ready are
ignored, so the card is kept as it was.

Scale notes: details are de-duplicated by URL first (keep first), so no card
fans out.  Cards without a URL (possibly a third of all rows) would all hash
to one join partition as NULL keys; they get a *salted* key instead -- a
unique value that no detail URL can equal (``\x00`` + ordinal) -- so they
spread evenly and pass through the left join unmatched, in one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .dedup import dedup_first

PREFERRED = ("title", "price", "availability", "rating")
DETAIL_ONLY = ("description", "product_type", "tax", "review_count", "category")


def enrich_listing(cards: DataFrame, details: DataFrame, url: str = "url",
                   ready: str | None = "ready", order: str = "ordinal") -> DataFrame:
    """``cards`` left-joined with ready ``details`` on ``url``.

    ``details`` may carry ``info_availability`` (information-table value).
    Output columns: the card columns, with PREFERRED coalesced detail-first,
    plus DETAIL_ONLY columns.
    """
    d = details if ready is None else details.where(F.coalesce(F.col(ready), F.lit(False)))
    if order in d.columns:
        d = dedup_first(d, F.col(url), order)
    else:
        d = d.dropDuplicates([url])
    has_info = "info_availability" in d.columns
    d_cols = [F.col(url)]
    for c in PREFERRED + DETAIL_ONLY:
        if c in d.columns:
            d_cols.append(F.col(c).alias(f"_d_{c}"))
    if has_info:
        d_cols.append(F.col("info_availability").alias("_d_info"))
    d = d.select(*d_cols)

    card_cols = cards.columns
    has_key = F.coalesce(F.col(url) != "", F.lit(False))
    salt = (F.concat(F.lit("\u0000"), F.col(order).cast("string")) if order in cards.columns
            else F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string")))
    keyed = cards.withColumn("_join_key", F.when(has_key, F.col(url)).otherwise(salt))
    d = d.withColumnRenamed(url, "_join_key")
    joined = keyed.join(d, on="_join_key", how="left").drop("_join_key")

    def finish(frame: DataFrame, matched: bool) -> DataFrame:
        out = []
        for c in card_cols:
            dtype = cards.schema[c].dataType
            detail = f"_d_{c}"
            if c in PREFERRED and matched and detail in frame.columns:
                dv = F.col(detail).cast(dtype)
                if isinstance(dtype, T.StringType):
                    dv = F.nullif(dv, F.lit(""))
                value = F.coalesce(dv, F.col(c))
                if c == "availability" and has_info:
                    value = F.when(F.coalesce(value, F.lit("")) == "",
                                   F.coalesce(F.col("_d_info"), value)).otherwise(value)
                out.append(value.alias(c))
            elif c in DETAIL_ONLY:
                value = F.col(detail) if matched and detail in frame.columns else F.lit(None)
                out.append(value.cast(dtype).alias(c))
            else:
                out.append(F.col(c))
        return frame.select(*out)

    return finish(joined, True)
