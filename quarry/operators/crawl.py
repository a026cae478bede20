"""Page-level operators over captured listing pages.

A crawl is a set of listing pages ``(crawl_id, page)``; each page holds cards.
Per-page and per-crawl values are partial aggregates (map-side combined) that
are written and joined back on their key, so neither a page that holds a third
of all cards nor a crawl that holds a third of all pages makes a large task: no
window runs over a crawl, and AQE can split the joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

#: Page numbers of one segment: the bits of a bigint, but for two that arithmetic needs.
SEGMENT = 62


def cards_per_page(cards: DataFrame, keys: Sequence[str] = ("crawl_id", "page"),
                   name: str = "products_on_page") -> DataFrame:
    """Number of cards of the card's page, copied onto each card.

    Aggregate + equi-join instead of ``count() over (partition by page)``:
    the count is combined map-side and the join side has one row per page, so
    AQE broadcasts it when small and splits a skewed page otherwise.
    """
    counts = cards.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return cards.join(counts, on=list(keys), how="left")


def _md5_word(digest: Column, start: int) -> Column:
    """60-bit integer taken from an md5 hex digest (same bytes in any engine)."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint").cast("decimal(20,0)")


def page_signatures(cards: DataFrame, value: Column, keys: Sequence[str] = ("crawl_id", "page"),
                    name: str = "signature") -> DataFrame:
    """An order-insensitive signature of the multiset of card values of a
    page (the sorted list, as a fingerprint).

    Computed as count plus two sums of 60-bit md5 words per value: equal
    multisets give equal signatures, and the aggregate is partial/final, so a
    page is never collected into one list.
    """
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")))
    words = cards.withColumn("_d", digest).select(*keys, _md5_word(F.col("_d"), 1).alias("_wa"),
                                                  _md5_word(F.col("_d"), 17).alias("_wb"))
    agg = words.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_wa").alias("_a"),
        F.sum("_wb").alias("_b"),
    )
    sig = F.sha2(F.concat_ws(":", F.col("_n").cast("string"), F.col("_a").cast("string"),
                             F.col("_b").cast("string")), 256)
    return agg.select(*keys, F.col("_n").alias("n_cards"), sig.alias(name))


def repeated_pages(pages: DataFrame, crawl: str = "crawl_id", page: str = "page",
                   signature: str = "signature", usable: Column | None = None,
                   name: str = "repeated") -> DataFrame:
    """A page is repeated when an earlier usable page of the same crawl has
    the same signature.

    Signatures that occur on two pages are found by one aggregate; only these
    (with their first page) are joined back, so a common signature costs a row
    per task.  NULL signatures and crawls equal each other.
    """
    usable = F.coalesce(F.lit(True) if usable is None else usable, F.lit(False))
    seen = pages.where(usable).groupBy(F.col(crawl).alias("_c"), F.col(signature).alias("_s")).agg(
        F.min(page).alias("_first"), F.max(page).alias("_last")).where("_first < _last").drop("_last")
    again = materialize(seen, "repeated-signatures")
    same = F.col(crawl).eqNullSafe(F.col("_c")) & F.col(signature).eqNullSafe(F.col("_s"))
    repeated = usable & F.coalesce(F.col(page) > F.col("_first"), F.lit(False))
    return pages.join(again, same, "left").withColumn(name, repeated).drop("_c", "_s", "_first")


def _lowest_gap(mask: Column) -> Column:
    """Place of the lowest zero bit: adding one flips the ones below it."""
    return F.bit_count(mask.bitwiseXOR(mask + F.lit(1).cast("bigint"))).cast("bigint") - 1


def _segments(numbers: DataFrame, number: str, *more: Column) -> DataFrame:
    """Masks of the numbers of each crawl, ``SEGMENT`` to a row, with further aggregates."""
    bit = F.expr(f"shiftleft(cast(1 as bigint), cast({number} % {SEGMENT} as int))")
    return materialize(numbers.groupBy("_c", F.expr(f"{number} div {SEGMENT}").alias("_seg")).agg(F.bit_or(bit).alias("_mask"), *more), "page-segments")


def _first_missing(segments: DataFrame) -> DataFrame:
    """(_c, _gap): the least number from 0 on that each crawl lacks.

    The segments without a gap are numbers again, a sixty-second of them, so
    the first segment with one is found the same way, carried down from level
    to level; every level is an aggregate, none sees a crawl as a whole.
    """
    full = segments.where(F.col("_mask") == (1 << SEGMENT) - 1)
    if full.isEmpty():
        found = segments.withColumn("_n", F.lit(0).cast("bigint"))
    else:
        above = _first_missing(_segments(full.select("_c", "_seg"), "_seg")).select(F.col("_c").alias("_k"), F.col("_gap").alias("_g"))
        found = segments.join(above, F.col("_c").eqNullSafe(F.col("_k")), "left").withColumn("_n", F.coalesce("_g", F.lit(0).cast("bigint")))
    here = F.when(F.col("_seg") == F.col("_n"), _lowest_gap(F.col("_mask")))
    return found.groupBy("_c").agg((F.min("_n") * SEGMENT + F.coalesce(F.min(here), F.lit(0).cast("bigint"))).alias("_gap"))


def crawl_prefix(pages: DataFrame, mode: str = "cars", strict: bool = False,
                 max_pages: int | None = None, crawl: str = "crawl_id",
                 page: str = "page") -> DataFrame:
    """Pages the sequential crawler would keep.

    ``pages`` has a row per captured page number (from 1) with boolean columns
    ``failed``, ``empty`` and (cars) ``repeated``, (books) ``has_next``; a page
    number that is absent is a failed load.  Cars: keep pages before the first
    failed/empty/repeated page; strict mode skips bad pages instead.  Books:
    keep pages before the first failed or empty page, and stop after a page
    without a next link.  ``max_pages`` caps the page numbers.

    The stops of a crawl are the least page that is bad, the least number that
    is absent and the least page without a next link: aggregates over segments
    of 62 page numbers (a bit for each) with a carry between segments.  One
    written row per crawl is joined back to the pages.
    """
    if max_pages is not None and max_pages < 1:
        raise ValueError("max_pages must be >= 1")
    df = pages.where(F.col(page) >= 1) if max_pages is None else pages.where(F.col(page).between(1, max_pages))
    bad = F.coalesce(F.col("failed"), F.lit(False)) | F.coalesce(F.col("empty"), F.lit(False))
    if mode == "cars":
        bad = bad | F.coalesce(F.col("repeated"), F.lit(False))
    if strict:
        return df.where(~bad)
    number = F.col(page).cast("bigint")
    ended = ~F.coalesce(F.col("has_next"), F.lit(False)) if mode == "books" else F.lit(False)
    facts = df.select(F.col(crawl).alias("_c"), (number - 1).alias("_p"), F.when(bad, number).alias("_bad"), F.when(ended, number).alias("_end"))
    segments = _segments(facts, "_p", F.min("_bad").alias("_bad"), F.min("_end").alias("_end"))
    gaps = _first_missing(segments.select("_c", "_seg", "_mask")).select(F.col("_c").alias("_k"), "_gap")
    stops = segments.groupBy("_c").agg(F.min("_bad").alias("_bad"), F.min("_end").alias("_end"))
    stops = stops.join(gaps, F.col("_c").eqNullSafe(F.col("_k"))).select("_c", F.least("_bad", F.col("_gap") + 1).alias("_stop"), "_end")
    stops = materialize(stops, "crawl-stops")
    kept = (F.col(page) < F.col("_stop")) & F.coalesce(F.col(page) <= F.col("_end"), F.lit(True))
    return df.join(stops, F.col(crawl).eqNullSafe(F.col("_c"))).where(kept).drop("_c", "_stop", "_end")


def first_page_failed(pages: DataFrame, crawl: str = "crawl_id", page: str = "page") -> DataFrame:
    """Crawls whose first page is absent or failed."""
    loaded = F.max((F.col(page) == 1) & ~F.coalesce(F.col("failed"), F.lit(False)))
    return pages.groupBy(crawl).agg(loaded.alias("_loaded")).where(~F.col("_loaded")).select(crawl)
