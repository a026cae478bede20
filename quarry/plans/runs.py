"""End-to-end collection runs over captured pages (U4) with a run report.

A run takes a table of captured listing pages ``(crawl_id, page, url, html)``
(and, for books, a table of captured product pages ``(url, html)``) and
performs what the crawler + cleaner + repository did page by page:

1. page facts (cards on the page, next link) and card records — one
   ``mapInArrow`` pass over the pages;
2. the crawl prefix (E4) with repeated-page detection (E3, cars) decides
   which pages the sequential crawler would have used; page 1 failing is an
   error;
3. books: first card per URL, enrichment with the product page (C1);
4. raw de-duplication (E2), cleaning (U2/U3, includes E1);
5. the cleaned table is checkpointed once (lineage cut in the shared
   checkpoint folder), then upserted into the snapshot table (U1) and
   exported as CSV (A11);
6. a one-row report: cleaned rows, persisted rows, elapsed seconds, source,
   output path (row counts gathered with an ``Observation`` on the same job).
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .. import schema as S
from ..operators import crawl as C
from ..operators.dedup import dedup_first, dedup_raw
from ..operators.enrich import enrich_listing
from ..operators.extract import (BOOK_CARD_SPEC, CAR_CARD_SPEC, COUNT, Field, Spec, book_details, extract,
                                 extract_nested)
from ..operators.ordering import with_position
from ..operators.upsert import StoredTable
from ..session import materialize
from ..sources.inline import one_row
from ..sources.sinks import write_csv
from .clean import clean_books, clean_cars


def validate(source: str, max_pages: int) -> None:
    if source not in S.MAX_PAGES:
        raise ValueError("unknown source")
    if int(max_pages) < 1:
        raise ValueError("max_pages must be >= 1")
    if int(max_pages) > S.MAX_PAGES[source]:
        raise ValueError(f"source {source} is limited to {S.MAX_PAGES[source]} pages")


def parse_listing_pages(pages: DataFrame, card_spec: Spec, next_selectors: tuple[str, ...]) -> DataFrame:
    """One parse per listing page: page facts + card records (nested).

    The result is written once as a table in the shared checkpoint folder:
    page facts, signatures and cards are all read from it, so HTML is parsed
    once even though several joins consume it, and a lost executor never
    re-parses.
    """
    page_fields = (Field("next_links", next_selectors, COUNT),) if next_selectors else ()
    spec = Spec(fields=card_spec.fields, records=card_spec.records, ready=card_spec.ready,
                page_fields=card_spec.page_fields + page_fields)
    return materialize(extract_nested(pages, spec, ("crawl_id", "page", "url")), "parsed-pages")


def crawl_pages(parsed: DataFrame, cards: DataFrame, source: str, max_pages: int,
                strict_pages: bool) -> tuple[DataFrame, DataFrame]:
    """(captured pages with flags, pages the sequential crawler keeps) (E3 + E4).

    A page absent from the captured table, or captured but not ready, is a
    failed load.
    """
    grid = parsed.select("crawl_id", "page", "ready", F.col("n_records").alias("n_cards"),
                         *(["next_links"] if "next_links" in parsed.columns else []))
    grid = grid.where(F.col("page") <= max_pages) \
               .withColumn("failed", ~F.coalesce(F.col("ready"), F.lit(False))) \
               .withColumn("empty", F.coalesce(F.col("n_cards"), F.lit(0)) == 0)
    if source == "books":
        grid = grid.withColumn("has_next", F.coalesce(F.col("next_links"), F.lit(0)) > 0)
    else:
        parts = [F.nullif(F.col(c), F.lit("")) for c in ("card_url", "inner_href", "heading") if c in cards.columns]
        value = F.coalesce(*parts, F.lit(""))
        sigs = C.page_signatures(cards, value)
        grid = grid.join(sigs.select("crawl_id", "page", "signature"), on=["crawl_id", "page"], how="left")
        grid = C.repeated_pages(grid, usable=~F.col("failed") & ~F.col("empty"))
    kept = C.crawl_prefix(grid, mode=source, strict=strict_pages and source == "cars")
    return grid, kept


def run_source(spark: SparkSession, source: str, listing_pages: DataFrame, *, max_pages: int,
               table_root: str, export_dir: str | None = None, detail_pages: DataFrame | None = None,
               card_spec: Spec | None = None, detail_spec: Spec | None = None,
               next_selectors: tuple[str, ...] = ("li.next a", ".pager .next a"),
               strict_pages: bool = False, batch_time: _dt.datetime | None = None,
               max_year: int | None = None) -> tuple[DataFrame, DataFrame]:
    """U4: collect -> clean -> persist -> export; returns (report, cleaned)."""
    validate(source, max_pages)
    started = time.monotonic()
    card_spec = card_spec or (BOOK_CARD_SPEC if source == "books" else CAR_CARD_SPEC)
    pages = listing_pages.select("crawl_id", "page", "url", "html")
    parsed = parse_listing_pages(pages, card_spec, next_selectors if source == "books" else ())
    cards = parsed.select("crawl_id", "page", F.col("url").alias("page_url"), "n_records",
                          F.explode("records").alias("_r")).select("*", "_r.*").drop("_r")
    grid, kept = crawl_pages(parsed, cards, source, max_pages, strict_pages)
    crawls = grid.select("crawl_id").distinct()
    if crawls.join(C.first_page_failed(grid), "crawl_id", "left_anti").isEmpty():
        raise ValueError("first listing page could not be loaded")
    cards = cards.join(kept.select("crawl_id", "page"), on=["crawl_id", "page"], how="left_semi")
    # crawl order: one place for every card, whatever the number of crawls, pages or cards
    cards = with_position(cards, [F.col("crawl_id"), F.col("page"), F.col("position")], "ordinal")
    cards = cards.withColumn("source_page", F.col("page").cast("bigint"))

    if source == "books":
        from ..functions.text import rating_from_class
        if "rating" not in cards.columns and "rating_class" in cards.columns:
            cards = cards.withColumn("rating", rating_from_class("rating_class", "rating_aria", "rating_title"))
        cards = cards.withColumn("url", F.col("card_url"))
        cards = cards.withColumn("products_on_page", F.col("n_records").cast("bigint"))
        # a card whose URL was already visited in this crawl is skipped
        with_url = cards.where(F.coalesce(F.col("url") != "", F.lit(False)))
        without = cards.where(~F.coalesce(F.col("url") != "", F.lit(False)))
        with_url = dedup_first(with_url, F.struct("crawl_id", "url"), "ordinal")
        cards = with_url.unionByName(without)
        for c in S.BOOK_COLUMNS:
            if c not in cards.columns:
                cards = cards.withColumn(c, F.lit(None).cast("string"))
        raw = cards.select("crawl_id", "ordinal", *S.BOOK_COLUMNS)
        if detail_pages is not None:
            details = (book_details(detail_pages.select("url", "html").withColumn("page_id", F.lit(0)),
                                    ("page_id", "url")) if detail_spec is None
                       else extract(detail_pages, detail_spec, ("url",)))
            details = details.withColumn("rating", F.col("rating").cast("string"))
            details = with_position(details, [F.col("url"), F.xxhash64(*details.columns)], "ordinal")
            raw = enrich_listing(raw.withColumn("rating", F.col("rating").cast("string")), details)
        raw = dedup_raw(raw, ("title", "price"))
        cleaned = clean_books(raw.drop("crawl_id"))
    else:
        from ..functions.text import vehicle_heading
        cards = vehicle_heading(cards, "heading")
        cards = cards.withColumn("url", F.coalesce(F.nullif(F.col("card_url"), F.lit("")),
                                                   F.col("inner_href") if "inner_href" in cards.columns
                                                   else F.lit(None).cast("string")))
        for c in S.CAR_COLUMNS:
            if c not in cards.columns:
                cards = cards.withColumn(c, F.lit(None).cast("string"))
        raw = cards.select("ordinal", *S.CAR_COLUMNS)
        raw = dedup_raw(raw, ("brand", "model", "year", "price", "mileage"))
        cleaned = clean_cars(raw, max_year=max_year)

    obs = Observation(f"run_{source}")
    cleaned = cleaned.observe(obs, F.count(F.lit(1)).alias("row_count"))
    # one materialisation in the shared checkpoint folder; later actions
    # (upsert, export) read it instead of re-parsing pages
    cleaned = materialize(cleaned, "cleaned")
    row_count = int(obs.get.get("row_count", 0))

    table = StoredTable(spark, table_root, source)
    persisted = table.upsert(cleaned, batch_time)
    out_path = None
    if export_dir:
        out_path = f"{export_dir.rstrip('/')}/{S.EXPORT_NAMES[source]}"
        write_csv(cleaned.drop("ordinal"), out_path, mode="overwrite")
    elapsed = time.monotonic() - started
    report = one_row(spark, {"source": source, "row_count": row_count, "persisted_rows": int(persisted),
                             "cleaned_file": out_path, "elapsed_seconds": float(elapsed)},
                     "source string, row_count bigint, persisted_rows bigint, cleaned_file string, "
                     "elapsed_seconds double")
    return report, cleaned
