"""Record extraction from captured HTML pages.

Pages live in a table ``(page_id, url, html, ...)``.  Extraction is a
``mapInArrow`` job: each task parses its pages one at a time with the small
selector engine in ``html.py`` and emits typed rows in small packs; Spark
partitions and schedules the work and the rest of the plan (joins with detail pages,
de-duplication, cleaning) stays in DataFrame operators.

A spec is declarative: an optional *record* selector list (one output row per
matched element, e.g. product cards; first selector that matches wins) and
a list of fields, each with ordered fallback selectors.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import html as H

TEXT, ATTR, TEXT_OR_ATTR, MAP, LAST_TEXT, ALL_TEXT, ALL_ATTR, COUNT = (
    "text", "attr", "text_or_attr", "map", "last_text", "all_text", "all_attr", "count")

#: Rows, and characters of HTML, after which a worker hands on what it extracted.
PACK_ROWS, PACK_CHARS = 1024, 1 << 20


@dataclass(frozen=True)
class Field:
    """One extracted value.

    kind: ``text`` (first non-blank text), ``attr`` (first non-blank
    attribute), ``text_or_attr`` (attribute of the first match, else its
    text), ``map`` (information table: ``th`` -> ``td``), ``last_text``
    (last non-blank text), ``all_text`` / ``all_attr`` (arrays), ``count``.
    ``absolute`` resolves URLs against the page URL.
    """
    name: str
    selectors: tuple[str, ...]
    kind: str = TEXT
    attribute: str | None = None
    absolute: bool = False

    def dtype(self) -> T.DataType:
        if self.kind == MAP:
            return T.MapType(T.StringType(), T.StringType())
        if self.kind in (ALL_TEXT, ALL_ATTR):
            return T.ArrayType(T.StringType())
        if self.kind == COUNT:
            return T.IntegerType()
        return T.StringType()


@dataclass(frozen=True)
class Spec:
    fields: tuple[Field, ...]
    records: tuple[str, ...] = ()
    ready: tuple[str, ...] = ()          # B14: page usable only if one matches
    page_fields: tuple[Field, ...] = field(default_factory=tuple)  # per page, copied to records


def _value(scope: H.Element, f: Field, base_url: str | None):
    def absolute(v):
        return urljoin(base_url or "", v) if (f.absolute and v is not None) else v

    if f.kind == TEXT:
        return H.text_first(scope, f.selectors)
    if f.kind == ATTR:
        return absolute(H.attribute_first(scope, f.selectors, f.attribute))
    if f.kind == TEXT_OR_ATTR:
        el = H.find_first(scope, f.selectors)
        if el is None:
            return None
        return el.get(f.attribute) or H.collapse(el.text()) or None
    if f.kind == LAST_TEXT:
        for sel in f.selectors:
            values = [H.collapse(e.text()) for e in H.select(scope, sel)]
            values = [v for v in values if v]
            if values:
                return values[-1]
        return None
    if f.kind == ALL_TEXT:
        for sel in f.selectors:
            found = H.select(scope, sel)
            if found:
                return [H.collapse(e.text()) for e in found]
        return []
    if f.kind == ALL_ATTR:
        for sel in f.selectors:
            found = [e.get(f.attribute) for e in H.select(scope, sel)]
            found = [absolute(v.strip()) for v in found if v is not None and v.strip()]
            if found:
                return found
        return []
    if f.kind == COUNT:
        for sel in f.selectors:
            found = H.select(scope, sel)
            if found:
                return len(found)
        return 0
    if f.kind == MAP:
        return information_table(scope, f.selectors)
    raise ValueError(f"unknown field kind {f.kind}")


def information_table(scope: H.Element, row_selectors: Sequence[str]) -> dict:
    """``th`` (casefolded) -> ``td`` text over the rows of the first row
    selector that matches; rows without heading text or ``td`` are skipped;
    a later duplicate heading wins."""
    rows = next(filter(None, (H.select(scope, sel) for sel in row_selectors)), [])
    cells = ((H.text_first(row, ("th",)), H.text_first(row, ("td",))) for row in rows)
    return {name.casefold(): value for name, value in cells if name and value is not None}


def output_schema(pages: DataFrame, spec: Spec, keep: Sequence[str]) -> T.StructType:
    fields = [pages.schema[c] for c in keep]
    fields.append(T.StructField("ready", T.BooleanType()))
    if spec.records:
        fields += [T.StructField("position", T.IntegerType()), T.StructField("n_records", T.IntegerType())]
    for f in spec.page_fields + spec.fields:
        fields.append(T.StructField(f.name, f.dtype(), True))
    return T.StructType(fields)


def _page(html: str | None, url: str | None, spec: Spec) -> tuple[dict, list[H.Element], H.Element]:
    """(page values, record elements, root) of one page."""
    root = H.parse(html)
    ready = (not spec.ready) or H.find_first(root, spec.ready) is not None
    values = {"ready": ready}
    for f in spec.page_fields:
        values[f.name] = _value(root, f, url) if ready else None
    cards = next(filter(None, (H.select(root, sel) for sel in spec.records)), []) if ready else []
    return values, cards, root


def _flat_rows(html: str | None, url: str | None, spec: Spec) -> Iterator[dict]:
    values, cards, root = _page(html, url, spec)
    if not spec.records:
        yield values | {f.name: _value(root, f, url) if values["ready"] else None for f in spec.fields}
    for i, card in enumerate(cards, start=1):
        yield values | {"position": i, "n_records": len(cards)} | {f.name: _value(card, f, url) for f in spec.fields}


def _nested_row(html: str | None, url: str | None, spec: Spec) -> Iterator[dict]:
    values, cards, _ = _page(html, url, spec)
    records = [{"position": i} | {f.name: _value(card, f, url) for f in spec.fields} for i, card in enumerate(cards, start=1)]
    yield values | {"n_records": len(cards), "records": records}


def _packed(batch: pa.RecordBatch, at: list[int], rows: list[dict], keep: Sequence[str], schema: pa.Schema) -> pa.RecordBatch:
    kept = batch.select(list(keep)).take(pa.array(at, pa.int32()))
    return pa.RecordBatch.from_arrays([kept.column(f.name).cast(f.type) if f.name in keep else pa.array([r[f.name] for r in rows], f.type)
                                       for f in schema], schema=schema)


def _extract_batches(batches: Iterator[pa.RecordBatch], page_rows: Callable[..., Iterator[dict]], spec: Spec, keep: Sequence[str],
                     url_col: str, html_col: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of every page, handed on after ``PACK_ROWS`` rows or ``PACK_CHARS`` read characters: beside the
    batch that Spark sent, a worker holds one page's tree and one pack, whatever the batch holds."""
    for batch in batches:
        urls, htmls = batch.column(url_col), batch.column(html_col)
        at, rows, read = [], [], 0
        for i in range(batch.num_rows):
            html = htmls[i].as_py()
            read += len(html or "")
            for values in page_rows(html, urls[i].as_py(), spec):
                at.append(i)
                rows.append(values)
                if len(rows) >= PACK_ROWS:
                    yield _packed(batch, at, rows, keep, schema)
                    at, rows, read = [], [], 0
            if rows and read >= PACK_CHARS:
                yield _packed(batch, at, rows, keep, schema)
                at, rows, read = [], [], 0
        if rows:
            yield _packed(batch, at, rows, keep, schema)


def _extracted(pages: DataFrame, page_rows: Callable[..., Iterator[dict]], spec: Spec, keep: Sequence[str], url_col: str,
               html_col: str, schema: T.StructType) -> DataFrame:
    needed = list(dict.fromkeys([*keep, url_col, html_col]))
    arrow = to_arrow_schema(schema)
    return pages.select(*needed).mapInArrow(lambda b: _extract_batches(b, page_rows, spec, keep, url_col, html_col, arrow), schema)


def extract(pages: DataFrame, spec: Spec, keep: Sequence[str] = ("page_id", "url"),
            url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Run ``spec`` over every page; one row per page, or one row
    per record element when the spec has a record selector."""
    return _extracted(pages, _flat_rows, spec, keep, url_col, html_col, output_schema(pages, spec, keep))


def nested_schema(pages: DataFrame, spec: Spec, keep: Sequence[str]) -> T.StructType:
    fields = [pages.schema[c] for c in keep]
    fields.append(T.StructField("ready", T.BooleanType()))
    for f in spec.page_fields:
        fields.append(T.StructField(f.name, f.dtype(), True))
    record = T.StructType([T.StructField("position", T.IntegerType())]
                          + [T.StructField(f.name, f.dtype(), True) for f in spec.fields])
    fields.append(T.StructField("n_records", T.IntegerType()))
    fields.append(T.StructField("records", T.ArrayType(record), True))
    return T.StructType(fields)


def extract_nested(pages: DataFrame, spec: Spec, keep: Sequence[str] = ("page_id", "url"),
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page with its page fields, ``n_records`` and the records
    as an array of structs: a single parse gives both page facts (empty
    pages included) and the card rows (``explode``)."""
    return _extracted(pages, _nested_row, spec, keep, url_col, html_col, nested_schema(pages, spec, keep))


# --- specs of the two listing sites ----------------------------------------------
# FIXED VALUES: CSS selectors of the pages the listings come from, in the
# order they are tried.

BOOK_CARD_SPEC = Spec(
    records=("article.product_pod",),
    fields=(
        Field("card_url", ("h3 a[title]", "h3 a", "a[href]"), ATTR, "href", absolute=True),
        Field("title", ("h3 a[title]", "h3 a", "a[href]"), TEXT_OR_ATTR, "title"),
        Field("price", (".price_color",)),
        Field("availability", (".availability", ".instock")),
        Field("rating_class", (".star-rating",), ATTR, "class"),
        Field("rating_aria", (".star-rating",), ATTR, "aria-label"),
        Field("rating_title", (".star-rating",), ATTR, "title"),
    ),
    page_fields=(Field("next_links", ("li.next a", ".pager .next a"), COUNT),),
)

BOOK_DETAIL_SPEC = Spec(
    ready=("article.product_page", ".product_main"),
    fields=(
        Field("title", (".product_main h1", "article.product_page h1")),
        Field("price", (".product_main .price_color", ".price_color")),
        Field("availability", (".product_main .availability", ".product_main .instock")),
        Field("rating_class", (".product_main .star-rating", ".star-rating"), ATTR, "class"),
        Field("rating_aria", (".product_main .star-rating", ".star-rating"), ATTR, "aria-label"),
        Field("rating_title", (".product_main .star-rating", ".star-rating"), ATTR, "title"),
        Field("description_text", ("#product_description + p", ".product_page > p")),
        Field("description_meta", ("meta[name='description']",), ATTR, "content"),
        Field("information", ("table.table-striped tr", ".product_page table tr"), MAP),
        Field("category", ("ul.breadcrumb li a",), LAST_TEXT),
    ),
)

CAR_CARD_SPEC = Spec(
    records=(
        "a.common-ad-card[href*='/vehicle_listings/']",
        "a.common-ad-card[href*='vehicle']",
        "a.common-ad-card",
        ".common-ad-card",
    ),
    fields=(
        Field("heading", ("h4[title]", ".ad-specification h4", "h4"), TEXT_OR_ATTR, "title"),
        Field("card_url", ("_parent_",), ATTR, "href", absolute=True),
        Field("inner_href", ("a[href*='/vehicle_listings/']", "a[href]"), ATTR, "href", absolute=True),
        Field("price", (".ad-vehicle-price .price", ".ad-vehicle-price .value", ".price-wrap .price")),
        Field("mileage", (".ad-vehicle-mileage .value", "[class*='mileage'] .value", ".ad-vehicle-mileage")),
        Field("transmission", (".ad-vehicle-engine .transmission span:last-child",
                               ".transmission span:last-child", ".transmission span", ".transmission")),
        Field("region", (".ad-specification .location", ".specification-section .location", ".location")),
    ),
)


def book_details(pages: DataFrame, keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """I5-I7 on product pages: detail fields + information table lookups
    (product type, tax, review count, availability) and the description
    with its meta fallback."""
    from ..functions.text import rating_from_class
    d = extract(pages, BOOK_DETAIL_SPEC, keep)
    info = F.col("information")
    return d.select(
        *keep, "ready", "title", "price", "availability",
        rating_from_class("rating_class", "rating_aria", "rating_title").alias("rating"),
        F.coalesce(F.nullif("description_text", F.lit("")), "description_meta").alias("description"),
        F.try_element_at(info, F.lit("product type")).alias("product_type"),
        F.try_element_at(info, F.lit("tax")).alias("tax"),
        F.try_element_at(info, F.lit("number of reviews")).alias("review_count"),
        F.try_element_at(info, F.lit("availability")).alias("info_availability"),
        "category",
    )


def book_cards(pages: DataFrame, keep: Sequence[str] = ("crawl_id", "page", "url")) -> DataFrame:
    """One row per product card with its absolute URL and rating."""
    from ..functions.text import rating_from_class
    c = extract(pages, BOOK_CARD_SPEC, keep)
    return c.select(*keep, "ready", "position", F.col("n_records").alias("products_on_page"),
                    (F.col("next_links") > 0).alias("has_next"), "card_url", "title", "price",
                    "availability", rating_from_class("rating_class", "rating_aria", "rating_title").alias("rating"))


def car_cards(pages: DataFrame, keep: Sequence[str] = ("crawl_id", "page", "url")) -> DataFrame:
    """I4: one row per vehicle card; heading split into year/brand/model."""
    from ..functions.text import vehicle_heading
    c = extract(pages, CAR_CARD_SPEC, keep)
    c = c.withColumn("card_url", F.coalesce(F.nullif("card_url", F.lit("")), "inner_href"))
    return vehicle_heading(c, "heading")


# --- sitemap specs (I2) -------------------------------------------------------------

def sitemap_plan(sitemap: dict | str):
    """Split a sitemap (selector tree) into: the record selector, the fields
    evaluated in a record, the per-page fields and the fields read from the
    linked page of a ``SelectorLink`` record."""
    if isinstance(sitemap, str):
        sitemap = json.loads(sitemap)
    sels = sitemap["selectors"]
    children = defaultdict(list)
    for s in sels:
        for p in s.get("parentSelectors", ["_root"]):
            children[p].append(s)
    roots = children["_root"]
    record = next((s for s in roots if s.get("multiple")), None)

    def as_field(s) -> list[Field]:
        kind = s["type"]
        sel = (s["selector"],)
        if kind == "SelectorText":
            return [Field(s["id"], sel, ALL_TEXT if s.get("multiple") else TEXT)]
        if kind == "SelectorElementAttribute":
            return [Field(s["id"], sel, ALL_ATTR if s.get("multiple") else ATTR, s["extractAttribute"],
                          absolute=s["extractAttribute"] in ("href", "src"))]
        if kind == "SelectorLink":
            return [Field(s["id"], sel, TEXT), Field(s["id"] + "_href", sel, ATTR, "href", absolute=True)]
        return [Field(s["id"], sel, TEXT)]

    page_fields = tuple(f for s in roots if s is not record for f in as_field(s))
    if record is None:
        return None, page_fields, (), ()
    in_record, on_linked = [], []
    if record["type"] == "SelectorLink":
        in_record = [Field(record["id"], ("_parent_",), TEXT),
                     Field(record["id"] + "_href", ("_parent_",), ATTR, "href", absolute=True)]
        on_linked = [f for s in children[record["id"]] for f in as_field(s)]
    else:
        in_record = [f for s in children[record["id"]] for f in as_field(s)]
    return record, page_fields, tuple(in_record), tuple(on_linked)


def sitemap_extract(pages: DataFrame, sitemap: dict | str, keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Run a sitemap over listing pages; records of a ``SelectorLink``
    get their child fields from the linked page, found in the same pages
    table by URL (left join; the detail side is de-duplicated by URL)."""
    record, page_fields, in_record, on_linked = sitemap_plan(sitemap)
    if record is None:
        return extract(pages, Spec(fields=page_fields), keep)
    spec = Spec(records=(record["selector"],), fields=in_record, page_fields=page_fields)
    listing = extract(pages, spec, keep)
    if not on_linked:
        return listing
    detail = extract(pages, Spec(fields=on_linked), ("url", "page_id"))
    from .dedup import dedup_first
    detail = dedup_first(detail, F.col("url"), "page_id").drop("page_id", "ready")
    href = record["id"] + "_href"
    detail = detail.withColumnRenamed("url", href)
    return listing.join(detail, on=href, how="left")
