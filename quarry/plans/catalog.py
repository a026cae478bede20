"""Registered queries: one per operator of the inventory.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
DuckDB SQL that must return the same rows (``None`` when the operator is not
expressible in SQL, e.g. file listing or HTML parsing).  Every query reads
whole driver tables (or data Spark derives from them); doubles are rounded
to 6 decimals on both sides so that summation order does not matter.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import bindings as B
from . import oracle as O

# Fixed parameters of the registered queries (reproducible results).
MAX_YEAR = 2027
BATCH_TIME = _dt.datetime(2026, 8, 18, 12, 0, 0)


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


RAW_BOOKS_SQL = B.oracle(B.RAW_BOOKS, part="part")
RAW_CARS_SQL = B.oracle(B.RAW_CARS, customer="customer")
CLEAN_BOOKS_SQL = O.clean_books(RAW_BOOKS_SQL)
CLEAN_CARS_SQL = O.clean_cars(RAW_CARS_SQL, MAX_YEAR)


def _clean_books(spark, d):
    from .clean import clean_books
    return clean_books(B.raw_books(spark, d))


def _clean_cars(spark, d):
    from .clean import clean_cars
    return clean_cars(B.raw_cars(spark, d), max_year=MAX_YEAR)


# --- U2 / U3 -------------------------------------------------------------------

@register("u2_clean_books", CLEAN_BOOKS_SQL)
def u2_clean_books(spark, d):
    return _clean_books(spark, d)


@register("u3_clean_cars", CLEAN_CARS_SQL)
def u3_clean_cars(spark, d):
    return _clean_cars(spark, d)


# --- D2 / D3 ------------------------------------------------------------------

@register("d2_book_metrics", f"""
SELECT CAST(count(*) AS BIGINT) AS total_books,
       round(avg(price), 6) AS average_price, round(min(price), 6) AS minimum_price,
       round(max(price), 6) AS maximum_price, round(avg(CAST(review_count AS DOUBLE)), 6) AS average_reviews
FROM ({CLEAN_BOOKS_SQL}) m""")
def d2_book_metrics(spark, d):
    from ..operators.aggregates import book_metrics
    return round_doubles(book_metrics(_clean_books(spark, d)))


@register("d3_car_metrics", f"""
SELECT CAST(count(*) AS BIGINT) AS total_ads,
       round(avg(CAST(price AS DOUBLE)), 6) AS average_price, round(min(CAST(price AS DOUBLE)), 6) AS minimum_price,
       round(max(CAST(price AS DOUBLE)), 6) AS maximum_price, round(avg(CAST(mileage AS DOUBLE)), 6) AS average_mileage
FROM ({CLEAN_CARS_SQL}) m""")
def d3_car_metrics(spark, d):
    from ..operators.aggregates import car_metrics
    return round_doubles(car_metrics(_clean_cars(spark, d)))


# --- H: scalar functions -----------------------------------------------------

DOC_NOISY = """
SELECT doc_id,
  CASE doc_id % 6 WHEN 0 THEN 'N/A' WHEN 1 THEN chr(9) || text || '  ' || chr(10)
                  WHEN 2 THEN '  Non   renseigné ' WHEN 3 THEN '' ELSE text END AS raw
FROM {documents}
"""


def _docs_noisy(spark, d):
    return B.bind(spark, d, DOC_NOISY, documents="documents")


@register("h1_clean_text", f"""
SELECT doc_id, {O.clean_text('raw')} AS value FROM ({B.oracle(DOC_NOISY, documents='documents')}) t""")
def h1_clean_text(spark, d):
    from ..functions.text import clean_text
    return _docs_noisy(spark, d).select("doc_id", clean_text("raw").alias("value"))


@register("h2_fold_text", f"""
SELECT doc_id, {O.fold_text('text')} AS value FROM documents""")
def h2_fold_text(spark, d):
    from ..functions.text import fold_text
    return B.load(spark, d, "documents").select("doc_id", fold_text("text").alias("value"))


@register("h3_parse_decimal", "SELECT ordinal, raw, value FROM (" + O.layers(
    f"SELECT ordinal, price AS raw FROM ({RAW_BOOKS_SQL}) r", O.parse_decimal_layers("raw", "value")) + ") h")
def h3_parse_decimal(spark, d):
    from ..functions.numbers import parse_decimal
    return B.raw_books(spark, d).select("ordinal", F.col("price").alias("raw"),
                                        parse_decimal("price").alias("value"))


ORDERS_COUNTERS = """
SELECT o_orderkey,
  CASE o_orderkey % 5
    WHEN 0 THEN CAST(o_orderkey AS STRING) || ' 000 CFA'
    WHEN 1 THEN '  -' || CAST(o_orderkey AS STRING) || ' km'
    WHEN 2 THEN 'Page -' || CAST(o_orderkey % 50 AS STRING)
    WHEN 3 THEN CAST(o_orderkey % 97 AS STRING) || '.5'
    ELSE 'aucun' END AS raw
FROM {orders}
"""


@register("h4_parse_integer", f"""
SELECT o_orderkey, raw, {O.parse_integer('raw')} AS value
FROM ({B.oracle(ORDERS_COUNTERS, orders='orders')}) t""")
def h4_parse_integer(spark, d):
    from ..functions.numbers import parse_integer
    return B.bind(spark, d, ORDERS_COUNTERS, orders="orders").select(
        "o_orderkey", "raw", parse_integer("raw").alias("value"))


@register("h5_analytics_number", f"""
SELECT ordinal, price AS raw, {O.analytics_number('price')} AS value FROM ({RAW_BOOKS_SQL}) r""")
def h5_analytics_number(spark, d):
    from ..functions.numbers import analytics_number
    return B.raw_books(spark, d).select("ordinal", F.col("price").alias("raw"),
                                        analytics_number("price").alias("value"))


@register("h6_storage_number", f"""
SELECT ordinal, price AS raw, {O.storage_number('price')} AS value,
       TRY_CAST(trunc({O.storage_number('price')}) AS BIGINT) AS int_value
FROM ({RAW_BOOKS_SQL}) r""")
def h6_storage_number(spark, d):
    from ..functions.numbers import storage_number
    return B.raw_books(spark, d).select("ordinal", F.col("price").alias("raw"),
                                        storage_number("price").alias("value"),
                                        storage_number("price", integer=True).alias("int_value"))


PART_STRICT = """
SELECT p_partkey,
  CASE p_partkey % 6
    WHEN 0 THEN ' ' || CAST(p_size AS STRING) || 'e2 '
    WHEN 1 THEN CAST(p_size AS STRING) || 'd'
    WHEN 2 THEN '-' || CAST(p_size AS STRING) || '.' || CAST(p_partkey % 10 AS STRING)
    WHEN 3 THEN '1,' || CAST(p_size AS STRING)
    WHEN 4 THEN ''
    ELSE '.' || CAST(p_size AS STRING) END AS raw
FROM {part}
"""


@register("h7_coerce_numeric", f"""
SELECT p_partkey, raw, {O.coerce_numeric('raw')} AS value FROM ({B.oracle(PART_STRICT, part='part')}) t""")
def h7_coerce_numeric(spark, d):
    from ..functions.numbers import coerce_numeric
    return B.bind(spark, d, PART_STRICT, part="part").select("p_partkey", "raw",
                                                             coerce_numeric("raw").alias("value"))


@register("h8_storage_text", f"""
SELECT doc_id, {O.storage_text('raw')} AS value FROM ({B.oracle(DOC_NOISY, documents='documents')}) t""")
def h8_storage_text(spark, d):
    from ..functions.text import storage_text
    return _docs_noisy(spark, d).select("doc_id", storage_text("raw").alias("value"))


EVENTS_NAN = """
SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN CAST('NaN' AS DOUBLE)
       WHEN event_id % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END AS value
FROM {events}
"""


@register("h9_is_missing", f"""
SELECT event_id, (value IS NULL OR isnan(value)) AS missing
FROM ({B.oracle(EVENTS_NAN, events='events')}) t""")
def h9_is_missing(spark, d):
    from ..functions.numbers import is_missing
    return B.bind(spark, d, EVENTS_NAN, events="events").select(
        "event_id", is_missing("value").alias("missing"))


@register("h10_iso_timestamp", f"""
SELECT event_id, {O.iso_timestamp('ts')} AS iso FROM events""")
def h10_iso_timestamp(spark, d):
    from ..functions.fmt import iso_timestamp
    return B.load(spark, d, "events").select("event_id", iso_timestamp("ts").alias("iso"))


@register("h11_canonical_key", f"""
SELECT p_partkey, {O.canonical_key("'part'", 'p_name', 'p_type', 'p_brand')} AS key FROM part""")
def h11_canonical_key(spark, d):
    from ..functions.keys import canonical_key
    return B.load(spark, d, "part").select(
        "p_partkey", canonical_key(F.lit("part"), F.col("p_name"), F.col("p_type"), F.col("p_brand")).alias("key"))


def _book_key_sql(src: str) -> str:
    url = O.storage_text("url")
    cat = "(CASE WHEN category IS NOT NULL AND category <> '' THEN category ELSE product_type END)"
    return (f"SELECT ordinal, CASE WHEN {url} IS NOT NULL THEN {O.canonical_key(chr(39) + 'book-url' + chr(39), url)} "
            f"ELSE {O.canonical_key(chr(39) + 'book' + chr(39), O.storage_text('title'), cat)} END AS source_key "
            f"FROM ({src}) k")


@register("h12_source_key", _book_key_sql(RAW_BOOKS_SQL))
def h12_source_key(spark, d):
    from ..functions.keys import book_source_key
    raw = B.raw_books(spark, d)
    return raw.select("ordinal", book_source_key(raw).alias("source_key"))


def _car_key_sql(raw: str) -> str:
    url, t = O.storage_text("url"), O.storage_text
    key = (f"CASE WHEN {url} IS NOT NULL THEN {O.canonical_key(O.q('car-url'), url)} ELSE "
           f"{O.canonical_key(O.q('car'), t('brand'), 'model', 'year', 'price', 'mileage', 'region')} END")
    return f"SELECT ordinal, {key} AS source_key FROM ({raw}) r"


@register("h12_car_key", _car_key_sql(RAW_CARS_SQL))
def h12_car_key(spark, d):
    from ..functions.keys import car_source_key
    raw = B.raw_cars(spark, d)
    return raw.select("ordinal", car_source_key(raw).alias("source_key"))


@register("h13_availability", f"""
SELECT ordinal, {O.availability('a', O.fold_text('a'))} AS availability
FROM (SELECT ordinal, {O.clean_text('availability')} AS a FROM ({RAW_BOOKS_SQL}) r) t""")
def h13_availability(spark, d):
    from ..functions.text import availability, clean_text
    raw = B.raw_books(spark, d).select("ordinal", clean_text("availability").alias("a"))
    return raw.select("ordinal", availability("a").alias("availability"))


@register("h14_rating", f"""
SELECT ordinal, rating AS raw, {O.rating_from_text(O.fold_text('rating'))} AS rating FROM ({RAW_BOOKS_SQL}) r""")
def h14_rating(spark, d):
    from ..functions.text import rating_from_text
    return B.raw_books(spark, d).select("ordinal", F.col("rating").alias("raw"),
                                        rating_from_text("rating").alias("rating"))


PART_RATING_ATTRS = """
SELECT p_partkey,
  CASE p_size % 7
    WHEN 0 THEN 'star-rating Three'
    WHEN 1 THEN 'star-rating'
    WHEN 2 THEN '  rating   FIVE extra'
    WHEN 3 THEN 'Two star-rating'
    WHEN 4 THEN 'star-rating twofold'
    WHEN 5 THEN CAST(NULL AS STRING)
    ELSE 'icon' END AS class_attr,
  CASE WHEN p_size % 3 = 0 THEN 'Rated ' || lower(p_type) || ' two out of five' ELSE CAST(NULL AS STRING) END AS aria_label,
  CASE WHEN p_size % 4 = 0 THEN 'Four stars' ELSE CAST(NULL AS STRING) END AS title_attr
FROM {part}
"""


def _rating_class_sql(src: str) -> str:
    tokens = "string_split(lower(" + O.collapse_ws("class_attr") + "), ' ')"
    words = list(__import__("quarry.schema", fromlist=["RATING_WORDS"]).RATING_WORDS.items())
    lookup = "CASE t " + " ".join(f"WHEN '{w}' THEN {v}" for w, v in words) + " END"
    from_class = f"list_filter(list_transform({tokens}, lambda t: {lookup}), lambda v: v IS NOT NULL)[1]"

    def contained(col):
        return "(CASE " + " ".join(f"WHEN contains(lower({col}), '{w}') THEN {v}" for w, v in words) + " END)"
    return (f"SELECT p_partkey, CAST(coalesce({from_class}, {contained('aria_label')}, {contained('title_attr')}) AS BIGINT) "
            f"AS rating FROM ({src}) r")


@register("h15_rating_class", _rating_class_sql(B.oracle(PART_RATING_ATTRS, part="part")))
def h15_rating_class(spark, d):
    from ..functions.text import rating_from_class
    df = B.bind(spark, d, PART_RATING_ATTRS, part="part")
    return df.select("p_partkey", rating_from_class("class_attr", "aria_label", "title_attr").alias("rating"))


@register("h16_brand", f"""
SELECT ordinal, {O.brand('b', O.fold_text(O.collapse_ws('b')))} AS brand
FROM (SELECT ordinal, {O.clean_text('brand')} AS b FROM ({RAW_CARS_SQL}) r) t""")
def h16_brand(spark, d):
    from ..functions.text import brand, clean_text
    raw = B.raw_cars(spark, d).select("ordinal", clean_text("brand").alias("b"))
    return raw.select("ordinal", brand("b").alias("brand"))


@register("h17_transmission", f"""
SELECT ordinal, {O.transmission('t', O.fold_text('t'))} AS transmission
FROM (SELECT ordinal, {O.clean_text('transmission')} AS t FROM ({RAW_CARS_SQL}) r) x""")
def h17_transmission(spark, d):
    from ..functions.text import clean_text, transmission
    raw = B.raw_cars(spark, d).select("ordinal", clean_text("transmission").alias("t"))
    return raw.select("ordinal", transmission("t").alias("transmission"))


CUSTOMER_NAMES = """
SELECT c_custkey,
  CASE c_custkey % 4 WHEN 0 THEN lower(c_name) || ' l''or-bleu'
                     WHEN 1 THEN 'mercedes-benz ' || lower(c_mktsegment)
                     WHEN 2 THEN '4x4 ' || upper(c_mktsegment) || ' été'
                     ELSE CAST(NULL AS STRING) END AS raw
FROM {customer}
"""


@register("h18_title_case", f"""
SELECT c_custkey, {O.title_case('raw')} AS value FROM ({B.oracle(CUSTOMER_NAMES, customer='customer')}) t""")
def h18_title_case(spark, d):
    from ..functions.text import title_case
    return B.bind(spark, d, CUSTOMER_NAMES, customer="customer").select(
        "c_custkey", title_case("raw").alias("value"))


PART_HEADINGS = """
SELECT p_partkey,
  CASE p_partkey % 6
    WHEN 0 THEN CAST(1990 + p_size AS STRING) || ' Land Rover ' || p_name
    WHEN 1 THEN 'toyota  ' || CAST(1990 + p_size AS STRING) || ' ' || p_name
    WHEN 2 THEN 'MERCEDES-BENZ'
    WHEN 3 THEN upper(p_name)
    WHEN 4 THEN CAST(1990 + p_size AS STRING)
    ELSE 'Rolls Royce' || CAST(p_size AS STRING) || ' ' || p_name END AS heading
FROM {part}
"""


def _heading_sql(src: str) -> str:
    import quarry.schema as SS
    norm = O.collapse_ws("heading")
    year = f"NULLIF(regexp_extract(h, '\\b((?:19|20)[0-9]{{2}})\\b', 1), '')"
    rest = (f"NULLIF({O.collapse_ws(f'CASE WHEN y IS NULL THEN h ELSE regexp_replace(h, {chr(39)}^(.*?)\\b(?:19|20)[0-9]{{2}}\\b{chr(39)}, {chr(39)}\\1 {chr(39)}) END')}, '')")
    bcases, mcases = [], []
    for known in sorted(SS.MULTIWORD_BRANDS, key=len, reverse=True):
        k = known.lower()
        cond = f"(lower(rest) = '{k}' OR starts_with(lower(rest), '{k} '))"
        bcases.append(f"WHEN {cond} THEN substr(rest, 1, {len(known)})")
        mcases.append(f"WHEN {cond} THEN NULLIF(trim(substr(rest, {len(known) + 1})), '')")
    first = "split_part(rest, ' ', 1)"
    brand_sql = f"CASE WHEN rest IS NULL THEN NULL {' '.join(bcases)} ELSE {first} END"
    model_sql = (f"CASE WHEN rest IS NULL THEN NULL {' '.join(mcases)} "
                 f"WHEN instr(rest, ' ') > 0 THEN NULLIF(substr(rest, length({first}) + 2), '') END")
    l1 = f"SELECT p_partkey, NULLIF({norm}, '') AS h FROM ({src}) s"
    l2 = f"SELECT *, {year} AS y FROM ({l1}) a"
    l3 = f"SELECT *, {rest} AS rest FROM ({l2}) b"
    return f"SELECT p_partkey, y AS year, {brand_sql} AS brand, {model_sql} AS model FROM ({l3}) c"


@register("h19_vehicle_heading", _heading_sql(B.oracle(PART_HEADINGS, part="part")))
def h19_vehicle_heading(spark, d):
    from ..functions.text import vehicle_heading
    df = B.bind(spark, d, PART_HEADINGS, part="part")
    return vehicle_heading(df.select("p_partkey", "heading"), "heading").drop("heading")


@register("h20_kpi_format", """
SELECT p_partkey, format('{:,.2f} £', p_retailprice) AS price_label,
       format('{:,.0f} FCFA', p_retailprice * 1000) AS cfa_label,
       format('{:,.0f} km', CAST(p_size AS DOUBLE) * 1234.5) AS km_label,
       format('{:.1f}', p_retailprice * 4 + 0.03) AS reviews_label
FROM part""")
def h20_kpi_format(spark, d):
    from ..functions.fmt import kilometres, money, one_decimal
    p = B.load(spark, d, "part")
    return p.select("p_partkey", money("p_retailprice").alias("price_label"),
                    money(F.col("p_retailprice") * 1000, "FCFA", 0).alias("cfa_label"),
                    kilometres(F.col("p_size").cast("double") * 1234.5).alias("km_label"),
                    one_decimal(F.col("p_retailprice") * 4 + 0.03).alias("reviews_label"))


@register("h21_file_size", """
SELECT o_orderkey, CASE WHEN sz < 1024 THEN CAST(sz AS VARCHAR) || ' o'
                        WHEN sz < 1048576 THEN format('{:,.1f} Kio', sz / 1024.0)
                        ELSE format('{:,.1f} Mio', sz / 1048576.0) END AS size_label
FROM (SELECT o_orderkey, CAST(round(o_totalprice * pow(10, o_orderkey % 4 - 1)) AS BIGINT) AS sz FROM orders) t""")
def h21_file_size(spark, d):
    from ..functions.fmt import file_size
    o = B.load(spark, d, "orders")
    sz = F.round(F.col("o_totalprice") * F.pow(F.lit(10.0), (F.col("o_orderkey") % 4 - 1).cast("double"))).cast("bigint")
    return o.select("o_orderkey", file_size(sz).alias("size_label"))


PAGE_URLS = """
SELECT page_id,
  CASE page_id % 6 WHEN 0 THEN 'ftp://' || substr(url, 8) WHEN 1 THEN 'http://'
                   WHEN 2 THEN CAST(NULL AS STRING) WHEN 3 THEN upper(url)
                   WHEN 4 THEN ' ' || chr(9) || url ELSE url END AS url
FROM {pages}
"""


@register("h22_public_url", f"""
SELECT page_id, coalesce(regexp_matches(regexp_replace(regexp_replace(url, '[\t\r\n]', '', 'g'), '^[\x00-\x20]+', ''),
                                         '^(?i)https?://[^/?#]'), false) AS public_url
FROM ({B.oracle(PAGE_URLS, pages='pages')}) t""")
def h22_public_url(spark, d):
    from ..functions.text import is_public_http_url
    return B.bind(spark, d, PAGE_URLS, pages="pages").select("page_id", is_public_http_url("url").alias("public_url"))


@register("h23_date_label", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y · %H:%M') AS label FROM orders""")
def h23_date_label(spark, d):
    from ..functions.fmt import date_label
    return B.load(spark, d, "orders").select("o_orderkey", date_label("o_orderdate").alias("label"))


# --- B: projections and filters ------------------------------------------------

PART_HEADERS = """
SELECT CAST(p_partkey AS BIGINT) AS ordinal, p_name AS Name, p_brand AS ` Titre `, p_retailprice AS PRIX,
       p_type AS `Type`, p_size AS `Page`, p_container_free AS `Catégorie`
FROM (SELECT *, p_brand || '/' || p_type AS p_container_free FROM {part}) x
"""


@register("b1_ensure_columns", """
SELECT CAST(p_partkey AS BIGINT) AS ordinal, p_name AS title, p_retailprice AS price,
       CAST(NULL AS VARCHAR) AS availability, CAST(NULL AS VARCHAR) AS products_on_page,
       CAST(NULL AS VARCHAR) AS rating, CAST(NULL AS VARCHAR) AS review_count,
       CAST(NULL AS VARCHAR) AS description, p_type AS product_type, CAST(NULL AS VARCHAR) AS tax,
       CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS source_page
FROM part""")
def b1_ensure_columns(spark, d):
    from .. import schema as S
    from ..operators.columns import canonical_projection, ensure_columns
    p = B.load(spark, d, "part").select(F.col("p_partkey").cast("bigint").alias("ordinal"),
                                         F.col("p_name").alias("title"), F.col("p_retailprice").alias("price"),
                                         F.col("p_type").alias("product_type"))
    return canonical_projection(ensure_columns(p, S.BOOK_COLUMNS), ("ordinal",) + S.BOOK_COLUMNS)


@register("b2_header_aliases", """
SELECT CAST(p_partkey AS BIGINT) AS ordinal, p_brand AS title, p_retailprice AS price, p_type AS product_type,
       p_size AS source_page, p_brand || '/' || p_type AS "catégorie"
FROM part""")
def b2_header_aliases(spark, d):
    from .. import schema as S
    from ..operators.columns import apply_aliases
    return apply_aliases(B.bind(spark, d, PART_HEADERS, part="part"), S.BOOK_ALIASES)


@register("b3_canonical_projection", f"""
SELECT {', '.join(__import__('quarry.schema', fromlist=['x']).BOOK_COLUMNS)} FROM ({RAW_BOOKS_SQL}) r""")
def b3_canonical_projection(spark, d):
    from .. import schema as S
    from ..operators.columns import canonical_projection
    return canonical_projection(B.raw_books(spark, d), S.BOOK_COLUMNS)


STORED_LIKE = """
SELECT CAST(p_partkey AS BIGINT) AS id, md5(p_name) AS source_key, p_retailprice AS price, p_name AS title,
       p_comment_free AS note, p_brand AS category, CAST(p_size AS BIGINT) AS source_page,
       'x' AS created_at, 'y' AS updated_at
FROM (SELECT *, 'size ' || CAST(p_size AS STRING) AS p_comment_free FROM {part}) x
"""


@register("b4_display_projection", """
SELECT title, price, category, source_page, note
FROM (SELECT p_name AS title, p_retailprice AS price, p_brand AS category, CAST(p_size AS BIGINT) AS source_page,
             'size ' || CAST(p_size AS VARCHAR) AS note FROM part) x""")
def b4_display_projection(spark, d):
    from ..operators.columns import display_projection
    return display_projection(B.bind(spark, d, STORED_LIKE, part="part"), "books")


@register("b5_equality_filter", """
SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part WHERE p_type = 'SMALL' AND p_size = 5""")
def b5_equality_filter(spark, d):
    from ..operators.filters import equality_filter
    p = B.load(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return equality_filter(p, {"p_type": "SMALL", "p_size": 5, "p_brand": None})


@register("b5_clustered_listing", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AND o_totalprice >= 100000 ORDER BY o_orderkey""")
def b5_clustered_listing(spark, d):
    """Orders stored by a cluster key of the filter columns; the listing reads few row groups."""
    from ..operators.layout import list_rows, write_clustered
    from ..session import scratch_path
    path = write_clustered(B.load(spark, d, "orders"), scratch_path(spark, "clustered"), ("o_orderstatus", "o_orderpriority", "o_totalprice"), row_group_rows=500)
    table = spark.read.parquet(path).where("o_totalprice >= 100000")
    return list_rows(table, {"o_orderstatus": "F", "o_orderpriority": "2-HIGH", "o_custkey": None}, "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


BOOK_CATEGORY_CHOICE = ["Brand#13", "Brand#21", "MEDIUM", "LARGE"]
BOOK_AVAIL_CHOICE = ["in_stock", "sur_commande"]


@register("b6_multi_select", f"""
SELECT ordinal, title, category, product_type, availability FROM ({CLEAN_BOOKS_SQL}) c
WHERE coalesce(NULLIF(category, ''), product_type) IN {O.tokens_list(BOOK_CATEGORY_CHOICE)}
  AND availability IN {O.tokens_list(BOOK_AVAIL_CHOICE)}""")
def b6_multi_select(spark, d):
    from ..operators.filters import filter_books
    out = filter_books(_clean_books(spark, d), categories=BOOK_CATEGORY_CHOICE,
                       availabilities=BOOK_AVAIL_CHOICE, product_types=[], ratings=None)
    return out.select("ordinal", "title", "category", "product_type", "availability")


@register("b7_dashboard_filter", f"""
SELECT ordinal, analysis_category, availability, rating FROM
  (SELECT *, coalesce(category, product_type) AS analysis_category FROM ({CLEAN_BOOKS_SQL}) c) x
WHERE analysis_category IS NOT NULL AND availability IS NOT NULL AND rating IS NOT NULL""")
def b7_dashboard_filter(spark, d):
    from ..operators.filters import analysis_category, dashboard_filter
    df = _clean_books(spark, d)
    df = df.withColumn("analysis_category", analysis_category(df))
    df = materialize(df.select("ordinal", "analysis_category", "availability", "rating"), "b7")
    return dashboard_filter(df, ["analysis_category", "availability", "rating"])


@register("b7_many_options", """
SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
WHERE o_custkey IN (SELECT CAST(i * 3 AS INTEGER) FROM range(1, 1801) t(i)) AND o_orderpriority IN ('1-URGENT', '5-LOW')""")
def b7_many_options(spark, d):
    from ..operators.filters import dashboard_filter
    chosen = {"o_custkey": [float(i * 3) for i in range(1, 1801)], "o_orderpriority": ["1-URGENT", "5-LOW"]}
    return dashboard_filter(B.load(spark, d, "orders"), list(chosen), chosen).select("o_orderkey", "o_totalprice", "o_orderpriority")


@register("b6_filter_cars", f"""
SELECT ordinal, brand, year, region FROM ({CLEAN_CARS_SQL}) c
WHERE brand IN ('BMW', 'Toyota', 'Peugeot') AND year IN (1990, 1992, 2000, 2004, 2010)""")
def b6_filter_cars(spark, d):
    from ..operators.filters import filter_cars
    out = filter_cars(_clean_cars(spark, d), brands=["BMW", "Toyota", "Peugeot"], years=[1990, 1992, 2000, 2004, 2010], regions=None)
    return out.select("ordinal", "brand", "year", "region")


@register("b8_drop_nulls", f"""
SELECT ordinal, brand, price, mileage FROM ({CLEAN_CARS_SQL}) c WHERE price IS NOT NULL AND mileage IS NOT NULL""")
def b8_drop_nulls(spark, d):
    from ..operators.filters import drop_null
    return drop_null(_clean_cars(spark, d), ["price", "mileage"]).select("ordinal", "brand", "price", "mileage")


@register("b9_range_nulls", """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal,
       CASE WHEN c_nationkey BETWEEN 3 AND 20 THEN c_nationkey END AS nationkey FROM customer""")
def b9_range_nulls(spark, d):
    from ..operators.filters import null_outside
    c = B.load(spark, d, "customer")
    return c.select("c_custkey", null_outside(F.col("c_acctbal"), low=0).alias("acctbal"),
                    null_outside(F.col("c_nationkey"), 3, 20).alias("nationkey"))


def _car_storage_sql(raw: str) -> str:
    return (f"SELECT ordinal, {O.storage_text('brand')} AS brand, "
            f"TRY_CAST(trunc({O.storage_number('year')}) AS BIGINT) AS year, {O.storage_number('price')} AS price, "
            f"{O.storage_number('mileage')} AS mileage, source_page FROM ({raw}) r")


@register("b10_violations", f"""
SELECT ordinal, concat_ws(',',
   CASE WHEN brand IS NULL OR length(trim(brand)) = 0 THEN 'brand_required' END,
   CASE WHEN year < 1886 OR year > 2100 THEN 'year_range' END,
   CASE WHEN price < 0 THEN 'price_negative' END,
   CASE WHEN mileage < 0 THEN 'mileage_negative' END,
   CASE WHEN source_page < 1 THEN 'source_page_below_one' END) AS violations
FROM ({_car_storage_sql(RAW_CARS_SQL)}) n""")
def b10_violations(spark, d):
    from ..operators.constraints import violations
    from ..operators.upsert import normalize_records
    rows = normalize_records(B.raw_cars(spark, d), "cars")
    return violations(rows, "cars").select("ordinal", F.array_join("violations", ",").alias("violations"))


@register("b10_unique_keys", f"""
SELECT source_key, CAST(count(*) AS BIGINT) AS n_rows FROM ({_book_key_sql(RAW_BOOKS_SQL)}) k GROUP BY 1 HAVING count(*) > 1""")
def b10_unique_keys(spark, d):
    from ..functions.keys import book_source_key
    from ..operators.constraints import repeated_keys
    raw = B.raw_books(spark, d)
    return repeated_keys(raw.select(book_source_key(raw).alias("source_key")), "source_key")


@register("b11_analysis_category", f"""
SELECT ordinal, coalesce(category, product_type) AS analysis_category FROM ({CLEAN_BOOKS_SQL}) c""")
def b11_analysis_category(spark, d):
    from ..operators.filters import analysis_category
    df = _clean_books(spark, d)
    return df.select("ordinal", analysis_category(df).alias("analysis_category"))


@register("b12_missing_bucket", f"""
SELECT ordinal, coalesce(availability, 'Non renseigné') AS availability FROM ({CLEAN_BOOKS_SQL}) c""")
def b12_missing_bucket(spark, d):
    from ..operators.filters import missing_bucket
    return _clean_books(spark, d).select("ordinal", missing_bucket(F.col("availability")).alias("availability"))


@register("b13_preview", """
SELECT doc_id, lang, n_chars, (SELECT CAST(count(*) AS BIGINT) FROM documents) AS total_rows
FROM documents ORDER BY doc_id LIMIT 100""")
def b13_preview(spark, d):
    from ..operators.filters import preview
    from ..sources.files import footer_count
    docs = B.load(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return preview(docs, "doc_id", 100, total=footer_count(spark, f"{d}/documents.parquet").first()[0])


READY_MARKERS = (r"<article[\s>]", r"class=\"[^\"]*\bproduct_main\b")


@register("b14_page_ready", r"""
SELECT page_id, coalesce(regexp_matches(html, '<article[\s>]') OR regexp_matches(html, 'class="[^"]*\bproduct_main\b'), false) AS ready
FROM pages""")
def b14_page_ready(spark, d):
    from ..operators.filters import page_ready
    return B.load(spark, d, "pages").select("page_id", page_ready(F.col("html"), READY_MARKERS).alias("ready"))


# --- D / F: aggregates and ordering ---------------------------------------------

@register("d1_row_count", "SELECT CAST(count(*) AS BIGINT) AS row_count FROM lineitem")
def d1_row_count(spark, d):
    """From the footers: the plan shows the pushed aggregate."""
    from ..sources.files import footer_count
    return footer_count(spark, f"{d}/lineitem.parquet")


@register("d4_value_counts", f"""
SELECT coalesce(coalesce(category, product_type), 'Non renseigné') AS value, CAST(count(*) AS BIGINT) AS count
FROM ({CLEAN_BOOKS_SQL}) c GROUP BY 1""")
def d4_value_counts(spark, d):
    from ..operators.aggregates import value_counts
    from ..operators.filters import analysis_category
    df = _clean_books(spark, d)
    return value_counts(df, analysis_category(df))


@register("d5_option_list", f"""
SELECT DISTINCT coalesce(category, product_type) AS option FROM ({CLEAN_BOOKS_SQL}) c
WHERE coalesce(category, product_type) IS NOT NULL""")
def d5_option_list(spark, d):
    from ..operators.filters import analysis_category, option_list
    df = _clean_books(spark, d)
    return option_list(df, analysis_category(df))


@register("d6_top_brands", """
SELECT coalesce(p_brand, 'Non renseigné') AS value, CAST(count(*) AS BIGINT) AS count FROM part
GROUP BY 1 ORDER BY count DESC, value ASC LIMIT 20""")
def d6_top_brands(spark, d):
    from ..operators.aggregates import top_k
    return top_k(B.load(spark, d, "part"), "p_brand", 20)


@register("d7_counts_per_year", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS key, CAST(count(*) AS BIGINT) AS count FROM orders
WHERE o_orderdate IS NOT NULL GROUP BY 1""")
def d7_counts_per_year(spark, d):
    from ..operators.aggregates import counts_by_key
    return counts_by_key(B.load(spark, d, "orders"), F.year("o_orderdate"))


@register("d8_histogram", """
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((l_extendedprice - lo) / ((hi - lo) / 25.0)), 24) END AS INTEGER) AS bin, lo, hi
      FROM lineitem, s WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice))
SELECT bin, round(CASE WHEN hi = lo THEN lo ELSE lo + bin * ((hi - lo) / 25.0) END, 6) AS lower,
       round(CASE WHEN hi = lo THEN hi ELSE lo + (bin + 1) * ((hi - lo) / 25.0) END, 6) AS upper,
       CAST(count(*) AS BIGINT) AS count
FROM b GROUP BY bin, lo, hi""")
def d8_histogram(spark, d):
    from ..operators.aggregates import histogram
    return round_doubles(histogram(B.load(spark, d, "lineitem"), "l_extendedprice", 25))


@register("d9_box_stats", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3, count(*) AS n, min(l_extendedprice) AS minimum,
                  max(l_extendedprice) AS maximum
           FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.l_returnflag, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence, CAST(n AS BIGINT) AS n,
       round(minimum, 6) AS minimum, round(maximum, 6) AS maximum,
       CAST(sum(CASE WHEN l.l_extendedprice < lower_fence OR l.l_extendedprice > upper_fence THEN 1 ELSE 0 END) AS BIGINT) AS outliers
FROM f JOIN lineitem l ON l.l_returnflag = f.l_returnflag
GROUP BY ALL""")
def d9_box_stats(spark, d):
    from ..operators.aggregates import box_stats
    return round_doubles(box_stats(B.load(spark, d, "lineitem"), "l_returnflag", "l_extendedprice"))


@register("d8_histogram_aligned", """
WITH x AS (SELECT CAST(o_totalprice AS DOUBLE) AS x FROM orders WHERE o_totalprice IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
w AS (SELECT lo, min(pow(2.0, e)) AS w FROM b, range(-20, 60) r(e) WHERE floor(hi / pow(2.0, e)) - floor(lo / pow(2.0, e)) < 25 GROUP BY lo)
SELECT CAST(floor(x / w) - floor(lo / w) AS INTEGER) AS bin, floor(x / w) * w AS lower, floor(x / w) * w + w AS upper, CAST(count(*) AS BIGINT) AS count
FROM x, w GROUP BY ALL""")
def d8_histogram_aligned(spark, d):
    from ..operators.aggregates import histogram_aligned
    return histogram_aligned(B.load(spark, d, "orders"), "o_totalprice", 25)


@register("d9_box_sketch", """
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(min(l_extendedprice), 6) AS minimum, round(max(l_extendedprice), 6) AS maximum,
       true AS q1_near, true AS median_near, true AS q3_near
FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY l_returnflag""")
def d9_box_sketch(spark, d):
    """Quartiles by sketches, and whether each one's rank among all values is within the stated error."""
    from ..operators.aggregates import box_sketch
    error = 0.01
    rows = B.load(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("v")).where("v IS NOT NULL")
    boxes = materialize(box_sketch(rows, "l_returnflag", "v", error), "box-sketches")
    places = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    ranks = [F.sum((F.col("v") < F.col(q)).cast("long")).alias(f"{q}_below") for q in places] + [F.sum((F.col("v") <= F.col(q)).cast("long")).alias(f"{q}_upto") for q in places]
    ranked = rows.join(boxes, "l_returnflag").groupBy("l_returnflag", "n", "minimum", "maximum").agg(*ranks)
    near = [((F.col(f"{q}_below") <= (p + error) * F.col("n")) & (F.col(f"{q}_upto") >= (p - error) * F.col("n"))).alias(f"{q}_near") for q, p in places.items()]
    return round_doubles(ranked.select("l_returnflag", "n", "minimum", "maximum", *near))


@register("d10_shares", """
SELECT coalesce(c_mktsegment, 'Non renseigné') AS value, CAST(count(*) AS BIGINT) AS count,
       round(count(*) / (SELECT count(*) FROM customer), 6) AS share
FROM customer GROUP BY 1""")
def d10_shares(spark, d):
    from ..operators.aggregates import shares
    return round_doubles(shares(B.load(spark, d, "customer"), "c_mktsegment"))


@register("d11_scatter", f"""
SELECT mileage, price, model, year, region FROM ({CLEAN_CARS_SQL}) c WHERE mileage IS NOT NULL AND price IS NOT NULL""")
def d11_scatter(spark, d):
    from ..operators.aggregates import scatter_extract
    return scatter_extract(_clean_cars(spark, d), "mileage", "price", ("model", "year", "region"))


@register("d11_scatter_thinned", """
WITH p AS (SELECT l_orderkey * 8 + l_linenumber AS k, l_quantity, l_extendedprice, l_returnflag FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
b AS (SELECT min(CAST(l_quantity AS DOUBLE)) AS xl, max(CAST(l_quantity AS DOUBLE)) AS xh, min(CAST(l_extendedprice AS DOUBLE)) AS yl, max(CAST(l_extendedprice AS DOUBLE)) AS yh FROM p),
c AS (SELECT p.*, CAST(least(floor((CAST(l_quantity AS DOUBLE) - xl) / ((xh - xl) / 40.0)), 39) AS INTEGER) AS x_cell,
             CAST(least(floor((CAST(l_extendedprice AS DOUBLE) - yl) / ((yh - yl) / 40.0)), 39) AS INTEGER) AS y_cell FROM p, b)
SELECT x_cell, y_cell, round(arg_min(l_quantity, row(md5(CAST(k AS VARCHAR)), l_quantity, l_extendedprice, l_returnflag)), 6) AS l_quantity, round(arg_min(l_extendedprice, row(md5(CAST(k AS VARCHAR)), l_quantity, l_extendedprice, l_returnflag)), 6) AS l_extendedprice,
       arg_min(l_returnflag, row(md5(CAST(k AS VARCHAR)), l_quantity, l_extendedprice, l_returnflag)) AS l_returnflag, CAST(count(*) AS BIGINT) AS count
FROM c GROUP BY x_cell, y_cell""")
def d11_scatter_thinned(spark, d):
    from ..operators.aggregates import scatter_thinned
    points = B.load(spark, d, "lineitem").withColumn("k", F.expr("l_orderkey * 8 + l_linenumber"))
    return round_doubles(scatter_thinned(points, "l_quantity", "l_extendedprice", "k", 40, ("l_returnflag",)))


@register("f1_ordered_limit", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 20""")
def f1_ordered_limit(spark, d):
    from ..operators.aggregates import ordered_limit
    from ..operators.filters import equality_filter
    o = equality_filter(B.load(spark, d, "orders"), {"o_orderstatus": "O"})
    return ordered_limit(o.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 20)


@register("f2_sorted_counts", """
SELECT value, count, CAST(row_number() OVER (ORDER BY count DESC, value) AS INTEGER) AS position FROM
  (SELECT coalesce(o_orderpriority, 'Non renseigné') AS value, CAST(count(*) AS BIGINT) AS count FROM orders GROUP BY 1) c""")
def f2_sorted_counts(spark, d):
    from ..operators.aggregates import value_counts
    from ..operators.ordering import with_position
    counts = value_counts(B.load(spark, d, "orders"), "o_orderpriority")
    out = with_position(counts, [F.desc("count"), F.asc("value")], "position")
    return out.withColumn("position", F.col("position").cast("int"))


# --- E / D12 / D13: order-dependent operators -----------------------------------

DOC_URLS = """
SELECT CAST(doc_id AS BIGINT) AS ordinal, doc_id, lang, text,
  CASE WHEN doc_id % 3 = 0 THEN CAST(NULL AS STRING)
       WHEN doc_id % 2 = 0 THEN 'HTTP://' || upper(source) || '/' || md5(text)
       WHEN doc_id % 5 = 0 THEN ' http://' || source || '/' || md5(text) || ' '
       ELSE 'http://' || source || '/' || md5(text) END AS url
FROM {documents}
"""
DOC_URLS_SQL = B.oracle(DOC_URLS, documents="documents")


@register("e1_dedup_clean", O.dedup_first_sql(DOC_URLS_SQL, [("lang", "str"), ("text", "str")], ["doc_id"]))
def e1_dedup_clean(spark, d):
    from ..operators.dedup import dedup_clean
    df = B.bind(spark, d, DOC_URLS, documents="documents")
    return dedup_clean(df, ("lang", "text")).select("doc_id")


@register("e2_dedup_raw", f"""
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY
   CASE WHEN coalesce(url <> '', false) THEN 'url' || chr(31) || {O.strip('url')}
        ELSE 'fields' || chr(31) || coalesce(lang, chr(0)) || chr(30) || coalesce(text, chr(0)) END
   ORDER BY ordinal) AS rn FROM ({DOC_URLS_SQL}) d) x WHERE rn = 1""")
def e2_dedup_raw(spark, d):
    from ..operators.dedup import dedup_raw
    df = B.bind(spark, d, DOC_URLS, documents="documents")
    return dedup_raw(df, ("lang", "text")).select("doc_id")


CONV_PAGES = """
SELECT conv_id AS crawl_id, CAST(turn + 1 AS BIGINT) AS page,
       md5(CASE WHEN (conv_id + turn) % 5 IN (1, 4) THEN 'the same cards in crawl ' || CAST(conv_id AS STRING) ELSE text END) AS signature,
       length(text) < 60 AS empty, length(text) % 7 <> 0 AS has_next, false AS failed
FROM {conversations}
"""
CONV_PAGES_SQL = B.oracle(CONV_PAGES, conversations="conversations")


@register("e3_repeated_pages", f"""
SELECT crawl_id, page, coalesce(page > min(page) OVER (PARTITION BY crawl_id, signature), false) AS repeated
FROM ({CONV_PAGES_SQL}) c""")
def e3_repeated_pages(spark, d):
    from ..operators.crawl import repeated_pages
    pages = B.bind(spark, d, CONV_PAGES, conversations="conversations")
    return repeated_pages(pages).select("crawl_id", "page", "repeated")


def _crawl_sql(mode: str) -> str:
    bad = "failed OR empty" + (" OR repeated" if mode == "cars" else "")
    stop_extra = (", min(CASE WHEN NOT coalesce(has_next, false) THEN page END) AS last_page"
                  if mode == "books" else "")
    keep_extra = (" AND (s.last_page IS NULL OR r.page <= s.last_page)" if mode == "books" else "")
    return f"""
WITH cap AS ({CONV_PAGES_SQL}),
bounds AS (SELECT crawl_id, max(page) AS hi FROM cap GROUP BY crawl_id),
grid AS (SELECT crawl_id, CAST(unnest(range(1, hi + 1)) AS BIGINT) AS page FROM bounds),
pg AS (SELECT g.crawl_id, g.page, c.signature, coalesce(c.empty, false) AS empty, c.has_next,
              c.page IS NULL AS failed FROM grid g LEFT JOIN cap c ON g.crawl_id = c.crawl_id AND g.page = c.page),
rep AS (SELECT *, CASE WHEN NOT failed AND NOT empty THEN coalesce(page > min(CASE WHEN NOT failed AND NOT empty
                 THEN page END) OVER (PARTITION BY crawl_id, signature), false) ELSE false END AS repeated FROM pg),
stop AS (SELECT crawl_id, min(CASE WHEN {bad} THEN page END) AS first_bad{stop_extra} FROM rep GROUP BY crawl_id)
SELECT r.crawl_id, r.page FROM rep r JOIN stop s ON r.crawl_id = s.crawl_id
WHERE (s.first_bad IS NULL OR r.page < s.first_bad){keep_extra}"""


def _crawl(spark, d, mode, strict=False):
    from ..operators.crawl import crawl_prefix, repeated_pages
    pages = B.bind(spark, d, CONV_PAGES, conversations="conversations")
    if mode == "cars":
        pages = repeated_pages(pages, usable=~F.col("failed") & ~F.col("empty"))
    return crawl_prefix(pages, mode=mode, strict=strict).select("crawl_id", "page")


@register("e4_crawl_strict", f"""
SELECT crawl_id, page FROM (SELECT *, coalesce(page > min(CASE WHEN NOT empty THEN page END)
  OVER (PARTITION BY crawl_id, signature), false) AS repeated FROM ({CONV_PAGES_SQL}) c) r WHERE NOT empty AND NOT repeated""")
def e4_crawl_strict(spark, d):
    return _crawl(spark, d, "cars", strict=True)


@register("e4_crawl_prefix", _crawl_sql("cars"))
def e4_crawl_prefix(spark, d):
    return _crawl(spark, d, "cars")


@register("e4_crawl_prefix_books", _crawl_sql("books"))
def e4_crawl_prefix_books(spark, d):
    return _crawl(spark, d, "books")


LINE_CARDS = """
SELECT l_orderkey AS crawl_id, CAST(FLOOR(l_linenumber / 3) AS INT) + 1 AS page, l_linenumber,
       'part-' || CAST(l_partkey AS STRING) AS card_url
FROM {lineitem}
"""
LINE_CARDS_SQL = B.oracle(LINE_CARDS, lineitem="lineitem")


@register("d12_cards_per_page", f"""
SELECT crawl_id, page, l_linenumber, card_url,
       CAST(count(*) OVER (PARTITION BY crawl_id, page) AS BIGINT) AS products_on_page
FROM ({LINE_CARDS_SQL}) c""")
def d12_cards_per_page(spark, d):
    from ..operators.crawl import cards_per_page
    return cards_per_page(B.bind(spark, d, LINE_CARDS, lineitem="lineitem"))


@register("d13_page_signature", f"""
SELECT crawl_id, page, CAST(count(*) AS BIGINT) AS n_cards,
       sha256(concat_ws(':', CAST(count(*) AS VARCHAR), CAST(sum({O.md5_word("coalesce(card_url, '')", 1)}) AS VARCHAR),
                        CAST(sum({O.md5_word("coalesce(card_url, '')", 17)}) AS VARCHAR))) AS signature
FROM ({LINE_CARDS_SQL}) c GROUP BY crawl_id, page""")
def d13_page_signature(spark, d):
    from ..operators.crawl import page_signatures
    return page_signatures(B.bind(spark, d, LINE_CARDS, lineitem="lineitem"), F.col("card_url"))


# --- C1 / C2 / U1: enrichment and upsert -------------------------------------------

LINE_LISTING = """
SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS ordinal,
  'Item ' || CAST(l_partkey AS STRING) AS title,
  '£' || CAST(CAST(FLOOR(l_extendedprice) AS BIGINT) AS STRING) AS price,
  CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'In stock' END AS availability,
  CAST(l_linenumber % 5 + 1 AS BIGINT) AS rating,
  CASE WHEN l_linenumber = 7 THEN CAST(NULL AS STRING)
       ELSE 'https://shop.example/item/' || CAST(l_partkey AS STRING) END AS url,
  CAST(NULL AS STRING) AS description, CAST(NULL AS STRING) AS product_type, CAST(NULL AS STRING) AS tax,
  CAST(NULL AS STRING) AS review_count, CAST(NULL AS STRING) AS category
FROM {lineitem}
"""
PART_DETAIL = """
SELECT CAST(p_partkey AS BIGINT) AS ordinal, 'https://shop.example/item/' || CAST(p_partkey AS STRING) AS url,
  p_name AS title, '£' || CAST(CAST(FLOOR(p_retailprice) AS BIGINT) AS STRING) || '.00' AS price,
  CASE WHEN p_size % 4 = 0 THEN '' ELSE 'En stock' END AS availability,
  CASE WHEN p_size % 6 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(p_size % 6 AS BIGINT) END AS rating,
  'About ' || p_name AS description, p_type AS product_type, '£0.00' AS tax,
  CAST(p_size AS STRING) AS review_count, p_brand AS category,
  'In stock (' || CAST(p_size AS STRING) || ' available)' AS info_availability,
  p_size % 5 <> 0 AS ready
FROM {part}
"""


@register("c1_enrich_listing", f"""
WITH c AS ({B.oracle(LINE_LISTING, lineitem='lineitem')}),
d AS (SELECT * FROM ({B.oracle(PART_DETAIL, part='part')}) x WHERE ready)
SELECT c.ordinal,
  CASE WHEN d.url IS NULL THEN c.title ELSE coalesce(NULLIF(d.title, ''), c.title) END AS title,
  CASE WHEN d.url IS NULL THEN c.price ELSE coalesce(NULLIF(d.price, ''), c.price) END AS price,
  CASE WHEN d.url IS NULL THEN c.availability
       WHEN coalesce(coalesce(NULLIF(d.availability, ''), c.availability), '') = ''
         THEN coalesce(d.info_availability, coalesce(NULLIF(d.availability, ''), c.availability))
       ELSE coalesce(NULLIF(d.availability, ''), c.availability) END AS availability,
  coalesce(d.rating, c.rating) AS rating, c.url, d.description, d.product_type, d.tax, d.review_count, d.category
FROM c LEFT JOIN d ON c.url = d.url AND c.url <> ''""")
def c1_enrich_listing(spark, d):
    from ..operators.enrich import enrich_listing
    cards = B.bind(spark, d, LINE_LISTING, lineitem="lineitem")
    details = B.bind(spark, d, PART_DETAIL, part="part")
    return enrich_listing(cards, details)


ORDERS_BASE = """
SELECT CAST(o_orderkey AS BIGINT) AS ordinal, 'order-' || CAST(o_orderkey AS STRING) AS source_key,
       o_totalprice AS price
FROM {orders}
"""
ORDERS_BATCH = """
SELECT CAST(o_orderkey AS BIGINT) AS ordinal,
       'order-' || CAST(o_orderkey * CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 3 END AS STRING) AS source_key,
       o_totalprice + 1 AS price
FROM {orders}
"""


@register("c2_upsert_match", f"""
SELECT coalesce(t.source_key, b.source_key) AS source_key, t.source_key IS NOT NULL AS in_target,
       b.source_key IS NOT NULL AS in_batch
FROM (SELECT DISTINCT source_key FROM ({B.oracle(ORDERS_BASE, orders='orders')}) x) t
FULL OUTER JOIN (SELECT DISTINCT source_key FROM ({B.oracle(ORDERS_BATCH, orders='orders')}) y) b ON t.source_key = b.source_key""")
def c2_upsert_match(spark, d):
    from ..operators.upsert import match_keys
    base = B.bind(spark, d, ORDERS_BASE, orders="orders")
    batch = B.bind(spark, d, ORDERS_BATCH, orders="orders")
    return match_keys(base, batch, unique=True)


RAW_BOOKS_V2 = """
SELECT ordinal, title, '£' || CAST(abs(products_on_page) AS STRING) || ',99' AS price, availability,
       products_on_page, rating, review_count, description, product_type, tax, category, url, source_page
FROM ({raw}) r
"""
T0, T1 = BATCH_TIME, BATCH_TIME + _dt.timedelta(days=1)


def _book_norm_sql(raw: str) -> str:
    t = O.storage_text
    n = O.storage_number
    url = t("url")
    cat = "(CASE WHEN category IS NOT NULL AND category <> '' THEN category ELSE product_type END)"
    key = (f"CASE WHEN {url} IS NOT NULL THEN {O.canonical_key(chr(39) + 'book-url' + chr(39), url)} "
           f"ELSE {O.canonical_key(chr(39) + 'book' + chr(39), t('title'), cat)} END")
    rows = (f"SELECT ordinal, {key} AS source_key, {t('title')} AS title, {n('price')} AS price, "
            f"{t('availability')} AS availability, CAST(products_on_page AS BIGINT) AS products_on_page, "
            f"{n('rating')} AS rating, TRY_CAST(trunc({n('review_count')}) AS BIGINT) AS review_count, "
            f"{t('description')} AS description, {t('product_type')} AS product_type, {t('category')} AS category, "
            f"{n('tax')} AS tax, {url} AS url, CAST(source_page AS BIGINT) AS source_page, "
            f"CAST(NULL AS VARCHAR) AS scraped_at FROM ({raw}) r")
    valid = ("title IS NOT NULL AND length(trim(title)) > 0 AND coalesce(price >= 0, true) "
             "AND coalesce(products_on_page >= 0, true) AND coalesce(rating >= 0 AND rating <= 5, true) "
             "AND coalesce(review_count >= 0, true) AND coalesce(tax >= 0, true) AND coalesce(source_page >= 1, true)")
    return f"SELECT * FROM ({rows}) v WHERE {valid}"


BOOK_STORED = ("title", "price", "availability", "products_on_page", "rating", "review_count", "description",
               "product_type", "category", "tax", "url", "source_page", "scraped_at")


def _merge_sql(target: str, norm: str, ts: _dt.datetime, stored: tuple[str, ...] = BOOK_STORED) -> str:
    tsl = f"TIMESTAMP '{ts.isoformat(sep=' ')}'"
    fields = ", ".join(f"CASE WHEN b.source_key IS NOT NULL THEN b.{c} ELSE t.{c} END AS {c}" for c in stored)
    return f"""
SELECT CAST(CASE WHEN t.source_key IS NOT NULL THEN t.id
            ELSE (SELECT coalesce(max(id), 0) FROM ({target}) m)
                 + row_number() OVER (PARTITION BY t.source_key IS NULL ORDER BY b.first_ord, b.source_key) END AS BIGINT) AS id,
       coalesce(t.source_key, b.source_key) AS source_key, {fields},
       CASE WHEN t.source_key IS NOT NULL THEN t.created_at ELSE {tsl} END AS created_at,
       CASE WHEN b.source_key IS NOT NULL THEN {tsl} ELSE t.updated_at END AS updated_at
FROM ({target}) t FULL OUTER JOIN
  (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY ordinal DESC) AS rn,
          min(ordinal) OVER (PARTITION BY source_key) AS first_ord FROM ({norm}) n) z WHERE rn = 1) b
  ON t.source_key = b.source_key"""


_EMPTY_BOOKS = ("SELECT CAST(NULL AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS source_key, "
                + ", ".join(f"CAST(NULL AS {'DOUBLE' if c in ('price', 'rating', 'tax') else 'BIGINT' if c in ('products_on_page', 'review_count', 'source_page') else 'VARCHAR'}) AS {c}" for c in BOOK_STORED)
                + ", CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at WHERE false")
_U1_B1 = f"SELECT * FROM ({RAW_BOOKS_SQL}) r WHERE products_on_page <= 25"
_U1_B2 = RAW_BOOKS_V2.format(raw=RAW_BOOKS_SQL)
_U1_SQL = _merge_sql(_merge_sql(_EMPTY_BOOKS, _book_norm_sql(_U1_B1), T0), _book_norm_sql(_U1_B2), T1)


@register("u1_upsert", "SELECT id, source_key, title, price, availability, products_on_page, rating, review_count, "
          "description, product_type, category, tax, url, source_page, scraped_at, "
          f"created_at, updated_at FROM ({_U1_SQL}) u")
def u1_upsert(spark, d):
    """Two crawls upserted into a stored table: the first saw the small ads
    and keeps to the rules, the second sees all of them with new prices.  A
    batch that breaks a rule is refused in between and leaves no trace."""
    from ..operators.constraints import split_valid
    from ..operators.upsert import StoredTable, normalize_records
    from ..session import scratch_path
    raw = B.raw_books(spark, d)
    table = StoredTable(spark, scratch_path(spark, "u1"), "books")
    valid, _ = split_valid(normalize_records(raw.where(F.col("products_on_page") <= 25), "books"), "books")
    table.upsert(valid, T0, strict=True)
    try:
        table.upsert(raw.withColumn("title", F.lit(" ")), T1, strict=True)
        raise AssertionError("a batch without titles was stored")
    except ValueError:
        pass
    table.upsert(spark.sql(RAW_BOOKS_V2, raw=raw), T1, strict=False)
    return table.read()


CAR_STORED = ("brand", "model", "year", "price", "mileage", "transmission", "region", "url", "source_page", "scraped_at")
_EMPTY_CARS = ("SELECT CAST(NULL AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS source_key, "
               + ", ".join(f"CAST(NULL AS {'DOUBLE' if c in ('price', 'mileage') else 'BIGINT' if c in ('year', 'source_page') else 'VARCHAR'}) AS {c}" for c in CAR_STORED)
               + ", CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at WHERE false")


def _car_norm_sql(raw: str) -> str:
    t, n = O.storage_text, O.storage_number
    rows = (f"SELECT r.ordinal, k.source_key, {t('brand')} AS brand, {t('model')} AS model, TRY_CAST(trunc({n('year')}) AS BIGINT) AS year, "
            f"{n('price')} AS price, {n('mileage')} AS mileage, {t('transmission')} AS transmission, {t('region')} AS region, {t('url')} AS url, "
            f"CAST(source_page AS BIGINT) AS source_page, CAST(NULL AS VARCHAR) AS scraped_at "
            f"FROM ({raw}) r JOIN ({_car_key_sql(raw)}) k ON r.ordinal = k.ordinal")
    valid = ("brand IS NOT NULL AND length(trim(brand)) > 0 AND coalesce(year BETWEEN 1886 AND 2100, true) AND coalesce(price >= 0, true) "
             "AND coalesce(mileage >= 0, true) AND coalesce(source_page >= 1, true)")
    return f"SELECT * FROM ({rows}) v WHERE {valid}"


_CARS_B1 = f"SELECT * FROM ({RAW_CARS_SQL}) r WHERE ordinal % 3 <> 0"
RAW_CARS_V2 = "SELECT * FROM (SELECT ordinal, brand, model, year, mileage AS price, mileage, transmission, region, url, source_page FROM ({raw}) r) x"


@register("u1_upsert_cars", "SELECT id, source_key, " + ", ".join(CAR_STORED) + ", created_at, updated_at FROM ("
          + _merge_sql(_merge_sql(_EMPTY_CARS, _car_norm_sql(_CARS_B1), T0, CAR_STORED),
                       _car_norm_sql(RAW_CARS_V2.format(raw=RAW_CARS_SQL)), T1, CAR_STORED) + ") u")
def u1_upsert_cars(spark, d):
    from ..operators.upsert import StoredTable
    from ..session import scratch_path
    raw = B.raw_cars(spark, d)
    table = StoredTable(spark, scratch_path(spark, "u1-cars"), "cars")
    table.upsert(raw.where("ordinal % 3 <> 0"), T0, strict=False)
    table.upsert(spark.sql(RAW_CARS_V2, raw=raw), T1, strict=False)
    return table.read()


@register("u1_unique_ids", f"""
SELECT CAST(count(DISTINCT source_key) AS BIGINT) AS n_rows, CAST(count(DISTINCT source_key) AS BIGINT) AS n_ids,
       CAST(count(DISTINCT source_key) AS BIGINT) AS max_id FROM ({_book_norm_sql(RAW_BOOKS_SQL)}) n""")
def u1_unique_ids(spark, d):
    """Ids stay unique and dense when many rows of a batch share their place in the order."""
    from ..operators.upsert import StoredTable
    from ..session import scratch_path
    table = StoredTable(spark, scratch_path(spark, "u1-ids"), "books")
    table.upsert(B.raw_books(spark, d).withColumn("ordinal", F.col("ordinal") % 7), T0, strict=False)
    return table.read().agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.max("id").alias("max_id"))


# --- A: sources and sinks ----------------------------------------------------------

@register("a1_list_files", None)
def a1_list_files(spark, d):
    from ..sources.files import list_files
    return list_files(spark, d).select("label", "suffix", "length")


@register("a2_depot_summary", None)
def a2_depot_summary(spark, d):
    from ..sources.files import depot_summary, list_files
    return depot_summary(list_files(spark, d)).select("files", "total_bytes", "total_size_label")


ORDER_NOTES = """
SELECT o_orderkey, o_orderpriority, lower(o_orderpriority) || ' été' AS note FROM {orders}
"""


@register("a3_csv_fallback", f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, nullif(text, '') AS text, NULL AS o_orderkey, NULL AS o_orderpriority, NULL AS note, 'UTF-8' AS _encoding FROM documents
UNION ALL
SELECT NULL, NULL, CAST(o_orderkey AS BIGINT), o_orderpriority, note, 'ISO-8859-1' FROM ({B.oracle(ORDER_NOTES, orders='orders')}) o""")
def a3_csv_fallback(spark, d):
    """Whole texts with quoted line feeds in UTF-8 (read file by file) beside
    plain rows in another encoding with another header (split by the reader)."""
    from ..session import scratch_path
    from ..sources.files import read_csv
    from ..sources.sinks import write_csv
    root = scratch_path(spark, "a3")
    write_csv(B.load(spark, d, "documents").select("doc_id", "text"), f"{root}/texts")
    write_csv(B.bind(spark, d, ORDER_NOTES, orders="orders"), f"{root}/orders", encoding="ISO-8859-1")
    out = read_csv(spark, [f"{root}/texts", f"{root}/orders"])
    return out.select("doc_id", "text", "o_orderkey", "o_orderpriority", "note", "_encoding")


@register("a4_json_auto", """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice,
       CAST(NULL AS BIGINT) AS s_suppkey, CAST(NULL AS VARCHAR) AS s_name FROM part
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, CAST(s_suppkey AS BIGINT), s_name FROM supplier""")
def a4_json_auto(spark, d):
    """One depot of JSON lines (part) and array documents (supplier, up to 500
    in a document) that begin with long blanks."""
    from ..session import scratch_path
    from ..sources.files import read_json
    root = scratch_path(spark, "a4")
    B.load(spark, d, "part").write.json(f"{root}/all")
    arrays = (B.load(spark, d, "supplier").groupBy(F.expr("s_suppkey div 500").alias("document"))
              .agg(F.to_json(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("value")))
    arrays = arrays.select(F.concat(F.lit("\n" + " " * 400), F.replace("value", F.lit("},"), F.lit("},\n"))).alias("value"), "document")
    arrays.repartition("document").write.partitionBy("document").text(f"{root}/arrays")
    out = read_json(spark, [f"{root}/all", f"{root}/arrays/*"])
    return out.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", "s_suppkey", "s_name")


@register("a5_read_parquet", "SELECT * FROM region")
def a5_read_parquet(spark, d):
    from ..sources.files import read_parquet
    return read_parquet(spark, f"{d}/region.parquet")


@register("a6_read_dispatch", """
SELECT 'csv' AS format, CAST(o_orderkey AS BIGINT) AS key, o_orderpriority AS name FROM orders
UNION ALL SELECT 'json', CAST(c_custkey AS BIGINT), c_name FROM customer
UNION ALL SELECT 'parquet', CAST(p_partkey AS BIGINT), p_name FROM part""")
def a6_read_dispatch(spark, d):
    """A folder of each format, chosen by its suffix."""
    from ..session import scratch_path
    from ..sources.files import read_tabular
    from ..sources.sinks import write_csv
    root = scratch_path(spark, "a6")
    write_csv(B.load(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("name")), f"{root}/orders.CSV")
    B.load(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).write.json(f"{root}/customer.json")
    frames = {"csv": read_tabular(spark, f"{root}/orders.CSV"), "json": read_tabular(spark, f"{root}/customer.json"),
              "parquet": read_tabular(spark, f"{d}/part.parquet").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"))}
    from functools import reduce
    return reduce(DataFrame.unionByName, [f.select(F.lit(n).alias("format"), F.col("key").cast("bigint").alias("key"), "name") for n, f in frames.items()])


@register("a7_newest_export", None)
def a7_newest_export(spark, d):
    import time
    from ..session import scratch_path
    from ..sources.files import export_candidates
    from ..sources.sinks import write_csv
    root = scratch_path(spark, "a7")
    clean = _clean_books(spark, d)
    write_csv(clean, f"{root}/books_cleaned_old.csv")
    time.sleep(1.1)
    write_csv(clean.where(F.col("price").isNotNull()), f"{root}/cleaned_books_new.csv")
    write_csv(_clean_cars(spark, d), f"{root}/cars_cleaned.csv")
    return export_candidates(spark, root, "books").select("export")


@register("a8_source_preference", "SELECT *, 'nation' AS origin FROM nation")
def a8_source_preference(spark, d):
    from ..sources.files import prefer_nonempty
    empty = B.load(spark, d, "part").where(F.col("p_size") > 1000)
    frame, origin = prefer_nonempty([("part", empty), ("nation", B.load(spark, d, "nation"))])
    return frame.withColumn("origin", F.lit(origin))


@register("a8_load_cleaned", f"SELECT ordinal, title, price, url, 'books_cleaned_new.csv' AS origin FROM ({CLEAN_BOOKS_SQL}) c")
def a8_load_cleaned(spark, d):
    """The stored table is empty, so the newest cleaned export is read."""
    from ..operators.upsert import empty_table
    from ..session import scratch_path
    from ..sources.files import load_cleaned
    from ..sources.sinks import write_csv
    root = scratch_path(spark, "a8")
    write_csv(_clean_books(spark, d), f"{root}/books_cleaned_new.csv")
    write_csv(_clean_cars(spark, d), f"{root}/cars_cleaned.csv")
    frame, origin = load_cleaned(spark, empty_table(spark, "books"), root, "books")
    return frame.select(F.col("ordinal").cast("bigint").alias("ordinal"), F.col("title").cast("string").alias("title"),
                        F.col("price").cast("double").alias("price"), "url", F.lit(origin).alias("origin"))


@register("a9_inline_records", "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey, "
          "CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS BIGINT) AS ordinal FROM nation")
def a9_inline_records(spark, d):
    """Records (mappings) of the smallest table; data sets are no case for inline records."""
    from ..sources.inline import as_frame
    return as_frame(spark, [r.asDict() for r in B.load(spark, d, "nation").orderBy("n_nationkey").collect()])


def _bundle_sql(counts: str, column: str, dataset: str) -> str:
    return f"SELECT '{dataset}' AS dataset, coalesce(CAST({column} AS VARCHAR), 'Non renseigné') AS value, CAST(count(*) AS BIGINT) AS count FROM ({counts}) x GROUP BY ALL"


_DASH_BOOKS_SQL = f"""SELECT * FROM (SELECT *, coalesce(category, product_type) AS analysis_category FROM ({CLEAN_BOOKS_SQL}) c) x
WHERE analysis_category IS NOT NULL AND availability IS NOT NULL AND rating IS NOT NULL"""
_DASH_CARS_SQL = f"SELECT * FROM ({CLEAN_CARS_SQL}) c WHERE brand IS NOT NULL AND year IS NOT NULL AND region IS NOT NULL AND transmission IS NOT NULL"


def _counts_of(bundle, names: dict):
    from functools import reduce
    parts = [bundle[n].select(F.lit(n).alias("dataset"), F.col(c).cast("string").alias("value"), F.col("count").cast("bigint").alias("count"))
             for n, c in names.items()]
    return reduce(DataFrame.unionByName, parts)


@register("dash_books", " UNION ALL ".join([_bundle_sql(_DASH_BOOKS_SQL, "analysis_category", "category_counts"),
                                            _bundle_sql(_DASH_BOOKS_SQL, "availability", "availability_shares")]))
def dash_books(spark, d):
    from .dashboard import books_bundle
    return _counts_of(books_bundle(_clean_books(spark, d)), {"category_counts": "value", "availability_shares": "value"})


@register("dash_cars", " UNION ALL ".join([_bundle_sql(_DASH_CARS_SQL, "year", "year_counts"),
                                           _bundle_sql(_DASH_CARS_SQL, "transmission", "transmission_shares")]))
def dash_cars(spark, d):
    from .dashboard import cars_bundle
    return _counts_of(cars_bundle(_clean_cars(spark, d)), {"year_counts": "key", "transmission_shares": "value"})


@register("a10_table_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def a10_table_scan(spark, d):
    from ..sources.files import read_table
    allowed = {"lineitem": f"{d}/lineitem.parquet", "orders": f"{d}/orders.parquet"}
    return read_table(spark, allowed, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


@register("a11_csv_sink", CLEAN_BOOKS_SQL)
def a11_csv_sink(spark, d):
    from .. import schema as S
    from ..session import scratch_path
    from ..sources.files import read_csv
    from ..sources.sinks import write_csv
    clean = _clean_books(spark, d)
    path = write_csv(clean, scratch_path(spark, "a11"))
    schema = T.StructType([T.StructField("ordinal", T.LongType())]
                          + [T.StructField(c, S.CLEAN_BOOK_TYPES[c]) for c in S.BOOK_COLUMNS])
    return read_csv(spark, path, schema).drop("_encoding")


@register("a12_page_urls", """
SELECT conv_id, CAST(page AS BIGINT) AS page, 'https://listing.example/c/' || CAST(conv_id AS VARCHAR) || '?page=' || CAST(page AS VARCHAR) AS page_url
FROM (SELECT conv_id, unnest(range(1, max(turn) + 2)) AS page FROM conversations GROUP BY conv_id) t""")
def a12_page_urls(spark, d):
    from ..sources.files import page_urls
    crawls = B.load(spark, d, "conversations").groupBy("conv_id").agg((F.max("turn") + 1).alias("max_pages"))
    return page_urls(crawls, "https://listing.example/c/{crawl}?page={page}".replace("{crawl}", "%CRAWL%"),
                     1, "max_pages") \
        .withColumn("page_url", F.expr("replace(page_url, '%CRAWL%', CAST(conv_id AS STRING))")) \
        .select("conv_id", "page", "page_url")


# --- I: record extraction from captured pages ---------------------------------------

def _unescape_sql(x: str) -> str:
    return ("replace(replace(replace(replace(replace(" + x + ", '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
            "'&#39;', chr(39)), '&amp;', '&')")


def _text_sql(x: str) -> str:
    return "NULLIF(trim(regexp_replace(" + _unescape_sql(x) + ", '\\s+', ' ', 'g')), '')"


@register("i1_extract_text", f"""
SELECT page_id, url, true AS ready, {_text_sql("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title,
       {_text_sql("regexp_extract(html, '<article>.*?<h1>(.*?)</h1>', 1)")} AS h1
FROM pages""")
def i1_extract_text(spark, d):
    from ..operators.markup import element_text
    html = F.col("html")
    return B.load(spark, d, "pages").select("page_id", "url", F.lit(True).alias("ready"), element_text(html, "title").alias("title"),
                                            element_text(html, "h1", inside="article").alias("h1"))


NAV_SITEMAP = {
    "_id": "nav-links",
    "selectors": [
        {"id": "nav_link", "type": "SelectorLink", "multiple": True, "parentSelectors": ["_root"],
         "selector": "nav ul li a"},
        {"id": "linked_title", "type": "SelectorText", "multiple": False, "parentSelectors": ["nav_link"],
         "selector": "title"},
        {"id": "page_heading", "type": "SelectorText", "multiple": False, "parentSelectors": ["_root"],
         "selector": "article h1"},
        {"id": "banner", "type": "SelectorText", "multiple": False, "parentSelectors": ["_root"],
         "selector": "div.ad"},
    ],
}


@register("i2_sitemap_extract", None)
def i2_sitemap_extract(spark, d):
    from ..operators.extract import sitemap_extract
    return sitemap_extract(B.load(spark, d, "pages"), NAV_SITEMAP)


_NAV_RE = """'<li><a href="([^"]*)">([^<]*)</a>'"""
_HOST_SQL = "regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"


def _nav_cards_sql() -> str:
    return f"""
WITH l AS (SELECT page_id, url, regexp_extract_all(html, {_NAV_RE}, 1) AS hrefs,
                  regexp_extract_all(html, {_NAV_RE}, 2) AS texts FROM pages),
e AS (SELECT *, unnest(generate_series(1, len(hrefs))) AS i FROM l)
SELECT page_id, url, true AS ready, CAST(i AS INTEGER) AS position, CAST(len(hrefs) AS INTEGER) AS n_records,
       {_HOST_SQL} || hrefs[i] AS card_url, {_text_sql('texts[i]')} AS title FROM e"""


@register("i3_listing_cards", _nav_cards_sql())
def i3_listing_cards(spark, d):
    from ..operators.markup import absolute, link_items, plain_text
    cards = link_items(B.load(spark, d, "pages")).select("page_id", "url", F.size("items").alias("n_records"), F.posexplode("items").alias("at", "item"))
    return cards.select("page_id", "url", F.lit(True).alias("ready"), (F.col("at") + 1).alias("position"), "n_records",
                        absolute(F.col("item.href"), F.col("url")).alias("card_url"), plain_text(F.col("item.text")).alias("title"))


@register("i4_vehicle_cards", None)
def i4_vehicle_cards(spark, d):
    from ..functions.text import vehicle_heading
    from ..operators.extract import TEXT_OR_ATTR, Field, Spec, extract
    spec = Spec(records=("div.ad",), fields=(Field("heading", ("_parent_",), TEXT_OR_ATTR, "title"),))
    cards = extract(B.load(spark, d, "pages"), spec)
    return vehicle_heading(cards, "heading")


@register("i5_info_table", None)
def i5_info_table(spark, d):
    from ..operators.extract import book_details
    return book_details(B.load(spark, d, "pages"))


_LAST_NAV = "list_filter(regexp_extract_all(html, " + _NAV_RE + ", 2), lambda t: trim(t) <> '')[-1]"


@register("i6_breadcrumb", f"""
SELECT page_id, url, true AS ready, {_text_sql(_LAST_NAV)} AS category
FROM pages""")
def i6_breadcrumb(spark, d):
    from ..operators.markup import last_text, link_items
    return link_items(B.load(spark, d, "pages")).select("page_id", "url", F.lit(True).alias("ready"), last_text(F.col("items")).alias("category"))


@register("i7_description", None)
def i7_description(spark, d):
    from ..operators.extract import ATTR, Field, Spec, extract
    spec = Spec(fields=(Field("first_p", ("article p", "p")),
                        Field("meta", ("meta[name='description']",), ATTR, "content"),
                        Field("h1", ("article h1", "h1"))))
    out = extract(B.load(spark, d, "pages"), spec)
    return out.select("page_id", "url", F.coalesce(F.nullif("first_p", F.lit("")), "meta", "h1").alias("description"))


@register("i8_absolute_links", f"""
WITH l AS (SELECT page_id, url, regexp_extract_all(html, {_NAV_RE}, 1) AS hrefs FROM pages)
SELECT page_id, {_HOST_SQL} || unnest(hrefs) AS link FROM l""")
def i8_absolute_links(spark, d):
    from ..operators.markup import absolute, link_items
    out = link_items(B.load(spark, d, "pages")).select("page_id", "url", F.explode("items.href").alias("href"))
    return out.select("page_id", absolute(F.col("href"), F.col("url")).alias("link"))


# --- U4 / D14 / U5: runs and incremental ingestion ----------------------------------

CRAWL_PAGES = """
SELECT CAST(FLOOR(page_id / 50) AS BIGINT) AS crawl_id, CAST(page_id % 50 + 1 AS INT) AS page, url, html
FROM {pages}
"""


def _driver_card_spec(source: str):
    from ..operators.extract import ATTR, TEXT_OR_ATTR, Field, Spec
    name = "title" if source == "books" else "heading"
    return Spec(records=("nav ul li",), ready=("body",),
                fields=(Field("card_url", ("a",), ATTR, "href", absolute=True),
                        Field(name, ("a",), TEXT_OR_ATTR, "title")))


def _run(spark, d, source):
    from ..session import scratch_path
    from .runs import run_source
    root = scratch_path(spark, f"run-{source}")
    pages = B.bind(spark, d, CRAWL_PAGES, pages="pages")
    report, _ = run_source(
        spark, source, pages, max_pages=50 if source == "books" else 100,
        table_root=f"{root}/table", export_dir=f"{root}/export",
        detail_pages=B.load(spark, d, "pages") if source == "books" else None,
        card_spec=_driver_card_spec(source), next_selectors=("footer",),
        batch_time=BATCH_TIME, max_year=MAX_YEAR)
    return report, root


@register("u4_run_books", None)
def u4_run_books(spark, d):
    from ..operators.upsert import StoredTable
    _, root = _run(spark, d, "books")
    return StoredTable(spark, f"{root}/table", "books").read()


@register("u4_run_cars", None)
def u4_run_cars(spark, d):
    from ..operators.upsert import StoredTable
    _, root = _run(spark, d, "cars")
    return StoredTable(spark, f"{root}/table", "cars").read()


@register("d14_run_report", None)
def d14_run_report(spark, d):
    report, _ = _run(spark, d, "books")
    return report.select("source", "row_count", "persisted_rows")


def _stream_sql() -> str:
    """U5 as one batch query: each drop cleaned (U2) on its own, then merged
    into the table in arrival order (what three stream triggers must give)."""
    page = "coalesce(source_page, 0)"
    conds = [f"{page} < 30", f"{page} >= 30 AND {page} < 60", f"{page} >= 60"]
    ctes = [f"c{i} AS ({O.clean_books(f'SELECT * FROM ({RAW_BOOKS_SQL}) r WHERE {c}')})"
            for i, c in enumerate(conds)]
    target = _EMPTY_BOOKS
    for i in range(len(conds)):
        ctes.append(f"s{i} AS ({_merge_sql(target, _book_norm_sql(f'SELECT * FROM c{i}'), BATCH_TIME + _dt.timedelta(hours=i))})")
        target = f"SELECT * FROM s{i}"
    cols = ("id, source_key, title, price, availability, products_on_page, rating, review_count, description, "
            "product_type, category, tax, url, source_page, scraped_at, created_at, updated_at")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {cols} FROM s{len(conds) - 1}"


@register("u5_stream_ingest", _stream_sql())
def u5_stream_ingest(spark, d):
    """Raw book ads arrive as three drops (by listing page range); each drop
    is ingested by the stream; the result is the stored table."""
    from .. import schema as S
    from ..operators.upsert import StoredTable
    from ..session import scratch_path
    from ..streaming.ingest import ingest
    root = scratch_path(spark, "u5")
    raw = B.raw_books(spark, d)
    page = F.coalesce(F.col("source_page"), F.lit(0))
    drops = [page < 30, (page >= 30) & (page < 60), page >= 60]  # together: every row once
    for i, cond in enumerate(drops):
        # files land in the drop folder over time; each call ingests what is new
        raw.where(cond).write.mode("append").parquet(f"{root}/drop")
        ingest(spark, "books", f"{root}/drop", S.RAW_BOOK_SCHEMA, f"{root}/work", f"{root}/table",
               batch_time=BATCH_TIME + _dt.timedelta(hours=i))
    return StoredTable(spark, f"{root}/table", "books").read()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
