"""Raw listing tables derived from the driver's tables.

The listing engine consumes raw scraped text; the test tables are TPC-H-like.
These bindings turn whole driver tables into raw listing records (book ads
from ``part``, car ads from ``customer``, captured pages from ``pages`` ...),
building every text value from integers so that Spark and the SQL oracle see
identical bytes.  The SELECTs use only syntax both engines share and take
their input tables as ``{name}`` placeholders: Spark binds DataFrames
(``spark.sql(text, part=df)``), the oracle binds view names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Book ads: eight price styles, availability labels, rating words and
# classes, URLs with case variants and repeats, out-of-range counters.
RAW_BOOKS = """
WITH b AS (
  SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM {part}
), c AS (
  SELECT *, CAST(FLOOR(cents / 100) AS BIGINT) AS units, cents % 100 AS frac FROM b
), d AS (
  SELECT *, CAST(units AS STRING) AS u, lpad(CAST(frac AS STRING), 2, '0') AS f2,
         CAST(CAST(FLOOR(units / 1000) AS BIGINT) AS STRING) AS k,
         lpad(CAST(units % 1000 AS STRING), 3, '0') AS r3
  FROM c
)
SELECT
  CAST(p_partkey AS BIGINT) AS ordinal,
  CASE p_partkey % 13 WHEN 0 THEN 'n/a'
                      WHEN 1 THEN '  ' || upper(p_name) || chr(9)
                      ELSE p_name END AS title,
  CASE p_partkey % 8
    WHEN 0 THEN '£' || u || '.' || f2
    WHEN 1 THEN u || ',' || f2 || ' €'
    WHEN 2 THEN k || ',' || r3 || '.' || f2
    WHEN 3 THEN k || '.' || r3 || ',' || f2
    WHEN 4 THEN k || ' ' || r3 || ' CFA'
    WHEN 5 THEN 'n/a'
    WHEN 6 THEN ''
    ELSE CAST(NULL AS STRING) END AS price,
  CASE WHEN p_partkey % 17 = 0 THEN CAST(NULL AS STRING)
       ELSE CASE p_size % 5
              WHEN 0 THEN 'In stock (' || CAST(p_size AS STRING) || ' available)'
              WHEN 1 THEN 'En stock (' || CAST(p_size AS STRING) || ')'
              WHEN 2 THEN 'ÉPUISÉ'
              WHEN 3 THEN 'Rupture de stock'
              ELSE 'Sur  commande' END END AS availability,
  CASE WHEN p_partkey % 19 = 0 THEN CAST(-1 AS BIGINT) ELSE CAST(p_size AS BIGINT) END AS products_on_page,
  CASE p_size % 7
    WHEN 0 THEN 'Three'
    WHEN 1 THEN 'star-rating Four'
    WHEN 2 THEN '5'
    WHEN 3 THEN 'five of one'
    WHEN 4 THEN '4.5'
    WHEN 5 THEN '10'
    ELSE CAST(NULL AS STRING) END AS rating,
  CASE WHEN p_partkey % 9 = 0 THEN 'aucun'
       ELSE CAST(p_size * 3 AS STRING) || ' avis' END AS review_count,
  CASE WHEN p_partkey % 4 = 0 THEN 'N/A'
       ELSE 'A ' || lower(p_type) || chr(10) || ' part  named ' || p_name END AS description,
  NULLIF(p_type, 'PROMO') AS product_type,
  CASE WHEN p_size % 10 = 0 THEN '£-' || CAST(p_size AS STRING) || '.00'
       ELSE '£' || CAST(p_size AS STRING) || '.' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0') END AS tax,
  CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN CAST(NULL AS STRING) ELSE p_brand END AS category,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(NULL AS STRING)
       WHEN p_partkey % 2 = 0 THEN 'HTTPS://Shop.Example/Item/' || CAST(p_partkey % 1700 AS STRING)
       ELSE 'https://shop.example/item/' || CAST(p_partkey % 1700 AS STRING) END AS url,
  CASE WHEN p_partkey % 23 = 0 THEN CAST(-1 AS BIGINT)
       ELSE CAST(FLOOR(p_partkey / 20) AS BIGINT) + 1 END AS source_page
FROM d
"""

# Car ads: brand spellings, year text (some out of range), CFA prices with
# negative balances, mileage text, gearbox words, regions, URLs with repeats.
RAW_CARS = """
SELECT
  CAST(c_custkey AS BIGINT) AS ordinal,
  CASE c_custkey % 7 WHEN 0 THEN 'bmw' WHEN 1 THEN 'mercedes-benz' WHEN 2 THEN '  land  rover '
                     WHEN 3 THEN 'TOYOTA' WHEN 4 THEN 'Mg' WHEN 5 THEN 'n/a' ELSE 'peugeot' END AS brand,
  CASE WHEN c_custkey % 6 = 0 THEN CAST(NULL AS STRING)
       ELSE 'Model ' || lower(c_mktsegment) END AS model,
  CASE WHEN c_custkey % 29 = 0 THEN '1885'
       ELSE CAST(1980 + c_nationkey * 2 AS STRING) END AS year,
  CAST(CAST(round(c_acctbal) AS BIGINT) AS STRING) || ' 000 CFA' AS price,
  CAST(c_custkey * 37 % 300 AS STRING) || ' 000 km' AS mileage,
  CASE c_custkey % 6 WHEN 0 THEN 'boite auto' WHEN 1 THEN 'manuelle' WHEN 2 THEN 'Manuel'
                     WHEN 3 THEN 'N/A' WHEN 4 THEN 'AUTOMATIC' ELSE CAST(NULL AS STRING) END AS transmission,
  CASE WHEN c_custkey % 9 = 0 THEN CAST(NULL AS STRING)
       ELSE lower(c_mktsegment) || '-' || CAST(c_nationkey AS STRING) END AS region,
  CASE WHEN c_custkey % 4 = 0 THEN CAST(NULL AS STRING)
       ELSE 'https://cars.example/v/' || CAST(c_custkey % 1300 AS STRING) END AS url,
  CASE WHEN c_custkey % 31 = 0 THEN CAST(0 AS BIGINT)
       ELSE CAST(FLOOR(c_custkey / 25) AS BIGINT) + 1 END AS source_page
FROM {customer}
"""


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str, sql: str, **tables: str) -> DataFrame:
    """Run a binding SELECT on Spark; ``tables`` maps placeholder -> table."""
    frames = {ph: load(spark, sf_dir, t) for ph, t in tables.items()}
    return spark.sql(sql, **frames)


def raw_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, RAW_BOOKS, part="part")


def raw_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, RAW_CARS, customer="customer")


def oracle(sql: str, **tables: str) -> str:
    """The same binding for the SQL oracle (view names)."""
    return sql.format(**{ph: t for ph, t in tables.items()})
