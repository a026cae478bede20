"""Column lists, schemas and fixed lookup values of the listing data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES.  These must equal the values of the application whose results
# we reproduce; they are data, not logic.  Keep them in this natural order.
# ---------------------------------------------------------------------------

# Text that means "no value" (compared after whitespace collapse + lower case).
MISSING_TOKENS = (
    "",
    "-",
    "--",
    "n/a",
    "na",
    "n.d.",
    "nd",
    "none",
    "null",
    "non renseigné",
    "non renseigne",
    "indisponible",
)

# Cleaned column order of the two listing kinds.
BOOK_COLUMNS = (
    "title",
    "price",
    "availability",
    "products_on_page",
    "rating",
    "review_count",
    "description",
    "product_type",
    "tax",
    "category",
    "url",
    "source_page",
)
CAR_COLUMNS = (
    "brand",
    "model",
    "year",
    "price",
    "mileage",
    "transmission",
    "region",
    "url",
    "source_page",
)

# Stored (upserted) field order.
BOOK_FIELDS = (
    "source_key",
    "title",
    "price",
    "availability",
    "products_on_page",
    "rating",
    "review_count",
    "description",
    "product_type",
    "category",
    "tax",
    "url",
    "source_page",
    "scraped_at",
)
CAR_FIELDS = (
    "source_key",
    "brand",
    "model",
    "year",
    "price",
    "mileage",
    "transmission",
    "region",
    "url",
    "source_page",
    "scraped_at",
)

# Header aliases accepted on import (after strip, lower case, space -> "_").
BOOK_ALIASES = {
    "titre": "title",
    "name": "title",
    "prix": "price",
    "stock": "availability",
    "in_stock": "availability",
    "product_count": "products_on_page",
    "nombre_produits": "products_on_page",
    "note": "rating",
    "reviews": "review_count",
    "number_of_reviews": "review_count",
    "categorie": "category",
    "type": "product_type",
    "source_url": "url",
    "page": "source_page",
}
CAR_ALIASES = {
    "marque": "brand",
    "make": "brand",
    "modele": "model",
    "annee": "year",
    "prix": "price",
    "kilometrage": "mileage",
    "kilometers": "mileage",
    "gearbox": "transmission",
    "boite": "transmission",
    "region_vente": "region",
    "location": "region",
    "source_url": "url",
    "page": "source_page",
}

# Rating words, tested in this order.
RATING_WORDS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5}

# Availability markers (searched in accent-free lower-case text, in order).
OUT_OF_STOCK_MARKERS = ("out of stock", "rupture", "epuise")
IN_STOCK_MARKERS = ("in stock", "en stock", "available", "disponible")

# Brands written in capitals instead of title case.
BRAND_CASE = {"bmw": "BMW", "byd": "BYD", "gmc": "GMC", "mg": "MG", "mini": "MINI"}

# Transmission markers and values treated as missing.
AUTOMATIC_MARKER = "auto"
MANUAL_MARKERS = ("manual", "manuell")
TRANSMISSION_MISSING = ("n/a", "na", "nd", "non renseigne")
AUTOMATIC_LABEL = "Automatique"
MANUAL_LABEL = "Manuelle"

# Brands of more than one word, recognised before the "first word" rule.
MULTIWORD_BRANDS = (
    "Alfa Romeo",
    "Aston Martin",
    "Great Wall",
    "Land Rover",
    "Mercedes Benz",
    "Mercedes-Benz",
    "Rolls Royce",
    "Rolls-Royce",
    "Ssang Yong",
)

# Label of the missing bucket in counts.
MISSING_LABEL = "Non renseigné"

# Range rules.
MIN_CAR_YEAR = 1886
MAX_STORED_CAR_YEAR = 2100
MAX_RATING = 5

# File depot.
SUPPORTED_SUFFIXES = (".csv", ".json", ".xlsx", ".xls", ".parquet")
CLEANED_PATTERNS = {
    "books": ("books_cleaned*", "cleaned_books*"),
    "cars": ("gaaraas_cleaned*", "cleaned_gaaraas*", "cars_cleaned*", "cleaned_cars*"),
}
HIDDEN_DISPLAY_COLUMNS = ("id", "source_key", "created_at", "updated_at")
DISPLAY_COLUMNS = {
    "books": (
        "title", "price", "availability", "products_on_page", "rating", "review_count",
        "description", "product_type", "category", "tax", "url", "source_page", "scraped_at",
    ),
    "cars": (
        "brand", "model", "year", "price", "mileage", "transmission", "region", "url",
        "source_page", "scraped_at",
    ),
}

# Run limits per source (pages) and export file names.
MAX_PAGES = {"books": 50, "cars": 100}
EXPORT_NAMES = {"books": "books_cleaned.csv", "cars": "gaaraas_cleaned.csv"}

PREVIEW_ROWS = 100
TOP_BRANDS = 20
RATING_BINS = 5
MILEAGE_BINS = 25

# ---------------------------------------------------------------------------
# Spark schemas.
# ---------------------------------------------------------------------------

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


RAW_BOOK_SCHEMA = _struct(
    [("ordinal", _L)]
    + [(c, _L if c in ("products_on_page", "source_page") else _S) for c in BOOK_COLUMNS]
)
RAW_CAR_SCHEMA = _struct(
    [("ordinal", _L)] + [(c, _L if c == "source_page" else _S) for c in CAR_COLUMNS]
)

CLEAN_BOOK_TYPES = {
    "title": _S, "price": _D, "availability": _S, "products_on_page": _L,
    "rating": _L, "review_count": _L, "description": _S, "product_type": _S,
    "tax": _D, "category": _S, "url": _S, "source_page": _L,
}
CLEAN_CAR_TYPES = {
    "brand": _S, "model": _S, "year": _L, "price": _L, "mileage": _L,
    "transmission": _S, "region": _S, "url": _S, "source_page": _L,
}

STORED_BOOK_TYPES = {
    "id": _L, "source_key": _S, "title": _S, "price": _D, "availability": _S,
    "products_on_page": _L, "rating": _D, "review_count": _L, "description": _S,
    "product_type": _S, "category": _S, "tax": _D, "url": _S, "source_page": _L,
    "scraped_at": _S, "created_at": T.TimestampType(), "updated_at": T.TimestampType(),
}
STORED_CAR_TYPES = {
    "id": _L, "source_key": _S, "brand": _S, "model": _S, "year": _L, "price": _D,
    "mileage": _D, "transmission": _S, "region": _S, "url": _S, "source_page": _L,
    "scraped_at": _S, "created_at": T.TimestampType(), "updated_at": T.TimestampType(),
}

STORED_TYPES = {"books": STORED_BOOK_TYPES, "cars": STORED_CAR_TYPES}
FIELDS = {"books": BOOK_FIELDS, "cars": CAR_FIELDS}
ALIASES = {"books": BOOK_ALIASES, "cars": CAR_ALIASES}
COLUMNS = {"books": BOOK_COLUMNS, "cars": CAR_COLUMNS}
CLEAN_TYPES = {"books": CLEAN_BOOK_TYPES, "cars": CLEAN_CAR_TYPES}
