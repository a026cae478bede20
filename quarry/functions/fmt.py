"""Display formatting and timestamp text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# FIXED VALUES: display conventions.
EMPTY_KPI = "—"
BOOK_CURRENCY = "£"
CAR_CURRENCY = "FCFA"
KM_UNIT = "km"
SIZE_UNITS = ("o", "Kio", "Mio")
DATE_LABEL_FORMAT = "dd/MM/yyyy · HH:mm"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col, currency: str = BOOK_CURRENCY, decimals: int = 2) -> Column:
    """H20: '1,234.56 £' (books) or '1,234 FCFA' (cars); NULL -> '—'."""
    return F.coalesce(F.concat(F.format_number(_c(col), decimals), F.lit(" " + currency)),
                      F.lit(EMPTY_KPI))


def kilometres(col) -> Column:
    """H20: '12,345 km'."""
    return money(col, KM_UNIT, 0)


def one_decimal(col) -> Column:
    """Reviews average with one decimal and no grouping ('1234.6'), NULL -> '—'."""
    return F.coalesce(F.replace(F.format_number(_c(col), 1), F.lit(",")), F.lit(EMPTY_KPI))


def file_size(col) -> Column:
    """Bytes -> 'n o' below 1024, 'x.y Kio' below 1024², else 'x.y Mio'."""
    size = _c(col)
    return (F.when(size < 1024, F.concat(size.cast("string"), F.lit(" " + SIZE_UNITS[0])))
             .when(size < 1024 * 1024, F.concat(F.format_number(size / 1024.0, 1), F.lit(" " + SIZE_UNITS[1])))
             .otherwise(F.concat(F.format_number(size / (1024.0 * 1024.0), 1), F.lit(" " + SIZE_UNITS[2]))))


def iso_timestamp(col) -> Column:
    """ISO-8601 text; microseconds only when non-zero."""
    ts = _c(col)
    return F.when(F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def date_label(col) -> Column:
    """H23: 'dd/MM/yyyy · HH:mm'."""
    return F.date_format(_c(col), DATE_LABEL_FORMAT)
