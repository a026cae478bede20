"""Number parsing dialects as Column expressions (H3-H7, H9).

Three text dialects disagree on inputs such as ``1,234`` and are kept apart:

* ``parse_decimal`` (cleaning): the separator followed by 1-2 digits is the
  decimal point, otherwise separators group thousands.
* ``analytics_number`` (KPIs): with both separators the comma is decimal.
* ``storage_number`` (upsert): the rightmost separator is decimal.

All are JVM-side: regex extraction + ``translate`` + ``try_cast``.  Before the
cast every candidate is checked against the plain float grammar
``[+-]digits[.digits]`` so that Spark's lenient casts (``'1d'``, ``' 1 '``)
never accept what the reference rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

PLAIN_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
SCI_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INF = float("inf")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def finite(col) -> Column:
    """NaN and +-Infinity -> NULL."""
    value = _c(col)
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(_INF)), value)


def _to_double(text: Column, grammar: str = PLAIN_FLOAT) -> Column:
    return _let(text, lambda t: finite(F.when(t.rlike(grammar), t.try_cast("double"))))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body`` (a
    one-element ``transform``): keeps the regexes of the separator rules
    from being re-run for every reference."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_decimal(col) -> Column:
    """H3: localised decimal text -> DOUBLE (cleaning dialect)."""
    match = F.regexp_extract(_c(col).cast("string"),
                             r"(?U)[-+]?[0-9][0-9\s\u00a0\u202f.,]*", 0)

    def rules(number: Column) -> Column:
        has_comma, has_dot = number.contains(","), number.contains(".")
        # both kinds: the rightmost separator is decimal, the other kind goes
        both = F.when(F.regexp_extract(number, r"([.,])[^.,]*$", 1) == ",",
                      F.translate(F.translate(number, ".", ""), ",", ".")) \
                .otherwise(F.translate(number, ",", ""))
        # one kind: 1-2 digits after its last occurrence -> decimal
        # (earlier occurrences dropped), otherwise all are thousands
        one = _let(F.regexp_extract(number, r"[.,]([^.,]*)$", 1), lambda frac: F.when(
            F.length(frac).isin(1, 2),
            F.concat(F.translate(F.regexp_extract(number, r"^(.*)[.,][^.,]*$", 1), ".,", ""), F.lit("."), frac))
            .otherwise(F.translate(number, ".,", "")))
        return F.when(has_comma & has_dot, both).when(has_comma | has_dot, one).otherwise(number)

    return _to_double(_let(F.regexp_replace(match, r"(?U)[\s\u00a0\u202f]", ""), rules))


def parse_integer(col) -> Column:
    """H4 (text input): all digit runs concatenated; negative only when the
    stripped text starts with '-'."""
    text = _c(col).cast("string")
    digits = F.regexp_replace(text, r"[^0-9]+", "")
    sign = F.when(text.rlike(r"(?U)^\s*-"), F.lit(-1)).otherwise(F.lit(1))
    value = digits.try_cast("bigint")
    return F.when(digits != "", value * sign)


def truncate_integer(col) -> Column:
    """H4 (numeric input): finite values truncated toward zero."""
    return finite(_c(col).cast("double")).try_cast("bigint")


def analytics_number(col) -> Column:
    """H5 (text input): keep [0-9,.-]; with both separators drop the dots and
    read the comma as decimal; a lone comma is decimal."""
    def rules(clean: Column) -> Column:
        has_comma, has_dot = clean.contains(","), clean.contains(".")
        return (F.when(has_comma & has_dot, F.translate(F.translate(clean, ".", ""), ",", "."))
                 .when(has_comma, F.translate(clean, ",", "."))
                 .otherwise(clean))
    return _to_double(_let(F.regexp_replace(_c(col).cast("string"), r"[^0-9,.\-]+", ""), rules))


def storage_number(col, integer: bool = False) -> Column:
    """H6 (text input): keep [0-9,.-]; the rightmost separator is decimal."""
    def rules(clean: Column) -> Column:
        has_comma, has_dot = clean.contains(","), clean.contains(".")
        both = F.when(F.regexp_extract(clean, r"([.,])[^.,]*$", 1) == ",",
                      F.translate(F.translate(clean, ".", ""), ",", ".")) \
                .otherwise(F.translate(clean, ",", ""))
        return (F.when(has_comma & has_dot, both)
                 .when(has_comma, F.translate(clean, ",", "."))
                 .otherwise(clean))
    value = _to_double(_let(F.regexp_replace(_c(col).cast("string"), r"[^0-9,.\-]+", ""), rules))
    return value.try_cast("bigint") if integer else value


def coerce_numeric(col) -> Column:
    """H7: strict coercion; malformed or blank text -> NULL, exponent allowed.
    NaN/inf results are treated as missing, like the dashboards do."""
    text = F.regexp_replace(_c(col).cast("string"), r"(?U)^\s+|\s+$", "")
    return _to_double(text, SCI_FLOAT)


def is_missing(col) -> Column:
    """H9: NULL or NaN."""
    value = _c(col)
    return value.isNull() | F.isnan(value)


# --- dtype dispatch ----------------------------------------------------------

def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType) and not isinstance(dtype, T.BooleanType)


def decimal_for(dtype: T.DataType, col) -> Column:
    """H3 on any column type: numbers pass through (finite), text is parsed."""
    if is_numeric_type(dtype):
        return finite(_c(col).cast("double"))
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("double")
    return parse_decimal(col)


def integer_for(dtype: T.DataType, col) -> Column:
    """H4 on any column type."""
    if is_numeric_type(dtype):
        return truncate_integer(col)
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("bigint")
    return parse_integer(col)


def analytics_for(dtype: T.DataType, col) -> Column:
    """H5 on any column type (booleans are not numbers)."""
    if is_numeric_type(dtype):
        return finite(_c(col).cast("double"))
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("double")
    return analytics_number(col)


def storage_for(dtype: T.DataType, col, integer: bool = False) -> Column:
    """H6 on any column type (booleans are not numbers)."""
    if isinstance(dtype, T.BooleanType) or isinstance(dtype, T.NullType):
        return F.lit(None).cast("bigint" if integer else "double")
    if is_numeric_type(dtype):
        value = finite(_c(col).cast("double"))
        return value.try_cast("bigint") if integer else value
    return storage_number(col, integer=integer)
