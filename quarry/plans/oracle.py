"""DuckDB SQL for the correctness oracle.

Each generator returns a DuckDB expression with the same meaning as the Spark
Column function of the same name.  Long chains are written as layered
sub-selects (``layers``) so that an expression is never repeated inside
itself.  These strings are only used to cross-check results.
"""

from __future__ import annotations

from .. import schema as S


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def tokens_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def layers(base: str, steps: list[list[tuple[str, str]]], alias: str = "t") -> str:
    """Wrap ``base`` in one ``SELECT *, expr AS name`` per step.  A name that
    already exists is replaced (``REPLACE``) rather than duplicated."""
    sql = base
    for i, step in enumerate(steps):
        sql = f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in step)} FROM ({sql}) {alias}{i}"
    return sql


def replace_layer(base: str, cols: dict[str, str], alias: str = "r") -> str:
    body = ", ".join(f"{e} AS {n}" for n, e in cols.items())
    return f"SELECT * REPLACE ({body}) FROM ({base}) {alias}"


# --- text ---------------------------------------------------------------------

def collapse_ws(x: str) -> str:
    return f"trim(regexp_replace(CAST({x} AS VARCHAR), '\\s+', ' ', 'g'))"


def clean_text(x: str) -> str:
    t = collapse_ws(x)
    return f"(CASE WHEN lower({t}) IN {tokens_list(S.MISSING_TOKENS)} THEN NULL ELSE {t} END)"


def storage_text(x: str) -> str:
    return f"NULLIF({collapse_ws(x)}, '')"


def fold_text(x: str) -> str:
    return f"replace(strip_accents(lower({x})), 'ß', 'ss')"


def fold_ascii(x: str) -> str:
    return f"lower(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g'))"


def availability(x: str, folded: str) -> str:
    out = " OR ".join(f"contains({folded}, {q(m)})" for m in S.OUT_OF_STOCK_MARKERS)
    inn = " OR ".join(f"contains({folded}, {q(m)})" for m in S.IN_STOCK_MARKERS)
    words = f"NULLIF(replace(trim(regexp_replace({folded}, '\\s+', ' ', 'g')), ' ', '_'), '')"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {out} THEN 'out_of_stock' "
            f"WHEN {inn} THEN 'in_stock' ELSE {words} END)")


def rating_from_text(folded: str) -> str:
    parts = " ".join(f"WHEN regexp_matches({folded}, '\\b{w}\\b') THEN {v}"
                     for w, v in S.RATING_WORDS.items())
    digit = f"regexp_extract({folded}, '\\b([1-5])\\b', 1)"
    return (f"(CASE WHEN {folded} IS NULL THEN NULL {parts} "
            f"WHEN {digit} <> '' THEN CAST({digit} AS BIGINT) ELSE NULL END)")


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)'), "
            f"lambda p: upper(p[1]) || lower(p[2:])), '')")


def capitalize(x: str) -> str:
    return f"(upper({x}[1]) || lower({x}[2:]))"


def brand(x: str, folded_cleaned: str) -> str:
    cleaned = collapse_ws(x)
    cases = " ".join(f"WHEN {folded_cleaned} = {q(k)} THEN {q(v)}" for k, v in S.BRAND_CASE.items())
    return f"(CASE WHEN {x} IS NULL THEN NULL {cases} ELSE {title_case(cleaned)} END)"


def transmission(x: str, folded: str) -> str:
    manual = " OR ".join(f"contains({folded}, {q(m)})" for m in S.MANUAL_MARKERS)
    return (f"(CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN contains({folded}, {q(S.AUTOMATIC_MARKER)}) THEN {q(S.AUTOMATIC_LABEL)} "
            f"WHEN {manual} THEN {q(S.MANUAL_LABEL)} "
            f"WHEN {folded} IN {tokens_list(S.TRANSMISSION_MISSING)} THEN NULL "
            f"ELSE {capitalize(collapse_ws(x))} END)")


# --- numbers ------------------------------------------------------------------

PLAIN_FLOAT = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$"
SCI_FLOAT = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"


def finite(x: str) -> str:
    return f"(CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE {x} END)"


def to_double(txt: str, grammar: str = PLAIN_FLOAT) -> str:
    return finite(f"(CASE WHEN regexp_matches({txt}, {q(grammar)}) THEN TRY_CAST({txt} AS DOUBLE) END)")


def parse_decimal_layers(x: str, out: str, p: str = "_pd") -> list[list[tuple[str, str]]]:
    """H3 as layers; the result column is ``out``."""
    n = f"{p}_n"
    return [
        [(n, f"regexp_replace(regexp_extract(CAST({x} AS VARCHAR), '[-+]?[0-9][0-9\\s.,]*', 0), '\\s', '', 'g')")],
        [(f"{p}_t", f"""(CASE WHEN contains({n}, ',') AND contains({n}, '.') THEN
              (CASE WHEN regexp_extract({n}, '([.,])[^.,]*$', 1) = ','
                    THEN replace(replace({n}, '.', ''), ',', '.') ELSE replace({n}, ',', '') END)
            WHEN contains({n}, ',') OR contains({n}, '.') THEN
              (CASE WHEN length(regexp_extract({n}, '[.,]([^.,]*)$', 1)) IN (1, 2)
                    THEN regexp_replace(regexp_extract({n}, '^(.*)[.,][^.,]*$', 1), '[.,]', '', 'g')
                         || '.' || regexp_extract({n}, '[.,]([^.,]*)$', 1)
                    ELSE regexp_replace({n}, '[.,]', '', 'g') END)
            ELSE {n} END)""")],
        [(out, to_double(f"{p}_t"))],
    ]


def parse_integer(x: str) -> str:
    digits = f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9]', '', 'g')"
    sign = f"(CASE WHEN regexp_matches(CAST({x} AS VARCHAR), '^\\s*-') THEN -1 ELSE 1 END)"
    return f"(CASE WHEN {digits} <> '' THEN TRY_CAST({digits} AS BIGINT) * {sign} END)"


def analytics_number(x: str) -> str:
    clean = f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9,.\\-]', '', 'g')"
    txt = (f"(CASE WHEN contains({clean}, ',') AND contains({clean}, '.') "
           f"THEN replace(replace({clean}, '.', ''), ',', '.') "
           f"WHEN contains({clean}, ',') THEN replace({clean}, ',', '.') ELSE {clean} END)")
    return to_double(txt)


def storage_number(x: str) -> str:
    clean = f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9,.\\-]', '', 'g')"
    txt = (f"(CASE WHEN contains({clean}, ',') AND contains({clean}, '.') THEN "
           f"(CASE WHEN regexp_extract({clean}, '([.,])[^.,]*$', 1) = ',' "
           f"THEN replace(replace({clean}, '.', ''), ',', '.') ELSE replace({clean}, ',', '') END) "
           f"WHEN contains({clean}, ',') THEN replace({clean}, ',', '.') ELSE {clean} END)")
    return to_double(txt)


def coerce_numeric(x: str) -> str:
    t = f"regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"
    return to_double(t, SCI_FLOAT)


def null_outside(x: str, low=None, high=None) -> str:
    conds = []
    if low is not None:
        conds.append(f"{x} >= {low}")
    if high is not None:
        conds.append(f"{x} <= {high}")
    return f"(CASE WHEN {x} IS NULL OR ({' AND '.join(conds)}) THEN {x} END)"


def canonical_key(*parts: str) -> str:
    folded = [f"coalesce({fold_ascii(storage_text(p))}, '')" for p in parts]
    return f"sha256(concat_ws('|', {', '.join(folded)}))"


def iso_timestamp(x: str) -> str:
    return (f"(CASE WHEN microsecond({x}) % 1000000 = 0 THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') END)")


def md5_word(x: str, start: int) -> str:
    return f"CAST(('0x' || substr(md5({x}), {start}, 15)) AS HUGEINT)"


# --- cleaning plans -------------------------------------------------------------

def clean_books_rows(raw: str) -> str:
    """Row-level U2 over the raw books SELECT ``raw``."""
    text_cols = ("title", "availability", "description", "product_type", "category", "url")
    base = replace_layer(raw, {c: clean_text(c) for c in text_cols}, "cb0")
    base = layers(base, [[("_fold_av", fold_text("availability")), ("_fold_rt", fold_text("rating"))]], "cb1")
    base = layers(base, parse_decimal_layers("price", "_price", "_pp")
                  + parse_decimal_layers("tax", "_tax", "_pt"), "cb2")
    cols = {
        "availability": availability("availability", "_fold_av"),
        "price": null_outside("_price", low=0),
        "tax": null_outside("_tax", low=0),
        "rating": rating_from_text("_fold_rt"),
    }
    for c in ("products_on_page", "review_count", "source_page"):
        src = c if c != "review_count" else parse_integer(c)
        cols[c] = null_outside(src, low=0)
    out = replace_layer(base, cols, "cb3")
    keep = ", ".join(("ordinal",) + S.BOOK_COLUMNS)
    return f"SELECT {keep} FROM ({out}) cb4"


def clean_cars_rows(raw: str, max_year: int) -> str:
    text_cols = ("brand", "model", "transmission", "region", "url")
    base = replace_layer(raw, {c: clean_text(c) for c in text_cols}, "cc0")
    base = layers(base, [[("_fold_br", fold_text(collapse_ws("brand"))),
                          ("_fold_tr", fold_text("transmission"))]], "cc1")
    cols = {
        "brand": brand("brand", "_fold_br"),
        "transmission": transmission("transmission", "_fold_tr"),
        "region": title_case("region"),
        "year": null_outside(parse_integer("year"), S.MIN_CAR_YEAR, max_year),
        "price": null_outside(parse_integer("price"), low=0),
        "mileage": null_outside(parse_integer("mileage"), low=0),
        "source_page": null_outside("source_page", low=1),
    }
    out = replace_layer(base, cols, "cc2")
    keep = ", ".join(("ordinal",) + S.CAR_COLUMNS)
    return f"SELECT {keep} FROM ({out}) cc3"


def py_str(x: str, kind: str) -> str:
    """str(value) for BIGINT / DOUBLE / VARCHAR values."""
    if kind == "double":
        return (f"(CASE WHEN abs({x}) < 1e16 AND {x} = floor({x}) "
                f"THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) || '.0' ELSE CAST({x} AS VARCHAR) END)")
    return f"CAST({x} AS VARCHAR)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def dedup_first_sql(rows: str, fallback: list[tuple[str, str]], cols: list[str]) -> str:
    """E1 over ``rows``: keep-first per key (url casefold, else folded fields)."""
    url_key = f"replace(lower({strip('CAST(url AS VARCHAR)')}), 'ß', 'ss')"
    parts = ", ".join(f"coalesce(replace(lower({strip(py_str(c, k))}), 'ß', 'ss'), '')" for c, k in fallback)
    key = (f"CASE WHEN coalesce({url_key} <> '', false) THEN 'url' || chr(31) || {url_key} "
           f"ELSE 'fallback' || chr(31) || concat_ws(chr(30), {parts}) END")
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {key} ORDER BY ordinal) AS _rn FROM ({rows}) d0) d1 WHERE _rn = 1")


def clean_books(raw: str) -> str:
    rows = clean_books_rows(raw)
    return dedup_first_sql(rows, [("title", "str"), ("price", "double")], ["ordinal", *S.BOOK_COLUMNS])


def clean_cars(raw: str, max_year: int) -> str:
    rows = clean_cars_rows(raw, max_year)
    fb = [("brand", "str"), ("model", "str"), ("year", "int"), ("price", "int"), ("mileage", "int")]
    return dedup_first_sql(rows, fb, ["ordinal", *S.CAR_COLUMNS])
