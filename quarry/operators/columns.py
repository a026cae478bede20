"""Schema-level projections (B1-B4).  All are pure ``select`` lists computed
on the driver from the schema; no data moves."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .. import schema as S


def ensure_columns(df: DataFrame, columns: Sequence[str] | Mapping[str, T.DataType]) -> DataFrame:
    """B1: add absent columns as typed NULLs (STRING when no type is given)."""
    present = set(df.columns)
    types = columns if isinstance(columns, Mapping) else {c: T.StringType() for c in columns}
    missing = {c: F.lit(None).cast(t) for c, t in types.items() if c not in present}
    return df.withColumns(missing) if missing else df


_BLANKS = re.compile(" ")


def apply_aliases(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """B2: headers are matched without case or outer blanks, inner blanks
    count as ``_``; aliases become field names.

    When two input headers land on the same field the later column wins.
    """
    matched = {header: _BLANKS.sub("_", header.strip()).casefold() for header in df.columns}
    source = {aliases.get(field, field): header for header, field in matched.items()}
    return df.select([F.col(f"`{header}`").alias(field) for field, header in source.items()])


def canonical_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed column order (missing columns must be ensured first)."""
    return df.select(*[F.col(c) for c in columns])


def display_projection(df: DataFrame, source: str) -> DataFrame:
    """Preferred columns first, other columns after, metadata hidden."""
    rank = {name: place for place, name in enumerate(S.DISPLAY_COLUMNS[source])}
    shown = df.drop(*S.HIDDEN_DISPLAY_COLUMNS)
    return shown.select(sorted(shown.columns, key=lambda name: rank.get(name, len(rank))))
