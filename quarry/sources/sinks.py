"""Sinks (A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame

BOM = "\ufeff"

#: One dialect for writing and reading: doubled quotes inside quotes, blanks kept.
CSV_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", bom: bool = True,
              encoding: str = "UTF-8") -> str:
    """Header row, no index.  The result is a directory of part files
    written in parallel, each a CSV of its own; in UTF-8 each starts with a
    byte order mark, as spreadsheets want it."""
    if bom and encoding.upper().replace("-", "") == "UTF8" and df.columns:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    df.write.mode(mode).options(header="true", encoding=encoding, **CSV_OPTIONS).csv(path)
    return path
