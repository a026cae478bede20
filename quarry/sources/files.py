"""File sources of the raw-export depot.

File *listings* use the ``binaryFile`` source with the ``content`` column
pruned, so only file-system metadata is read.  Format detection that needs
bytes (CSV encoding and headers, JSON array vs lines) is done by Spark jobs
over the files themselves, never by loading a file on the driver.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.fmt import date_label, file_size
from ..session import materialize
from .inline import empty_frame
from .sinks import BOM, CSV_OPTIONS

#: The reader's column for what it cannot parse; of a mixed folder it holds the other kind's lines.
CORRUPT = "_corrupt_record"

LISTING_SCHEMA = "path string, label string, suffix string, length bigint, modificationTime timestamp"


def _root_uri_pattern(root: str) -> str:
    root = root.rstrip("/")
    if "://" not in root and not root.startswith("file:"):
        return r"^(file:)?" + re.escape(root) + "/"
    return "^" + re.escape(root) + "/"


def list_files(spark: SparkSession, root: str, suffixes: Sequence[str] = S.SUPPORTED_SUFFIXES,
               glob: str | None = None) -> DataFrame:
    """A1: files under ``root`` (recursive) whose suffix is supported
    (case-insensitive), sorted by path; a missing root gives no rows.
    ``label`` is the path relative to ``root``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(root)
    except Exception as exc:  # noqa: BLE001 - missing directory -> empty listing
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return empty_frame(spark, LISTING_SCHEMA)
        raise
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    out = files.select(
        F.col("path"),
        F.regexp_replace("path", _root_uri_pattern(root), "").alias("label"),
        suffix.alias("suffix"),
        F.col("length"),
        F.col("modificationTime"),
    )
    return out.where(F.col("suffix").isin(*[s.lower() for s in suffixes])).orderBy("path")


def depot_summary(files: DataFrame) -> DataFrame:
    """A2: number of files, total bytes, latest modification (+ labels)."""
    agg = files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("total_bytes"),
                    F.max("modificationTime").alias("latest_update"))
    return agg.select("files", "total_bytes", "latest_update",
                      file_size(F.coalesce("total_bytes", F.lit(0))).alias("total_size_label"),
                      date_label("latest_update").alias("latest_update_label"))


def _paths(spark: SparkSession, paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _lines(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """(file, at, value) for every line; ``at`` grows along each file."""
    return spark.read.options(**options).text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), F.col("value"))


def _typed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text columns as bigint, double or boolean where every value parses as such (one aggregate)."""
    kinds = ("bigint", "double", "boolean")
    if not names:
        return df
    tests = [F.struct(F.count(F.col(f"`{n}`")).alias("n"), *[F.count(F.col(f"`{n}`").try_cast(k)).alias(k) for k in kinds]).alias(n)
             for n in names]
    found = df.agg(*tests).first()
    kind = {n: next((k for k in kinds if found[n]["n"] and found[n][k] == found[n]["n"]), "string") for n in names}
    return df.select(*[F.col(f"`{c}`").cast(kind[c]).alias(c) if c in kind else F.col(f"`{c}`") for c in df.columns])


def read_csv(spark: SparkSession, paths, schema: T.StructType | str | None = None) -> DataFrame:
    """A3: CSV with header, each file by its own header, with an encoding
    fallback per file.

    A file is read as UTF-8 (a leading byte order mark is dropped) unless one
    of its lines is not valid UTF-8, in which case it is read as ISO-8859-1,
    which accepts every byte.  Quoted values may hold quotes (doubled),
    separators and line feeds.  Files may differ in the order and number of
    their columns: a column that a file lacks is NULL there.  Files without a
    line give no rows; without any header the result has no columns but
    ``_encoding`` (or those of ``schema``).

    Files are split and read by many tasks, except those where a quoted value
    may hold a line feed, which shows as a line with an odd number of quotes:
    these are read as a whole, one task each.  File facts (header, encoding,
    odd quotes) come from one pass over the lines and stay a distributed table,
    joined by file where files differ; the driver sees the distinct headers,
    and the names of the files with odd quotes where both kinds are mixed.
    """
    paths = _paths(spark, paths)
    facts = None
    if paths:
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        facts = materialize(_lines(spark, paths, encoding="UTF-8").groupBy("file").agg(
            F.max(~F.is_valid_utf8("value")).alias("latin"), F.max(quotes % 2 == 1).alias("whole"), F.min_by("value", "at").alias("header")), "csv-files")
        variants = [(r["header"], r["latin"], r["whole"]) for r in facts.select("header", "latin", "whole").distinct().collect()]
    if not paths or not variants:
        empty = empty_frame(spark, schema) if schema is not None else spark.range(0).select()
        return empty.withColumn("_encoding", F.lit(None).cast("string"))
    wholes = [r["file"] for r in facts.where("whole").select("file").collect()] if len({v[2] for v in variants}) > 1 else []
    frames = []
    for latin, whole in sorted({v[1:] for v in variants}):
        encoding = "ISO-8859-1" if latin else "UTF-8"
        headers = sorted({v[0] for v in variants if v[1:] == (latin, whole)})
        names = {h: _header_names(spark, h) for h in headers}
        width = max(map(len, names.values()))
        generic = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
        rows = spark.read.schema(generic).options(header="true", encoding=encoding, multiLine=str(whole).lower(), **CSV_OPTIONS).csv(paths)
        if wholes:
            # A filter by file name alone: files that fail it are not opened.
            among = F.col("_metadata.file_path").isin(wholes)
            rows = rows.where(among if whole else ~among)
        rows = rows.select("*", F.col("_metadata.file_path").alias("_file"))
        if len(variants) > 1:
            mine = facts.where((F.col("latin") == F.lit(latin)) & (F.col("whole") == F.lit(whole)))
            rows = rows.join(mine.select(F.col("file").alias("_file"), "header"), "_file")
        else:
            rows = rows.withColumn("header", F.lit(headers[0]))
        columns = dict.fromkeys(n for h in headers for n in names[h])
        picked = []
        for name in columns:
            value = F.lit(None).cast("string")
            for h in headers:
                if name in names[h]:
                    here = F.col(f"_c{len(names[h]) - 1 - names[h][::-1].index(name)}")
                    value = here if len(headers) == 1 else F.when(F.col("header") == F.lit(h), here).otherwise(value)
            picked.append(value.alias(name))
        frames.append(rows.select(*picked, F.lit(encoding).alias("_encoding")))
    out = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
    if schema is None:
        return _typed(out, [c for c in out.columns if c != "_encoding"])
    fields = (schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)).fields
    return out.select(*[(F.col(f"`{f.name}`") if f.name in out.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
                        for f in fields], "_encoding")


def _header_names(spark: SparkSession, line: str) -> list[str]:
    """Column names of a header line, parsed by the reader's own rules."""
    parsed = spark.range(1).select(F.from_csv(F.lit(line.lstrip(BOM) + ","), ", ".join(f"_c{i} string" for i in range(line.count(",") + 2)),
                                              CSV_OPTIONS).alias("h")).select("h.*").first()
    names = [v for v in parsed]
    while names and names[-1] is None:
        names.pop()
    return [n if n is not None else f"_c{i}" for i, n in enumerate(names)]


def read_json(spark: SparkSession, paths, schema: T.StructType | str | None = None) -> DataFrame:
    """A4: a JSON array document, else JSON lines, decided for every file by
    its first non-blank character, wherever that is (``multiLine`` on JSON
    lines would silently keep only the first object, and the line reader turns
    an array into corrupt records).

    The test is a distributed pass over the lines; its result stays a table, a
    row for each file.  Where both kinds are mixed, each kind's reader goes over
    all files and keeps the rows of its own by a join on the file: the document
    reader stops after the first value of a file of lines, and the line reader
    splits whatever it reads.  Columns are those of either kind; files
    without any value give no rows.
    """
    paths = _paths(spark, paths)
    facts = None
    if paths:
        solid = _lines(spark, paths).withColumn("value", F.regexp_replace("value", "^[\ufeff\\s]+", "")).where("value <> ''")
        facts = materialize(solid.groupBy("file").agg(F.min_by(F.col("value").startswith("["), "at").alias("array")), "json-files")
        kinds = facts.agg(F.min("array").alias("least"), F.max("array").alias("most")).first()
    if not paths or kinds["least"] is None:
        return empty_frame(spark, schema or "value string")
    frames = []
    for array in sorted({kinds["least"], kinds["most"]}):
        reader = spark.read.option("multiLine", str(array).lower())
        rows = (reader.schema(schema) if schema is not None else reader).json(paths)
        if kinds["least"] != kinds["most"]:
            mine = facts.where(F.col("array") == F.lit(array)).select(F.col("file").alias("_file"))
            rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != CORRUPT], F.col("_metadata.file_path").alias("_file"))
            rows = rows.join(mine, "_file", "left_semi").drop("_file")
        frames.append(rows)
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def read_parquet(spark: SparkSession, paths) -> DataFrame:
    """A5."""
    return spark.read.parquet(*_paths(spark, paths))


def read_tabular(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Dispatch on the (case-insensitive) suffix; unknown -> ValueError.

    Spreadsheets have no Spark source: export them to CSV or Parquet first.
    """
    suffix = ("." + path.rstrip("/").rsplit(".", 1)[-1].lower()) if "." in path.rsplit("/", 1)[-1] else ""
    if suffix == ".csv":
        return read_csv(spark, path, schema).drop("_encoding")
    if suffix == ".json":
        return read_json(spark, path, schema)
    if suffix == ".parquet":
        return read_parquet(spark, path)
    if suffix in (".xlsx", ".xls"):
        raise NotImplementedError("spreadsheets: export to CSV or Parquet first")
    raise ValueError(f"unsupported format: {suffix or path}")


def _top_level(label_col):
    return F.regexp_extract(label_col, r"^([^/]+)", 1)


def export_candidates(spark: SparkSession, root: str, source: str) -> DataFrame:
    """Exports named like the source's cleaned-file patterns, newest
    first (distinct paths; ties by path).  A Spark-written export is a
    directory; it is represented by its newest data file."""
    files = list_files(spark, root)
    name = _top_level(F.col("label"))
    cond = None
    for pattern in S.CLEANED_PATTERNS[source]:
        c = name.rlike(fnmatch.translate(pattern))
        cond = c if cond is None else (cond | c)
    matched = files.where(cond).select(name.alias("export"), "path", "modificationTime")
    per_export = matched.groupBy("export").agg(F.max("modificationTime").alias("modificationTime"),
                                                F.min("path").alias("path"))
    return per_export.orderBy(F.desc("modificationTime"), F.asc("export"))


def newest_export(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The newest cleaned export (zero or one row)."""
    return export_candidates(spark, root, source).limit(1)


def prefer_nonempty(candidates: Sequence[tuple[str, DataFrame]]) -> tuple[DataFrame | None, str]:
    """The first non-empty candidate and its origin label (one cheap
    ``limit 1`` probe per candidate); ``(None, 'none')`` when all are empty."""
    for label, frame in candidates:
        if frame is not None and not frame.isEmpty():
            return frame, label
    return None, "none"


def load_cleaned(spark: SparkSession, table: DataFrame, depot_root: str, source: str) -> tuple[DataFrame, str]:
    """The stored table if non-empty, else the newest cleaned export,
    else an empty frame; returns (frame, origin)."""
    frame, origin = prefer_nonempty([("table", table)])
    if frame is not None:
        return frame, origin
    newest = newest_export(spark, depot_root, source).select("export").first()
    if newest is not None:
        path = f"{depot_root.rstrip('/')}/{newest['export']}"
        return read_tabular(spark, path), newest["export"]
    return table.limit(0), "none"


def read_table(spark: SparkSession, tables: Mapping[str, str], name: str) -> DataFrame:
    """A10: scan an allowed table; names outside the allow-list are refused."""
    if name not in tables:
        raise ValueError("table not allowed")
    return spark.read.parquet(tables[name])


def footer_count(spark: SparkSession, path: str, name: str = "row_count") -> DataFrame:
    """D1 on a Parquet table: rows counted from the files' footers.

    The count is pushed into the source (no row group is opened), which
    Spark's newer reader does; a session of its own holds that setting, so the
    caller's plans stay as they are."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path).agg(F.count(F.lit(1)).alias(name))


def page_urls(crawls: DataFrame, template: str, first: str | int = 1, last: str | int = "max_pages",
              page: str = "page", url: str = "page_url") -> DataFrame:
    """One row per page number in [first, last] per crawl row, with the
    page URL from a ``{page}`` template (``page-[1-50]`` style ranges)."""
    lo = F.lit(first) if isinstance(first, int) else F.col(first)
    hi = F.lit(last) if isinstance(last, int) else F.col(last)
    pages = crawls.withColumn(page, F.explode(F.sequence(lo.cast("bigint"), hi.cast("bigint"))))
    head, _, tail = template.partition("{page}")
    return pages.withColumn(url, F.concat(F.lit(head), F.col(page).cast("string"), F.lit(tail)))
