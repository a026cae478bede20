"""Incremental drop-folder ingestion (U5) with Structured Streaming.

Raw export files dropped into a folder are picked up by a file-source stream
with an explicit schema, cleaned row by row (the stateless part of U2/U3)
and appended to a Parquet staging folder with ``trigger(availableNow=True)``:
every new file is processed exactly once, tracked by the stream checkpoint.
Staged rows carry the time of their micro-batch, which the stream keeps when it
repeats one, as the partition column ``batch``.  The rows of each batch that the
stored table has not merged are then de-duplicated (E1) and upserted (U1).

No ``foreachBatch`` callback is used (it needs a callback server in the
Python process); the staging folder plays its role.  Re-running after a
crash is safe at any point: Spark's reader shows what the sink committed, and
the table lists the batches it merged.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..operators.columns import canonical_projection
from ..operators.dedup import dedup_clean
from ..operators.upsert import StoredTable
from ..plans.clean import clean_books_rows, clean_cars_rows

_FALLBACK = {"books": ("title", "price"), "cars": ("brand", "model", "year", "price", "mileage")}


def stage(spark: SparkSession, source: str, raw_dir: str, schema: T.StructType, staging_dir: str,
          checkpoint_dir: str, fmt: str = "parquet", max_year: int | None = None,
          max_files_per_trigger: int | None = None) -> T.StructType:
    """Stream new raw files through row-level cleaning into ``staging_dir``
    and wait until everything available has been processed; returns the
    schema of the staged rows."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(raw_dir)
    rows = clean_books_rows(raw) if source == "books" else clean_cars_rows(raw, max_year)
    rows = rows.withColumn("batch", F.unix_millis(F.current_timestamp()))
    query = (rows.writeStream.format("parquet").partitionBy("batch")
                 .option("checkpointLocation", checkpoint_dir)
                 .outputMode("append")
                 .trigger(availableNow=True)
                 .start(staging_dir))
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to caller
        raise RuntimeError(str(query.exception()))
    return rows.schema


def ingest(spark: SparkSession, source: str, raw_dir: str, schema: T.StructType, work_dir: str,
           table_root: str, fmt: str = "parquet", batch_time: _dt.datetime | None = None,
           max_year: int | None = None, max_files_per_trigger: int | None = None,
           strict: bool = False) -> int:
    """Ingest the files that arrived and merge every staged batch that the
    table has not merged yet; returns the number of rows merged.

    A crash after staging or before a batch is marked as merged is made good by
    the next call, which merges it again with the same result.  Unattended
    ingestion is lenient: rows breaking an integrity rule are stored apart
    (``StoredTable.rejected``); ``strict=True`` fails the batch instead."""
    work = work_dir.rstrip("/")
    schema = stage(spark, source, raw_dir, schema, f"{work}/staging", f"{work}/checkpoint", fmt, max_year, max_files_per_trigger)
    return merge_staged(spark, source, f"{work}/staging", schema, table_root, batch_time, strict)


def merge_staged(spark: SparkSession, source: str, staging: str, schema: T.StructType, table_root: str,
                 batch_time: _dt.datetime | None = None, strict: bool = False) -> int:
    """Merge the staged batches that the table has not merged, in order; each
    read is pruned to its batch.  The driver holds their numbers alone."""
    table = StoredTable(spark, table_root, source)
    staged = spark.read.schema(schema).parquet(staging)
    waiting = staged.select("batch").distinct().join(table.merged(), "batch", "left_anti")
    merged = 0
    for batch in sorted(r["batch"] for r in waiting.collect()):
        rows = dedup_clean(staged.where(F.col("batch") == batch), _FALLBACK[source])
        at = batch_time or _dt.datetime.fromtimestamp(batch / 1000, _dt.timezone.utc).replace(tzinfo=None)
        merged += table.upsert(canonical_projection(rows, ("ordinal",) + S.COLUMNS[source]), at, strict=strict, batch_id=batch)
    return merged


def batch_equivalent(raw: DataFrame, source: str, max_year: int | None = None) -> DataFrame:
    """The cleaned rows a single batch over the same input produces (used to
    check stream == batch)."""
    rows = clean_books_rows(raw) if source == "books" else clean_cars_rows(raw, max_year)
    return canonical_projection(dedup_clean(rows, _FALLBACK[source]), ("ordinal",) + S.COLUMNS[source])
