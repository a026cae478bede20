"""Idempotent upsert by stable content key (U1, C2) and the stored table.

Merge semantics:

* every batch row is normalised (aliases, storage text/number rules,
  ISO timestamps, source_key) and checked against the integrity rules; any
  violation aborts before anything is written;
* inside a batch the *last* row of a key wins (``max_by`` aggregate, combined
  map-side so a hot key never lands whole in one task; rows tied in order
  are ordered by a hash of their fields, so reruns agree);
* matched keys get all non-key fields replaced (NULLs too) and keep ``id``
  and ``created_at``; ``updated_at`` = batch time;
* new keys get the ids after the current maximum, in order of the key's first
  appearance in the batch (``ordering.with_position``: no one-task window, and
  no two rows share an id whatever the order column holds).

The stored table is a Parquet folder partitioned by ranges of ids.  A row keeps
its id and so its range: the number of ranges grows with the table, none grows
with it.  An upsert finds the ranges its keys lie in and overwrites these (and
the last one, which new ids fill) with Spark's dynamic partition overwrite.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.fmt import iso_timestamp
from ..functions.keys import book_source_key, car_source_key
from ..functions.numbers import storage_for
from ..functions.text import storage_text
from .columns import apply_aliases, ensure_columns
from ..session import materialize
from .constraints import assert_valid, split_valid, violations
from .keyfilter import key_filter
from .ordering import with_position

_TEXT = {"books": ("title", "availability", "description", "product_type", "category", "url"),
         "cars": ("brand", "model", "transmission", "region", "url")}
_FLOAT = {"books": ("price", "rating", "tax"), "cars": ("price", "mileage")}
_INT = {"books": ("products_on_page", "review_count", "source_page"), "cars": ("year", "source_page")}


def _timestamp_text(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType if name in df.columns else T.NullType()
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(F.col(name))
    if isinstance(dtype, T.DateType):
        return F.date_format(F.col(name), "yyyy-MM-dd")
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("string")
    return storage_text(F.col(name))


def normalize_records(batch: DataFrame, source: str, order: str = "ordinal") -> DataFrame:
    """Repository normalisation of a batch.

    The result has ``ordinal`` plus the stored field list, typed as stored.
    """
    aliased = apply_aliases(batch, S.ALIASES[source])
    if order not in aliased.columns:
        raise ValueError(f"batch needs an '{order}' column to define row order")
    fields = S.FIELDS[source]
    present = {f.name: f.dataType for f in aliased.schema.fields}
    df = ensure_columns(aliased, [c for c in fields if c not in present])
    key = book_source_key(df) if source == "books" else car_source_key(df)
    cols = [F.col(order).alias("ordinal"), key.alias("source_key")]
    for name in fields[1:]:
        dtype = df.schema[name].dataType
        if name in _TEXT[source]:
            cols.append(storage_text(F.col(name)).alias(name))
        elif name in _FLOAT[source]:
            cols.append(storage_for(dtype, F.col(name)).alias(name))
        elif name in _INT[source]:
            cols.append(storage_for(dtype, F.col(name), integer=True).alias(name))
        elif name == "scraped_at":
            cols.append(_timestamp_text(df, name).alias(name))
    return df.select(*cols)


def empty_table(spark: SparkSession, source: str) -> DataFrame:
    types = S.STORED_TYPES[source]
    from ..sources.inline import empty_frame
    return empty_frame(spark, T.StructType([T.StructField(n, t, True) for n, t in types.items()]))


def match_keys(target: DataFrame, batch: DataFrame, key: str = "source_key", unique: bool = False) -> DataFrame:
    """Full outer match of target and batch keys (which rows update,
    which insert, which stay).

    A filter of the batch's keys is tested on the target as it is scanned: keys
    that it excludes are told ``in_batch`` false at once, and only the rest meet
    the batch.  With ``unique`` (a stored table, whose keys are) those rows
    pass without any shuffle; else equal keys are made one.
    """
    b = materialize(batch.select(F.col(key).alias("_b_key")).distinct(), "batch-keys")
    t = target.select(F.col(key).alias("_t_key"))
    maybe = key_filter(b, "_b_key")(F.col("_t_key"))
    once = (lambda x: x) if unique else DataFrame.distinct
    apart = once(t.where(~maybe)).select(F.col("_t_key").alias(key), F.lit(True).alias("in_target"), F.lit(False).alias("in_batch"))
    near = once(t.where(maybe))
    j = near.join(b, near["_t_key"] == b["_b_key"], "full_outer")
    return apart.unionByName(j.select(F.coalesce("_t_key", "_b_key").alias(key), F.col("_t_key").isNotNull().alias("in_target"),
                                      F.col("_b_key").isNotNull().alias("in_batch")))


def last_rows(rows: DataFrame, source: str) -> DataFrame:
    """One row for each key of a normalised batch, the last one, as a written
    table; ``_first`` is where the key appears first."""
    fields = [c for c in S.FIELDS[source] if c != "source_key"]
    last = (rows.groupBy("source_key")
                .agg(F.max_by(F.struct(*fields), F.struct("ordinal", F.xxhash64(*fields))).alias("_row"),
                     F.min("ordinal").alias("_first")))
    return materialize(last.select("source_key", "_first", *[F.col(f"_row.{c}").alias(c) for c in fields]), "batch-rows")


def _numbered(fresh: DataFrame) -> DataFrame:
    """``source_key`` of new keys with their place (from 1) by first appearance."""
    placed = with_position(fresh.select("source_key", "_first"), [F.col("_first"), F.col("source_key")], "_place")
    return placed.select("source_key", "_place")


def _combine(target: DataFrame, last: DataFrame, maybe: Column, source: str, batch_time: _dt.datetime, top: Column) -> DataFrame:
    """``target`` with the rows of ``last``; ids of new keys follow ``top``.
    Rows that ``maybe`` excludes pass without a shuffle."""
    fields = [c for c in S.FIELDS[source] if c != "source_key"]
    near = target.where(maybe)
    fresh = _numbered(last.join(near.select("source_key"), "source_key", "left_anti"))
    last = last.join(fresh, "source_key", "left")

    t = near.select([F.col(c).alias(f"_t_{c}") for c in target.columns])
    joined = t.join(last, t["_t_source_key"] == last["source_key"], "full_outer")
    ts = F.lit(batch_time).cast(S.STORED_TYPES[source]["created_at"])
    in_batch = F.col("source_key").isNotNull()
    in_target = F.col("_t_source_key").isNotNull()

    out = [F.coalesce(F.col("_t_id"), top + F.col("_place")).cast("bigint").alias("id"),
           F.coalesce(F.col("_t_source_key"), F.col("source_key")).alias("source_key")]
    for c in fields:
        dtype = S.STORED_TYPES[source][c]
        out.append(F.when(in_batch, F.col(c).cast(dtype)).otherwise(F.col(f"_t_{c}").cast(dtype)).alias(c))
    out.append(F.when(in_target, F.col("_t_created_at")).otherwise(ts).alias("created_at"))
    out.append(F.when(in_batch, ts).otherwise(F.col("_t_updated_at")).alias("updated_at"))
    merged = joined.select(*out)
    return merged.unionByName(target.where(~maybe).select(*[F.col(f.name).cast(f.dataType) for f in merged.schema.fields]))


def merge(target: DataFrame, batch: DataFrame, source: str, batch_time: _dt.datetime, strict: bool = True) -> DataFrame:
    """``target`` after upserting ``batch``.

    ``strict`` (the reference behaviour) raises when any batch row breaks an
    integrity rule, ``False`` leaves broken rows out (``StoredTable`` keeps
    them, see ``rejected``).
    """
    rows = normalize_records(batch, source)
    if strict:
        assert_valid(rows, source)
    else:
        rows, _ = split_valid(rows, source)
    last = last_rows(rows, source)
    maybe = key_filter(last.select("source_key"), "source_key")(F.col("source_key"))
    top = target.select(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return _combine(target, last, maybe, source, batch_time, top)


class StoredTable:
    """A stored table under ``root``, all plain Parquet: ``rows`` partitioned by
    ``part`` (ids by ``rows_per_part``), ``rejected`` by batch, ``merged`` with
    the ids of the merged batches.

    One writer at a time; a frame read before an upsert is to be read again.
    Lost executors only repeat tasks: folders change when the write's job
    commits.  A batch that ends before that is merged again with the same
    result; ranges are replaced one after the other, so a driver lost in that
    step leaves the range it was at in Spark's staging folder.
    """

    def __init__(self, spark: SparkSession, root: str, source: str, rows_per_part: int = 1_000_000):
        if source not in S.STORED_TYPES:
            raise ValueError("table not allowed")
        self.spark, self.root, self.source, self.rows_per_part = spark, root.rstrip("/"), source, rows_per_part

    def _load(self, name: str, schema: T.StructType | None = None) -> DataFrame | None:
        """A folder of the table, ``None`` before its first write."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self.root}/{name}")

    def _rows(self) -> DataFrame | None:
        return self._load("rows", empty_table(self.spark, self.source).schema.add("part", T.LongType()))

    def read(self) -> DataFrame:
        rows = self._rows()
        return empty_table(self.spark, self.source) if rows is None else rows.drop("part")

    def rejected(self) -> DataFrame | None:
        """Rows that lenient upserts left out, with the rules they break."""
        return self._load("rejected")

    def merged(self) -> DataFrame:
        """``batch``: ids of the batches that are merged."""
        done = self._load("merged", T.StructType().add("batch", T.LongType()))
        return self.spark.range(0).select(F.col("id").alias("batch")) if done is None else done

    def upsert(self, batch: DataFrame, batch_time: _dt.datetime | None = None, strict: bool = True,
               batch_id: int | None = None) -> int:
        """Merge ``batch``; returns the number of rows merged.

        ``strict=False`` stores rows that break an integrity rule apart
        (``rejected``) instead of failing.  A ``batch_id`` that is merged already
        does nothing; one that died before its end is merged again.
        """
        if batch_id is not None and not self.merged().where(F.col("batch") == batch_id).isEmpty():
            return 0
        rows = materialize(violations(normalize_records(batch, self.source), self.source), "batch")
        broken = F.size("violations") > 0
        n_rows, n_bad = rows.agg(F.count(F.lit(1)), F.count_if(broken)).first()
        if strict and n_bad:
            raise ValueError(f"{self.source}: batch breaks an integrity rule; nothing written")
        if n_bad:
            bad = rows.where(broken).withColumn("batch", F.lit(batch_id).cast("bigint"))
            # a batch merged again replaces what it rejected the first time
            bad.write.mode("append" if batch_id is None else "overwrite").option("partitionOverwriteMode", "dynamic") \
               .partitionBy("batch").parquet(f"{self.root}/rejected")
        if n_rows > n_bad:
            batch_time = batch_time or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            changed = self._changed(last_rows(rows.where(~broken).drop("violations"), self.source), batch_time)
            changed.withColumn("part", F.expr(f"(id - 1) div {self.rows_per_part}")).repartition("part") \
                   .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.root}/rows")
        if batch_id is not None:
            self._mark(batch_id)
        return n_rows - n_bad

    def _changed(self, last: DataFrame, batch_time: _dt.datetime) -> DataFrame:
        """All rows of the ranges that ``last`` changes.

        The driver learns which these are: one number for ``rows_per_part`` stored
        rows at most, and the scan of their rows is pruned to them."""
        stored = self._rows()
        if stored is None:
            return _combine(empty_table(self.spark, self.source), last, F.lit(True), self.source, batch_time, F.lit(0))
        keys = last.select("source_key")
        maybe = key_filter(keys, "source_key")(F.col("source_key"))
        found = stored.where(maybe).join(keys, "source_key", "left_semi").groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()
        top = stored.agg(F.max("id")).first()[0] or 0
        parts = {r["part"] for r in found}
        if sum(r["n"] for r in found) < keys.count():  # new keys go on in the last range
            parts.add(top // self.rows_per_part)
        return _combine(stored.where(F.col("part").isin(sorted(parts))).drop("part"), last, maybe, self.source, batch_time, F.lit(top))

    def _mark(self, batch_id: int) -> None:
        self.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch")).coalesce(1).write.mode("append").parquet(f"{self.root}/merged")
