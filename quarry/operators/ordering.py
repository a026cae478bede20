"""Row numbers in a global order without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize


def with_position(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its place (from 1) in ``order``.  Rows are range-partitioned
    and numbered by partition; partitions, one row each, are then shifted by
    the counts before them.  The ranges are written once, so that numbers and
    counts agree whatever is computed again."""
    ranged = materialize(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
                           .withColumn("__in", F.row_number().over(Window.partitionBy("__part").orderBy(*order))), "ordered")
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    shift = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return ranged.join(shift, "__part").withColumn(name, F.col("__before") + F.col("__in")).drop("__part", "__in", "__before")
