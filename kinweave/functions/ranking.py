"""Dense global numbering without sending all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging


def dense_index(df: DataFrame, *order: Column | str, name: str = "index", start: int = 0) -> DataFrame:
    """Adds a running number by the given total order.

    Rows are dealt to ranges of the order; each range numbers its own rows and adds the sizes
    of the ranges before it, a table with a row for each partition.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    stage = Staging(df.sparkSession, "index")
    ranged = stage.write(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return ranged.withColumn("_own", own).join(F.broadcast(before), "_part").withColumn(name, F.col("_base") + F.col("_own") - 1 + start).drop("_part", "_own", "_base")


def running_max(df: DataFrame, value: Column, order: str, name: str = "last") -> DataFrame:
    """Adds the largest ``value`` of all rows up to each row in the order of a column, without one task for all.

    Ranges of the order carry over the largest value of the ranges before them, a table with a
    row for each partition. Rows with equal order see each other's values only within the order of
    ``value``; nulls of ``value`` don't count.
    """
    stage = Staging(df.sparkSession, "running")
    ranged = stage.write(df.withColumn("_value", value).repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = ranged.groupBy("_part").agg(F.max("_value").alias("_v"))
    before = before.select("_part", F.max("_v").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_base"))
    own = F.max("_value").over(Window.partitionBy("_part").orderBy(order, "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ranged.withColumn("_own", own).join(F.broadcast(before), "_part").withColumn(name, F.greatest("_base", "_own")).drop("_part", "_own", "_base", "_value")
