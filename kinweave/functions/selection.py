"""Exact quantiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging


def quantiles(df: DataFrame, groups: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """``groups`` and a double for each name in ``fractions``: interpolated quantiles of the group's values that aren't null.

    Equal values of a group become one with a count. These are dealt to ranges of (group,
    value); each range counts on from the ranges before it that hold the same group, and the
    values at the wanted ranks are picked. No task holds more than a range. Groups may be null; those
    without a value are left out. NaN is the largest value.
    """
    stage = Staging(df.sparkSession, "quantiles")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*groups, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    ranged = stage.write(counts.repartitionByRange(*groups, "_v").withColumn("_part", F.spark_partition_id()), "ranges")
    # At most a row for each group and each range.
    parts = ranged.groupBy(*groups, "_part").agg(F.sum("_n").alias("_n"))
    of_group = Window.partitionBy(*groups)
    before = F.coalesce(F.sum("_n").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(*[F.col(g).alias(f"_{g}") for g in groups], F.col("_part").alias("_p"), before.alias("_base"), F.sum("_n").over(of_group).alias("_all"))
    same = F.col("_part") == F.col("_p")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    own = F.sum("_n").over(Window.partitionBy("_part", *groups).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = ranged.withColumn("_own", own).join(parts, same).withColumn("_to", F.col("_base") + F.col("_own"))
    # Ranks from 0: a value has those from _to - _n to _to - 1.
    at = {name: (F.col("_all") - 1) * f for name, f in fractions.items()}
    holds = lambda rank: (rank >= F.col("_to") - F.col("_n")) & (rank < F.col("_to"))
    picked = [F.max(F.when(holds(f(p)), F.col("_v"))).alias(f"_{n}_{s}") for n, p in at.items() for s, f in (("a", F.floor), ("b", F.ceil))]
    shares = [F.max(p - F.floor(p)).alias(f"_{n}_s") for n, p in at.items()]
    out = placed.groupBy(*groups).agg(*picked, *shares)
    between = {n: F.col(f"_{n}_a") + F.when(F.col(f"_{n}_s") > 0, (F.col(f"_{n}_b") - F.col(f"_{n}_a")) * F.col(f"_{n}_s")).otherwise(0.0) for n in fractions}
    return out.select(*groups, *[v.alias(n) for n, v in between.items()])
