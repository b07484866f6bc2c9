"""Lists of any length as runs of bounded rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.ranking import dense_index


def chunked(rows: DataFrame, keys: list[str], order: list[Column | str], value: Column, size: int, name: str = "values") -> DataFrame:
    """``keys, chunk, name``: the values of each key in order, in arrays of up to ``size``.

    Rows are numbered over the whole table by keys and order, and a chunk is what a key holds of
    one run of ``size`` numbers, so neither a task nor a row holds a long list whole. Chunks
    are numbered from 0 within their key; the first and the last may be shorter. Keys may be null.
    """
    keyed = rows.select(*keys, F.struct(*[F.col(c) if isinstance(c, str) else c for c in order]).alias("_o"), value.alias("_v"))
    placed = dense_index(keyed, *keys, "_o", name="_i").withColumn("_run", F.floor(F.col("_i") / size))
    runs = placed.groupBy(*keys, "_run").agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_x"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_run")) - 1
    return runs.select(*keys, number.cast("long").alias("chunk"), F.transform("_x", lambda x: x["_v"]).alias(name))
