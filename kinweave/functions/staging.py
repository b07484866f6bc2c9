"""Cutting lineage through Parquet tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only where that is unset.

    Only a local master may go without the setting: there, driver and executors share a disk.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


#: Rows of a small table that one task writes.
ROWS = 2000


class Staging:
    """Named Parquet tables below one fresh folder of the shared directory.

    ``write`` runs a plan once and returns a scan of its result, so that a lost
    executor costs a re-read and not a recomputation; ``drop`` deletes a table that
    nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/kinweave-{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0

    def write(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """The table as written. ``rows``, about how many it has, spares a small one a file for each partition."""
        self.n += 1
        if rows is not None:
            df = df.coalesce(rows // ROWS + 1)
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_at = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._staged_at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
