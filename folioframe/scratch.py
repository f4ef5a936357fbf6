"""Tables written between the steps of a job, in the folder all executors share."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from folioframe.session import ship


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one where it is unset and all runs on one machine. On a
    cluster without one this raises, since executors would write to disks that the others do not see."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = getattr(spark, "_folio_scratch", None) or tempfile.mkdtemp(prefix="folio-")
        spark._folio_scratch = found
        found = f"file://{found}"
    return found.rstrip("/")


class Scratch:
    """Parquet tables that cut the lineage: a lost executor costs a re-read, never a re-run of earlier steps."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.n = ship(spark), f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        atexit.register(self.clear)

    def save(self, df: DataFrame) -> DataFrame:
        """Writes ``df`` and reads it back; shuffle files of finished steps become free."""
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._folio_path = path
        return out

    def release(self) -> None:
        """Lets Spark's cleaner drop the shuffle files that nothing refers to any longer."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def _remove(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self, df: DataFrame) -> None:
        """Deletes a saved table that nothing will read again."""
        self._remove(df._folio_path)

    def clear(self) -> None:
        """Deletes all tables of this scratch space; called at exit, since results may read them till then."""
        try:
            self._remove(self.base)
        except Exception:  # the session has ended  # noqa: BLE001
            pass


def input_partitions(df: DataFrame) -> int:
    """How many tasks read the input: a size estimate that costs no job."""
    return max(1, df.rdd.getNumPartitions())
