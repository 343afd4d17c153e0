"""Intermediate tables in the shared checkpoint folder.

Loops cut their lineage by writing parquet tables: columnar, counted, readable by any executor
after another is lost, and planned with known sizes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the session's file system.

    On a cluster whose file system is each machine's own disk there is no such folder, so one has
    to be named.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    system = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    local_master = spark.sparkContext.master.split("[")[0] == "local"
    if system.getUri().getScheme() == "file" and not local_master:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = f"/tmp/citeloom-checkpoints-{spark.sparkContext.applicationId}"
    return system.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(folder)).toString()


class Scratch:
    """One run's folder of intermediate tables."""

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.path = f"{checkpoint_root(spark)}/citeloom/{label}-{uuid.uuid4().hex}"
        self._tables: dict[str, StructType] = {}

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write a DataFrame once, with the writer's options, and give it back as a table scan."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").options(**options).parquet(path)
        self._tables[name] = df.schema
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        """A table written before, as a scan."""
        return self.spark.read.schema(self._tables[name]).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables nothing reads any more."""
        for name in set(self._tables).intersection(names):
            self._delete(f"{self.path}/{name}")
            del self._tables[name]

    def drop_since(self, before: set[str], keep: tuple[str, ...] = ()) -> None:
        """Remove the tables written since ``before`` (from :meth:`tables`), but for some."""
        self.drop(*(set(self._tables) - before - set(keep)))

    def tables(self) -> set[str]:
        return set(self._tables)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        self.close()

    def close(self) -> None:
        """Remove the whole folder; results that read from it must be written first."""
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsc.hadoopConfiguration()
        hadoop_path.getFileSystem(conf).delete(hadoop_path, True)
