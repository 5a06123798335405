"""Tables written between two steps of one computation.

They go to the shared folder the session names in ``spark.checkpoint.dir``, or
below the warehouse where that is unset: both are places every executor and the
driver can reach. What is read back is Parquet, so lineage is cut, the work is
done once, and a lost executor costs a re-read. A workspace is removed when the
session's JVM ends, or earlier by ``drop``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_MARK = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
_PARALLEL = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share; the same rule on any master."""
    named = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging").rstrip("/")


class Workspace:
    """A folder of its own for the intermediate tables of one computation."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/basketlens/{label}-{uuid.uuid4().hex}"
        self._kept = False

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table.

        Shuffled rows are written in files of the advisory partition size, not
        in as many as there are cores: each file costs every store some calls.
        What the write shuffled is removed with its end, not when the driver next
        collects its garbage: nothing else reads it.
        """
        conf = self.spark.conf
        before = {setting: conf.get(setting) for setting in (_PARALLEL, _CLEAN)}
        conf.set(_PARALLEL, "false")
        conf.set(_CLEAN, "true")
        try:
            # Nobody looks for the mark of success of a table that is read at once.
            df.write.mode("error").option(_MARK, "false").parquet(self.path(name))
        finally:
            for setting, value in before.items():
                conf.set(setting, value)
        if not self._kept:
            # Removed by the file system's own shutdown hook, whatever store it is.
            self._delete("", at_exit=True)
            self._kept = True
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str = "") -> None:
        """Remove one table, or the whole workspace."""
        self._delete(name, at_exit=False)

    def _delete(self, name: str, at_exit: bool) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.folder)
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if at_exit:
            system.deleteOnExit(path)
        else:
            system.delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a workspace of its own and return the written table."""
    return Workspace(df.sparkSession, label).save(df, "table")
