"""Sets of tables that are whole or absent.

A set is written under a version of its own; readers find it by a pointer file,
which is replaced by one rename after the last table is written. Until then, and
if a write fails, they read the version before. That one is kept, as readers may
still be at it; older ones are removed.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

POINTER = "current"
#: Versions that are kept, the current one included.
KEPT = 2


class Versions:
    """The versions of the tables in a folder; any file system that renames a file at once will do."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self.folder = folder.rstrip("/")

    def path(self, version: str) -> str:
        return f"{self.folder}/versions/{version}"

    def new(self) -> str:
        """Name of a version to write; names sort by time."""
        now = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        return f"{now}-{uuid.uuid4().hex[:8]}"

    def published(self) -> list[str]:
        """The current version and those kept before it, latest first."""
        system, path = self._at(f"{self.folder}/{POINTER}")
        if not system.exists(path):
            return []
        stream = system.open(path)
        try:
            return stream.readUTF().split("\n")
        finally:
            stream.close()

    def current(self) -> str:
        """Folder of the current version's tables, or the folder itself if it has no versions."""
        versions = self.published()
        return self.path(versions[0]) if versions else self.folder

    def publish(self, version: str) -> None:
        """Make a written version the current one."""
        versions = [version, *self.published()]
        made = f"{self.folder}/.{POINTER}-{version}"
        system, path = self._at(made)
        stream = system.create(path, True)
        try:
            stream.writeUTF("\n".join(versions[:KEPT]))
        finally:
            stream.close()
        jvm = self._spark._jvm
        hadoop = jvm.org.apache.hadoop.fs
        rename = getattr(hadoop, "Options$Rename")
        how = self._spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context = hadoop.FileContext.getFileContext(path.toUri(), self._spark._jsc.hadoopConfiguration())
        context.rename(path, self._at(f"{self.folder}/{POINTER}")[1], how)
        for old in versions[KEPT:]:
            self.drop(old)

    def drop(self, version: str) -> None:
        system, path = self._at(self.path(version))
        system.delete(path, True)

    def _at(self, name: str):
        path = self._spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self._spark._jsc.hadoopConfiguration()), path
