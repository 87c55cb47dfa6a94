"""Folders of a table on whatever file system holds it, through Hadoop's own client.

Spark reads and writes data; listing, marking, renaming and deleting single folders has no DataFrame
form. All calls here are made by the driver and touch names only, never rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# The characters that a partition value is escaped for in a folder name, and its null.
ESCAPED = set('"#%\'*/:=?\\{[]^\x7f') | {chr(c) for c in range(1, 32)}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def partition_folder(name: str, value: str | int | None) -> str:
    """``name=value`` as Spark writes it."""
    if value is None or value == "":
        return f"{name}={NULL_FOLDER}"
    return f"{name}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in str(value))


class Folders:
    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._file = spark._jvm.java.io.File
        self.root = root.rstrip("/")
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """What lies directly in a folder, empty if there is none."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._at(name)))

    def claim(self, name: str) -> bool:
        """Create an empty file; false if somebody else has done so. One caller at most gets true."""
        at = self._at(name)
        self._files.mkdirs(at.getParent())
        if self._files.getScheme() == "file":
            return self._file(at.toUri().getPath()).createNewFile()
        try:
            self._files.create(at, False).close()
            return True
        except Exception:
            if self.exists(name):
                return False
            raise

    def mark(self, name: str) -> None:
        """Create an empty file if it isn't there."""
        self._files.mkdirs(self._at(name).getParent())
        self._files.create(self._at(name), True).close()

    def make(self, name: str) -> None:
        self._files.mkdirs(self._at(name))

    def move(self, old: str, new: str) -> None:
        """Rename a folder, which others see at once as a whole."""
        self._files.mkdirs(self._at(new).getParent())
        if not self._files.rename(self._at(old), self._at(new)):
            raise OSError(f"cannot move {old} to {new} in {self.root}")

    def drop(self, name: str) -> None:
        self._files.delete(self._at(name), True)
