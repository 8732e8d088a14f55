"""File specs on any file system Spark reads.

A spec is a comma-separated list.  Items are trimmed and blanks ignored; a glob in
an item's last component is expanded to the files it names, sorted; order and
repeats are kept; a relative item is also tried against a base folder.  Listing
goes through the session's Hadoop file systems and looks at names only: no row,
no footer and no local disk of the driver is read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

GLOB_CHARS = "*?[]"


def literal_path(path: str) -> str:
    """A path in which Spark expands nothing."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _pattern(folder: str, name: str) -> str:
    """Hadoop's glob for ``* ? [..]`` in the last component only."""
    name = name.replace("\\", "\\\\").replace("{", "\\{").replace("}", "\\}").replace("[!", "[^")
    return (literal_path(folder) + "/" if folder else "") + name


class _Hadoop:
    """The few calls needed, on the session's Hadoop classes."""

    def __init__(self, spark: SparkSession):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def glob(self, pattern: str) -> list:
        path = self.path(pattern)
        return list(path.getFileSystem(self.conf).globStatus(path) or [])

    def files(self, statuses: list) -> list[str]:
        """Files in sorted order; of a dataset's folder its data files."""
        return sorted(s.getPath().toString() for s in statuses if s.isFile())

    def below(self, folder) -> list[str]:
        found = folder.getFileSystem(self.conf).listFiles(folder, True)
        base, out = folder.toString().rstrip("/"), []
        while found.hasNext():
            path = found.next().getPath().toString()
            if not any(p.startswith(("_", ".")) for p in path[len(base) + 1:].split("/")):
                out.append(path)
        return sorted(out)


def list_data_files(spark: SparkSession, spec: str | Sequence[str], base_dir: str | None = None) -> list[str]:
    """The files of a spec in order, as qualified paths.  A literal that names a
    folder stands for the data files below it.  ``FileNotFoundError`` for an item
    that names nothing, ``ValueError`` if the spec names no file."""
    hadoop, out = _Hadoop(spark), []
    for raw in spec.split(",") if isinstance(spec, str) else spec:
        item = raw.strip()
        if not item:
            continue
        tries = [item]
        if base_dir and not item.startswith("/") and "://" not in item and not item.startswith("file:"):
            tries.append(base_dir.rstrip("/") + "/" + item)
        found: list[str] = []
        for path in tries:
            folder, _, name = path.rstrip("/").rpartition("/")
            if path.startswith("/"):
                folder = folder or "/"
            if any(c in name for c in GLOB_CHARS):
                found = [f for f in hadoop.files(hadoop.glob(_pattern(folder, name)))
                         if name.startswith(".") or not f.rpartition("/")[2].startswith(".")]
            if not found:                           # also a literal name with [ ] in it
                for status in hadoop.glob(literal_path(path)):
                    found = [status.getPath().toString()] if status.isFile() else hadoop.below(status.getPath())
            if found:
                break
        if not found:
            raise FileNotFoundError(f"data file not found: {item}")
        out += found
    if not out:
        raise ValueError("the file spec names no file")
    return out


def source_path() -> Column:
    """The file of each row read, with one slash after ``file:``."""
    return F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")


def metadata_path(spark: SparkSession, path: str) -> str:
    """A listed file as :func:`source_path` spells it."""
    uri = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()
    return re.sub(r"^file:/+", "file:/", uri)
