"""Names in a folder of the lake, through the file system that owns the path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``, ascending; none if it does not exist."""
    fs, at = _folder(spark, path)
    if not fs.exists(at):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(at))


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _folder(spark, path)
    fs.delete(at, True)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder ``path`` has ended well."""
    fs, at = _folder(spark, f"{path}/_SUCCESS")
    return fs.exists(at)


def newest(spark: SparkSession, path: str, below: str | None = None) -> str | None:
    """The greatest name under ``path`` (less than ``below``) whose write has
    finished: one listing, and a look at the last entries only."""
    for name in reversed(names(spark, path)):
        if (below is None or name < below) and finished(spark, f"{path}/{name}"):
            return name
    return None


def committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers n of the finished writes ``<path>/v<n>``, ascending."""
    found = [n for n in names(spark, path) if n.startswith("v") and n[1:].isdigit()]
    return sorted(int(n[1:]) for n in found if finished(spark, f"{path}/{n}"))


def numbered(number: int) -> str:
    """Name of a numbered write; names sort as the numbers do."""
    return f"v{number:012d}"


def keep_newest(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the greatest ``keep`` names under ``path``."""
    for name in names(spark, path)[:-keep]:
        remove(spark, f"{path}/{name}")
