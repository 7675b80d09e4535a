"""Existence checks and deletes on whatever storage the session is configured for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _handle(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none when it does not exist."""
    files, target = _handle(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def delete(spark: SparkSession, path: str) -> None:
    files, target = _handle(spark, path)
    files.delete(target, True)


def has_input(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or pattern holds anything a reader would take."""
    files, target = _handle(spark, path)
    found = files.globStatus(target)
    if not found:
        return False
    return any(
        status.isFile() or len(files.listStatus(status.getPath())) > 0 for status in found
    )


def files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of change of each visible file directly in a folder (or of a file)."""
    system, target = _handle(spark, path)
    return sorted(_state(status) for status in system.listStatus(target) if status.isFile() and _visible(status))


def tree(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Like :func:`files`, of the folder and of all visible folders below it."""
    system, target = _handle(spark, path)
    found, folders = [], [target]
    while folders:
        for status in system.listStatus(folders.pop()):
            if _visible(status):
                if status.isDirectory():
                    folders.append(status.getPath())
                else:
                    found.append(_state(status))
    return sorted(found)


def raw_path(spark: SparkSession, path: str) -> str:
    """The absolute path of a folder as it stands, percent-encoded, in the addresses of its files."""
    system, target = _handle(spark, path)
    return system.makeQualified(target).toUri().getRawPath().rstrip("/")


def _state(status) -> tuple[str, int, int]:
    return status.getPath().toString(), status.getLen(), status.getModificationTime()


def _visible(status) -> bool:
    return status.getPath().getName()[0] not in "._"
