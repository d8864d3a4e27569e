"""What the file system says: which days have a source, how large it is, whether a path exists.

Calls go to Hadoop's file system interface from the driver. They see folders and files, start no Spark job, and
read no data.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from py4j.java_gateway import JavaObject
from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

DATE_GLOB = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
DATE_LENGTH = 10
# Calls that wait for the file system at the same time.
THREADS = 8
A, B = TypeVar("A"), TypeVar("B")
_SPECIAL = re.compile(r"([\\*?\[\]{}])")


def each(spark: SparkSession, function: Callable[[A], B], items: Sequence[A]) -> list[B]:
    """``function`` of every item, several at a time, for calls that mostly wait."""
    if len(items) < 2:
        return [function(item) for item in items]
    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(function), items))


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _path(spark, path)
    return files.exists(found)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    files, found = _path(spark, path)
    return files.getContentSummary(found).getLength()


def remove(spark: SparkSession, path: str) -> None:
    files, found = _path(spark, path)
    files.delete(found, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a path that does not exist; one step on a file system that has folders."""
    files, found = _path(spark, source)
    _, to = _path(spark, target)
    files.mkdirs(to.getParent())
    if not files.rename(found, to):
        raise OSError(f"cannot move {source} to {target}")


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder, none if it is not there."""
    files, found = _path(spark, folder)
    return sorted(e.getPath().getName() for e in files.listStatus(found)) if files.exists(found) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it appears under its name only once it is complete."""
    files, part = _path(spark, f"{path}.part")
    out = files.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    files, found = _path(spark, path)
    stream = files.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def literal(path: str) -> str:
    """A path that a reader does not take for a pattern."""
    return _SPECIAL.sub(r"\\\1", path)


def before_date(spark: SparkSession, layout: str) -> str:
    """What stands before the date in the encoded path of a file stored under ``layout`` (with ``{dt}``)."""
    ends = []
    for digit in "01":
        files, found = _path(spark, layout.replace("{dt}", digit * DATE_LENGTH))
        ends.append(files.makeQualified(found).toUri().getRawPath())
    same = next(i for i, (a, b) in enumerate(zip(*ends, strict=True)) if a != b)
    return ends[0][:same]


def dates_of(spark: SparkSession, layout: str) -> list[str]:
    """The dates for which a file or folder is there; one listing entry for each, however many files it holds."""
    before, after = layout.split("{dt}")
    files, pattern = _path(spark, f"{literal(before)}{DATE_GLOB}{literal(after)}")
    entries = files.globStatus(pattern) or []
    at = len(before_date(spark, layout))
    return sorted({e.getPath().toUri().getRawPath()[at : at + DATE_LENGTH] for e in entries})


def sizes_of(spark: SparkSession, layout: str, dates: Sequence[str]) -> dict[str, int]:
    """Bytes of each date's source, for the dates that have one."""

    def size(dt: str) -> int | None:
        path = layout.replace("{dt}", dt)
        return size_of(spark, path) if exists(spark, path) else None

    return {dt: size for dt, size in zip(dates, each(spark, size, list(dates)), strict=True) if size is not None}
