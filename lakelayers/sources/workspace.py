"""Where jobs may put intermediate tables."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import SparkSession

from lakelayers.sources.files import remove

_local_base: tempfile.TemporaryDirectory | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may fall back to a temporary folder.
    """
    global _local_base
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_base is None:
        _local_base = tempfile.TemporaryDirectory(prefix="lakelayers-")
    return _local_base.name


_made: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; :func:`clear_scratch` removes what was written there."""
    path = f"{shared_dir(spark)}/lakelayers/{name}-{uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


class Scratch:
    """The intermediate tables made within a ``with`` block; all but the last one are removed at its end."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._application = spark, spark.sparkContext.applicationId
        self._begin = len(_made.setdefault(self._application, []))

    def last(self) -> str:
        return _made[self._application][-1]

    def remove(self, paths: Sequence[str]) -> None:
        for path in paths:
            remove(self._spark, path)
            _made[self._application].remove(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error: object) -> None:
        own = _made[self._application][self._begin :]
        self.remove(own if error[0] else own[:-1])


def scratch_since(spark: SparkSession) -> Scratch:
    """Use as ``with scratch_since(spark) as made``; what is made last, the result, has to be complete by the end of the block."""
    return Scratch(spark)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the session's intermediate tables, once nothing that was read from them is needed any more."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)
