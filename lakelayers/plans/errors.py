"""Whether an error speaks of the data or of the machines."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.errors import AnalysisException

# Beginnings of Spark's error conditions that name rows, files or columns.
DATA = (
    "ARITHMETIC_OVERFLOW", "CANNOT_MERGE", "CANNOT_PARSE", "CAST_", "DATATYPE_MISMATCH", "DIVIDE_BY_ZERO", "FAILED_READ_FILE",
    "INVALID_", "MALFORMED_", "NUMERIC_", "PARQUET_", "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "UNRESOLVED_COLUMN",
    "USER_RAISED_EXCEPTION",
)
# What the machines or the network are to blame for, whatever condition wraps it.
CLUSTER = re.compile(
    r"^java\.net\.|SocketException|InterruptedIOException|InterruptedException|OutOfMemoryError|FetchFailed|ExecutorLost"
    r"|ExecutorDeadException|BlockMissing|No space left on device|Connection (reset|refused)"
)
_CONDITION = re.compile(r"\[([A-Z][A-Z0-9_]*)(?:\.[A-Z0-9_]+)*\]")


def names_data(error: BaseException) -> bool:
    """True if another choice of dates may help: rows that do not parse, files that cannot be read, columns that lack.

    All else, lost executors, full disks, time-outs, is worth a second try of the same work and no smaller one.
    """
    said = [*_chain(error)]
    if any(CLUSTER.search(text) for text in said):
        return False
    if isinstance(error, (ValueError, AnalysisException)):
        return True
    conditions = [found for text in said for found in _CONDITION.findall(text)]
    return any(condition.startswith(DATA) for condition in conditions)


def _chain(error: BaseException | None) -> Iterator[str]:
    """Class and first line of the error and of what caused it, in Python and in the JVM."""
    seen = 0
    while error is not None and seen < 20:
        yield f"{type(error).__name__} {_first(str(error))}"
        java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
        while java is not None and seen < 20:
            yield java.getClass().getName()
            yield _first(java.getMessage() or "")
            java, seen = java.getCause(), seen + 1
        error, seen = error.__cause__ or error.__context__, seen + 1


def _first(text: str) -> str:
    """The message without the stack traces that Spark puts behind it."""
    return text.split("\n\tat ")[0][:2000]
