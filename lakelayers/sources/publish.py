"""Publication of written folders by renaming, with a note of what is to be done that the next run can finish.

Rows are written once, to a staging folder. Publishing moves whole date folders, or single files, into the tables.
Before the first move a note with all of them is written below the table; it is deleted after the last one. A run that dies or
breaks in between leaves the note, and :func:`finish` makes the moves that are still open. So a publication is done either wholly
or, before its note, not at all, and doing it again changes nothing. Between two moves a reader can see some dates new and
others old, and for the time of two renames a date without its folder.

From the note on the staging folder belongs to the publication: it is removed with the note, not by who wrote it. Should
somebody else remove it before, replaced dates go back to what they were, and files that were to be added are an error.

This needs a file system on which a folder is renamed in one step (HDFS, local disks), not an object store.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from uuid import uuid4

from pyspark.sql import SparkSession

from lakelayers.schemas import PARTITION
from lakelayers.sources.files import each, exists, names_in, read_text, remove, rename, write_text

# Below a table; readers skip names that begin with an underscore and have no equals sign.
NOTES = "_publish"


@dataclass(frozen=True)
class Move:
    """``source`` becomes ``target``; what was there goes ``aside``. Without a source ``target`` only goes."""

    source: str | None
    target: str
    aside: str | None = None


def date_folder(table: str, dt: str) -> str:
    return f"{table}/{PARTITION}={dt}"


def stored_dates(spark: SparkSession, table: str) -> list[str]:
    """The dates a table has a folder for."""
    before = f"{PARTITION}="
    return [name.removeprefix(before) for name in names_in(spark, table) if name.startswith(before)]


def replacements(staging: str, table: str, dates: Sequence[str], name: str, gone: Sequence[str] = ()) -> list[Move]:
    """Moves that give ``table`` the staged folders of ``dates`` and take its folders of the dates ``gone`` away."""
    aside = f"{table}/{NOTES}/{name}"
    moves = [Move(date_folder(staging, dt), date_folder(table, dt), date_folder(aside, dt)) for dt in dates]
    return moves + [Move(None, date_folder(table, dt), date_folder(aside, dt)) for dt in gone]


def additions(spark: SparkSession, staging: str, table: str) -> list[Move]:
    """Moves of all staged files of a flat folder, or of its date folders, beside those that the table has.

    Spark gives the files of every job names of their own.
    """
    folders = [f"/{name}" for name in names_in(spark, staging) if name.startswith(f"{PARTITION}=")] or [""]
    return [
        Move(f"{staging}{folder}/{name}", f"{table}{folder}/{name}")
        for folder in folders
        for name in names_in(spark, f"{staging}{folder}")
        if name[0] not in "_."
    ]


def publish(
    spark: SparkSession, table: str, moves: Sequence[Move], name: str | None = None, staging: str | None = None
) -> None:
    """Make ``moves``, some of which may concern other tables, under one note below ``table``; then ``staging`` goes."""
    note = f"{table}/{NOTES}/{name or uuid4().hex}.json"
    write_text(spark, note, json.dumps({"staging": staging, "moves": [asdict(move) for move in moves]}))
    _carry_out(spark, note)


def publish_dates(
    spark: SparkSession, staging: str, table: str, dates: Sequence[str], whole: bool = False
) -> None:
    """Give ``table`` the staged folders of ``dates``, with ``whole`` it keeps no others; then ``staging`` goes."""
    name = uuid4().hex
    gone = sorted(set(stored_dates(spark, table)) - set(dates)) if whole else []
    publish(spark, table, replacements(staging, table, dates, name, gone), name, staging)


def finish(spark: SparkSession, table: str) -> list[str]:
    """Make the moves that an interrupted publication left open; the notes that were found."""
    notes = [name for name in names_in(spark, f"{table}/{NOTES}") if name.endswith(".json")]
    for name in notes:
        _carry_out(spark, f"{table}/{NOTES}/{name}")
    return notes


def _carry_out(spark: SparkSession, note: str) -> None:
    said = json.loads(read_text(spark, note))
    moves = [Move(**fields) for fields in said["moves"]]
    each(spark, lambda move: _make(spark, move), moves)
    # What was replaced or not published goes before the note: without the note nobody would look for it.
    replaced = {move.aside.rpartition("/")[0] for move in moves if move.aside}
    for folder in sorted(replaced) + ([said["staging"]] if said["staging"] else []):
        remove(spark, folder)
    remove(spark, note)


def _make(spark: SparkSession, move: Move) -> None:
    """One move, or what is left of it: a source that is gone has been moved, an aside that is there is in place."""
    if move.source is not None and not exists(spark, move.source):
        if exists(spark, move.target):
            return
        if move.aside is None or not exists(spark, move.aside):
            raise OSError(f"{move.source} is gone and {move.target} is not there")
        rename(spark, move.aside, move.target)
        return
    if move.aside is not None and exists(spark, move.target) and not exists(spark, move.aside):
        rename(spark, move.target, move.aside)
    if move.source is not None:
        rename(spark, move.source, move.target)
