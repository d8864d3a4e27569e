"""Line dedup: lines that many documents share stay in one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayers.llm.common import BLANKS, ascii_lower, stored, text_hash

MIN_CHARS = 20
MIN_DOCS = 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``doc_id, rid, keep_runs`` for every document that loses a line.

    ``keep_runs`` is the bitmap of the lines that stay, run-length compressed: ``start`` and ``length`` of each run, in
    order; the last run has no length and goes to the end. A document without a row keeps all lines.

    Hashes (96 bits) of the keys are range-partitioned by hash and document, so a line that a third of the documents
    share is cut into several ranges, and sorted by hash, document and position in them. The sorted rows stream by, and
    the first occurrence of a hash in a document passes. What passes is counted per hash and range, and the ranges of a hash are merged.
    Runs come from the lines that go, in the order of their positions: neighbours keep the same distance to their number.

    A null text is one empty line. ``rid`` tells rows of one id with different texts apart; such rows count as
    one document. A null id is a document smaller than all others. Empty tables give empty tables.
    """
    lines = docs.select(
        F.col(id_col).alias("doc_id"),
        text_hash(F.col(text_col)).alias("rid"),
        F.posexplode(F.transform(lines_of(F.col(text_col)), line_key)).alias("pos", "key"),
    )
    occurrences = lines.filter(F.char_length("key") >= min_chars).select(
        F.xxhash64("key").alias("h"), F.hash("key").alias("g"), "doc_id", "rid", "pos"
    )
    # Read three times below: to find the ranges, to deal them out, and to mark what goes.
    occurrences = stored(occurrences, "lines")
    shared = first_occurrences(occurrences).groupBy("h", "g").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper"))
    # Written, so that the join below has a plain shuffle on either side, which can be split where one line is hot.
    shared = stored(shared.filter(F.col("docs") >= min_docs).select("h", "g", "keeper"), "shared_lines")
    dropped = occurrences.join(shared, ["h", "g"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    # Rows that repeat are reduced in the map tasks before a document's lines meet.
    dropped = dropped.select("doc_id", "rid", "pos").distinct()
    in_order = Window.partitionBy("doc_id", "rid").orderBy("pos")
    numbered = dropped.withColumn("run", F.col("pos") - F.row_number().over(in_order))
    runs = numbered.groupBy("doc_id", "rid", "run").agg(F.min("pos").alias("start"), F.count(F.lit(1)).cast("int").alias("length"))
    listed = runs.groupBy("doc_id", "rid").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("gone"))
    return listed.select("doc_id", "rid", _between(F.col("gone")).alias("keep_runs"))


def first_occurrences(occurrences: DataFrame) -> DataFrame:
    """``h, g, doc_id`` once per hash and document: the first row of each in the stream sorted by hash, document, position."""
    ranged = occurrences.select("h", "g", "doc_id", "pos").repartitionByRange("h", "g", "doc_id")
    stream = Window.partitionBy("h", "g", "doc_id").orderBy("pos")
    first = ranged.withColumn("occurrence", F.row_number().over(stream)).filter("occurrence = 1")
    return first.select("h", "g", "doc_id")


def _between(gone: Column) -> Column:
    """The runs between the runs of lines that go, before the first and behind the last of them."""

    def run(i: Column) -> Column:
        before, after = F.get(gone, i - 1), F.get(gone, i)
        start = F.coalesce(before["start"] + before["length"], F.lit(0))
        return F.struct(start.alias("start"), (after["start"] - start).alias("length"))

    return F.filter(F.transform(F.sequence(F.lit(0), F.size(gone)), run), lambda r: r["length"].isNull() | (r["length"] > 0))


def with_kept_lines(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` as ``_row`` (a struct of all its columns) with ``kept`` text, ``n_lines`` and ``n_dropped``."""
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
        docs[id_col].alias("_id"),
        text_hash(docs[text_col]).alias("_rid"),
    )
    runs = bitmaps.select(
        F.col("doc_id").alias("_bid"), F.col("rid").alias("_brid"), F.col("keep_runs").alias("_runs")
    )
    joined = rows.join(runs, rows["_id"].eqNullSafe(runs["_bid"]) & (rows["_rid"] == runs["_brid"]), "left")
    lines = lines_of(F.col("_row")[text_col])

    def piece(run: Column) -> Column:
        return F.slice(lines, run["start"] + 1, F.coalesce(run["length"], F.size(lines) - run["start"]))

    kept = F.when(F.col("_runs").isNull(), lines).otherwise(F.flatten(F.transform("_runs", piece)))
    counted = joined.select("_row", F.size(lines).alias("n_lines"), kept.alias("_kept"))
    return counted.select(
        "_row",
        F.array_join("_kept", "\n").alias("kept"),
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``docs`` with the lines taken out of the text; columns as before. A null text stays null."""
    kept = with_kept_lines(docs, line_bitmaps(docs, id_col, text_col, min_chars, min_docs), id_col, text_col)
    new = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("_row")[text_col])
    return kept.select(*[(new if c == text_col else F.col("_row")[c]).alias(c) for c in docs.columns])
