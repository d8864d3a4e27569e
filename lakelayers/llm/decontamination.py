"""Benchmark decontamination with a positional inverted index of the training documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import ascii_lower, stored, text_hash

# Fixed value of the contract: what separates words, after lower-casing A-Z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Rows of a query table that may be broadcast: at most some 100 bytes each. Beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1)
    return F.filter(parts, lambda w: w != "")


def windows_of(items: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``window, phrase, terms, items``: distinct windows of the items with the ids that hold them.

    An item of fewer words than a window, but not none, is one window.
    """
    words = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
    words = words.filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    spans = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("terms"))
    spans = spans.withColumn("phrase", F.array_join("terms", " "))
    return spans.groupBy("phrase", "terms").agg(
        F.xxhash64(F.first("phrase")).alias("window"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def postings(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``term, doc_id, rid, pos`` for every occurrence of the given terms in the whole texts."""
    tokens = docs.select(
        F.col(id_col).alias("doc_id"),
        text_hash(F.col(text_col)).alias("rid"),
        F.posexplode(words_of(F.col(text_col))).alias("pos", "term"),
    )
    return tokens.join(_small(terms.select("term").distinct()), "term")


def rare_terms(windows: DataFrame, counts: DataFrame, ranks: int) -> DataFrame:
    """``window, term, offset, rank``: the places of a window's ``ranks`` rarest terms, by count in the training texts."""
    places = windows.select("window", F.size("terms").alias("len"), F.posexplode("terms").alias("offset", "term"))
    counted = places.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ordered = F.array_sort(F.collect_list(F.struct("n", "term", "offset")))
    per_window = counted.groupBy("window").agg(F.slice(ordered, 1, ranks).alias("rarest"))
    picked = per_window.select("window", F.size("rarest").alias("ranks"), F.posexplode("rarest").alias("rank", "r"))
    return picked.select("window", "ranks", "rank", F.col("r.term").alias("term"), F.col("r.offset").alias("offset"))


def find_phrases(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    slop: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, rid, starts, near``: per document its exact windows and how many windows come near.

    ``starts`` lists (start, length, items) of candidate windows for :func:`judge_documents`, which compares
    the words. ``near`` counts the windows whose two rarest terms lie up to ``slop`` words out of place but
    nowhere in place.

    Counts of the test terms over all documents decide which terms of a window are its rarest two. Only their
    postings are stored. A posting minus the term's offset in the window is a possible start; the two lists of
    starts of a document and window are intersected. Every row is one document and window, so frequent
    passages and frequent words spread over the documents that hold them.
    """
    windows = stored(windows_of(items, window, item_col, item_text_col), "windows")
    vocabulary = windows.select(F.explode("terms").alias("term")).distinct()
    counts = stored(
        postings(docs, vocabulary, id_col, text_col).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "terms"
    )
    rare = stored(rare_terms(windows, counts, 2), "rare")
    index = postings(docs, rare, id_col, text_col)
    placed = index.join(_small(rare), "term").withColumn("start", F.col("pos") - F.col("offset"))
    found = placed.groupBy("doc_id", "rid", "window", "ranks").agg(
        F.collect_set(F.when(F.col("rank") == 0, F.col("start"))).alias("first"),
        F.collect_set(F.when(F.col("rank") == 1, F.col("start"))).alias("second"),
    )
    found = found.filter((F.size("first") > 0) & ((F.size("second") > 0) | (F.col("ranks") == 1)))
    both = F.when(F.col("ranks") == 1, F.col("first")).otherwise(F.array_intersect("first", "second"))
    close = F.exists("first", lambda a: F.exists("second", lambda b: F.abs(a - b) <= slop))
    found = found.withColumn("starts", F.filter(both, lambda s: s >= 0))
    found = found.withColumn("near", ((F.size(both) == 0) & (F.col("ranks") > 1) & close).cast("long"))
    found = found.filter((F.size("starts") > 0) | (F.col("near") > 0))
    found = found.join(_small(windows.select("window", "phrase", F.size("terms").alias("len"), "items")), "window")
    one = F.transform("starts", lambda s: F.struct(s.alias("start"), "len", "phrase", "items"))
    return found.groupBy("doc_id", "rid").agg(
        F.flatten(F.collect_list(one)).alias("starts"), F.sum("near").alias("near")
    )


def judge_documents(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    slop: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` as ``_row`` with ``n_words``, ``n_hit``, ``hit_items`` (sorted ids as text) and ``n_near``.

    A word inside any occurrence of a window is hit. Every row of ``docs`` gives one row; rows of one id with
    different texts are judged apart. A null or wordless text has no words and no hits, an item without words
    no windows. A null item id takes part, but is no id in ``hit_items``.
    """
    found = find_phrases(docs, items, window, slop, id_col, text_col, item_col, item_text_col)
    found = found.select(
        F.col("doc_id").alias("_fid"), F.col("rid").alias("_frid"), F.col("starts").alias("_starts"),
        F.col("near").alias("_near"),
    )
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
        docs[id_col].alias("_id"),
        text_hash(docs[text_col]).alias("_rid"),
    )
    joined = rows.join(found, rows["_id"].eqNullSafe(found["_fid"]) & (rows["_rid"] == found["_frid"]), "left")
    joined = joined.select("_row", "_starts", "_near", words_of(F.col("_row")[text_col]).alias("_words"))
    exact = F.filter(
        F.coalesce("_starts", F.array().cast("array<struct<start:int,len:int,phrase:string,items:array<string>>>")),
        lambda s: F.array_join(F.slice("_words", s["start"] + 1, s["len"]), " ") == s["phrase"],
    )
    joined = joined.withColumn("_exact", exact)
    covered = F.transform("_exact", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))
    named = F.array_distinct(F.flatten(F.transform("_exact", lambda s: s["items"])))
    return joined.select(
        "_row",
        F.size("_words").cast("long").alias("n_words"),
        F.size(F.array_distinct(F.flatten(covered))).cast("long").alias("n_hit"),
        F.array_sort(named).alias("hit_items"),
        F.coalesce("_near", F.lit(0)).alias("n_near"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any hit, columns as before.

    Null and wordless texts have no hit and stay, repeated rows share their verdict. Null and wordless items have no window;
    without items all rows stay. An empty table gives an empty table.
    """
    judged = judge_documents(docs, items, window, id_col=id_col, text_col=text_col).filter("n_hit = 0")
    return judged.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
