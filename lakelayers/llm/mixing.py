"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakelayers.llm.common import WORD, stored, text_hash

# Fixed values of the contract: weights by rank of the source, share of all words, repeats of a document.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``source, source_size, rank, target`` from ``source, source_size``, one row per source.

    Sources rank by code point, null last, and take the weights in turn. Filling ``share`` of all words by
    weight while no source exceeds ``repeats`` times its size means a common level: a source gets the smaller
    of its cap and level times weight. With sources in the order of cap over weight, the level follows from
    the sums before the first source that it leaves below its cap. Only this table, one row per source, is
    ordered as a whole.
    """
    every = W.orderBy(F.col("source").asc_nulls_last())
    cap = F.col("source_size") * repeats
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("rank", F.row_number().over(every) - 1).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = W.orderBy("ratio", "rank").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    zero = F.lit(0).cast("long")
    level = (
        F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(before), zero)
    ) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero))
    levelled = ranked.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(whole)
    target = F.least(F.col("cap").cast("double"), first["level"] * F.col("weight"))
    return levelled.withColumn("target", F.coalesce(target, F.col("cap").cast("double"))).select(
        "source", "source_size", "rank", "target"
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = MAX_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``doc_id, rid, source, copies, size, source_size, target, pass, start, taken``: a row per document and pass.

    Each source queues its documents in the order of md5 of the id, ``repeats`` times over. A document's
    virtual finish time is its source's words up to its end divided by the source's target. All sources
    together are taken by finish time until the next document would exceed the sum of the targets; ``taken``
    says how many copies of a pass got in, ``start`` is the source's words ahead of them. Running sums are built from sums per slice (of the md5, then of the finish
    time), about the root of the number of documents many, so neither a hot source nor the whole queue meets in
    one task.

    Identical rows are queued as one item, a run of ``copies`` rows that have a finish time each. Rows of one id with different texts are items of
    their own. A null or wordless text has size 0; such a row has one pass without a finish time, not taken. A null
    source is the last. Empty tables give empty tables.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        text_hash(F.col(text_col)).alias("rid"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    items = sized.groupBy("doc_id", "rid", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    items = stored(items.withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "mix")
    rows = items.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("copies"), F.lit(0)).alias("copies")).first()
    slices = isqrt(rows["items"]) + 1

    load = F.col("size") * F.col("copies")
    targets = source_targets(items.groupBy("source").agg(F.sum(load).alias("source_size")), weights, share, repeats)
    targets = stored(targets, "targets")
    slice_of = (F.conv(F.substr("key", F.lit(1), F.lit(12)), 16, 10).cast("long") % slices).cast("int")
    queued = items.withColumn("slice", slice_of)
    ahead = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = queued.groupBy("source", "slice").agg(F.sum(load).alias("total"))
    starts = starts.select("source", "slice", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("start"))
    within = W.partitionBy("source", "slice").orderBy("key", "doc_id", "rid").rowsBetween(W.unboundedPreceding, 0)
    queued = queued.withColumn("cum", F.sum(load).over(within))
    same = [F.col("q.source").eqNullSafe(F.col("s.source")), F.col("q.slice") == F.col("s.slice")]
    queued = queued.alias("q").join(starts.alias("s"), same).select("q.*", "s.start")
    queued = queued.alias("q").join(targets.alias("t"), F.col("q.source").eqNullSafe(F.col("t.source")))
    passes = F.when(F.col("size") > 0, F.sequence(F.lit(0), F.lit(repeats - 1))).otherwise(F.array(F.lit(0)))
    queued = queued.select(
        "q.doc_id", "q.rid", "q.source", "key", "copies", "size", "source_size", "target", "rank", "start", "cum",
        F.explode(passes).alias("pass"),
    )
    ahead = F.col("pass") * F.col("source_size") + F.col("start") + F.col("cum") - load
    queued = stored(queued.withColumn("start", ahead).drop("cum"), "queue")
    return _truncated(queued, targets, isqrt(rows["copies"]) + 1)


def _finish(copy: Column) -> Column:
    return (F.col("start") + copy * F.col("size")) / F.col("target")


def _runs(slices: int) -> Column:
    """``slice, after, upto`` of every slice of the finish time: the copies behind ``after``, up to ``upto``, lie in it.

    An entry per copy, or per slice if those are fewer.
    """
    # Nearly all of the queue's end lies at time 1; the last slice holds what comes after time 4.
    def slice_of(copy: Column) -> Column:
        return F.least(F.floor(_finish(copy) * slices), F.lit(4 * slices)).cast("long")

    one = F.lit(1).cast("long")
    first, last = slice_of(one), slice_of(F.col("copies"))

    def upto(slice_: Column) -> Column:
        guess = F.floor(((slice_ + 1) / F.lit(slices) * F.col("target") - F.col("start")) / F.col("size")).cast("long")
        near = [F.least(F.greatest(guess + d, F.lit(0).cast("long")), F.col("copies")) for d in (-1, 0, 1)]
        inside = F.greatest(*[F.when(slice_of(n) <= slice_, n) for n in near])
        return F.when(slice_ < first, F.lit(0).cast("long")).when(slice_ >= last, F.col("copies")).otherwise(inside)

    def run(slice_: Column, after: Column, upto_: Column) -> Column:
        return F.struct(slice_.alias("slice"), after.alias("after"), upto_.alias("upto"))

    by_copy = F.transform(F.sequence(one, F.col("copies")), lambda k: run(slice_of(k), k - 1, k))
    by_slice = F.transform(F.sequence(first, last), lambda x: run(x, upto(x - 1), upto(x)))
    return F.when(F.col("copies") - 1 <= last - first, by_copy).otherwise(by_slice)


def _truncated(queued: DataFrame, targets: DataFrame, slices: int) -> DataFrame:
    """Adds ``taken``: the longest start of the queue, by finish time, whose words stay within all targets."""
    none = F.struct(F.lit(None).cast("long").alias("slice"), F.lit(0).cast("long").alias("after"), F.col("copies").alias("upto"))
    runs = F.explode(F.when(F.col("size") > 0, _runs(slices)).otherwise(F.array(none))).alias("run")
    queued = queued.select("*", runs).select("*", "run.*").drop("run")
    load = F.col("size") * (F.col("upto") - F.col("after"))
    sums = queued.filter("slice IS NOT NULL").groupBy("slice").agg(F.sum(load).alias("total"))
    ahead = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    edges = sums.select("slice", "total", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("before"))
    queued = queued.join(edges, "slice", "left")
    budget = F.lit(targets.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0])
    whole = F.col("before") + F.col("total") <= budget
    cut = (F.col("before") <= budget) & ~whole
    # The first copy that has no room by itself ends the queue, those behind it need no rows.
    room = F.floor((budget - F.col("before")) / F.col("size")).cast("long") + 1
    copies = F.sequence(F.col("after") + 1, F.least(F.col("upto"), F.col("after") + room))
    last = queued.filter(cut & (F.col("upto") > F.col("after"))).withColumn("copy", F.explode(copies))
    last = last.withColumn("finish", _finish(F.col("copy")))
    order = W.partitionBy("slice").orderBy("finish", "rank", "pass", "key", "doc_id", "rid", "copy")
    running = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    last = last.withColumn("taken", F.when(F.col("before") + running <= budget, F.col("copy")).otherwise(F.lit(0))).drop("copy", "finish")
    rest = queued.filter(~F.coalesce(cut, F.lit(False)))
    rest = rest.withColumn("taken", F.when(F.coalesce(whole, F.lit(False)), F.col("upto")).otherwise(F.lit(0)))
    # The copies of a pass that got in are its first ones.
    keys = ["doc_id", "rid", "source", "copies", "size", "source_size", "target", "pass", "start"]
    both = rest.select(*keys, "taken").unionByName(last.select(*keys, "taken"))
    return both.groupBy(*keys).agg(F.max("taken").alias("taken"))


def mixture_sizes(mixed: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (words) for every row that was mixed."""
    keys = ["doc_id", "rid", "source", "copies", "size", "source_size", "target"]
    per_item = mixed.groupBy(*keys).agg(F.collect_list("taken").alias("passes"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    words = F.col("size") * F.size(F.filter("passes", lambda n: n >= F.col("_copy")))
    return per_item.select("*", copy).select("doc_id", "size", "source_size", "target", words.alias("taken"))


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = MAX_REPEATS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` once for every pass that was taken, with ``mix_pass`` and ``mix_finish``, in queue order.

    Identical rows are taken one by one, in the order in which they are read. A column of ``docs`` by one of the
    new names is replaced.
    """
    taken = mix(docs, weights, share, repeats, id_col, text_col, source_col).filter("taken > 0")
    taken = taken.select(
        F.col("doc_id").alias("_i"), F.col("rid").alias("_r"), F.col("source").alias("_s"), "copies", "size", "target",
        F.col("pass").cast("int").alias("_p"), "start", "taken",
    )
    taken = stored(taken, "taken")
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
        docs[id_col].alias("_id"), text_hash(docs[text_col]).alias("_rid"), docs[source_col].cast("string").alias("_src"),
    )
    same = rows["_id"].eqNullSafe(taken["_i"]) & (rows["_rid"] == taken["_r"]) & rows["_src"].eqNullSafe(taken["_s"])
    kept = [c for c in docs.columns if c not in ("mix_pass", "mix_finish")]
    joined = rows.join(taken.filter("copies = 1"), same).withColumn("_f", _finish(F.lit(1)))
    again = taken.filter("copies > 1")
    if not again.isEmpty():
        found = ["_row", "_id", "_rid", "_src", "_p", "_f"]
        joined = joined.select(*found).unionByName(_numbered(rows, again).select(*found))
    joined = joined.orderBy("_f", "_src", "_p", "_id", "_rid")
    return joined.select(
        *[F.col("_row")[c].alias(c) for c in kept], F.col("_p").alias("mix_pass"), F.col("_f").alias("mix_finish")
    )


def _numbered(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """Identical rows, numbered, for every pass that took their number; each task numbers its own, from their count on."""
    passes = F.collect_list(F.struct("_p", "start", "taken")).alias("passes")
    items = taken.groupBy("_i", "_r", "_s", "size", "target").agg(passes)
    same = rows["_id"].eqNullSafe(items["_i"]) & (rows["_rid"] == items["_r"]) & rows["_src"].eqNullSafe(items["_s"])
    found = rows.join(items, same).withColumn("_task", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    found = stored(found, "copies")
    item = ["_id", "_rid", "_src"]
    ahead = W.partitionBy(*item).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    sums = found.groupBy(*item, "_task").agg(F.count(F.lit(1)).alias("n"))
    sums = sums.select(*item, "_task", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy(*item, "_task").orderBy("_at"))
    found = found.withColumn("own", own).alias("f").join(
        sums.alias("s"),
        [F.col(f"f.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*item, "_task"]],
    ).select("f.*", (F.col("own") + F.col("before")).alias("copy"))
    found = found.select("*", F.explode("passes").alias("got")).select("*", "got.*").filter(F.col("copy") <= F.col("taken"))
    return found.withColumn("_f", _finish(F.col("copy")))
