"""Source divergence audit: how far the term shares of each source lie from those of its language's other sources."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakelayers.llm.common import UPPER, apply_arrow, map_arrow, stored

# Fixed values of the contract: documents of a language that a kept term is in, shares in parts per this, reported terms.
MIN_DOCS = 3
UNIT = 1_000_000_000
TOP_TERMS = 200

# Different terms that a task holds before it passes its counts on, and bytes of a text that it splits at a time.
HELD = 200_000
PIECE = 1 << 20
# Postings of a slice of the index, and sources of a block; together they bound what a task holds.
SLICE = 200_000
BLOCK = 512
CELLS = 1 << 20

COUNTS = "lang string, source string, term string, n long, docs long"
PARTIAL = "lang string, source string, item string, value long"

# Letters stay, A-Z in lower case, bytes of other characters stay, all else ends a term.
_LETTERS = bytes(b + 32 if chr(b) in UPPER else b if b > 127 or chr(b).lower() in UPPER.lower() else 32 for b in range(256))


def divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: per source of a language its distance to each other source, and its terms.

    Terms are counted per (language, source); a language keeps those in at least ``min_docs`` of its documents. A
    share is 1 plus the whole part of a thousand million times (count + 1) / (counts + terms), in whole numbers throughout. The distance of
    two shares p and q is the whole part of (p - q)^2 / q. Part ``pair`` sums it over all kept terms, part ``term`` lists
    the ``top_terms`` terms whose share most exceeds the language's.

    The pair sums follow Gustavson's scheme. The term-major index, cut into slices of terms, holds for each term the
    sources it occurs in; a task takes one source after the other and scatters its terms through the index into a dense array with a cell per
    peer. Only one partial sum per two sources leaves a slice, no pair of postings. Terms that one or both of two
    sources lack enter as a baseline from the sources' different shares and their numbers; the scatter corrects
    it where both have the term. Languages with over ``BLOCK`` sources are cut into pairs of blocks of them.

    Every row is a document, also repeated rows. A null text, language or source is the empty string. A source without
    kept terms has pairs, no terms; the value of a pair is 0 if the language keeps no term. Equal values rank by UTF-8. Empty ``docs``
    give an empty table.
    """
    filled = [F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in (("lang", lang_col), ("source", source_col), ("text", text_col))]
    rows = docs.select(*filled)
    postings = stored(_postings(rows, min_docs), "postings")
    groups = stored(_groups(rows.select("lang", "source").distinct(), postings), "groups")

    # A row per source: adaptive execution sends it along if it is small, or splits a hot source's postings.
    sized = postings.join(groups.select("lang", "source", "size", "terms", "lang_size", "slices", "blocks"), ["lang", "source"])
    shares = sized.withColumns(
        {
            "p": share(F.col("n"), F.col("size"), F.col("terms")),
            "q": share(F.col("total"), F.col("lang_size"), F.col("terms")),
        }
    )
    pair = _ranked(_pairs(shares, groups)).withColumn("part", F.lit("pair"))
    above = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), distance("p", "q").alias("value"))
    term = _ranked(above).filter(F.col("rank") <= top_terms).withColumn("part", F.lit("term"))
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")


def share(count: Column, size: Column, terms: Column) -> Column:
    """Exact also for counts that leave a long on multiplication."""
    above = (count + 1).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, (size + terms).cast("decimal(19,0)"))


def distance(p: str, q: str) -> Column:
    off = F.col(p) - F.col(q)
    return F.call_function("div", off * off, F.col(q))


def _ranked(values: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return values.withColumn("rank", F.row_number().over(order))


def _postings(rows: DataFrame, min_docs: int) -> DataFrame:
    """The term-major index: per kept term and source its count ``n``, beside the language's ``total``.

    Map tasks sum before the shuffle. That is by language and term and serves the sums of each source as well as
    those of the language. ``first`` marks one row of each term.
    """
    partial = map_arrow(rows, _count_terms, COUNTS).repartition("lang", "term")
    counts = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = W.partitionBy("lang", "term")
    whole = counts.withColumns(
        {
            "total": F.sum("n").over(own),
            "docs": F.sum("docs").over(own),
            "first": F.col("source") == F.min("source").over(own),
        }
    )
    return whole.filter(F.col("docs") >= min_docs).drop("docs")


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, docs = defaultdict(Counter), defaultdict(Counter)
    for batch in batches:
        texts = batch["text"].cast(pa.large_binary())
        for lang, source, text in zip(batch["lang"], batch["source"], texts):
            key = lang.as_py(), source.as_py()
            own = set()
            for words in _words(text.as_py()):
                found[key].update(words)
                own.update(words)
            docs[key].update(own)
            if len(found[key]) > HELD:
                yield from _counted({key: found.pop(key)}, docs)
        if sum(map(len, found.values())) > HELD:
            yield from _counted(found, docs)
            found.clear()
    yield from _counted(found, docs)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    rest = b""
    for start in range(0, len(text), PIECE):
        piece = rest + text[start : start + PIECE].translate(_LETTERS)
        cut = len(piece) if start + PIECE >= len(text) else piece.rfind(b" ") + 1
        yield piece[:cut].split()
        rest = piece[cut:]


def _counted(found: dict[tuple[str, str], Counter], docs: dict[tuple[str, str], Counter]) -> Iterator[pa.RecordBatch]:
    for (lang, source), counter in found.items():
        own = docs.pop((lang, source))
        n = len(counter)
        if n:
            columns = [
                pa.array([lang] * n, pa.string()),
                pa.array([source] * n, pa.string()),
                pa.array(list(counter), pa.binary()).cast(pa.string(), safe=False),
                pa.array(list(counter.values()), pa.int64()),
                pa.array([own[t] for t in counter], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def _groups(groups: DataFrame, postings: DataFrame) -> DataFrame:
    """A row per source: its kept words, its language's kept words and terms, and into how many slices and blocks the language is cut."""
    zero = F.lit(0).cast("long")
    sizes = postings.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("n"))
    rows = groups.join(sizes, ["lang", "source"], "left").fillna(0, ["size", "n"])
    kept = postings.groupBy("lang").agg(F.sum("n").alias("lang_size"), F.count_if("first").alias("terms"))
    # Languages are reduced before they meet; what is joined by language has one row for each.
    langs = rows.groupBy("lang").agg(F.sum("n").alias("postings"), F.count(F.lit(1)).alias("sources"))
    langs = stored(langs.join(kept, "lang", "left"), "languages")
    parts = lambda n, most: F.greatest(F.ceil(F.col(n) / most), F.lit(1)).cast("int")
    langs = langs.select(
        "lang",
        F.coalesce("lang_size", zero).alias("lang_size"),
        F.coalesce("terms", zero).alias("terms"),
        parts("postings", SLICE).alias("slices"),
        parts("sources", BLOCK).alias("blocks"),
    )
    return stored(rows, "sources").join(langs, "lang").drop("n")


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum of distances for each two sources of a language, both ways."""
    nothing = F.lit(None).cast("string")
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    of_terms = shares.select(
        "lang",
        F.pmod(F.xxhash64("term"), F.col("slices")).cast("int").alias("slice"),
        "source",
        "term",
        "p",
        F.lit(0).cast("long").alias("terms"),
        "blocks",
        block.alias("block"),
    )
    # Every slice needs the share of a term that a source lacks; the first one counts the language's terms.
    lacking = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("size"), F.greatest("terms", F.lit(1))))
    heads = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")).select(
        "lang",
        "slice",
        "source",
        nothing.alias("term"),
        F.coalesce(lacking, F.lit(1).cast("long")).alias("p"),
        F.when(F.col("slice") == 0, F.col("terms")).otherwise(F.lit(0).cast("long")).alias("terms"),
        "blocks",
        block.alias("block"),
    )
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = lambda x: F.struct(F.col("block").alias("left"), x.alias("right"))
    other = lambda x: F.struct(x.alias("left"), F.col("block").alias("right"))
    tasks = F.array_distinct(F.concat(F.transform(every, own), F.transform(every, other)))
    dealt = of_terms.unionByName(heads).select("*", F.inline(tasks)).drop("blocks")
    partial = apply_arrow(dealt, ["lang", "slice", "left", "right"], _accumulate, PARTIAL)
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    off = p - q
    return off * off // q


def _accumulate(rows: pa.Table) -> pa.Table:
    """The share of one slice, and of one pair of blocks, in all pair sums."""
    left, right = rows["left"][0].as_py(), rows["right"][0].as_py()
    is_head = pc.is_null(rows["term"])
    heads, rows = rows.filter(is_head), rows.filter(pc.invert(is_head))
    head_block = heads["block"].to_numpy()
    names, lacking, n_terms = heads["source"].combine_chunks(), heads["p"].to_numpy(), heads["terms"].to_numpy()
    number = pc.index_in(rows["source"], value_set=names).to_numpy()
    term = pc.index_in(rows["term"], value_set=pc.unique(rows["term"])).to_numpy()
    share, block = rows["p"].to_numpy(), rows["block"].to_numpy()

    # The index of the right block by term, and its cells in the dense array.
    peers = np.flatnonzero(head_block == right)
    cell = np.full(len(names), -1)
    cell[peers] = np.arange(len(peers))
    there = np.flatnonzero(block == right)
    there = there[np.argsort(term[there], kind="stable")]
    peer, q = cell[number[there]], share[there]
    start = np.searchsorted(term[there], np.arange(term.max(initial=-1) + 2))
    q0 = lacking[peers]
    # Different shares of each peer and how many of its terms have them.
    by_share = np.lexsort((q, peer))
    change = np.flatnonzero(np.diff(peer[by_share], prepend=-1) | np.diff(q[by_share], prepend=-1))
    seen_peer, seen_q = peer[by_share][change], q[by_share][change]
    seen = np.diff(change, append=len(by_share))
    peer_terms = np.bincount(peer, minlength=len(peers))

    by_source = np.argsort(number, kind="stable")
    first = np.searchsorted(number[by_source], np.arange(len(names) + 1))
    found = [(np.zeros(0, np.int64),) * 3]
    for g in np.flatnonzero(head_block == left):
        mine = by_source[first[g] : first[g + 1]]
        p, p0 = share[mine], lacking[g]
        both_lack = _distance(p0, q0)
        # Baseline, as if no term were in both: terms of neither, terms of this source, terms of the peer.
        total = both_lack * (n_terms[g] - len(mine) - peer_terms)
        values, many = np.unique(p, return_counts=True)
        step = max(1, CELLS // max(1, len(q0)))
        for i in range(0, len(values), step):
            total += many[i : i + step] @ _distance(values[i : i + step, None], q0)
        np.add.at(total, seen_peer, seen * _distance(p0, seen_q))
        # Scatter: every posting of this source's terms goes to its peer's cell and mends the baseline.
        lengths = start[term[mine] + 1] - start[term[mine]]
        ends = np.cumsum(lengths)
        for i, j in _runs(ends):
            n, begin = lengths[i:j], ends[i] - lengths[i]
            at = np.repeat(start[term[mine[i:j]]] - (ends[i:j] - n), n) + np.arange(begin, ends[j - 1])
            to, theirs, ours = peer[at], q[at], np.repeat(p[i:j], n)
            mend = _distance(ours, theirs) - _distance(ours, q0[to]) - _distance(p0, theirs) + both_lack[to]
            np.add.at(total, to, mend)
        others = peers != g
        found.append((np.full(others.sum(), g), peers[others], total[others]))
    own, item, value = (np.concatenate(x) for x in zip(*found))
    lang = pa.repeat(heads["lang"][0], len(value))
    columns = [lang, names.take(pa.array(own)), names.take(pa.array(item)), pa.array(value, pa.int64())]
    return pa.table(columns, names=["lang", "source", "item", "value"])


def _runs(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of terms with about ``CELLS`` postings together."""
    i = 0
    while i < len(ends):
        before = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + CELLS, "right")))
        yield i, j
        i = j
