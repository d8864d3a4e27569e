"""Near-duplicate vectors by a subspace pigeonhole join."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import map_arrow, stored
from lakelayers.llm.components import components
from lakelayers.llm.pairs import merged_links

MIN_COSINE = 0.95
BLOCKS = 4
# Leading coordinates of a block that its grid uses.
GRID = 2
# Vectors of a cell that meet in one task with as many of another; larger cells are cut.
CHUNK = 8192
ROWS_AT_ONCE = 512
PAIRS_AT_ONCE = 1 << 16
# Distances are filtered in 32 bits first; budgets are widened by far more than rounding can move a distance.
SLACK = 1e-4


def valid(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@lru_cache(maxsize=8)
def _rotation(size: int) -> np.ndarray:
    """A fixed random rotation; it spreads what distinguishes vectors evenly over the blocks."""
    return np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))[0]


def _bounds(size: int, blocks: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, size, min(blocks, size) + 1).round().astype(int).tolist()
    return list(zip(edges, edges[1:], strict=False))


def _budgets(size: int, blocks: int, min_cosine: float) -> np.ndarray:
    """Squared distance allowed in each block, in proportion to its coordinates; together a little over the whole."""
    widths = np.array([b - a for a, b in _bounds(size, blocks)])
    return (2 - 2 * min_cosine + SLACK) * widths / size


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _turned(vectors: np.ndarray) -> np.ndarray:
    """The rotated unit vectors; ``einsum`` gives a row the same numbers whatever rows it comes with."""
    return np.einsum("ij,jk->ik", _unit(vectors), _rotation(vectors.shape[1]))


def _placed(classes: DataFrame, blocks: int, min_cosine: float) -> DataFrame:
    """A row per class and block: its cell, and the vector as bytes in the precision it came in."""
    narrow = classes.schema["vector"].dataType.elementType.simpleString() == "float"

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy()
            flat, at = batch.column(2).flatten().to_numpy().astype(np.float64), np.r_[0, np.cumsum(sizes)]
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                vectors = flat[at[rows][:, None] + np.arange(size)]
                turned = _turned(vectors)
                packed = [v.tobytes() for v in (vectors.astype(np.float32) if narrow else vectors)]
                radius = np.sqrt(_budgets(int(size), blocks, min_cosine))
                for b, (low, high) in enumerate(_bounds(int(size), blocks)):
                    lead = turned[:, low : min(high, low + GRID)]
                    cells = np.zeros((len(rows), GRID), np.int32)
                    cells[:, : lead.shape[1]] = np.floor(lead / max(radius[b], 1e-9))
                    columns = [
                        pa.array(np.full(len(rows), size, np.int32)), pa.array(np.full(len(rows), b, np.int32)),
                        pa.array(cells.tolist(), pa.list_(pa.int32())), batch.column(0).take(pa.array(rows)),
                        batch.column(1).take(pa.array(rows)), pa.array(packed, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    names = ["size", "block", "cell", "cid", "n", "vector"]
    schema = "size int, block int, cell array<int>, cid long, n long, vector binary"
    return map_arrow(classes.select("cid", "n", "vector"), place, schema)


def _tiles(cells: DataFrame) -> DataFrame:
    """``tile, side, self`` by cell and chunk: every two chunks of the same or of adjacent cells are one tile."""
    steps = F.array(*[F.array(*map(F.lit, step)) for step in product((-1, 0, 1), repeat=GRID) if step >= (0,) * GRID])
    ahead = cells.select("size", "block", "cell", "chunks", F.explode(steps).alias("step"))
    ahead = ahead.withColumn("other", F.zip_with("cell", "step", lambda c, s: c + s))
    others = cells.select("size", "block", F.col("cell").alias("other"), F.col("chunks").alias("other_chunks"))
    near = ahead.join(others, ["size", "block", "other"])
    near = near.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    near = near.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("other_chunks") - 1)))
    same = F.col("cell") == F.col("other")
    near = near.filter(~same | (F.col("i") <= F.col("j")))
    near = near.withColumn("tile", F.xxhash64("size", "block", "cell", "i", "other", "j"))
    near = near.withColumn("self", same & (F.col("i") == F.col("j")))
    sides = F.array(
        F.struct(F.col("cell").alias("cell"), F.col("i").alias("chunk"), F.lit(0).alias("side")),
        F.struct(F.col("other").alias("cell"), F.col("j").alias("chunk"), F.lit(1).alias("side")),
    )
    sides = F.when(F.col("self"), F.slice(sides, 1, 1)).otherwise(sides)
    return near.select("size", "block", "tile", "self", F.explode(sides).alias("s")).select(
        "size", "block", "s.cell", "s.chunk", "tile", "s.side", "self"
    )


class _Tile:
    """The rows of one tile as matrices."""

    def __init__(self, rows: pa.Table) -> None:
        self.size, self.block = rows["size"][0].as_py(), rows["block"][0].as_py()
        self.alone = rows["self"][0].as_py()
        self.cid, self.n = rows["cid"].to_numpy(), rows["n"].to_numpy()
        side = rows["side"].to_numpy()
        self.left = np.flatnonzero(side == 0)
        self.right = self.left if self.alone else np.flatnonzero(side == 1)
        data = b"".join(rows["vector"].to_pylist())
        narrow = len(data) == 4 * self.size * len(side)
        vectors = np.frombuffer(data, np.float32 if narrow else np.float64).reshape(len(side), self.size)
        self.vectors = vectors.astype(np.float64)
        self.turned = _turned(self.vectors)

    def links(self, blocks: int, min_cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row pairs linked, each only in the first block whose budget it keeps."""
        bounds, budgets = _bounds(self.size, blocks), _budgets(self.size, blocks, min_cosine)
        low, high = bounds[self.block]
        own = self.turned[:, low:high].astype(np.float32)
        square = (own * own).sum(1)
        unit = _unit(self.vectors)
        for at in range(0, len(self.left), ROWS_AT_ONCE):
            left = self.left[at : at + ROWS_AT_ONCE]
            near = square[left][:, None] + square[self.right] - 2 * (own[left] @ own[self.right].T)
            i, j = np.nonzero(near <= budgets[self.block] + SLACK)
            i, j = left[i], self.right[j]
            if self.alone:
                i, j = i[i < j], j[i < j]
            for cut in range(0, len(i), PAIRS_AT_ONCE):
                a, b = i[cut : cut + PAIRS_AT_ONCE], j[cut : cut + PAIRS_AT_ONCE]
                gap = (self.turned[a] - self.turned[b]) ** 2
                kept = np.stack([gap[:, x:y].sum(1) for x, y in bounds], axis=1) <= budgets
                first = kept[:, self.block] & ~kept[:, : self.block].any(1)
                a, b = a[first], b[first]
                linked = np.einsum("ij,ij->i", unit[a], unit[b]) >= min_cosine
                if linked.any():
                    yield a[linked], b[linked]


def _tile_links(tile: _Tile, blocks: int, min_cosine: float) -> pa.RecordBatch:
    """Numbers of links (``b`` null) and a forest of the links (``n`` null) of one tile."""
    counts, found = np.zeros(len(tile.cid), np.int64), []
    for a, b in tile.links(blocks, min_cosine):
        counts += np.bincount(a, tile.n[b], len(counts)).astype(np.int64)
        counts += np.bincount(b, tile.n[a], len(counts)).astype(np.int64)
        found = [merged_links([*found, (tile.cid[a], tile.cid[b])])]
    some = np.flatnonzero(counts)
    a, b = merged_links(found)
    ends = pa.array(np.r_[np.zeros(len(some), np.int64), b], mask=np.r_[np.ones(len(some), bool), np.zeros(len(b), bool)])
    n = pa.array(np.r_[counts[some], np.zeros(len(b), np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(np.r_[tile.cid[some], a]), ends, n], ["a", "b", "n"])


def class_links(classes: DataFrame, min_cosine: float, blocks: int, chunk: int) -> DataFrame:
    """``a, b, n``: link counts of the classes ``cid, n, vector`` by tile, and links that join what is linked.

    Two unit vectors with a cosine of ``min_cosine`` are at most ``2 - 2 * min_cosine`` apart (squared). Cut into
    blocks of coordinates, at least one block keeps its share of that. So each block is joined by itself within
    its share: a grid over its leading coordinates, with cells as wide as the radius, brings together what lies
    in adjacent cells. Pairs within the share are compared exactly, in double precision, by the first of the
    blocks that finds them. Pairs never leave a task: it returns sums per vector and a forest.
    """
    placed = stored(_placed(classes, blocks, min_cosine), "blocks")
    cells = placed.groupBy("size", "block", "cell").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    cells = stored(cells, "cells")
    tiles = _tiles(cells)
    own = placed.join(cells, ["size", "block", "cell"])
    own = own.withColumn("chunk", F.pmod(F.xxhash64("cid", F.lit("chunk")), F.col("chunks")).cast("int"))
    dealt = own.join(tiles, ["size", "block", "cell", "chunk"]).select(
        "tile", "side", "self", "size", "block", "cid", "n", "vector"
    )
    dealt = dealt.repartition("tile").sortWithinPartitions("tile", "side")

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            tile = batch.column(0).to_numpy()
            heads = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]]) if len(tile) else []
            for at, end in zip(heads, [*heads[1:], len(tile)], strict=True):
                if parts and tile[at] != last:
                    yield _tile_links(_Tile(pa.Table.from_batches(parts)), blocks, min_cosine)
                    parts = []
                parts.append(batch.slice(at, end - at))
                last = tile[at]
        if parts:
            yield _tile_links(_Tile(pa.Table.from_batches(parts)), blocks, min_cosine)

    return map_arrow(dealt, linked, "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame,
    min_cosine: float = MIN_COSINE,
    blocks: int = BLOCKS,
    chunk: int = CHUNK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row, whatever its other columns.

    Equal vectors meet as one class first, so a vector that a third of the rows repeat is one row from there on.
    Vectors that are null, empty or zero, or hold null or non-finite components, have no links and are
    components of their own. Vectors of different lengths have no links. Each repeated row counts as a vector;
    a null id is larger than all others. An empty table gives an empty table.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    rows = rows.withColumn("usable", valid(F.col("vector")))
    classes = rows.filter("usable").groupBy("vector").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    # Numbers, not hashes: no two different vectors share one.
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    found = stored(class_links(classes, min_cosine, blocks, chunk), "links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("links"))
    joined = components(found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "cid")
    grouped = classes.select("cid", "n", "least").join(joined, "cid", "left").join(counts, "cid", "left")
    grouped = stored(grouped.withColumn("component", F.coalesce("component", "cid")), "grouped")
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    links = (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links")
    named = grouped.join(least, "component").select("cid", links, "component_id")
    named = stored(named.join(classes.select("cid", "vector"), "cid").drop("cid"), "named")
    linked = rows.filter("usable").join(named, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id", kept)
