"""SimHash near-dedup with a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import map_arrow, stored, text_hash
from lakelayers.llm.components import components
from lakelayers.llm.pairs import merged_links, runs_of, spans_product

# Fixed values of the contract.
SHINGLE = 4
MAX_BITS = 4
SEED = 42
# Members of a bin that meet in one task; larger bins are cut into pairs of such chunks.
CHUNK = 4096
LEAF = 32
# Codes that a bin of the index holds on average before its masks are widened.
IN_BIN = 64
PIECE = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint; ``bytes.lower`` and ``bytes.split`` know ASCII letters and white space only."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle, len(words))
    firsts = [0, *(ends[: len(words) - size] + 1).tolist()]
    lasts = ends[size - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(lasts), PIECE):
        spans = zip(firsts[at : at + PIECE], lasts[at : at + PIECE], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(lasts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, rid, fp`` of every row; the fingerprint as a signed long."""

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle) for text in batch.column(2)]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], ["doc_id", "rid", "fp"])

    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_hash(F.col(text_col)).alias("rid"), F.col(text_col).cast("binary").alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, scored, f"doc_id {kind}, rid long, fp long")


def gray_rank(code: Column) -> Column:
    """Place of a bit pattern in Gray order: every bit becomes the parity of itself and all higher bits."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code


def _patterns(max_bits: int, agreeing: int) -> list[int]:
    """Masks of ``agreeing`` whole blocks out of ``max_bits + agreeing``: codes within ``max_bits`` agree on one mask at least."""
    edges = np.linspace(0, 64, max_bits + agreeing + 1).round().astype(int).tolist()
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(blocks, agreeing)]


def agreeing_blocks(n: int, max_bits: int = MAX_BITS) -> int:
    """How many blocks a mask has: enough that a bin holds about ``IN_BIN`` of ``n`` codes or fewer, 2 to 4.

    With 4 bits two blocks are 21 bits and 15 masks, three 27 bits and 35 masks, four 32 bits and 70 masks: more
    copies of a code, so wider masks pay only for many codes.
    """
    return next((k for k in (2, 3) if n <= IN_BIN << (64 * k // (max_bits + k))), 4)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def code_links(codes: DataFrame, max_bits: int = MAX_BITS, agreeing: int = 2) -> DataFrame:
    """Links ``a, b`` between distinct codes ``fp`` that connect just what lies within ``max_bits`` bits.

    The roots of the index are masked bit patterns: for each of the masks (``agreeing`` blocks of bits, see
    :func:`agreeing_blocks`), the codes that share the masked bits are one bin, in which these bits add no difference. Bins of one code are left out; a bin of more than
    ``CHUNK`` codes becomes pairs of chunks, so that no task holds a whole large bin. A task has its codes in
    Gray order, where neighbours differ in few bits, and builds the lower nodes over runs of them: the bits that
    all codes of a run share. Two nodes whose shared bits differ in too many places are dropped with all their
    codes. Links found are thinned to a forest with the same components.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in _patterns(max_bits, agreeing)])
    binned = codes.select("fp", F.posexplode(masks).alias("t", "mask"))
    binned = binned.select("fp", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sizes = binned.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    placed = binned.join(sizes.select("t", "key", chunks.alias("chunks")), ["t", "key"])
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks")).cast("int"))
    own = F.col("chunk")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j"), (own > o).cast("int").alias("side")),
    )
    spread = placed.select("fp", "t", "key", F.explode(tiles).alias("tile"))
    spread = spread.select(
        "fp", F.xxhash64("t", "key", "tile.i", "tile.j").alias("tile"), "t", "key", F.col("tile.i").alias("i"),
        F.col("tile.j").alias("j"), F.col("tile.side").alias("side"), gray_rank(F.col("fp")).alias("gray"),
    )
    order = ["t", "key", "i", "j", "side", "gray"]
    dealt = spread.repartition("t", "key", "i", "j").sortWithinPartitions(*order)

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            a, b = near_codes(*table, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return map_arrow(dealt.select("tile", "side", "fp", (F.col("i") == F.col("j")).alias("self")), linked, "a long, b long")


def _whole_tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The sorted rows in parts that end where a tile ends; a tile is two chunks at most."""
    kept: tuple[np.ndarray, ...] | None = None
    for batch in batches:
        part = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        kept = part if kept is None else tuple(np.concatenate(x) for x in zip(kept, part, strict=True))
        ends = np.flatnonzero(kept[0][1:] != kept[0][:-1])
        if len(ends):
            cut = ends[-1] + 1
            yield tuple(x[:cut] for x in kept)
            kept = tuple(x[cut:] for x in kept)
    if kept is not None and len(kept[0]):
        yield kept


def near_codes(
    tile: np.ndarray, side: np.ndarray, fp: np.ndarray, alone: np.ndarray, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the pairs within ``max_bits`` in each tile: within a chunk, or across its two sides."""
    codes = fp.view(np.uint64)
    group = np.cumsum(np.r_[False, (tile[1:] != tile[:-1]) | (side[1:] != side[:-1])])
    leaf_at, leaf_n = runs_of(group, LEAF)
    top_at, top_n = runs_of(group[leaf_at], LEAF)
    every, some = np.bitwise_and.reduceat(codes, leaf_at), np.bitwise_or.reduceat(codes, leaf_at)
    leaf = (every, ~(every ^ some))
    every, some = np.bitwise_and.reduceat(every, top_at), np.bitwise_or.reduceat(some, top_at)
    top = (every, ~(every ^ some))

    def close(node: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count((node[0][a] ^ node[0][b]) & node[1][a] & node[1][b]) <= max_bits

    # Upper nodes of one tile meet: in a chunk's own tile the later with the earlier, else one side with the other.
    first = leaf_at[top_at]
    tops_at, tops_n = runs_of(np.cumsum(np.r_[False, tile[first][1:] != tile[first][:-1]]), None)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for a, b in spans_product(tops_at, tops_n, tops_at, tops_n):
        fits = (a <= b) & (alone[first[a]] | (side[first[a]] < side[first[b]])) & close(top, a, b)
        a, b = a[fits], b[fits]
        for c, d in spans_product(top_at[a], top_n[a], top_at[b], top_n[b]):
            fits = (c <= d) & close(leaf, c, d)
            c, d = c[fits], d[fits]
            for i, j in spans_product(leaf_at[c], leaf_n[c], leaf_at[d], leaf_n[d]):
                fits = (i < j) & (np.bitwise_count(codes[i] ^ codes[j]) <= max_bits)
                if fits.any():
                    found.append((i[fits], j[fits]))
                    if sum(len(x) for x, _ in found) > 1 << 21:
                        found = [merged_links(found)]
    a, b = merged_links(found)
    return fp[a], fp[b]


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, rid, fp, component_id, keeper`` for every row.

    ``component_id`` is the smallest id reachable over fingerprints that differ in ``max_bits`` bits or fewer;
    ``keeper`` marks the rows of the smallest id (of its smallest text hash, if one id has several texts).
    Rows of one fingerprint meet as one, so copies cost nothing. A null or wordless text has fingerprint zero
    and links like any other. A null id is larger than every other id; repeated rows get the same result.
    Empty tables give empty tables.
    """
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("least")
    codes = stored(rows.groupBy("fp").agg(least), "codes")
    joined = components(code_links(codes.select("fp"), max_bits, agreeing_blocks(codes.count(), max_bits)))
    grouped = codes.join(joined.withColumnRenamed("node", "fp"), "fp", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "fp"))
    best = grouped.groupBy("component").agg(F.min("least").alias("best"))
    named = grouped.select("fp", "component").join(best, "component").select("fp", "best")
    result = rows.join(named, "fp")
    keeper = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("rid") == F.col("best.rid"))
    return result.select("doc_id", "rid", "fp", F.col("best.doc_id").alias("component_id"), keeper.alias("keeper"))


def first_of_each(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of ``docs`` for each component, columns as before.

    Of rows with equal id and text the one whose other columns have the lowest hash stays, the same one in every run
    (columns of maps, which have no hash, are not looked at). A null text is a document like any other; an empty table gives an
    empty table.
    """
    kept = near_duplicates(docs, shingle, max_bits, id_col, text_col).filter("keeper")
    kept = kept.select(F.col("doc_id").alias("_kid"), F.col("rid").alias("_krid")).distinct()
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
        docs[id_col].alias("_id"),
        text_hash(docs[text_col]).alias("_rid"),
    )
    joined = rows.join(kept, rows["_id"].eqNullSafe(kept["_kid"]) & (rows["_rid"] == kept["_krid"]))
    hashed = [F.col("_row")[c] for c, kind in docs.dtypes if "map<" not in kind]
    single = joined.groupBy("_id", "_rid").agg(F.min_by("_row", F.xxhash64(*hashed)).alias("_row"))
    return single.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
