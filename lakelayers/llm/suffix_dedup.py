"""Suffix-array dedup: bytes of strings that start earlier in the corpus go."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.llm.common import map_arrow, stored, text_hash

LENGTH = 100
# A string of LENGTH bytes holds SPAN grams of GRAM bytes; the least by hash are its anchors.
GRAM = 32
SPAN = LENGTH - GRAM + 1
PIECE = 1 << 17
# An anchor's strings start 0 to SPAN - 1 bytes before it. Those of one part share all but a few of their bytes.
PARTS = (0, 18, 35, 52, SPAN)
# Surroundings of one gram that are sorted together; the strings around a gram with more are dealt out one by one.
TOGETHER = 20_000
ROWS_AT_ONCE = 8_000


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C55
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(2 * PIECE + 8 * LENGTH, factor, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def _sliding(pick: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class Anchors:
    """The anchors of some texts, by text and place, with what their strings cover.

    Every string of ``LENGTH`` bytes holds an anchor, and which grams of it are anchors depends on its bytes
    alone. The surroundings of an anchor are all strings that hold it, cut at the ends of the text. ``text`` is the
    number of the text, ``place`` where the gram begins in it, ``gram`` its hash, ``around`` the hash of the
    surroundings, which go from ``begin`` to ``end``; ``again`` marks surroundings that the text has further up.
    """

    def __init__(self, texts: Sequence[bytes]) -> None:
        sizes = np.array([len(t) for t in texts], np.int64)
        found = [_anchors_of(block, sizes) for block in _blocks(texts)]
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 4
        self.text, self.place, self.gram, self.around = columns
        if (sizes > PIECE).any():
            # Two pieces of a long text may both have found an anchor between them.
            by = np.lexsort((self.place, self.text))
            columns = [x[by] for x in columns]
            new = np.r_[True, (np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)][: len(by)]
            self.text, self.place, self.gram, self.around = (x[new] for x in columns)
        self.begin = np.maximum(self.place - SPAN + 1, 0)
        self.end = np.minimum(self.place + LENGTH, sizes[self.text])
        self.keys = self.around.view(np.uint64) ^ _mixed(self.text.astype(np.uint64) + np.uint64(1))
        by = np.argsort(self.keys, kind="stable")
        self.again = np.zeros(len(by), bool)
        self.again[by[1:][self.keys[by[1:]] == self.keys[by[:-1]]]] = True

    def among(self, lists: Sequence[Sequence[int] | None]) -> np.ndarray:
        """Which anchors have surroundings that the list of their text names."""
        wanted = np.array([x for own in lists for x in own or ()], np.int64).view(np.uint64)
        owner = np.repeat(np.arange(len(lists)), [len(own or ()) for own in lists]).astype(np.uint64)
        return np.isin(self.keys, wanted ^ _mixed(owner + np.uint64(1)))


def _blocks(texts: Sequence[bytes]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Texts long enough to matter, ``(number, from, owned from, bytes)``, about a piece together; long ones in pieces.

    A piece owns the strings that start in it, and sees the surroundings of their anchors.
    """
    block, held = [], 0
    for number, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, PIECE):
            low = max(0, at - SPAN)
            block.append((number, low, at, text[low : at + PIECE + 3 * LENGTH]))
            held += len(block[-1][3])
            if held >= PIECE:
                yield block
                block, held = [], 0
    if block:
        yield block


def _anchors_of(block: list[tuple[int, int, int, bytes]], sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(b"".join(x[3] for x in block), np.uint8)
    up, down = _powers()
    sums = np.zeros(len(raw) + 1, np.uint64)
    terms = raw.astype(np.uint64)
    terms += np.uint64(1)
    terms *= up[: len(raw)]
    np.cumsum(terms, out=sums[1:])
    grams = sums[GRAM:] - sums[:-GRAM]
    grams *= down[: len(grams)]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    # The least is decided by the upper half; on a tie all are anchors.
    ranks = (grams >> np.uint64(32)).astype(np.uint32)
    least = _sliding(np.minimum, ranks, SPAN)
    ends = np.cumsum([len(x[3]) for x in block])
    owned = np.zeros(len(least), bool)
    for (_, low, at, data), end in zip(block, ends.tolist(), strict=True):
        first = end - len(data)
        owned[first + at - low : min(first + at - low + PIECE, end - LENGTH + 1)] = True
    least[~owned] = 0
    edge = np.zeros(SPAN - 1, np.uint32)
    found = np.flatnonzero((_sliding(np.maximum, np.concatenate([edge, least, edge]), SPAN) == ranks) & (ranks > 0))
    piece = np.searchsorted(ends, found, "right")
    number, low = (np.array([x[i] for x in block], np.int64)[piece] for i in (0, 1))
    first = ends[piece] - np.array([len(x[3]) for x in block])[piece]
    place = found - first + low
    before = np.minimum(place, SPAN - 1)
    after = np.minimum(sizes[number] - place, LENGTH)
    begin, end = found - before, found + after
    shape = (before * 1000 + after).astype(np.uint64)
    around = _mixed((sums[end] - sums[begin]) * down[begin] + shape * np.uint64(0xC2B2AE3D27D4EB4F))
    return number, place, grams[found].view(np.int64), around.view(np.int64)


def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Order of the suffixes that start at ``wanted`` (ascending), by their first ``depth`` bytes at least.

    Only suffixes smaller than their successors are sorted directly. Each other suffix follows from its
    successor, which lies in an earlier place: buckets by first byte are scanned in order, and what stands
    before each suffix is appended to its own bucket. ``text`` ends in a zero and ``depth + 8`` zeros more.
    """
    size = len(text) - depth - 8
    step = np.sign(text[1 : size + 1].astype(np.int16) - text[:size])
    later = np.where(step != 0, np.arange(size, dtype=np.int32), np.int32(size - 1))
    decided = np.minimum.accumulate(later[::-1])[::-1]
    smaller = (step[decided] > 0) | (decided == size - 1)
    # A larger suffix needs its successor, up to the next smaller one.
    stops = np.flatnonzero(smaller)
    until = stops[np.searchsorted(stops, wanted)]
    delta = np.zeros(size + 1, np.int32)
    np.add.at(delta, wanted, 1)
    np.add.at(delta, until + 1, -1)
    needed = np.cumsum(delta[:-1]) > 0

    direct = np.flatnonzero(needed & smaller)
    width = -(-depth // 8) * 8
    keys = np.lib.stride_tricks.sliding_window_view(text, width)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(keys).view(f"S{width}").ravel(), kind="stable")]
    heads = np.searchsorted(text[direct], np.arange(257))
    induced = needed & ~smaller
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for byte in range(256):
        bucket = waiting[byte]
        level = np.concatenate(bucket) if bucket else np.empty(0, np.int64)
        bucket = [level]
        while len(level):
            before = level[level > 0] - 1
            level = before[induced[before] & (text[before] == byte)]
            bucket.append(level)
        full = np.concatenate([*bucket, direct[heads[byte] : heads[byte + 1]]])
        if not len(full):
            continue
        order.append(full)
        before = full[full > 0] - 1
        before = before[induced[before] & (text[before] > byte)]
        before = before[np.argsort(text[before], kind="stable")]
        chars, firsts = np.unique(text[before], return_index=True)
        for char, part in zip(chars, np.split(before, firsts[1:]), strict=False):
            waiting[char].append(part)
    full = np.concatenate(order) if order else np.empty(0, np.int64)
    chosen = np.zeros(size, bool)
    chosen[wanted] = True
    return full[chosen[full]]


def adjacent_prefixes(text: np.ndarray, order: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Common prefix, up to ``most`` bytes, of each suffix in the order with the one before it (first: 0)."""
    words = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    prefix = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for offset in range(0, most, 8):
        differ = words[order[alive] + offset] ^ words[order[alive - 1] + offset]
        lowest = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.bitwise_count(lowest - np.uint64(1)) // 8)
        prefix[alive] += same.astype(np.int64)
        alive = alive[same == 8]
    return np.minimum(prefix, most)


def repeated_starts(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc, tie, start`` of the strings in these surroundings that another one holds earlier; some several times.

    Columns ``gram, doc, tie, begin, lead, bytes``: rows with one gram hold it ``lead`` bytes in.
    """
    frame = SPAN - 1 + LENGTH
    lead = rows["lead"].to_numpy()
    sizes = np.array([len(b) for b in rows["bytes"].to_pylist()])
    matrix = np.zeros((len(sizes), frame), np.uint8)
    inside = np.arange(frame) >= (SPAN - 1 - lead)[:, None]
    inside &= np.arange(frame) < (SPAN - 1 - lead + sizes)[:, None]
    matrix[inside] = np.frombuffer(b"".join(rows["bytes"].to_pylist()), np.uint8)
    gram, origin = rows["gram"].to_numpy(), rows["begin"].to_numpy() - (SPAN - 1 - lead)
    up, _ = _powers()
    doc, tie = rows["doc"].to_numpy(), rows["tie"].to_numpy()
    later: list[tuple[np.ndarray, np.ndarray]] = []
    # Equal strings hold their anchor at the same place, so each part of the strings is a sort of its own.
    for a, b in zip(PARTS, PARTS[1:], strict=False):
        low, high = SPAN - 1 - (b - 1), frame - a
        # Only rows whose shared bytes of this part occur twice can hold equal strings of it.
        core = slice(b - 1 - a, LENGTH)
        able = np.flatnonzero(inside[:, low:high][:, core].all(1))
        values = np.where(inside[able, low:high], matrix[able, low:high].astype(np.uint64) + np.uint64(1), np.uint64(0))
        hashes = _mixed((values[:, core] @ up[: core.stop - core.start]) ^ gram[able].view(np.uint64))
        _, group, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        twice = counts[group] > 1
        able, values = able[twice], values[twice]
        # Of rows that are equal in the whole part the first is sorted, the strings of the others go.
        whole = _mixed(values @ up[: high - low])
        by = np.lexsort((origin[able], tie[able], doc[able], whole))
        copy = np.zeros(len(able), bool)
        copy[by[1:][whole[by[1:]] == whole[by[:-1]]]] = True
        at = np.arange(b - a) + low
        fits = inside[able][:, at] & inside[able][:, at + LENGTH - 1]
        rows_at, starts_at = np.nonzero(fits & copy[:, None])
        later.append((able[rows_at], low + starts_at))
        able, fits = able[~copy], fits[~copy]
        width = high - low + 1
        rows_at, starts_at = np.nonzero(fits)
        wanted = rows_at * width + starts_at
        if not len(wanted):
            continue
        text = np.zeros(len(able) * width + LENGTH + 8, np.uint8)
        text[: len(able) * width].reshape(-1, width)[:, :-1] = matrix[able, low:high]
        order = two_stage_order(text, wanted)
        run = np.cumsum(adjacent_prefixes(text, order) < LENGTH)
        owner, shift = able[order // width], low + order % width
        # Equal strings stand together; the first of them by document and place stays.
        by = np.lexsort((origin[owner] + shift, tie[owner], doc[owner], run))
        run, owner, shift = run[by], owner[by], shift[by]
        head = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        first = np.repeat(head, np.diff(np.r_[head, len(run)]))
        start = origin[owner] + shift
        other = (doc[owner] != doc[owner[first]]) | (tie[owner] != tie[owner[first]]) | (start != start[first])
        later.append((owner[other], shift[other]))
    owner, shift = (np.concatenate([x[i] for x in later]) for i in (0, 1))
    return doc[owner], tie[owner], origin[owner] + shift


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, tie, text`` (bytes): ``tie`` orders different texts of one id, and is 0 where an id has one row."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    again = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc")
    if again.isEmpty():
        return rows.select("doc", F.lit(0).alias("tie"), F.col("text").cast("binary").alias("text"))
    texts = rows.join(again, "doc").select("doc", text_hash(F.col("text")).alias("rid")).distinct()
    ties = texts.withColumn("tie", F.row_number().over(W.partitionBy("doc").orderBy("rid")) - 1)
    joined = rows.withColumn("rid", text_hash(F.col("text"))).join(ties, ["doc", "rid"], "left")
    return joined.select("doc", F.coalesce("tie", F.lit(0)).alias("tie"), F.col("text").cast("binary").alias("text"))


def _anchor_rows(texts: DataFrame) -> DataFrame:
    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            found = Anchors(batch.column(2).to_pylist())
            once = np.flatnonzero(~found.again)
            who = [batch.column(i).take(pa.array(found.text[once])) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(found.gram[once]), pa.array(found.around[once]), *who], names)

    names = ["gram", "around", "doc", "tie"]
    long_enough = texts.filter(F.octet_length("text") >= LENGTH)
    return map_arrow(long_enough, listed, "gram long, around long, doc long, tie int")


def _parts(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows, fewer at a time: what is derived from a text takes more room than the text."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _hits(texts: DataFrame) -> DataFrame:
    """``doc, tie, gone, open, dealt``: hashes of a document's surroundings that matter, by what is to be done.

    ``gone``: equal surroundings stand in an earlier document, all their strings go. ``open``: they are the first of
    their kind, but other surroundings hold the same gram, so their strings are to be compared. ``dealt``: the
    same for a gram with very many different surroundings.
    """
    found = _anchor_rows(texts)
    twice = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    seen = stored(found.join(twice, "gram"), "anchors")
    who = F.struct("doc", "tie")
    kinds = seen.groupBy("gram", "around").agg(F.min(who).alias("first"), F.count(F.lit(1)).alias("n"))
    kinds = stored(kinds, "surroundings")
    variants = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("variants"))
    kinds = kinds.join(variants, "gram").filter("n > 1 OR variants > 1").select("around", "gram", "first", "variants")
    state = (
        F.when(F.col("first") != who, 0)
        .when(F.col("variants") > TOGETHER, 2)
        .when(F.col("variants") > 1, 1)
    )
    marked = seen.join(kinds, ["gram", "around"]).select("doc", "tie", "around", state.alias("state"))
    lists = [F.collect_set(F.when(F.col("state") == s, F.col("around"))).alias(n) for s, n in enumerate(("gone", "open", "dealt"))]
    return stored(marked.filter("state IS NOT NULL").groupBy("doc", "tie").agg(*lists), "hits")


def _compared(packed: DataFrame, hits: DataFrame) -> DataFrame:
    """``doc, tie, starts, ends``: strings that were found earlier, as spans, by document."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, found in _chosen(batches):
            at = np.flatnonzero(~found.again & found.among(batch.column(3).to_pylist()))
            begin, end, number = found.begin[at], found.end[at], found.text[at]
            cuts = [texts[n][b:e] for n, b, e in zip(number.tolist(), begin.tolist(), end.tolist(), strict=True)]
            who = [batch.column(i).take(pa.array(number)) for i in (0, 1)]
            columns = [pa.array(found.gram[at]), *who, pa.array(begin), pa.array(found.place[at] - begin)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cuts, pa.binary())], names)

    def sorted_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_grams(batches):
            doc, tie, start = repeated_starts(rows)
            by = np.lexsort((start, tie, doc))
            doc, tie, start = doc[by], tie[by], start[by]
            head = np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > start[:-1] + LENGTH)][: len(doc)]
            at = np.flatnonzero(head)
            ends = start[np.r_[at[1:], len(doc)] - 1] + LENGTH if len(at) else start
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[at], tie[at], start[at], ends)], spans)

    names = ["gram", "doc", "tie", "begin", "lead", "bytes"]
    spans = ["doc", "tie", "start", "end"]
    opened = hits.filter("size(open) > 0").select("doc", "tie", "open")
    rows = packed.join(opened, ["doc", "tie"]).select("doc", "tie", "blob", "open")
    rows = map_arrow(rows, cut, "gram long, doc long, tie int, begin long, lead long, bytes binary")
    rows = rows.repartition("gram").sortWithinPartitions("gram")
    found = map_arrow(rows, sorted_out, "doc long, tie int, start long, end long")
    dealt = hits.filter("size(dealt) > 0").select("doc", "tie", "dealt")
    if not dealt.isEmpty():
        found = found.unionByName(_dealt_out(packed, dealt))
    return found.groupBy("doc", "tie").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))


def _chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], Anchors]]:
    """Some rows at a time with their texts (third column) and anchors."""
    unpack = zstandard.ZstdDecompressor()
    for batch in _parts(batches):
        texts = [unpack.decompress(blob) for blob in batch.column(2).to_pylist()]
        yield batch, texts, Anchors(texts)


def _dealt_out(packed: DataFrame, dealt: DataFrame) -> DataFrame:
    """``doc, tie, start, end`` of strings around very frequent grams that another one holds earlier.

    Each string is a row with its 128-bit digest. Equal ones are reduced to the first in every map task before they
    meet, so neither a frequent gram nor a frequent string gathers in one task.
    """

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, found in _chosen(batches):
            at = np.flatnonzero(~found.again & found.among(batch.column(3).to_pylist()))
            sizes = np.maximum(found.end[at] - found.begin[at] - LENGTH + 1, 0)
            number = np.repeat(found.text[at], sizes)
            start = np.repeat(found.begin[at] - np.r_[0, np.cumsum(sizes)[:-1]][: len(at)], sizes) + np.arange(len(number))
            both = np.unique(np.stack([number, start]), axis=1)
            digests = [hashlib.blake2b(texts[n][s : s + LENGTH], digest_size=16).digest() for n, s in both.T.tolist()]
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            who = [batch.column(i).take(pa.array(both[0])) for i in (0, 1)]
            columns = [pa.array(halves[:, 0]), pa.array(halves[:, 1]), *who, pa.array(both[1])]
            yield pa.RecordBatch.from_arrays(columns, ["h", "g", "doc", "tie", "start"])

    rows = packed.join(dealt, ["doc", "tie"]).select("doc", "tie", "blob", "dealt")
    strings = stored(map_arrow(rows, listed, "h long, g long, doc long, tie int, start long"), "strings")
    who = F.struct("doc", "tie", "start")
    first = strings.groupBy("h", "g").agg(F.min(who).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = stored(first.select("h", "g", "first"), "first_strings")
    later = strings.join(first, ["h", "g"]).filter(F.col("first") != who)
    return later.select("doc", "tie", "start", (F.col("start") + LENGTH).alias("end"))


def _whole_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows in parts that end where a gram ends."""
    parts: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        gram = batch.column(0).to_numpy()
        ends = np.flatnonzero(gram[1:] != gram[:-1]) + 1
        if held and len(gram) and parts[-1].column(0)[-1].as_py() != gram[0]:
            ends = np.r_[0, ends]
        if held + len(gram) >= ROWS_AT_ONCE and len(ends):
            cut = int(ends[-1])
            yield pa.Table.from_batches([*parts, batch.slice(0, cut)])
            parts, held, batch = [], 0, batch.slice(cut)
        if batch.num_rows:
            parts.append(batch)
            held += batch.num_rows
    if parts:
        yield pa.Table.from_batches(parts)


def _kept(
    texts: list[bytes], gone: list[list[int] | None], starts: list[list[int] | None], ends: list[list[int] | None]
) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Bytes removed, runs removed, and what is left, of every text."""
    found = Anchors(texts)
    away = (found.again | found.among(gone)) & (found.end - found.begin >= LENGTH)
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.r_[0, np.cumsum(sizes + 1)[:-1]]  # a byte that stays stands between two texts
    owner = np.repeat(np.arange(len(texts)), [len(x or ()) for x in starts])
    spans = [np.array([x for own in lists for x in own or ()], np.int64) + base[owner] for lists in (starts, ends)]
    delta = np.zeros(int((sizes + 1).sum()) + 1, np.int32)
    np.add.at(delta, np.r_[(found.begin + base[found.text])[away], spans[0]], 1)
    np.add.at(delta, np.r_[(found.end + base[found.text])[away], spans[1]], -1)
    removed = np.cumsum(delta[:-1]) > 0
    counts = np.add.reduceat(removed, base, dtype=np.int64)
    runs = np.add.reduceat(removed & ~np.r_[False, removed[:-1]], base, dtype=np.int64)
    kept = []
    for text, at, size, n in zip(texts, base.tolist(), sizes.tolist(), runs.tolist(), strict=True):
        kept.append(np.frombuffer(text, np.uint8)[~removed[at : at + size]].tobytes() if n else text)
    return counts, runs, kept


def _by_number(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Documents ``number, text``, and ``number, _id`` of their ids: ids of any type, numbered in their order.

    Different ids are range-sorted, and the numbers rise from one sorted part to the next.
    """
    ids = docs.select(F.col(id_col).alias("_id")).filter("_id IS NOT NULL").distinct().sort("_id")
    ids = stored(ids.withColumn("number", F.monotonically_increasing_id()), "ids")
    rows = docs.select(F.col(id_col).alias("_own"), F.col(text_col).alias("text"))
    named = rows.filter("_own IS NOT NULL").join(ids, F.col("_own") == F.col("_id")).select("number", "text")
    nameless = rows.filter("_own IS NULL").select(F.lit(None).cast("long").alias("number"), "text")
    return stored(named.unionByName(nameless), "numbered"), ids


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes) for every row of ``docs``.

    A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier, in a document with a smaller
    id or further up in its own. Strings do not cross documents and are judged on the input.

    Strings are not shuffled one by one. Of every string the grams with the least hash are its anchors, so equal
    strings have equal anchors, and only anchors travel, 16 bytes for some 30 bytes of text. Anchors whose
    gram occurs once are done. Of equal surroundings (all strings around an anchor) only the first matters. The
    surroundings that remain, different texts around one gram, meet by gram; a two-stage suffix sort brings
    equal strings together, their common prefixes tell which are equal, and all but the earliest go. The strings around
    grams with more than ``TOGETHER`` different surroundings are compared by digest instead. Equality of surroundings is
    that of two hashes of 64 bits, of strings around very frequent grams that of a digest of 128 bits.

    Ids may have any type that can be ordered; whole numbers are taken as they are (the largest long stands for a null
    id), others are numbered in their order first.

    A null text is empty; a text shorter than ``LENGTH`` stays. Rows of one id with different texts are ordered by hash
    of the text; identical rows of one id are one document and get the same result. A null id is the largest
    and comes back as null. An empty table gives an empty table.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        numbered, ids = _by_number(docs, id_col, text_col)
        found = remove_repeats(numbered, "number", "text")
        named = found.filter("doc_id IS NOT NULL").join(ids, F.col("doc_id") == F.col("number"))
        nameless = found.filter("doc_id IS NULL").withColumn("_id", F.lit(None).cast(ids.schema["_id"].dataType))
        columns = [F.col("_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept"]
        return named.select(*columns).unionByName(nameless.select(*columns))
    texts = _numbered(docs, id_col, text_col)
    hits = _hits(texts)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            blobs = pa.array([squeeze.compress(text.as_py()) for text in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), blobs], ["doc", "tie", "blob"])

    packed = map_arrow(texts, pack, "doc long, tie int, blob binary").repartition("doc", "tie")

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in _parts(batches):
            texts = [unpack.decompress(blob) for blob in batch.column(1).to_pylist()]
            counts, runs, kept = _kept(texts, *(batch.column(i).to_pylist() for i in (2, 3, 4)))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), sizes, pa.array(counts), pa.array(runs), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept"]
    spans = _compared(packed, hits)
    joined = packed.join(hits.select("doc", "tie", "gone"), ["doc", "tie"], "left").join(spans, ["doc", "tie"], "left")
    result = map_arrow(
        joined.select("doc", "blob", "gone", "starts", "ends"),
        clean,
        "doc long, n_bytes long, n_removed long, n_spans long, kept binary",
    )
    doc_id = F.when(F.col("doc") < F.lit((1 << 63) - 1), F.col("doc"))
    return result.select(doc_id.alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
