"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import map_arrow

# Terms are hashed: shapes (three classes of characters in a row), words, and a few facts about the whole text.
SHAPES = 1024
WORDS = 2048
FACTS = 64
TERMS = SHAPES + WORDS + FACTS
# Labelled documents whose vectors are broadcast: 6,000 vectors of 64 numbers are 1.5 MB.
MAX_LABELLED = 6000
LATENT = 64
NEIGHBOURS = 25
AT_ONCE = 256
PIECE = 1 << 20


def _classes() -> np.ndarray:
    """Class of a byte: letter (1; bytes beyond ASCII too), capital (2), digit (3), blank (4), line end (5), or itself."""
    kinds = np.ones(256, np.int64)
    for byte in range(128):
        char = chr(byte)
        kinds[byte] = (
            1 if char.islower() else 2 if char.isupper() else 3 if char.isdigit() else 5 if char == "\n"
            else 4 if byte <= 32 or byte == 127 else 6 + byte
        )
    return kinds


CLASS = _classes()
POWERS = np.cumprod(np.r_[1, np.full(63, 0x100000001B3, np.uint64)].astype(np.uint64))


def _mixed(values: np.ndarray, size: int) -> np.ndarray:
    return ((values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % size


def term_counts(text: bytes | None) -> np.ndarray:
    """Counts of all terms in the whole text; null is empty."""
    text = text or b""
    out = np.zeros(TERMS, np.float32)
    words = twice = 0
    for at in range(0, len(text), PIECE):
        n, repeated = _add_counts(np.frombuffer(text, np.uint8, min(PIECE, len(text) - at), at), out)
        words, twice = words + n, twice + repeated
    lines = text.split(b"\n")
    kinds = np.bincount(CLASS[np.frombuffer(text, np.uint8)], minlength=6) if text else np.zeros(6, np.int64)
    letters, total = kinds[1] + kinds[2], max(1, len(text))
    facts = (
        int(np.log2(len(text) + 1)) // 2,
        16 + int(7.99 * (1 - len(set(lines)) / len(lines))),
        24 + int(7.99 * min(1.0, 8 * (1 - (letters + kinds[4] + kinds[5]) / total))),
        32 + int(7.99 * kinds[2] / max(1, letters)),
        40 + int(7.99 * min(1.0, 4 * kinds[3] / total)),
        48 + int(7.99 * min(1.0, 4 * twice / max(1, words))),
    )
    for fact in facts:
        out[SHAPES + WORDS + fact] = 1.0
    return out


def _add_counts(data: np.ndarray, out: np.ndarray) -> tuple[int, int]:
    """Adds a piece's shapes and words; returns its number of words and how many repeat the word before them."""
    kinds = CLASS[data]
    runs = kinds[np.r_[True, (kinds[1:] != kinds[:-1]) | (kinds[1:] > 5)]]
    if len(runs) > 2:
        shapes = (runs[:-2] << 16) | (runs[1:-1] << 8) | runs[2:]
        out[:SHAPES] += np.bincount(_mixed(shapes, SHAPES), minlength=SHAPES)
    inside = (kinds <= 3) & (data > 32)
    begins = np.flatnonzero(inside & np.r_[True, ~inside[:-1]])
    if len(begins):
        offset = np.arange(len(data)) - np.repeat(np.r_[0, begins], np.diff(np.r_[0, begins, len(data)]))
        low = np.where(kinds == 2, data + 32, data).astype(np.uint64)
        hashes = np.add.reduceat(np.where(inside, low * POWERS[offset & 63], 0), begins)
        out[SHAPES : SHAPES + WORDS] += np.bincount(_mixed(hashes ^ (hashes >> np.uint64(29)), WORDS), minlength=WORDS)
        return len(hashes), int((hashes[1:] == hashes[:-1]).sum())
    return 0, 0


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with their term counts (last column: the text), a bounded number of rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            yield part, np.stack([term_counts(text.as_py()) for text in part.column(part.num_columns - 1)])


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, np.ndarray]:
    """Number of documents, and in how many each term occurs: over all rows, summed in the map tasks first."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, seen = 0, np.zeros(TERMS, np.int64)
        for part, counts in _blocks(batches):
            rows += part.num_rows
            seen += (counts > 0).sum(0)
        columns = [pa.array(np.r_[np.arange(TERMS), -1]), pa.array(np.r_[seen, rows])]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    parts = map_arrow(docs.select(F.col(text_col).cast("binary").alias("text")), counted, "term long, n long")
    found = parts.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row per term
    frequencies = np.zeros(TERMS + 1, np.int64)
    frequencies[found["term"].to_numpy()] = found["n"].to_numpy()
    return int(frequencies[-1]), frequencies[:-1]


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.log1p(counts) * idf
    # Shapes, words and facts weigh the same, however many terms a text has of each.
    for a, b in ((0, SHAPES), (SHAPES, SHAPES + WORDS), (SHAPES + WORDS, TERMS)):
        weights[:, a:b] /= np.maximum(np.linalg.norm(weights[:, a:b], axis=1, keepdims=True), 1e-9)
    return weights


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


@dataclass(frozen=True)
class QualityModel:
    """Weights of the terms, the projection to the latent space, and the labelled vectors in it."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def scores(self, counts: np.ndarray, neighbours: int) -> np.ndarray:
        """Mean label of the nearest labelled documents by cosine, weighted by the cosine; all products are exact."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosines = _unit(_weighted(counts, self.idf) @ self.projection) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6).astype(np.float64) ** 4
        return (weights * self.labels[near]).sum(1) / weights.sum(1)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = MAX_LABELLED,
    latent: int = LATENT,
) -> QualityModel:
    """Term statistics of all documents; latent space and vectors from up to ``max_labelled`` labelled ones.

    ``labels`` has the rows to learn from; they are picked by hash of the id, about ``max_labelled`` of them and
    never more. Several labels of one id are averaged.
    """
    total, seen = document_frequencies(docs, text_col)
    idf = np.log((total + 1) / (seen + 1)).astype(np.float32) + 0.1
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.avg(label_col).alias("_label"))
    share = F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < 0.95 * max_labelled / max(1, known.count()) * 1_000_003
    picked = F.broadcast(known.filter(share).limit(max_labelled))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text")).join(picked, "_id")

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, counts in _blocks(batches):
            sparse = [(np.flatnonzero(row).astype("<i2"), row[row > 0].astype("<f4")) for row in counts]
            columns = [part.column(0), *(pa.array([x[i].tobytes() for x in sparse], pa.binary()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "terms", "counts"])

    ordered = rows.select(F.col("_label").cast("double").alias("label"), "_text")
    found = map_arrow(ordered, counted, "label double, terms binary, counts binary").limit(2 * max_labelled).toArrow()
    labelled = sorted(zip(*(found[c].to_pylist() for c in ("terms", "counts", "label")), strict=True))
    matrix = np.zeros((len(labelled), TERMS), np.float32)
    for row, (terms, counts, _) in zip(matrix, labelled, strict=True):
        row[np.frombuffer(terms, "<i2")] = np.frombuffer(counts, "<f4")
    matrix = _weighted(matrix, idf)
    projection = _latent_space(matrix, latent)
    return QualityModel(idf, projection, _unit(matrix @ projection), np.array([x[2] for x in labelled]))


def _latent_space(matrix: np.ndarray, size: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    start = np.random.default_rng(7).standard_normal((matrix.shape[1], size + 16)).astype(np.float32)
    for _ in range(6):
        start, _ = np.linalg.qr(matrix.T @ (matrix @ start)) if len(matrix) else (start, None)
    _, _, right = np.linalg.svd(matrix @ start, full_matrices=False) if len(matrix) else (None, None, np.eye(size + 16))
    return (start @ right.T[:, :size]).astype(np.float32)


def score(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", neighbours: int = NEIGHBOURS
) -> DataFrame:
    """``doc_id, score`` of every row: 0 to 1, higher for likelier label 1.

    A null or empty text has a vector of its facts alone and is scored like any other. Without labelled
    documents every score is 0.5. Repeated rows get the same score; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.idf, model.projection, model.vectors, model.labels))

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(*shared.value)
        for part, counts in _blocks(batches):
            columns = [part.column(0), pa.array(own.scores(counts, neighbours), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, scored, f"doc_id {kind}, score double")
