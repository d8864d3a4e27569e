"""Language identification with interpolated Kneser-Ney models over characters."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.llm.common import map_arrow, stored

ORDER = 4
BITS = 15
# The model is broadcast up to this many n-grams of all languages together, and this many log probabilities for each
# of them; a larger one stays in written tables.
MAX_GRAMS = 2_000_000
LOGS_PER_GRAM = 8
UNKNOWN = "und"
PIECE = 1 << 18
# Rows that are judged together.
AT_ONCE = 512
# Characters of a stretch when texts are halved for the calibration.
STRETCH = 100
FOUND = ["lang_pred", "score", "entropy", "symbols", "rejected"]
KINDS = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.bool_())

Judged = tuple[list[str], list[float], list[float], list[int], list[bool]]


@lru_cache(maxsize=1)
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """Symbol of every code point, and whether it is a letter.

    Letters and marks are lower-cased and keep 15 bits, so that four of them fit into a long; all else is 0, the gap. Those above U+7FFF
    share symbols with letters of other scripts: ideographs of the basic block do not share any among themselves, nor do
    syllables of Hangul.
    """
    symbols, letters = np.zeros(0x110000, np.int64), np.zeros(0x110000, bool)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind in "LM":
            low = chr(cp).lower()
            base = ord(low) if len(low) == 1 else cp
            symbols[cp] = base if base < 0x8000 else 0x800 + base % 0x7800
            letters[cp] = kind == "L"
    return symbols, letters


def _pieces(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(document, length, packed n-grams)`` for a bounded stretch of text at a time.

    A document begins after a gap and ends with one; runs of gaps count once. A text longer than a piece is read
    in several pieces. Documents without a letter do not appear.
    """
    symbols, letters = _alphabet()
    docs: list[int] = []
    parts: list[np.ndarray] = []
    size = 0
    pad = np.zeros(ORDER - 1, np.int64)
    for number, text in enumerate(texts):
        whole = np.frombuffer((text or "").encode("utf-32-le"), "<u4")
        if not letters[whole].any():
            continue
        for at in range(0, len(whole), PIECE):
            ids = symbols[whole[at : at + PIECE]]
            ids = ids[(ids != 0) | np.r_[False, ids[:-1] != 0]]
            if not len(ids):
                continue
            docs.append(number)
            parts += [pad, ids, np.zeros(int(ids[-1] != 0), np.int64)]
            size += len(ids)
            if size >= PIECE:
                yield _packed(docs, parts)
                docs, parts, size = [], [], 0
    if docs:
        yield _packed(docs, parts)


def _packed(docs: list[int], parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(a) + len(b) for a, b in zip(parts[1::3], parts[2::3], strict=True)])
    stream = np.concatenate(parts)
    grams = np.zeros(len(stream) - ORDER + 1, np.int64)
    for step in range(ORDER):
        grams = (grams << BITS) | stream[step : len(stream) - ORDER + 1 + step]
    # Windows that end in a document's padding belong to nobody.
    inside = np.concatenate([np.r_[np.ones(n, bool), np.zeros(ORDER - 1, bool)] for n in lengths])[: len(grams)]
    return np.array(docs), lengths, grams[inside]


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, gram, n``: counts of the packed n-grams of all texts by language; map tasks send sums."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[np.ndarray]] = {}

        def add(lang: str, grams: np.ndarray, n: np.ndarray) -> None:
            if lang in sums:
                grams, n = np.r_[sums[lang][0], grams], np.r_[sums[lang][1], n]
                grams, place = np.unique(grams, return_inverse=True)
                n = np.bincount(place, n).astype(np.int64)
            sums[lang] = [grams, n]

        def full() -> bool:
            return sum(len(grams) for grams, _ in sums.values()) > 1 << 20

        def sent(lang: str) -> pa.RecordBatch:
            grams, n = sums.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)], names)

        names = ["lang", "gram", "n"]
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang in dict.fromkeys(langs):
                own = [i for i, x in enumerate(langs) if x == lang]
                for _, _, grams in _pieces(batch.column(1)[i].as_py() for i in own):
                    add(lang, *np.unique(grams, return_counts=True))
                    if full():
                        yield from map(sent, list(sums))
        for lang in list(sums):
            yield sent(lang)

    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    parts = map_arrow(rows, counted, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _logged(probabilities: np.ndarray) -> np.ndarray:
    """Logarithms as multiples of 2^-20, so that sums of them are exact in any order."""
    return (np.round(np.log(probabilities) * (1 << 20)) / (1 << 20)).astype(np.float32)


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


class KneserNey:
    """One language: for each order sorted n-grams with their discounted share, sorted contexts with the rest."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, symbols: int) -> None:
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order].astype(float)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.uniform = 1.0 / symbols
        for size in range(ORDER, 0, -1):
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            contexts, first, kinds = np.unique(grams >> BITS, return_index=True, return_counts=True)
            total = np.add.reduceat(counts, first)
            share = np.maximum(counts - discount, 0) / np.repeat(total, kinds)
            self.levels.append((grams, share, contexts, discount * kinds / total))
            # Below, an n-gram counts once for every symbol that it follows.
            grams, counts = np.unique(grams & ((1 << BITS * (size - 1)) - 1), return_counts=True)
            counts = counts.astype(float)

    def probability(self, grams: np.ndarray, level: int = 0) -> np.ndarray:
        if level == ORDER:
            return np.full(len(grams), self.uniform)
        known, share, contexts, rest = self.levels[level]
        lower = self.probability(grams & ((1 << BITS * (ORDER - level - 1)) - 1), level + 1)
        return _looked_up(known, share, grams, 0.0) + _looked_up(contexts, rest, grams >> BITS, 1.0) * lower


class LanguageModel:
    """The models of all languages, with one sorted table of the log probabilities of every n-gram seen in any."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.languages = sorted(counts)
        self.limits: dict[str, tuple[float, float]] = {}
        self.models = [KneserNey(*counts[lang], symbols=1 << BITS) for lang in self.languages]
        self.grams = np.unique(np.concatenate([np.empty(0, np.int64), *(counts[x][0] for x in self.languages)]))
        self.logs = self._logs(self.grams)
        # First guess of a gram's place in the sorted table, by hash; the rest is searched.
        self.shift = 64 - max(1, int(len(self.grams) * 4).bit_length())
        self.slots = np.zeros(1 << (64 - self.shift), np.int32)
        self.slots[self._slot(self.grams)] = np.arange(len(self.grams))

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return (grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)

    def _logs(self, grams: np.ndarray) -> np.ndarray:
        columns = [_logged(m.probability(grams)) for m in self.models]
        return np.stack(columns, axis=1) if columns else np.zeros((len(grams), 0), np.float32)

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return self._logs(grams)
        at = self.slots[self._slot(grams)]
        missed = np.flatnonzero(self.grams[at] != grams)
        if len(missed):
            rare, place = np.unique(grams[missed], return_inverse=True)
            found = np.minimum(np.searchsorted(self.grams, rare), len(self.grams) - 1)
            unseen = self.grams[found] != rare
            at[missed] = found[place]
            out = self.logs[at]
            if unseen.any():
                logs = self.logs[found]
                logs[unseen] = self._logs(rare[unseen])
                out[missed] = logs[place]
            return out
        return self.logs[at]

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per symbol of every text under every language, and its number of symbols (0: no letter)."""
        sums = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts), np.int64)
        for docs, lengths, grams in _pieces(texts):
            logs = self.log_probabilities(grams)
            starts = np.r_[0, np.cumsum(lengths)[:-1]]
            np.add.at(sums, docs, np.add.reduceat(logs, starts, axis=0, dtype=np.float64))
            np.add.at(sizes, docs, lengths)
        return -sums / np.maximum(sizes, 1)[:, None], sizes

    def judged(self, texts: list[str | None]) -> Judged:
        return decided(self.languages, self.limits, *self.entropies(texts))


def decided(languages: list[str], limits: dict[str, tuple[float, float]], entropy: np.ndarray, sizes: np.ndarray) -> Judged:
    """Language, share of the likelihood (0 to 1), cross-entropy, symbols, rejection of every text."""
    if not languages:
        return [UNKNOWN] * len(sizes), [0.0] * len(sizes), [0.0] * len(sizes), sizes.tolist(), [True] * len(sizes)
    best = entropy.argmin(1)
    least = entropy[np.arange(len(sizes)), best]
    # Neighbouring symbols depend on each other, so a text counts as that many independent ones at most.
    weight = np.exp(-(entropy - least[:, None]) * np.minimum(sizes, 100)[:, None])
    score = np.where(sizes > 0, 1.0 / weight.sum(1), 0.0)
    lang = [languages[b] if n else UNKNOWN for b, n in zip(best, sizes, strict=True)]
    mean, spread = np.array([limits.get(x, (np.inf, 0.0)) for x in languages]).T
    limit = mean[best] + spread[best] / np.sqrt(np.maximum(sizes, 1))
    return lang, score.tolist(), least.tolist(), sizes.tolist(), ((sizes == 0) | (least > limit)).tolist()


class LanguageTables:
    """The same models as written tables, for any number of n-grams.

    For each order the shares by n-gram and the rests by context, with the languages that have them. An n-gram and a
    context meet at most ``1 << BITS`` others in a join.
    """

    def __init__(self, counts: DataFrame, languages: list[str], max_logs: int) -> None:
        self.languages, self.max_logs = languages, max_logs
        self.limits: dict[str, tuple[float, float]] = {}
        self.levels: list[tuple[DataFrame, DataFrame]] = []
        places = counts.sparkSession.createDataFrame(list(enumerate(languages)), "place int, lang string")
        level = counts.join(places, "lang").select("place", "gram", F.col("n").cast("double").alias("n"))
        for size in range(ORDER, 0, -1):
            level = stored(level, "level")
            kinds = [F.count_if(F.col("n") == x).alias(name) for x, name in ((1, "once"), (2, "twice"))]
            discounts = [0.5] * len(languages)
            for r in level.groupBy("place").agg(*kinds).collect():  # one row per language
                if r["once"] and r["twice"]:
                    discounts[r["place"]] = r["once"] / (r["once"] + 2 * r["twice"])
            discount = F.array(*map(F.lit, discounts))[F.col("place")]
            context = F.shiftright("gram", BITS)
            total = F.sum("n").over(Window.partitionBy("place", context))
            share = F.greatest(F.col("n") - discount, F.lit(0.0)) / total
            rest = discount * F.count(F.lit(1)) / F.sum("n")
            shares = level.select("gram", F.struct("place", share.alias("x")).alias("own"))
            rests = level.groupBy("place", context.alias("context")).agg(rest.alias("x"))
            rests = rests.select("context", F.struct("place", "x").alias("own"))
            shares = shares.groupBy("gram").agg(F.collect_list("own").alias("shares"))
            rests = rests.groupBy("context").agg(F.collect_list("own").alias("rests"))
            self.levels.append((stored(shares, "shares"), stored(rests, "rests")))
            lower = F.col("gram").bitwiseAND((1 << BITS * (size - 1)) - 1)
            level = level.groupBy("place", lower.alias("gram")).agg(F.count(F.lit(1)).cast("double").alias("n"))

    def logs(self, grams: DataFrame) -> DataFrame:
        """``gram, logs``: log probability under every language of each of the different ``grams``."""
        width = len(self.languages)

        def dense(places: pa.Array, values: pa.Array, missing: float) -> np.ndarray:
            out = np.full((len(places), width), missing)
            rows = np.repeat(np.arange(len(places)), places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            out[rows, places.flatten().to_numpy()] = values.flatten().to_numpy()
            return out

        def interpolated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                gram, share_of, shares, rest_of, rests, lower = batch.columns
                below = np.full((len(gram), width), 1.0 / (1 << BITS)) if lower.null_count else _matrix(lower, width)
                found = dense(share_of, shares, 0.0) + dense(rest_of, rests, 1.0) * below
                yield pa.RecordBatch.from_arrays([gram, _lists(found)], ["gram", "p"])

        def logged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _lists(_logged(_matrix(batch.column(1), width)))
                yield pa.RecordBatch.from_arrays([batch.column(0), found], ["gram", "logs"])

        wanted = [grams.select("gram")]
        for size in range(ORDER - 1, 0, -1):
            part = F.col("gram").bitwiseAND((1 << BITS * size) - 1)
            wanted.append(wanted[-1].select(part.alias("gram")).distinct())
        lower = None
        for size, own, (shares, rests) in zip(range(1, ORDER + 1), wanted[::-1], self.levels[::-1], strict=True):
            rows = own.join(shares, "gram", "left").withColumn("context", F.shiftright("gram", BITS)).join(rests, "context", "left")
            if lower is None:
                rows = rows.withColumn("lower", F.lit(None).cast("array<double>"))
            else:
                rows = rows.withColumn("below", F.col("gram").bitwiseAND((1 << BITS * (size - 1)) - 1))
                rows = rows.join(lower.select(F.col("gram").alias("below"), F.col("p").alias("lower")), "below")
            rows = rows.select("gram", "shares.place", "shares.x", "rests.place", "rests.x", "lower")
            rows = rows.toDF("gram", "share_of", "share", "rest_of", "rest", "lower")
            lower = map_arrow(rows, interpolated, "gram long, p array<double>")
        return map_arrow(lower, logged, "gram long, logs array<float>")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(-1, width)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))


def _scored(docs: DataFrame, model: LanguageModel | LanguageTables, text_col: str) -> DataFrame:
    """``_row`` (all columns of ``docs``) with ``lang_pred, score, entropy, symbols, rejected``."""
    if isinstance(model, LanguageTables):
        return _joined(docs, model, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE).column(0)
                found = shared.value.judged(part.field(place).to_pylist())
                columns = [pa.array(x, t) for x, t in zip(found, KINDS, strict=True)]
                yield pa.RecordBatch.from_arrays([part, *columns], ["_row", *FOUND])

    # The text is sent once, inside its row.
    place = docs.columns.index(text_col)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    schema = T.StructType([rows.schema["_row"]])
    schema.add("lang_pred", "string").add("score", "double").add("entropy", "double")
    return map_arrow(rows, scored, schema.add("symbols", "long").add("rejected", "boolean"))


def _joined(docs: DataFrame, model: LanguageTables, text_col: str) -> DataFrame:
    """As ``_scored``, from tables: what the documents' most frequent n-grams cost is broadcast, the others are joined.

    An n-gram that is not broadcast holds a small share of the text, so no key of the join is frequent. Logarithms
    are summed exactly: the result is that of a broadcast model.
    """
    spark, languages, limits = docs.sparkSession, model.languages, model.limits
    width = len(languages)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    rows = stored(rows.withColumn("_id", F.monotonically_increasing_id()), "rows")
    texts = rows.select("_id", F.col("_row")[text_col].alias("text"))
    wanted = stored(gram_counts(texts.withColumn("lang", F.lit("")), "text", "lang").select("gram", "n"), "wanted")
    logs = stored(model.logs(wanted), "logs")
    frequent = wanted.filter(F.col("n") >= _threshold(wanted, model.max_logs // width))
    found = logs.join(frequent, "gram", "left_semi").toArrow().combine_chunks()
    grams, costs = found["gram"].to_numpy(), found["logs"].combine_chunks()
    order = np.argsort(grams)
    shared = spark.sparkContext.broadcast((grams[order], _matrix(costs, width)[order]))

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, costs = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                ids, texts = (c.slice(start, AT_ONCE) for c in batch.columns)
                sums, sizes = np.zeros((len(ids), width)), np.zeros(len(ids), np.int64)
                for numbers, lengths, grams in _pieces(texts.to_pylist()):
                    owner = np.repeat(numbers, lengths)
                    np.add.at(sizes, numbers, lengths)
                    at = np.minimum(np.searchsorted(known, grams), max(len(known) - 1, 0))
                    here = known[at] == grams if len(known) else np.zeros(len(grams), bool)
                    for lang in range(width):
                        sums[:, lang] += np.bincount(owner[here], costs[at[here], lang], len(ids))
                    owner, grams = owner[~here], grams[~here]
                    order = np.lexsort((grams, owner))
                    owner, grams = owner[order], grams[order]
                    first = np.flatnonzero(np.diff(owner, prepend=-1) | np.diff(grams, prepend=-1))
                    n = np.diff(first, append=len(grams))
                    late = ids.take(pa.array(owner[first]))
                    none = pa.nulls(len(late), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([late, pa.array(grams[first]), pa.array(n, pa.int64()), none], names)
                yield pa.RecordBatch.from_arrays([ids, pa.nulls(len(ids), pa.int64()), pa.array(sizes), _lists(sums)], names)

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(ids: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
            found = decided(languages, limits, -sums / np.maximum(sizes, 1)[:, None], sizes)
            columns = [pa.array(x, t) for x, t in zip(found, KINDS, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ids), *columns], ["_id", *FOUND])

        # The last document of a batch may go on in the next.
        held = np.zeros(0, np.int64), np.zeros((0, width)), np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, sizes, times = (batch.column(i).to_numpy() for i in range(3))
            ids = np.r_[held[0], ids]
            sums = np.r_[held[1], _matrix(batch.column(3), width) * times[:, None]]
            first = np.flatnonzero(np.diff(ids, prepend=-1))
            sums, sizes = np.add.reduceat(sums, first, axis=0), np.add.reduceat(np.r_[held[2], sizes], first)
            ids = ids[first]
            held = ids[-1:], sums[-1:], sizes[-1:]
            yield sent(ids[:-1], sums[:-1], sizes[:-1])
        if len(held[0]):
            yield sent(*held)

    names = ["_id", "gram", "n", "sums"]
    parts = stored(map_arrow(texts, summed, "_id long, gram long, n long, sums array<double>"), "parts")
    whole = parts.filter("gram IS NULL").select("_id", F.col("n").alias("size"), F.lit(1).cast("long").alias("times"), "sums")
    late = parts.filter("gram IS NOT NULL").select("_id", "gram", "n").join(logs, "gram")
    late = late.select("_id", F.lit(0).cast("long"), "n", F.col("logs").cast("array<double>"))
    both = whole.union(late).repartition("_id").sortWithinPartitions("_id")
    results = map_arrow(both, judged, "_id long, lang_pred string, score double, entropy double, symbols long, rejected boolean")
    return rows.join(results, "_id").select("_row", *FOUND)


def _threshold(wanted: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` n-grams reach by their count, from a histogram of a row per power."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["power"]: r["count"] for r in wanted.groupBy(power.alias("power")).count().collect()}
    above, at = 0, max(sizes, default=0) + 1
    while at > 0 and above + sizes.get(at - 1, 0) <= most:
        at -= 1
        above += sizes.get(at, 0)
    return 1 << at


@dataclass(frozen=True)
class Calibration:
    """Rejected is what costs over ``slack`` more per symbol than unseen text of the language, plus ``sds`` deviations.

    What unseen text costs is measured on parts of texts under a model that was trained without them. A language with
    fewer than ``few`` such parts takes the largest deviation of the others, ``spread`` if there is none, and its limit
    is at least ``floor``, which is between what ordinary text and what random letters cost under a model of a few sentences.
    """

    sds: float = 8.0
    slack: float = 1.0
    few: int = 20
    spread: float = 0.25
    floor: float = 4.0


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_grams: int = MAX_GRAMS,
    calibration: Calibration = Calibration(),
) -> LanguageModel | LanguageTables:
    """Models from the whole texts of all rows with a language.

    Counts cover all rows and every n-gram. A model of up to ``max_grams`` n-grams is broadcast, a larger one stays in
    tables; both give the same results. The rejection is calibrated on all rows with a language, on text that the
    measuring models have not seen (:class:`Calibration`).
    """
    model = _model(stored(gram_counts(docs, text_col, lang_col), "grams"), max_grams)
    _calibrate(model, docs, text_col, lang_col, max_grams, calibration)
    return model


def _model(counts: DataFrame, max_grams: int) -> LanguageModel | LanguageTables:
    """A model of ``lang, gram, n``, in the form that its size asks for."""
    size = counts.count()
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())  # one row per language
    if size > max_grams or size * len(languages) > LOGS_PER_GRAM * max_grams:
        return LanguageTables(counts, languages, LOGS_PER_GRAM * max_grams)
    found = counts.toArrow()
    langs = np.array(found["lang"].to_pylist(), dtype=object)
    grams, n = found["gram"].to_numpy(), found["n"].to_numpy()
    return LanguageModel({lang: (grams[langs == lang], n[langs == lang]) for lang in languages})


def halves(text: str) -> tuple[str, str]:
    """Two texts of every other stretch of about ``STRETCH`` characters each, cut behind a word; copies are cut alike."""
    found: tuple[list[str], list[str]] = ([], [])
    at, side = 0, zlib.crc32(text.encode("utf-8", "replace")) & 1
    while at < len(text):
        end = text.find(" ", at + STRETCH)
        end = len(text) if end < 0 else end
        found[side].append(text[at:end])
        at, side = end, 1 - side
    return "\n".join(found[0]), "\n".join(found[1])


def _calibrate(
    model: LanguageModel | LanguageTables, docs: DataFrame, text_col: str, lang_col: str, max_grams: int, by: Calibration
) -> None:
    """The limit of each language, from either half of every text under models of the other halves."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                langs, texts = (column.slice(at, AT_ONCE) for column in batch.columns)
                sides = zip(*(halves(text.as_py()) for text in texts))
                for side, own in enumerate(sides):
                    arrays = [langs, pa.array([side] * len(own), pa.int32()), pa.array(own, pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["lang", "side", "text"])

    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    labelled = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    parts = map_arrow(labelled, split, "lang string, side int, text string").filter("text <> ''")
    both = F.concat(F.col("side").cast("string"), F.col("lang"))
    counts = stored(gram_counts(parts.select(both.alias("lang"), "text"), "text", "lang"), "half_grams")
    seen = []
    for side in (0, 1):
        other = counts.filter(F.col("lang").startswith(str(1 - side))).withColumn("lang", F.col("lang").substr(F.lit(2), F.length("lang")))
        unseen = _model(other, max_grams)
        # Where the other halves have no text of a language nothing can be said about it.
        own = parts.filter((F.col("side") == side) & F.col("lang").isin(unseen.languages))
        seen.append(_scored(own.select("lang", "text"), unseen, "text").select(F.col("_row.lang").alias("lang"), "entropy", "symbols"))
    weight = F.col("symbols").cast("double")
    mean = F.sum(F.col("entropy") * weight) / F.sum(weight)
    found = seen[0].union(seen[1]).filter("symbols > 0").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), mean.alias("mean"), F.stddev("entropy").alias("sd"), F.avg(F.sqrt(weight)).alias("root")
    )
    measured = {r["lang"]: r for r in found.collect()}  # one row per language
    sure = [r["sd"] * r["root"] for r in measured.values() if r["n"] >= by.few]
    widest = max(sure, default=None)
    for lang in model.languages:
        r = measured.get(lang)
        if r is not None and r["n"] >= by.few:
            model.limits[lang] = (r["mean"] + by.slack, by.sds * r["sd"] * r["root"])
        elif r is not None:
            spread = by.spread * r["root"] if widest is None else widest
            model.limits[lang] = (max(r["mean"] + by.slack, by.floor), by.sds * spread)
        else:
            model.limits[lang] = (by.floor, by.sds * (widest or 0.0))


def identify(
    docs: DataFrame, model: LanguageModel | LanguageTables, text_col: str = "text"
) -> DataFrame:
    """``_row`` with ``lang_pred``, ``score``, ``entropy``, ``symbols`` and ``rejected`` for every row of ``docs``.

    The language with the lowest cross-entropy per symbol; ties go to the first by name. A text that is null or
    has no letter is ``und`` with score 0 and rejected, as is every text if no language was learned. Other texts
    are rejected only if they cost clearly more than the texts the model was calibrated on. Repeated rows get
    the same result, an empty table gives an empty table.
    """
    return _scored(docs, model, text_col)


def known_language(docs: DataFrame, model: LanguageModel | LanguageTables, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, columns as before.

    Null texts and texts without a letter are rejected, repeated rows alike; an empty table gives an empty table.
    """
    kept = identify(docs, model, text_col).filter("NOT rejected")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
