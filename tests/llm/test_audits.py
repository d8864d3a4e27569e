"""Source divergence, exact search and filter audit against brute force, on nulls, ties, repeated rows and other edges."""

import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations
from math import floor

import numpy as np
import pyarrow as pa
import pytest

from lakelayers.llm import filter_audit, source_divergence, term_search

SCHEMA = "doc_id long, text string, lang string, source string, term string, rid long, part string, p long, n int, `a.b` int"
TEXTS = [
    (1, "One two two three THREE three, naïve Été", "en", "a"), (2, "one two zwölf. three naïve", "en", "b"),
    (3, "one one one two\nthree", "en", None), (4, "ONE two", "en", "a"), (5, None, "en", "b"), (6, "", "en", "empty"),
    (7, "12 !? 34", None, "x"), (8, "eins zwei drei", "de", "a"), (9, "eins zwei", "de", "b"), (10, "eins drei zwei", "de", "b"),
    (10, "eins drei zwei", "de", "b"), (11, "solo", "fr", "a"), (12, "x" * 3000 + " one two three", "en", "c"),
    (None, "one two three four", "en", "c"), (13, "naïve " * 500, "en", "d"), (14, "a", "it", "only"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "q", 2, 3, 4) for r in rows], SCHEMA)


def diverging(rows, top=200):
    """The contract, term by term."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for _, text, lang, source in rows]
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [(lang, source, [w.translate(lower) for w in words]) for lang, source, words in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        within = Counter(w for d in own for w in set(d[2]))
        kept = sorted(w for w, n in within.items() if n >= 3)
        counts = defaultdict(Counter)
        for _, source, words in own:
            counts[source].update(w for w in words if w in kept)
        whole = sum(counts.values(), Counter())

        def share(counter, w):
            return 1 + 10**9 * (counter[w] + 1) // (sum(counter.values()) + len(kept))

        for g in counts:
            pairs = [(-sum((share(counts[g], w) - share(counts[h], w)) ** 2 // share(counts[h], w) for w in kept), h) for h in counts if h != g]
            terms = [(w, share(counts[g], w), share(whole, w)) for w in kept if counts[g][w]]
            terms = [(-((p - q) ** 2 // q), w) for w, p, q in terms if p > q]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, g, part, item, -value, rank + 1) for rank, (value, item) in enumerate(found)}
    return out


def test_divergence(spark):
    rows = source_divergence.divergence(frame(spark, TEXTS)).collect()
    assert len(rows) == len(set(map(tuple, rows))) and set(map(tuple, rows)) == diverging(TEXTS)
    assert source_divergence.divergence(frame(spark, TEXTS).limit(0)).collect() == []


def test_divergence_in_slices_and_blocks(spark, monkeypatch):
    """Small slices and blocks of sources, hot source, sources without terms: the same sums."""
    monkeypatch.setattr(source_divergence, "SLICE", 40)
    monkeypatch.setattr(source_divergence, "BLOCK", 3)
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]
    rows = [
        (i, " ".join(rng.choice(words, rng.integers(0, 40), p=None)), "en", f"s{rng.integers(0, 9) if i % 3 else 0}") for i in range(120)
    ] + [(500, "", "en", "nothing"), (501, None, "en", "nothing more")]
    found = source_divergence.divergence(frame(spark, rows), top_terms=5).collect()
    assert set(map(tuple, found)) == diverging(rows, 5) and len({r.item for r in found if r.part == "pair"}) == 11


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(source_divergence, "PIECE", 7)
    text = "Aé bbbbbbbbbbbbbbbbbbbbbb, C-d" + "e" * 30
    found = [w.decode() for piece in source_divergence._words(text.encode()) for w in piece]
    assert found == ["aé", "b" * 22, "c", "d" + "e" * 30]
    assert list(source_divergence._words(b"")) == []


def test_counts_are_passed_on_before_they_grow(monkeypatch):
    monkeypatch.setattr(source_divergence, "HELD", 3)
    batch = pa.table({"lang": ["x"] * 4, "source": ["s"] * 4, "text": ["a b c d", "a a", "", "a e f g h"]}).to_batches()[0]
    n, docs = Counter(), Counter()
    for out in source_divergence._count_terms([batch]):
        for row in out.to_pylist():
            n[row["term"]] += row["n"]
            docs[row["term"]] += row["docs"]
    assert n["a"] == 4 and docs["a"] == 3 and n["h"] == docs["h"] == 1


NAN, INF = float("nan"), float("inf")
VECTORS = [
    (0, [0.5, -0.25, 0.0]), (50, [0.1, 0.2, 0.3]), (1, [0.5, -0.25, 0.0]), (2, [0.5, -0.25, 0.0]), (3, [-0.5, 0.25, 1e-9]),
    (4, None), (5, [0.1, None, 0.2]), (6, [NAN, 0.0, 0.0]), (7, [INF, 0.0, 0.0]), (100, []), (9, [1.0]), (10, [0.0, 0.0, 0.0, 9.0]),
    (None, [1.0, 1.0, 1.0]), (11, [0.1, 0.2, 0.3]), (11, [0.1, 0.2, 0.3]), (50, [0.1, 0.2, 0.3]), (50, [9.0, 0.0, 0.0]), (150, None),
]


def searched(rows, k, scale=256):
    """The contract over all pairs, for queries whose id 50 divides."""
    whole = [(i, [floor(scale * Fraction(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for query in {(i, tuple(v)) for i, v in whole if i is not None and i % 50 == 0}:
        scores = [(sum(a * b for a, b in zip(query[1], v)), i) for i, v in whole if i != query[0]]
        held = [(max(-(2**63) + 1, min(2**63 - 1, s)), i) for s, i in scores]
        best = sorted(held, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(query[0], rank + 1, i, s) for rank, (s, i) in enumerate(best)]
    return sorted(out, key=str)


def vector_frame(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, id int, query int, score int")
    return frame, frame.filter("vec_id % 50 = 0")


@pytest.mark.parametrize("k", [1, 5, 40])
def test_search(spark, k):
    vectors, queries = vector_frame(spark, VECTORS)
    found = sorted(map(tuple, term_search.top_k(vectors, queries, k).collect()), key=str)
    assert found == searched(VECTORS, k)


def test_search_in_blocks_of_queries(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).round(1).tolist() if i % 3 else [0.0, 1.0] + [0.0] * 6) for i in range(700)]
    vectors, queries = vector_frame(spark, rows)
    found = term_search.top_k(vectors.repartition(3), queries, 5, block_bytes=400)
    assert sorted(map(tuple, found.collect()), key=str) == searched(rows, 5)


def test_search_of_huge_components(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [-1e300, 0.5]), (3, [1e-300, 3.0]), (50, [2.0**40, 2.0**33]), (4, [2.0**30, -(2.0**31)])]
    vectors, queries = vector_frame(spark, rows)
    found = sorted(map(tuple, term_search.top_k(vectors, queries, 3).collect()), key=str)
    assert found == searched(rows, 3) and any(abs(r[3]) == 2**63 - 1 for r in found)


def test_search_of_nothing_and_by_text_id(spark):
    vectors, queries = vector_frame(spark, VECTORS)
    assert term_search.top_k(vectors, queries.limit(0)).collect() == [] == term_search.top_k(vectors.limit(0), queries.limit(0)).collect()
    assert term_search.top_k(vectors.limit(0), queries).collect() == []
    named = spark.createDataFrame([("é", [1.0]), ("b", [1.0]), ("z", [1.0]), (None, [1.0])], "vec_id string, embedding array<float>")
    found = term_search.top_k(named, named.filter("vec_id = 'b'"), 3).collect()
    assert [(r.rank, r.id) for r in sorted(found, key=lambda r: r.rank)] == [(1, "z"), (2, "é"), (3, None)]


WORDS = " ".join(f"w{i}" for i in range(60))
AUDITED = [
    (1, WORDS, "a"), (2, WORDS, "b"), (2, WORDS, "a"), (3, None, None), (4, "", "a"), (5, "Short TEXT", "a"), (6, "x " * 80, "b"),
    (7, WORDS + " $", "b"), (8, WORDS.upper() + " |", ""), (None, WORDS, "a"), (9, WORDS + " É|", "c"), (10, WORDS + "x", "c"),
    (11, WORDS + " w1\x0b\x1cw2", "c"), (10, WORDS + "x", "c"),
]
LABELS = [(1, 1, 0), (2, None, 1), (2, 1, None), (5, 0, 1), (7, 1, 1), (7, 0, 0), (None, 1, 1), (99, 1, 1), (6, 1, None)]


def audited(rows, labels, letters="ABCDE"):
    """The contract, document by document and order by order."""
    texts = [(i, t or "", p or "") for i, t, p in rows]
    fails, good, toxic = [], {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    for i, text, _ in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)}
        bad |= {"D": bool(re.search("[#$%&*|]", text)), "E": i is not None and any(j is not None and j < i and t == text for j, t, _ in texts)}
        fails.append({x for x in letters if bad[x]})
    out, removals = {}, Counter()
    for part in {p for *_, p in texts}:
        own = [(i, f) for (i, _, p), f in zip(texts, fails) if p == part]
        for order in map("".join, permutations(letters)):
            there = own
            for step, letter in enumerate(order):
                gone = [(i, f) for i, f in there if letter in f]
                there = [x for x in there if letter not in x[1]]
                removals[part, letter] += len(gone)
                late = sum(letter in f for _, f in own) - len(gone)
                lost = [sum(i in ids for i, _ in gone) for ids in (good, toxic)]
                out[part, order, step + 1] = (len(there), len(gone), late, sum(f == {letter} for _, f in own), *lost)
    return {(*k, *v, removals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


AUDIT_SCHEMA = "doc_id long, text string, source string, words string, rid long, part string, digest int, fails_A int, good int, prefix int"


@pytest.fixture(scope="module")
def audit_tables(spark):
    docs = spark.createDataFrame([(*r, "w", 1, "p", 2, 3, 4, 5) for r in AUDITED], AUDIT_SCHEMA)
    labels = spark.createDataFrame([(*r, "x") for r in LABELS], "doc_id long, quality int, toxic int, source string")
    return docs, labels


def test_audit(audit_tables):
    docs, labels = audit_tables
    rows = filter_audit.audit(docs, labels).collect()
    assert len(rows) == 4 * 600 and set(map(tuple, rows)) == audited(AUDITED, LABELS)
    assert filter_audit.audit(docs.limit(0), labels).collect() == []


def test_audit_without_labels_and_with_other_filters(audit_tables):
    docs, labels = audit_tables
    some = {x: filter_audit.FILTERS[x] for x in "EC"}
    rows = filter_audit.audit(docs, labels.limit(0), some).collect()
    assert set(map(tuple, rows)) == audited(AUDITED, [], "EC")


def test_audit_joins_ids_only(spark, audit_tables):
    """Left-anti joins give the survivors, a left-semi and a left-anti join what is removed and redundant; no cross join."""
    docs, labels = audit_tables
    plan = filter_audit.audit(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") >= 1 and plan.count("Join LeftAnti") >= 2 and "Cross" not in plan
    fails = [spark.range(0, 4).withColumnRenamed("id", "rid"), spark.range(2, 6).withColumnRenamed("id", "rid")]
    left = filter_audit.survivors(spark.range(8).withColumnRenamed("id", "rid"), fails)
    assert sorted(map(tuple, left.collect())) == sorted(
        (i, s) for i in range(8) for s in range(4) if not (s & 1 and i < 4) and not (s & 2 and 2 <= i < 6)
    )
    assert left._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 2
