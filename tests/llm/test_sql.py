"""The operators' queries against their SQL and against brute force, on the given tables."""

import numpy as np
import pytest
from compare import connect, differences

from lakelayers.llm import quality
from lakelayers.llm.oracles import ORACLES
from lakelayers.llm.queries import QUERIES

from . import brute

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) == []


def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_suffix_dedup(spark):
    exact = {d: (*x[:3], brute.sha(x[3])) for d, x in brute.removed_repeats(documents(spark, SMALL)).items()}
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op1_suffix_dedup"](spark, SMALL).collect()} == exact


def test_simhash(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op6_simhash"](spark, sf_dir).collect()}
    near = brute.near_fingerprints(docs)
    assert found == {d: (f"{brute.fingerprint(t):016x}", near[d]) for d, t in docs}


def test_embeddings(spark, sf_dir):
    rows = sorted(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect())
    vectors = np.array([r.embedding for r in rows], np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = [np.setdiff1d(np.flatnonzero(unit @ v >= 0.95), [i]) for i, v in enumerate(unit)]
    component = brute.grouped([r.vec_id for r in rows], lambda i: near[i])
    found = {r[0]: tuple(r[1:]) for r in QUERIES["op8_embedding_near_dedup"](spark, sf_dir).collect()}
    assert found == {r.vec_id: (len(near[i]), component[r.vec_id], component[r.vec_id] == r.vec_id) for i, r in enumerate(rows)}


def test_language_id(spark, sf_dir):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op4_language_id"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == sorted(langs)
    assert all(r.held_out == (brute.remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in found)
    outside = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in outside) >= 0.98 * len(outside) > 0


def test_quality(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = QUERIES["op10_quality"](spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (brute.remainder(r.doc_id, 3) == 1) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    good = [r.score for r in found if r.held_out and labels.get(r.doc_id) == 1]
    bad = [r.score for r in found if r.held_out and labels.get(r.doc_id) == 0]
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert above >= 0.95


def test_quality_votes(spark, sf_dir):
    """Every cosine with every labelled vector in double precision, all neighbours sorted, one document after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels)
    found = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    frequencies = np.zeros(quality.TERMS)
    counts = {r.doc_id: quality.term_counts((r.text or "").encode()).astype(float) for r in docs.collect()}
    for own in counts.values():
        frequencies += own > 0
    idf = np.log((len(counts) + 1) / (frequencies + 1)) + 0.1
    assert np.allclose(idf, model.idf, atol=1e-5) and len(model.labels) == labels.filter("quality IS NOT NULL").count()
    labelled = model.vectors.astype(float)
    for doc, own in counts.items():
        weights = np.log1p(own) * idf
        for a, b in ((0, quality.SHAPES), (quality.SHAPES, quality.SHAPES + quality.WORDS), (quality.SHAPES + quality.WORDS, quality.TERMS)):
            weights[a:b] /= max(np.linalg.norm(weights[a:b]), 1e-9)
        vector = weights @ model.projection.astype(float)
        cosines = labelled @ (vector / max(np.linalg.norm(vector), 1e-9))
        order = sorted(range(len(cosines)), key=lambda i: -cosines[i])[: quality.NEIGHBOURS]
        # Ties at the last place may be broken either way.
        edge = [i for i in range(len(cosines)) if abs(cosines[i] - cosines[order[-1]]) < 1e-5]
        near = {i for i in order} - set(edge)
        votes = [max(cosines[i], 1e-6) ** 4 for i in near]
        free = quality.NEIGHBOURS - len(near)
        edge_labels = sorted(model.labels[i] for i in edge)
        weight = max(cosines[order[-1]], 1e-6) ** 4
        fixed, total = sum(v * model.labels[i] for v, i in zip(votes, near)), sum(votes) + free * weight
        low, high = (fixed + weight * sum(edge_labels[:free])) / total, (fixed + weight * sum(edge_labels[-free:])) / total
        assert low - 1e-3 <= found[doc] <= high + 1e-3


def test_html_extract(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = QUERIES["op3_html_extract"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in found) == sorted(pages)
    import html
    import re

    for r in found:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        parts = [re.sub(r"<[^>]*>", " ", part) for part in re.split(r"</?(?:p|h1)>", inner)]
        parts = [" ".join(html.unescape(part).split()) for part in parts]
        assert r.text == "\n\n".join(filter(None, parts))
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
