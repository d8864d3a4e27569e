"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakelayers.llm import (
    decontamination, embeddings, html_extract, language_id, line_dedup, mixing, quality, simhash, suffix_dedup, url_filter,
)

from . import brute

LONG = " ".join(f"word{i * 7919 % 1000}" for i in range(30_000))
LINE = "A line of more than twenty characters"
SCHEMA = "doc_id long, text string, lang string, source string, _row string, rid long, pos int, kept string, size long, `a.b` int"
DOCS = [
    (1, LINE + "\nx", "en", "a"), (2, " " + LINE.upper() + "\t\ny", "en", "a"), (3, LINE, "en", None),
    (4, None, None, None), (5, "", "en", "b"), (6, LONG, "de", "b"), (7, LONG + " more", "de", "b"),
    (8, "  \n\n ", "de", "a"), (9, "12 !? 34", None, "a"), (10, "é" * 120 + "e" * 120, "fr", "c"),
    (2, " " + LINE.upper() + "\t\ny", "en", "a"), (11, LINE + "\n" + LINE, "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*d, "r", 7, 1, "k", 3, 0) for d in DOCS], SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


SINGLE = [d for i, d in enumerate(DOCS) if i != 10]


def test_suffix_dedup(docs, empty):
    exact = {d: x for d, x in brute.removed_repeats([d[:2] for d in SINGLE]).items()}
    rows = suffix_dedup.remove_repeats(docs).collect()
    assert len(rows) == len(DOCS)
    assert {r[0]: (*r[1:4], bytes(r[4])) for r in rows} == exact and exact[7][1] > 100_000
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_suffix_dedup_of_one_id(spark):
    text = hashlib.sha512(b"x").hexdigest() + hashlib.md5(b"y").hexdigest()[:22]
    rows = [(1, text), (1, text + "?"), (1, text), (None, text), (None, None)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r.doc_id is None, r.n_bytes, r.n_removed) for r in found)
    assert len(found) == 5
    assert [x for x in got if x[0]] == [(True, 0, 0), (True, 150, 150)]
    # Of the two texts of id 1 the one with the smaller hash comes first; identical rows are one document.
    assert [x for x in got if not x[0]] in (
        [(False, 150, 0), (False, 150, 0), (False, 151, 150)], [(False, 150, 150), (False, 150, 150), (False, 151, 0)],
    )


def test_suffix_dedup_of_text_ids(spark):
    """Ids in the order of their type: "10" before "9"; a null id is the largest."""
    text = hashlib.sha512(b"x").hexdigest() + hashlib.md5(b"y").hexdigest()[:22]
    rows = [("9", text), ("10", "ab" + text), (None, text + "c"), ("b", None), ("b2", "short")]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "name string, body string"), "name", "body").collect()
    assert sorted(((r.doc_id or "~", r.n_bytes, r.n_removed, r.n_spans) for r in found)) == [
        ("10", 152, 0, 0), ("9", 150, 150, 1), ("b", 0, 0, 0), ("b2", 5, 0, 0), ("~", 151, 150, 1),
    ]
    ids = spark.createDataFrame([(float(i) / 7, "x") for i in range(500)], "name double, body string")
    numbered, ids = suffix_dedup._by_number(ids, "name", "body")
    assert [r.number for r in ids.orderBy("_id").collect()] == sorted(r.number for r in ids.collect())


def test_suffix_dedup_deals_out_frequent_grams(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 5)
    rng = np.random.default_rng(4)
    noise = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    phrase, longer = noise(40), noise(130)
    rows = [(i, noise(90) + (phrase if i % 3 else longer) + noise(90)) for i in range(60)]
    rows += [(100 + i, noise(20) + rows[i][1][30:190] + noise(20)) for i in range(20)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r[0]: (*r[1:4], bytes(r[4])) for r in found} == brute.removed_repeats(rows)


def test_line_dedup(docs, empty):
    exact = brute.dedup_lines([d[:2] for d in SINGLE])
    rows = line_dedup.with_kept_lines(docs, line_dedup.line_bitmaps(docs)).collect()
    assert len(rows) == len(DOCS)
    assert {r["_row"]["doc_id"]: (r.n_lines, r.n_dropped, r.kept) for r in rows} == exact and exact[1][1] == 1
    assert line_dedup.line_bitmaps(empty).collect() == [] == line_dedup.dedup_lines(empty).collect()
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.filter("text IS NULL").count() == 1


def test_line_dedup_of_many_lines(spark):
    many = "\n".join(f"This is line number {i:06d} of the text" for i in range(5000))
    rows = [(1, many), (2, many), (3, many + "\nend"), (None, many)]
    found = line_dedup.with_kept_lines(d := spark.createDataFrame(rows, "doc_id long, text string"), line_dedup.line_bitmaps(d))
    assert sorted((r.n_lines, r.n_dropped) for r in found.collect()) == [(5000, 5000)] * 3 + [(5001, 0)]


def test_line_dedup_streams_sorted_ranges(spark):
    """Ranges by hash and document, sorted by position within; the first row of each passes, no hash aggregate does that."""
    rows = spark.createDataFrame([(1, 2, 3, 4, 5)], "h long, g int, doc_id long, rid long, pos int")
    first = line_dedup.first_occurrences(rows)
    plan = re.sub(r"#\d+L?", "", first._jdf.queryExecution().executedPlan().toString())
    assert "Exchange rangepartitioning(h ASC NULLS FIRST, g ASC NULLS FIRST, doc_id ASC NULLS FIRST" in plan
    assert "Sort [h ASC NULLS FIRST, g ASC NULLS FIRST, doc_id ASC NULLS FIRST, pos ASC NULLS FIRST]" in plan
    assert "Window" in plan and "Aggregate" not in plan and plan.count("Exchange") == 1


def test_line_bitmaps_are_compressed(spark):
    """Two runs for a block of lines that go, however long, and none of length 0."""
    shared = [f"{LINE} {i}" for i in range(300)]
    own = [f"own line number {i} of this document" for i in range(3000)]
    rows = [(1, "\n".join(own + shared + own[:5])), (2, "\n".join(shared)), (3, "\n".join(shared[:150] + ["x"] + shared[150:])), (4, "\n".join(shared))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [tuple(x) for x in r.keep_runs] for r in line_dedup.line_bitmaps(docs).collect()}
    assert found == {1: [(0, 3000), (3300, None)], 2: [(300, None)], 3: [(150, 1), (301, None)]}
    kept = {r["_row"].doc_id: r.kept for r in line_dedup.with_kept_lines(docs, line_dedup.line_bitmaps(docs)).collect()}
    assert kept == {1: "\n".join(own + own[:5]), 2: "", 3: "x", 4: rows[3][1]}


def test_html_extract(spark):
    rows = [(1, "http://h/a", "<article><p>x</p></article>"), (2, None, None), (3, "", ""), (3, "", ""), (None, "http://h/b", "<p>y"),
            (4, "http://h/" + "c" * 9999, "<article>" + "<p>text" * 20_000)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id int, url string, html string, host string, container int")
    found = sorted(((r.page_id or 0, r.text) for r in html_extract.main_texts(pages).collect()))
    assert found == [(0, "y"), (1, "x"), (2, ""), (3, ""), (3, ""), (4, "\n\n".join(["text"] * 20_000))]
    assert html_extract.main_texts(pages.limit(0)).collect() == []


def test_language_id(docs, empty):
    model = language_id.train(docs)
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == len(DOCS)
    pred = {r["_row"]["doc_id"]: (r.lang_pred, r.score, r.rejected) for r in rows}
    assert all(pred[d] == ("und", 0.0, True) for d in (4, 5, 8, 9))
    assert {d: pred[d][0] for d in (1, 2, 3, 6, 7, 10)} == {1: "en", 2: "en", 3: "en", 6: "de", 7: "de", 10: "fr"}
    assert language_id.identify(empty, model).collect() == []
    kept = language_id.known_language(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 2, 3, 6, 7, 10, 11]
    none = language_id.train(empty)
    assert {(r.lang_pred, r.score, r.rejected) for r in language_id.identify(docs, none).collect()} == {("und", 0.0, True)}


def test_language_id_keeps_every_gram(spark, docs, empty):
    rare = [(20, "qwx jzkv", "zz"), (21, "zażółć gęślą jaźń", "pl"), (22, LINE + " Щъы unseen", None), (23, None, "zz")]
    more = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(rare, "doc_id long, text string, lang string"))
    found = []
    for most in (language_id.MAX_GRAMS, 40, 1):
        model = language_id.train(more, max_grams=most)
        assert isinstance(model, language_id.LanguageModel) == (most > 40)
        rows = language_id.identify(more, model).collect()
        found.append(sorted((r["_row"]["doc_id"], *r[1:]) for r in rows))
        assert {r[0]: r[1] for r in found[-1] if r[0] >= 20} == {20: "zz", 21: "pl", 22: "en", 23: "und"}
        assert len(rows) == len(DOCS) + 4 and language_id.identify(empty, model).collect() == []
    # Not nearly but wholly the same, limits and scores too.
    assert found[0] == found[1] == found[2]


def test_language_id_is_calibrated_on_copies(spark):
    copies = [(i, f"{LINE} {t}", "en") for t, n in (("one", 3000), ("two of them", 1500)) for i in range(n)]
    labelled = copies + [(9000, "Noch eine Zeile mit Text", "de")]
    model = language_id.train(spark.createDataFrame(labelled, "doc_id long, text string, lang string"))
    assert set(model.limits) == {"de", "en"}
    asked = [LINE + " one", LINE + " two of them", "Noch eine Zeile mit mehr Text", "xq zzkv qpw vvx jjkq wwz " * 8]
    found = language_id.identify(spark.createDataFrame([(t,) for t in asked], "text string"), model).collect()
    assert {r["_row"].text: r.rejected for r in found} == dict(zip(asked, [False, False, False, True]))



def test_language_id_rejects_what_it_was_not_calibrated_on(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.train(given)
    odd = "Щ".join("ъыьэюя"[i * i % 6] * (i % 3 + 1) for i in range(400))
    more = spark.createDataFrame([(-1, odd)], "doc_id long, text string")
    rows = language_id.identify(given.select("doc_id", "text").union(more), model).collect()
    assert {r["_row"]["doc_id"] for r in rows if r.rejected} == {-1}


def test_language_pieces(monkeypatch):
    texts = ["some text, to be read in pieces " * 5, None, "", "x", "1"]
    counts = np.unique(np.concatenate([g for _, _, g in language_id._pieces(texts)]), return_counts=True)
    model = language_id.LanguageModel({"en": counts})
    whole, sizes = model.entropies(texts)
    assert sizes.tolist()[1:] == [0, 0, 2, 0]
    monkeypatch.setattr(language_id, "PIECE", 50)
    parts, again = model.entropies(texts)
    assert abs(again - sizes).max() < 10 and parts == pytest.approx(whole, abs=0.3)


def test_mixing(docs, empty):
    rows = mixing.mixture_sizes(mixing.mix(docs)).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    sizes = {}
    for r in rows:
        sizes[r.target] = sizes.get(r.target, 0) + r.size
    assert sum(r.size for r in rows) == sum(len((t or "").split()) for _, t, *_ in DOCS)
    assert mixing.mixture_sizes(mixing.mix(empty)).collect() == []
    out = mixing.mixed_documents(docs)
    assert out.columns == [*docs.columns, "mix_pass", "mix_finish"]
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mixed_documents(docs.repartition(5)).collect()))
    finish = [r.mix_finish for r in out.collect()]
    assert finish == sorted(finish) and out.select(F.sum(F.size(F.split("text", " ")))).first()[0] > 0


@pytest.mark.parametrize("copies", [300, 40])
def test_mixing_of_copies(spark, copies):
    texts = [(7, "the same words again and again", "a")] * copies + [(100 + i, "one two three " * (i % 5 + 1), "abc"[i % 3]) for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(7)
    # Brute force: the copies as documents of their own, one behind the other in their source.
    given = mixing.mix(docs).collect()
    queue = []
    for r in given:
        queue += [((r.start + k * r.size) / r.target, r.source, r["pass"], r.doc_id, k, r.size) for k in range(1, r.copies + 1)]
    taken, total, budget = [], 0, sum({r.source: r.target for r in given}.values())
    for entry in sorted(queue):
        total += entry[-1]
        if total > budget:
            break
        taken.append(entry)
    got = {(r.doc_id, r["pass"]): r.taken for r in given}
    assert all(sum(t[3] == d and t[2] == p for t in taken) == n for (d, p), n in got.items())
    assert any(0 < got[7, p] < copies for p in (0, 1)) == (copies == 300)
    out = mixing.mixed_documents(docs).collect()
    assert [(r.mix_finish, r.source, r.mix_pass, r.doc_id) for r in out] == [t[:4] for t in taken]
    sizes = mixing.mixture_sizes(mixing.mix(docs)).collect()
    assert len(sizes) == len(texts) and sum(r.taken for r in sizes) == sum(t[-1] for t in taken)
    for r in {(r.target, r.source_size) for r in sizes}:
        assert abs(sum(x.taken for x in sizes if x.target == r[0]) - r[0]) <= 30


def test_mixing_without_words(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.size, r.target, r.taken) for r in mixing.mixture_sizes(mixing.mix(rows)).collect()} == {(0, 0.0, 0)}


def test_simhash(docs, empty):
    exact = brute.near_fingerprints([d[:2] for d in SINGLE])
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(DOCS) and {r.doc_id: r.component_id for r in rows} == exact
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(exact.values()))
    assert simhash.near_duplicates(empty).collect() == [] == simhash.first_of_each(empty).collect()


def test_simhash_null_id(spark):
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, "c d e f g"), (3, "a b")], "doc_id long, text string")
    found = sorted((r.doc_id is None, str(r.component_id), r.keeper) for r in simhash.near_duplicates(rows).collect())
    assert found == [(False, "3", True), (True, "3", False), (True, "3", False), (True, "None", True)]
    assert simhash.first_of_each(rows).count() == 2


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short, ITEM!"), (3, None), (4, "..."), (None, "null item here"),
         (10, "short item"), (5, " ".join(["the"] * 12))]


def test_decontamination(spark, docs, empty):
    texts = [
        (1, "x ONE two, three four five six seven eight nine TEN y"), (2, "one two three four five six seven eight or nine ten eleven"),
        (3, None), (4, ""), (5, "a short item and a short-item"), (6, "null item here"), (7, "the " * 40), (8, LONG),
        (9, "zero two three four five six seven eight nine ten eleven x"), (1, "short item"), (7, "the " * 40),
    ]
    more = spark.createDataFrame([(*t, 1, "w", 0) for t in texts], "doc_id long, text string, n_hit int, window string, start int")
    items = spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id int, text string, phrase string")
    rows = decontamination.judge_documents(more, items).collect()
    named = [(a, b) for a, b in ITEMS if a is not None]
    for r in rows:
        one = brute.contaminated([(0, r["_row"]["text"])], named)[0]
        hit = one[1] if r["_row"]["doc_id"] != 6 else 3
        assert (r.n_words, r.n_hit, r.hit_items) == (one[0], hit, one[2]), r
    assert len(rows) == len(texts)
    near = {r["_row"]["doc_id"]: r.n_near for r in rows}
    assert near[2] > 0 == near[8]
    clean = decontamination.clean_documents(more, items)
    assert clean.columns == more.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 8]
    assert decontamination.judge_documents(empty, items).collect() == []
    assert decontamination.judge_documents(docs, items.limit(0)).filter("n_hit > 0").count() == 0


def test_decontamination_without_broadcast(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    exact = brute.contaminated([(r.doc_id, r.text) for r in given.collect()], [(r.item_id, r.text) for r in items.collect()])
    rows = decontamination.judge_documents(given, items).collect()
    assert {r["_row"]["doc_id"]: (r.n_words, r.n_hit, r.hit_items) for r in rows} == exact


def test_embeddings(spark):
    one = [1.0, 0.0, 0.0, 0.5]
    rows = [(1, one), (2, one), (3, None), (4, []), (5, [0.0] * 4), (6, [1.0, None, 0.0, 0.0]), (7, [float("nan")] * 4),
            (8, [float("inf"), 0.0, 0.0, 0.0]), (9, [x * 1e30 for x in one]), (10, [-x for x in one]), (2, one), (11, [1.0, 0.0]),
            (12, [5.0, 0.0]), (None, one), (13, [3.0])]
    frame = spark.createDataFrame([(*r, 1, "c") for r in rows], "vec_id long, embedding array<float>, cid int, vector string")
    found = sorted((r.vec_id or 99, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame).collect())
    assert found == [
        (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
        (7, 0, 7, True), (8, 0, 8, True), (9, 4, 1, False), (10, 0, 10, True), (11, 1, 11, True), (12, 1, 11, False),
        (13, 0, 13, True), (99, 4, 1, False),
    ]
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


URLS = {
    "http://Sub.NET/x": ("sub.net", "/x", "net/", "block"), "net": ("", "", None, "allow"), None: ("", "", None, "allow"),
    "x://net": ("net", "", None, "allow"), "x://net?a/": ("net", "", None, "allow"), "http://anet/": ("anet", "/", None, "allow"),
    "http://a.example.net/en/1?q#f": ("a.example.net", "/en/1", "example.net/en/", "allow"), "http://#": ("", "", None, "allow"),
    "http://example.net/en": ("example.net", "/en", "net/", "block"), "http://e.org/fr/": ("e.org", "/fr/", "org/fr/", "allow"),
    "a://b://example.com/de/": ("b:", "//example.com/de/", None, "allow"), "": ("", "", None, "allow"),
    "http://É.ORG/FR/": ("É.org", "/FR/", None, "allow"),
}


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u, None, 1, "c") for i, u in enumerate(URLS)], "page_id int, url string, html string, node int, own string")
    found = {r.page_id: tuple(r[1:]) for r in url_filter.judge_urls(pages).collect()}
    assert found == dict(enumerate(URLS.values()))
    assert url_filter.judge_urls(pages.limit(0)).collect() == []
    assert len(url_filter.judge_urls(pages.union(pages)).collect()) == 2 * len(URLS)


def test_url_filter_spreads_over_aliases(spark):
    page = lambda to: f"<head><LINK href='{to}' rel=canonical></head>"
    rows = [
        (1, "http://a.com/1", page("https://bad.net/x?a=1&amp;b=2")), (2, "http://b.com/2", page("/3")),
        (3, "http://b.com/3", "<meta http-equiv='refresh' content='0; url=http://a.com/1'>"), (4, "http://c.com/", page("http://d.com/5")),
        (5, "https://d.com/5#x", page("http://evil.net/")), (6, "http://d.com/5", page("http://f.org/fr/ok")), (7, "http://b.com/7", ""),
        (8, "http://bad.net/x?a=1&b=2", ""), (9, "http://e.com/9", page("mailto:x")), (10, "http://f.org/fr/ok", None),
        (11, "http://g.com/11", None), (12, "http://example.com/de/", None),
    ]
    redirects = spark.createDataFrame([("http://g.com/11", "http://example.com/de/"), (None, "http://x.net/"), ("q", "http://x.net/")], "url string, target string")
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    found = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, redirects).collect()}
    # 4, 5 and 6 are aliases of a blocked and of an allowed page: explicit allow comes first.
    assert {i for i, v in found.items() if v == "block"} == {1, 2, 3, 8, 11, 12} and len(found) == 12


@pytest.mark.parametrize(
    ("url", "target", "bad"),
    [
        ("http://a.com/en/x", "../de/1", "http://a.com/de/1"), ("http://a.com/en/x", "./y", "http://a.com/en/y"),
        ("http://a.com/en/x", "/b/./c/../d", "http://a.com/b/d"), ("http://a.com/en/x", "http://B.com/../q/..?z=/../", "http://b.com/?z=/../"),
        ("http://a.com/en/x?p=1#f", "?p=2", "http://a.com/en/x?p=2"), ("http://a.com", "?p=2", "http://a.com/?p=2"),
        ("http://a.com/en/x/", "..", "http://a.com/en/"), ("http://a.com/u/../en/x", "%2E%2e/./v/", "http://a.com/v/"),
        ("http://a.com/en/x", "y", "http://a.com/z/../en/./y"), ("http://a.com/en/x", "a/b//../c", "http://a.com/en/a/b/c"),
    ],
)
def test_url_filter_resolves_targets(spark, url, target, bad):
    tag = f'<link title="x" rel="alternate Canonical shortlink" href="{target}">'
    rows = [(1, url, tag), (2, bad, '<link rel=canonical href="http://bad.net/">'), (3, "http://a.com/en/", ""), (4, "http://a.com/x", "")]
    rows += [(5, "http://c.com/1", '<link rel="no-canonical" href="http://bad.net/">'), (6, "http://c.com/d/2", "<link rel='canonical' href='#top'>")]
    pages = spark.createDataFrame([*rows, (7, "http://c.com/d/", "<link rel='x canonical' href=http://bad.net/>")], "page_id int, url string, html string")
    found = {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()}
    same = {3} if bad == "http://a.com/en/" else set()
    assert {i for i, v in found.items() if v == "block"} == {1, 2, 7} | same


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (6, 1), (6, 0), (999, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 2}) == 1
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(empty, model).collect() == []
    assert quality.train(empty, labels).labels.size == 0


def test_hashes_are_the_contracts():
    assert brute.sha("") == hashlib.sha256(b"").hexdigest()
    assert simhash.fingerprint(b"A  b\x0bC d e\x1c") == brute.fingerprint("A  b\x0bC d e\x1c")


def texts_of(spark, htmls, host="h"):
    pages = spark.createDataFrame([(i, f"http://{host}/{i}", h) for i, h in enumerate(htmls)], "page_id int, url string, html string")
    return [r.text for r in sorted(html_extract.main_texts(pages).collect(), key=lambda r: r.page_id)]


def test_html_template_text_is_no_article(spark):
    """Menus and footers without a telling name, and a line inside the article, are the same on all pages of the host."""
    own = [f"This is what page {i} has to say, and it says it at some length {'and more ' * i}." for i in range(6)]
    untold = ["<div class=z9>Home | About | Contact</div><div class=c3><p>%s</p></div><div class=q2>Copyright of it all</div>" % t for t in own]
    assert texts_of(spark, untold) == [t.strip() for t in own]
    shared = ["<article><p>%s</p><p>Share on Facebook - Read more news</p></article>" % t for t in own]
    assert texts_of(spark, shared) == [t.strip() for t in own]
    # Few pages, or text that most pages do not have, tell nothing.
    assert texts_of(spark, shared[:3])[0] == own[0].strip() + "\n\nShare on Facebook - Read more news"
    some = [p if i % 3 else p.replace("Share on", "Found on") for i, p in enumerate(shared)]
    assert all("Read more news" in t for t in texts_of(spark, some))
    # Copies of one page do not make its text a template; a page that is nothing but template keeps its text.
    assert texts_of(spark, [shared[0]] * 9)[0].startswith(own[0].strip())
    assert texts_of(spark, ["<div><p>same</p></div><!-- %d -->" % i for i in range(5)]) == ["same"] * 5


def test_html_of_a_host_with_many_signatures(spark, monkeypatch):
    """More signatures than a group takes: wrappers are aligned as a tree."""
    monkeypatch.setattr(html_extract, "FAN", 3)
    rng = np.random.default_rng(2)
    pages, texts = [], []
    for i in range(60):
        parts = [f"<{t}>Text {i} {j} with words</{t}>" for j, t in enumerate(rng.choice(["p", "h2", "pre", "blockquote"], rng.integers(1, 9)))]
        pages.append(f"<nav>Menu {i}</nav><article>{''.join(parts)}</article><footer>end</footer>")
        texts.append("\n\n".join(f"Text {i} {j} with words" for j in range(len(parts))))
    assert texts_of(spark, pages) == texts
    rows = spark.createDataFrame([("http://h/", p) for p in pages], "url string, html string")
    (found,) = html_extract.wrappers(rows).collect()
    assert found.pages == 60 and "article" in found.container


def test_long_irregular_streams_are_cut_where_both_agree(monkeypatch):
    monkeypatch.setattr(html_extract, "CELLS", 40)
    left = tuple(f"a{i}" if i % 4 else f"k{i}" for i in range(60))
    right = tuple(f"b{i}" if i % 4 else f"k{i}" for i in range(60))
    out = html_extract.aligned(left, right)
    assert [x for x in out if isinstance(x, str)] == [f"k{i}" for i in range(0, 60, 4)]
    assert sum(isinstance(x, tuple) and x[0] == "?" for x in out) == 30
    apart = html_extract.aligned(("x",) * 9 + ("y",) * 9, ("z",) * 18)
    assert apart == (("?", ("x",) * 9 + ("y",) * 9), ("?", ("z",) * 18))
