"""Language models against Kneser-Ney in fractions, and rejection of text the models have not seen."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from lakelayers.llm import language_id as L

GERMAN = [
    "Der Hund lief gestern durch den Garten und bellte laut, weil die Katze auf dem Dach der Nachbarn saß und nicht herunterkommen wollte.",
    "Am Morgen gehen wir gemeinsam in die Stadt, um frisches Brot und etwas Käse für das Frühstück zu kaufen.",
]
ENGLISH = [
    "The weather was fine and we walked along the river until the evening came and the lights were lit in the houses.",
    "She opened the letter slowly and read the few lines that her brother had written from the other side of the sea.",
    "It is not easy to find a good place for the children to play when the streets are full of cars all day.",
    "When the train arrived at the station nobody was waiting there, so he took his bag and went to the hotel alone.",
]


def kneser_ney(grams: Counter, order: int, gram: tuple) -> Fraction:
    """Interpolated Kneser-Ney as the textbook has it, one discount per order."""
    if order == 0:
        return Fraction(1, 1 << L.BITS)
    ones, twos = (sum(n == k for n in grams.values()) for k in (1, 2))
    discount = Fraction(ones, ones + 2 * twos) if ones and twos else Fraction(1, 2)
    below = Counter()
    for g in grams:
        below[g[1:]] += 1
    lower = kneser_ney(below, order - 1, gram[1:])
    own = {g: n for g, n in grams.items() if g[:-1] == gram[:-1]}
    if not own:
        return lower
    total = sum(own.values())
    return max(Fraction(own.get(gram, 0)) - discount, 0) / total + discount * len(own) / total * lower


@pytest.mark.parametrize("text", ["abracadabra abba", "aaab", "ab ba ab ba cab", "x"])
def test_probabilities(text):
    ids = {c: i for i, c in enumerate(sorted({*text, "q", " "}))}
    padded = " " * (L.ORDER - 1) + text
    grams = Counter(tuple(padded[i : i + L.ORDER]) for i in range(len(padded) - L.ORDER + 1))

    def packed(g):
        out = 0
        for c in g:
            out = out << L.BITS | ids[c]
        return out

    model = L.KneserNey(np.array([packed(g) for g in grams]), np.array(list(grams.values())), 1 << L.BITS)
    rng = random.Random(1)
    wanted = [*grams, *[tuple(rng.choices(list(ids), k=L.ORDER)) for _ in range(60)]]
    found = model.probability(np.array([packed(g) for g in wanted]))
    exact = [float(kneser_ney(grams, L.ORDER, g)) for g in wanted]
    assert np.allclose(found, exact, rtol=1e-12, atol=0)
    whole = defaultdict(Fraction)
    for c in ids:
        whole["a"] += kneser_ney(grams, L.ORDER, (*padded[: L.ORDER - 1], c))
    unseen = (1 << L.BITS) - len(ids)
    assert abs(float(whole["a"]) + unseen * float(kneser_ney(grams, L.ORDER, (*padded[: L.ORDER - 1], "?"))) - 1) < 1e-9


def junk():
    rng = random.Random(1)
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=300)), "xq zzkv qpw vvx jjkq wwz " * 8, "аоуыэ ёжзк лмнп " * 6]


@pytest.mark.parametrize("max_grams", [L.MAX_GRAMS, 10])
def test_languages_with_few_texts_are_kept(spark, max_grams):
    """One German and four English texts to learn from: another German and other English texts stay, junk goes."""
    rows = [(GERMAN[0], "de"), *[(t, "en") for t in ENGLISH]]
    model = L.train(spark.createDataFrame(rows, "text string, lang string"), max_grams=max_grams)
    asked = [GERMAN[1], "There are many reasons why people decide to leave the country where they were born.", *junk()]
    found = L.identify(spark.createDataFrame([(t,) for t in asked], "text string"), model).collect()
    found = {r["_row"].text: (r.lang_pred, r.rejected) for r in found}
    assert [found[t] for t in asked[:2]] == [("de", False), ("en", False)]
    assert all(found[t][1] for t in asked[2:])


def test_single_short_text(spark):
    """Too short to be halved: what unseen text costs cannot be measured, and ordinary text stays."""
    model = L.train(spark.createDataFrame([("Guten Morgen, liebe Leute", "de"), (ENGLISH[0], "en")], "text string, lang string"))
    assert set(model.limits) == {"de", "en"}
    found = L.identify(spark.createDataFrame([("Guten Abend, liebe Leute",)], "text string"), model).collect()
    assert [(r.lang_pred, r.rejected) for r in found] == [("de", False)]


def test_texts_of_other_kinds_stay(spark, sf_dir):
    """Plain sentences under the models of the given, invented texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = L.train(docs)
    asked = spark.createDataFrame([(t,) for t in [*ENGLISH, GERMAN[1], *junk()]], "text string")
    found = {r["_row"].text: r.rejected for r in L.identify(asked, model).collect()}
    assert not any(found[t] for t in [*ENGLISH, GERMAN[1]]) and all(found[t] for t in junk())
    assert L.identify(docs, model).filter("rejected AND symbols > 0").count() == 0


def test_halves():
    text = "word " * 300 + "x" * 500
    left, right = L.halves(text)
    assert sorted((left + " " + right).split()) == sorted(text.split()) and abs(len(left) - len(right)) < 700
    assert L.halves(text) == (left, right) and L.halves("") == ("", "") and sorted(L.halves("short")) == ["", "short"]


def test_threshold_keeps_at_most_that_many(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1] * 10 + [2] * 5 + [3] * 4 + [4, 9, 1000])], "gram long, n long")
    for most in range(24):
        at = L._threshold(counts, most)
        assert counts.filter(f"n >= {at}").count() <= most and (at == 1 or counts.filter(f"n >= {at // 2}").count() > most)
    assert L._threshold(counts.limit(0), 3) == 1


def test_letters_of_a_script_are_told_apart():
    symbols, letters = L._alphabet()
    assert symbols.min() == 0 and symbols.max() < 1 << L.BITS
    for first, last in ((0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0x0900, 0x097F), (0x0E01, 0x0E30), (0x3041, 0x30FF)):
        used = symbols[first : last + 1][letters[first : last + 1]]
        assert len(used) == len(set(used.tolist())) and used.all()
    # The widest n-gram is a positive long.
    assert (1 << L.BITS * L.ORDER) - 1 < 1 << 63


def test_languages_in_ideographs(spark):
    """Ideographs that shared a symbol in a small alphabet tell these two languages apart."""
    chinese = ["今天天气很好我们一起去公园散步然后回家吃饭看书。", "他昨天在图书馆里看了很多关于历史和文化的书。", "老师告诉学生们明天要早一点到学校来参加考试。"]
    japanese = ["今日は天気が良いので公園を散歩してから家に帰ります。", "彼は昨日図書館で歴史と文化についての本を読みました。", "先生は学生たちに明日早く学校に来るように言いました。"]
    rows = [(t, "zh") for t in chinese[:2]] + [(t, "ja") for t in japanese[:2]]
    asked = spark.createDataFrame([(chinese[2],), (japanese[2],)], "text string")
    for max_grams in (L.MAX_GRAMS, 10):
        model = L.train(spark.createDataFrame(rows, "text string, lang string"), max_grams=max_grams)
        found = {r["_row"].text: r.lang_pred for r in L.identify(asked, model).collect()}
        assert found == {chinese[2]: "zh", japanese[2]: "ja"}
