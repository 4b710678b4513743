"""Languages of few documents beside one of many."""

from __future__ import annotations

import random

import numpy as np
import pytest

from rosterline.llm import language


def corpus() -> list[tuple]:
    """Many texts in Latin letters, and two languages of rare scripts with two texts each."""
    chance = random.Random(4)

    def text(letters: str) -> str:
        return " ".join("".join(chance.choices(letters, k=5)) for _ in range(40))

    latin = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x180)))
    rows = [(text(latin), "la") for _ in range(300)]
    rows += [(text("ႠႡႢႣႤႥႦ"), "ka"), (text("ႠႡႢႣႤႥႦ"), "ka")]
    rows += [(text("አኡኢኣኤእኦ"), "am"), (text("አኡኢኣኤእኦ"), "am")]
    return [(i, *row) for i, row in enumerate(rows)]


@pytest.mark.parametrize("grams", [4_000_000, 1])
def test_rare_languages_keep_their_trees(spark, monkeypatch, grams):
    """Also with a pass for each language."""
    monkeypatch.setattr(language, "PASS_GRAMS", grams)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    learned = language.learn(docs)
    assert learned.langs == ["am", "ka", "la"]
    assert learned.counts.df.where("lang = 'ka'").agg({"n": "sum"}).first()[0] == sum(
        len(text.encode()) for _, text, lang in rows if lang == "ka"
    )
    assert len(learned.passes) == (1 if grams > 1 else 3)
    found = language.identify(docs, learned)
    assert found.columns == ["doc_id", "lang_pred", "score"]
    got = {r["doc_id"]: r["lang_pred"] for r in found.collect()}
    assert got == {i: lang for i, _, lang in rows}


def test_bytes_of_all_languages_are_told_apart():
    """127 frequent bytes of one language do not make the bytes of another alike."""
    hot = "".join(map(chr, range(0x20, 0x250)))
    trees = []
    for text in (hot * 50, "አኡኢ" * 3, "ႠႡႢ" * 3):
        grams, _ = language._grams([text])
        keys, n = np.unique(grams, return_counts=True)
        trees.append(language.Tree(keys.astype("int64"), n))
    bits = language.lengths(trees, ["አኡኢ", "ႠႡႢ", ""])
    assert bits.argmin(axis=1).tolist() == [1, 2, 0] and bits[2].tolist() == [0, 0, 0]
    assert bits[0, 1] < bits[0, 2] - 8


def test_signs_that_are_no_letters(spark):
    """Fractions, raised and circled numbers are numbers: such texts have no language."""
    trees = language.learn(spark.createDataFrame([(1, "some words here", "en")], "doc_id int, text string, lang string"))
    docs = spark.createDataFrame([(1, "½ ² ① _ 7"), (2, "ª"), (3, "x²")], "doc_id int, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, trees).collect()}
    assert found == {1: "und", 2: "en", 3: "en"}
