"""Nulls, empty, long and repeated texts, clashing columns and empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from conftest import ODD

from rosterline.llm import (
    bpe,
    decontaminate,
    fingerprints,
    language,
    licenses,
    line_dedup,
    near_duplicates,
    quality,
    substring_dedup,
    token_counts,
)

TEXTS = [(doc, text or "") for doc, text, _ in ODD]


def pairs(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, "of the AND to the and"), (None, "another text of"), (3, None), (4, ""), (5, "#")],
        "item_id bigint, text string",
    )


def test_bpe_round_trip(odd, nothing):
    rows = bpe.decode(bpe.encode(odd)).collect()
    assert pairs(rows, "doc_id", "decoded") == sorted(
        ((doc, bytearray(text.encode())) for doc, text in TEXTS), key=repr
    )
    assert bpe.decode(bpe.encode(nothing)).collect() == []


def test_token_counts(odd, nothing):
    rows = token_counts.count_tokens(odd).collect()
    assert len(rows) == len(TEXTS)
    assert {(r["n_pieces"], r["n_tokens"]) for r in rows if r["doc_id"] in (1, 2)} == {(0, 0)}
    assert token_counts.count_tokens(nothing).collect() == []


def test_short_test_strings(odd, nothing, benchmark):
    rows = decontaminate.find_windows(odd, benchmark).collect()
    hits = {(r["doc_id"], r["n_hit"], tuple(r["items"])) for r in rows if r["n_hit"]}
    assert hits == {(5, 6, (1,)), (None, 6, (1,)), (5, 3, ())}
    small = decontaminate.find_windows(odd, benchmark, part_bytes=8).collect()
    assert pairs(rows, "doc_id", "n_words", "n_hit", "items", "spans") == pairs(
        small, "doc_id", "n_words", "n_hit", "items", "spans"
    )
    left = decontaminate.decontaminate(odd, benchmark)
    assert left.columns == odd.columns
    assert left.count() == len(TEXTS) - 4
    assert decontaminate.find_windows(nothing, benchmark).collect() == []
    assert decontaminate.decontaminate(odd, benchmark.limit(0)).count() == len(TEXTS)


def test_test_strings_of_any_id_and_in_copies(spark, odd, benchmark):
    """Copies of a test string are one, so that they cannot fill a part; ids need not be numbers."""
    named = benchmark.withColumn("item_id", F.concat(F.lit("i"), "item_id"))
    want = decontaminate.find_windows(odd, named)
    assert {x for r in want.collect() for x in r["items"]} == {"i1"}
    copies = named
    for _ in range(3):
        copies = copies.unionByName(copies)
    found = decontaminate.find_windows(odd, copies, part_bytes=8)
    names = ("doc_id", "n_words", "n_hit", "items", "spans")
    assert pairs(found.collect(), *names) == pairs(want.collect(), *names)


def test_substring_dedup(spark, odd, nothing):
    rows = substring_dedup.remove_repeats(odd).collect()
    want = [(doc, 0) for doc, _ in TEXTS]
    assert pairs(rows, "doc_id", "n_removed") == sorted(want, key=repr)
    assert substring_dedup.remove_repeats(nothing).collect() == []
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(9, f"a b {passage} c"), (3, f"x {passage} y"), (5, passage), (5, passage), (None, "q")],
        "doc_id bigint, text string",
    )
    rows = substring_dedup.remove_repeats(docs).collect()
    assert pairs(rows, "doc_id", "n_removed", "kept") == sorted(
        [(9, 60, "a b c"), (3, 0, f"x {passage} y"), (5, 60, ""), (5, 60, ""), (None, 0, "q")],
        key=repr,
    )


def test_licenses(spark, odd, nothing):
    assert {r["n_matches"] for r in licenses.find_licenses(odd).collect()} == {0}
    assert licenses.find_licenses(odd).count() == len(TEXTS)
    assert licenses.find_licenses(nothing).collect() == []
    mit = next(text for name, text in licenses.KNOWN if "free of charge" in text)
    docs = spark.createDataFrame(
        [
            (1, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ,")),
            (2, "Prose.\nReleased under the  MIT LICENCE\nmore"),
            (None, "Licensed under CC BY-NC 4.0"),
        ],
        "doc_id bigint, text string",
    )
    rows = licenses.find_licenses(docs).collect()
    assert pairs(rows, "doc_id", "licenses", "whole_text", "n_matches") == sorted(
        [
            (1, ["MIT"], ["MIT"], 1),
            (2, ["MIT"], [], 1),
            (None, ["CC-BY-NC-4.0"], ["CC-BY-NC-4.0"], 2),
        ],
        key=repr,
    )


def test_every_known_text_is_found(spark):
    """Whole, re-wrapped, in capitals and with a copyright line before it."""
    texts = [(name, text) for name, text in licenses.KNOWN if len(text) > 100]
    assert len(texts) > 15
    docs = []
    for i, (_, text) in enumerate(texts):
        words = text.upper().split()
        wrapped = "\n".join(" ".join(words[a : a + 1000]) for a in range(0, len(words), 1000))
        docs += [(2 * i, text), (2 * i + 1, "Copyright 2020 A. Uthor\n\n" + wrapped)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {r["doc_id"]: r["whole_text"] for r in licenses.find_licenses(df).collect()}
    assert found == {j: [texts[j // 2][0]] for j, _ in docs}


def test_line_dedup(odd, nothing):
    kept = line_dedup.without_copies(odd).drop("__removed")
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert len(rows) == len(TEXTS)
    # The null id holds the line first; rows that are the same are one document.
    assert [r["text"] for r in rows if r["doc_id"] == 5 and r["text"][:3] == "One"] == [
        "One two three four five six."
    ] * 2
    assert line_dedup.without_copies(nothing).collect() == []


def test_near_duplicates(spark, odd, nothing):
    rows = near_duplicates.near_duplicates(odd).collect()
    assert len(rows) == len(TEXTS)
    # Texts without words are equal if they are but for blanks at their ends.
    assert {r["class_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert near_duplicates.near_duplicates(nothing).collect() == []
    left = near_duplicates.one_of_each(odd)
    assert left.columns == odd.columns
    assert near_duplicates.one_of_each(nothing).collect() == []
    long = [f"w{i}" for i in range(300)]
    near = [*long[:150], "changed", *long[151:]]
    moved = [*long[150:], *long[:150]]
    docs = spark.createDataFrame(
        [(7, " ".join(long)), (4, " ".join(near)), (5, " ".join(moved)), (9, " ".join(long))],
        "doc_id bigint, text string",
    )
    rows = near_duplicates.near_duplicates(docs).collect()
    assert pairs(rows, "doc_id", "class_id") == [(4, 4), (5, 5), (7, 4), (9, 4)]


def test_one_of_each_with_repeated_ids(spark):
    """An id with several texts: a row goes for a row of its own group only."""
    long = [f"w{i}" for i in range(300)]
    near = " ".join([*long[:150], "changed", *long[151:]])
    other, third = " ".join(f"v{i}" for i in range(80)), " ".join(f"u{i}" for i in range(80))
    rows = [(1, " ".join(long)), (2, near), (2, other), (2, other), (3, other), (4, third), (None, third)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = near_duplicates.one_of_each(docs).collect()
    assert pairs(left, "doc_id", "text") == sorted(
        [(1, " ".join(long)), (2, other), (None, third)], key=repr
    )


def test_language(odd, nothing):
    trees = language.learn(odd)
    rows = language.identify(odd, trees).collect()
    assert len(rows) == len(TEXTS)
    none = {(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (1, 2, 3, 4)}
    assert none == {("und", 0.0)}
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 8} == {"de"}
    assert language.identify(nothing, trees).collect() == []
    untaught = language.identify(odd, language.learn(nothing)).collect()
    assert {r["lang_pred"] for r in untaught} == {"und"}


def test_fingerprints(odd, nothing):
    pairs_of = fingerprints.with_next(odd, "doc_id", "text", 1_000)
    rows = pairs_of.collect()
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = [
        (doc, text, order[(i + 1) % len(order)][1]) for i, (doc, text) in enumerate(order)
    ]
    assert pairs(rows, "id", "text", "next_text") == sorted(want, key=repr)
    ranged = fingerprints.with_next(odd, "doc_id", "text", 5 * fingerprints.RANGE_BYTES).collect()
    assert pairs(ranged, "id", "text", "next_text") == sorted(want, key=repr)
    made = fingerprints.fingerprints(pairs_of, keep=("id",), against=("next_text",)).collect()
    assert all(0 <= r["likeness_next_text"] <= 1 for r in made)
    assert fingerprints.with_next(nothing, "doc_id", "text", 0).collect() == []


def test_quality(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(5, 1), (8, 0), (8, 1), (None, 1), (7, None)], "doc_id bigint, quality int"
    )
    model = quality.fit(odd, labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == len(TEXTS)
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2)} == {model.prior}
    assert next(r["score"] for r in rows if r["doc_id"] == 8) < 0.5
    assert quality.score(nothing, model).collect() == []
    untaught = quality.score(odd, quality.fit(odd, labels.limit(0))).collect()
    assert {r["score"] for r in untaught} == {0.5}
