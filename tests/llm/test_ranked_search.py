"""Ranked search against plain scoring of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from conftest import ODD, SF

from rosterline.llm import ranked_search
from rosterline.llm.common import Stored

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text: str | None) -> list[str]:
    return [x.translate(LOWER) for x in TERM.findall(text or "")]


def plain(docs: list[tuple], queries: dict, k: int) -> list[tuple]:
    """(query, rank, id, score), every document scored."""
    held = [(doc, Counter(terms(text))) for doc, text in docs if terms(text)]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(term for _, c in held for term in c)
    out = []
    for query, text in queries.items():
        scores = []
        for doc, c in held:
            m = 100 - 50 + (50 * c.total() * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc is not None, doc or 0, doc))
        best = sorted(scores)[:k]
        out += [(query, i, x[3], -x[0]) for i, x in enumerate(best, 1)]
    return sorted(out, key=repr)


def ranked(docs, queries, k, segment_chars=10_000, span=16, **names) -> list[tuple]:
    index = Stored(ranked_search.build_index(docs, segment_chars=segment_chars, **names), "test")
    found = ranked_search.search(index.df, queries, k, span=span)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize(("segment_chars", "span"), [(20_000, 7), (200_000, 64), (10**9, 16)])
def test_equals_plain_scores(spark, documents, texts, segment_chars, span):
    queries = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain(list(texts.items()), {r["item_id"]: r["text"] for r in queries.collect()}, 5)
    assert ranked(documents, queries, 5, segment_chars, span) == want


def lists_of(texts: list[str], names: list[str]) -> list[ranked_search.Postings]:
    segment = ranked_search._Segment()
    for i, text in enumerate(texts):
        segment.add(pa.array([i]), text)
    words, df, packed, _, lengths = segment.lists()
    n, total = len(lengths), int(lengths.sum())
    measures = ranked_search.measure(lengths, n, total)
    out = []
    for name in names:
        i = words.index(name.encode())
        row = {"weight": int(1000 * math.log((2 * n + 2) / (2 * df[i] + 1))), "df": int(df[i])}
        row |= dict(zip(("blocks", "impacts", "payload"), (x[i].as_py() for x in packed), strict=True))
        out.append(ranked_search.Postings(row, n, total, measures))
    return out


def test_impacts_bound_every_block():
    chance = random.Random(3)
    texts = [" ".join(chance.choices("abcdef", k=chance.choice([3, 40, 900]))) for _ in range(700)]
    for held in lists_of(texts, list("abcdef")):
        for i in range(len(held.last)):
            assert held.block(i)[1].max() == held.bounds[i]


def test_blocks_that_cannot_win_stay_packed():
    """A common word's blocks are unpacked only where a rare word stands."""
    chance = random.Random(4)
    texts = ["the " * chance.choice([0, 1, 3, 9]) + "x" for _ in range(20_000)]
    for i in (5, 11_000, 19_000):
        texts[i] = "the rare find"
    rare, common = lists_of(texts, ["rare", "the"])
    docs, scores = ranked_search.best([common, rare], len(texts), 3)
    assert docs.tolist() == [5, 11_000, 19_000]
    assert len(set(scores.tolist())) == 1
    assert len(common.unpacked) < len(common.last) / 4
    blocks = [common.block(i) for i in range(len(common.last))]
    every = sorted((-s, d) for docs, scores in blocks for d, s in zip(docs, scores, strict=True))
    only, _ = ranked_search.best([common], len(texts), 10)
    assert only.tolist() == [d for _, d in every[:10]]


def test_odd_input(spark, odd, nothing):
    queries = spark.createDataFrame(
        [(None, "One TWO of"), (3, "word5x5 the and"), (3, "der"), (4, None), (5, "!"), (6, "absent")],
        "item_id bigint, text string",
    )
    docs = [(doc, text) for doc, text, _ in ODD]
    want = plain(docs, {None: "One TWO of", 3: "word5x5 the and der"}, 9)
    assert ranked(odd, queries, 9) == want
    assert ranked(nothing, queries, 9) == []
    assert ranked(odd, queries.limit(0), 9) == []


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "doc_id string, text string")
    queries = spark.createDataFrame([("q", "x")], "item_id string, text string")
    found = [r[:3] for r in ranked(docs, queries, 9)]
    assert found == [("q", 1, "a"), ("q", 2, "b")]


def test_many_blocks_of_queries(spark, documents, texts, monkeypatch):
    monkeypatch.setattr(ranked_search, "QUERY_BLOCK", 7)
    queries = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain(list(texts.items()), {r["item_id"]: r["text"] for r in queries.collect()}, 5)
    assert ranked(documents, queries, 5, 50_000) == want
