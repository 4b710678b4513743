"""Packing: all ids in exactly one place, full windows, the library's ids."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rosterline.llm import packing
from rosterline.llm.bpe import VOCABULARY
from rosterline.llm.queries import QUERIES

PATH = public_tokenizers.path(packing.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text: str | None) -> np.ndarray:
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, packing.END_ID], "<u4")


def assert_gapless(pieces: list[tuple[int, int, int]], window: int, short: int = 1) -> None:
    """(sequence, offset, length): no gaps, no overlaps, all but ``short`` sequences full."""
    held = defaultdict(list)
    for sequence, offset, length in pieces:
        held[sequence].append((offset, length))
    sizes = []
    for found in held.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    assert max(sizes, default=0) <= window
    assert sum(x < window for x in sizes) <= short


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 4), max_size=6), st.integers(1, 30))
def test_closest_sum_is_the_closest(counts, capacity):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * i for s in sums for i in range(n + 1)}
    found = packing.closest_sum(counts, capacity)
    assert all(0 < n <= counts[x] for x, n in found.items())
    assert sum(x * n for x, n in found.items()) == max(s for s in sums if s <= capacity)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 40), max_size=16))
def test_plan_places_every_id_once(counts):
    pieces, stretches = [], defaultdict(list)
    for of, first, last, start, length, member, members, window, at in packing.plan(counts, 16):
        for number in range(first, last + 1):
            mine = member + number - first
            pieces.append((window + mine // members, at + mine % members * length, length))
            stretches[of, number].append((start, length))
    assert len(stretches) == sum(counts.values())
    for (of, _), found in stretches.items():
        assert_gapless([(0, *x) for x in found], of, 0)
    assert_gapless(pieces, 16)


def test_plan_of_large_counts_is_short():
    assert len(packing.plan({length: 10**9 + 7 * length for length in range(1, 2049)})) < 20_000
    assert len(packing.plan({1500: 10**12, 2048: 10**13})) < 200


@pytest.mark.parametrize(
    "text",
    ["", " ", "a<|endoftext|>b <|endoftext|>", "naïve  café\n\n\t x", "日本語 \U0001f600 ʼn ٣ mixed", "\x00\x0b", "'s 12 're"],
)
def test_ids_are_the_librarys(text):
    ranks = public_tokenizers.path(VOCABULARY)
    encoder = packing.Encoder(PATH, ranks, public_tokenizers.PATTERN)
    assert [*encoder.ids(text), packing.END_ID] == ids_of(text).tolist()


def assert_pieces_hold(rows: list[dict], texts: list[tuple]) -> None:
    by = defaultdict(list)
    for row in rows:
        by[row["doc_id"]].append(row)
    for doc, text in texts:
        ids, at = ids_of(text), 0
        for row in sorted(by[doc], key=lambda r: r["start"]):
            assert (row["start"], row["doc_tokens"]) == (at, len(ids))
            piece = ids[at : at + row["length"]]
            assert row["ids_crc32"] == zlib.crc32(piece.tobytes())
            at += row["length"]
        assert at == len(ids)


def test_query_packs_all_documents(spark, texts):
    rows = [r.asDict() for r in QUERIES["op13_packing"](spark, SF).collect()]
    assert {r["doc_id"] for r in rows} == set(texts)
    assert_pieces_hold(rows, list(texts.items()))
    assert_gapless([(r["sequence_id"], r["offset"], r["length"]) for r in rows], packing.WINDOW)


def test_odd_input(odd, nothing):
    rows = packing.pack(odd, window=64).collect()
    want = defaultdict(int)
    for row in odd.select("doc_id", "text").collect():
        want[row["doc_id"]] += len(ids_of(row["text"]))
    got = defaultdict(int)
    for row in rows:
        assert len(row["ids"]) == 4 * row["length"]
        got[row["doc_id"]] += row["length"]
    assert got == want
    assert_gapless([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 64)
    assert packing.pack(nothing).collect() == []


def test_one_length_of_many_tasks(spark):
    """Copies of one text, in several tasks, each cut into two places."""
    docs = spark.range(300).selectExpr("id doc_id", "repeat('word ', 1400) text").repartition(5)
    rows = [r.asDict() for r in packing.pack(docs).collect()]
    assert {r["doc_id"] for r in rows} == set(range(300))
    assert sum(r["length"] for r in rows) == 300 * len(ids_of("word " * 1400))
    assert_gapless([(r["sequence_id"], r["offset"], r["length"]) for r in rows], packing.WINDOW)
