"""Sketches of short texts that are just similar enough."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from rosterline.llm import near_duplicates
from rosterline.llm.near_duplicates import SHORT, sketches


def test_short_pairs_have_a_sketch_in_common():
    """The shorter text is the longer one without some k-mers: 0.8 of all are aligned."""
    chance = np.random.default_rng(1)
    for one, other in ((4, 5), (5, 6), (8, 10), (9, 11), (12, 15), (16, 20), (24, 30), (48, 60), (60, 75)):
        for _ in range(500):
            longer = chance.integers(0, 2**63, other).astype(np.uint64)
            shorter = longer[np.sort(chance.choice(other, one, replace=False))]
            assert np.intersect1d(sketches(longer), sketches(shorter)).size


def test_stated_share_of_longer_pairs():
    """Six k-mers drawn from the aligned ones, for each size beyond ``SHORT``."""
    for longer in range(SHORT + 1, 2_000):
        aligned = -(-longer * 4 // 5)
        alike = np.prod([(aligned - i) / (longer - i) for i in range(6)])
        assert (1 - alike) ** 24 < 0.00105


def test_a_common_header_makes_no_pairs(spark):
    """400 unrelated texts of 17 words that begin with the same five share no bucket."""
    chance = random.Random(6)
    texts = [
        "all begin with these words " + " ".join(f"w{chance.randrange(10**9)}" for _ in range(12))
        for _ in range(400)
    ]
    found = [set(near_duplicates.sketches(near_duplicates.kmers(near_duplicates.canonical(t))).tolist()) for t in texts]
    counts = Counter(x for sketches in found for x in sketches)
    assert max(counts.values()) == 1
