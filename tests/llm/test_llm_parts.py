"""Properties of the parts: crowded buckets, alignment, replay, anchors, trees, native plans."""

from __future__ import annotations

import base64
import random

import brute
import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterline.llm import fingerprints, groups, licenses, line_dedup, near_duplicates, quality
from rosterline.llm.bpe import MergeReplay
from rosterline.llm.token_counts import LongestMatch
from rosterline.llm.windows import Words

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
REPLAY = MergeReplay(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab etThé\n.", min_size=1, max_size=30), min_size=1, max_size=8))
def test_replay_equals_library(pieces):
    ids, sizes = REPLAY.encode([p.encode() for p in pieces])
    found = np.split(ids, np.cumsum(sizes)[:-1])
    assert [x.tolist() for x in found] == [LIBRARY.encode_ordinary(p) for p in pieces]


def test_replay_in_a_table_without_order():
    """A merge may make a pair of a smaller rank, which then comes first."""
    single = {bytes([b]): 100 + b for b in range(256)}
    ranks = single | {b"ab": 9, b"abc": 2, b"bc": 50, b"cab": 1, b"aba": 60}
    replay = MergeReplay(ranks)
    library = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    chance = random.Random(4)
    pieces = ["".join(chance.choice("abc") for _ in range(n)) for n in range(1, 60)]
    ids, sizes = replay.encode([p.encode() for p in pieces])
    found = np.split(ids, np.cumsum(sizes)[:-1])
    assert [x.tolist() for x in found] == [library.encode_ordinary(p) for p in pieces]


@settings(max_examples=60, deadline=None)
@given(st.text("ab etThé", max_size=40))
def test_automaton_equals_greedy_matching(text):
    rest, count = text.encode(), 0
    while rest:
        size = next(n for n in range(len(rest), 0, -1) if rest[:n] in RANKS)
        rest, count = rest[size:], count + 1
    assert AUTOMATON.count(text.encode()) == count


AUTOMATON = LongestMatch(RANKS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=40), st.lists(st.sampled_from("abcd"), max_size=40))
def test_alignment_equals_plain_table(one, other):
    one, other = " ".join(one), " ".join(other)
    want = brute.aligned_share(brute.ordered_kmers(one, 2), brute.ordered_kmers(other, 2))
    a, b = (near_duplicates.kmers(x.encode(), 2) for x in (one, other))
    got = near_duplicates.similarity(a, b, 0.5)
    if one and other and want >= 0.5:
        assert got == want
    elif one or other:
        assert got < 0.5 or one == other


def test_window_hashes_tell_windows_apart():
    words = [random.Random(1).choice(["a", "b", "ab", "ba"]) for _ in range(4000)]
    words = Words(" ".join(words).encode())
    joined = words.bytes.tobytes().split()
    for size in (1, 3, 25):
        found = {}
        for i, h in enumerate(words.hashes(size).tolist()):
            window = tuple(joined[i : i + size])
            assert found.setdefault(h, window) == window
        assert len(found) == len({tuple(joined[i : i + size]) for i in range(len(joined) - size + 1)})


def test_edit_similarity_of_lines(spark):
    chance = random.Random(5)
    rows = []
    for _ in range(300):
        words = [chance.choice(["a", "bc", "def", "ä"]) for _ in range(chance.randint(1, 12))]
        other = list(words)
        for _ in range(chance.randint(0, 3)):
            at = chance.randrange(len(other) + 1)
            other[at : at + chance.randint(0, 1)] = chance.choice([[], ["x"], ["bc", "a"]])
        rows.append((" ".join(words), " ".join(other) or "x"))
    df = spark.createDataFrame(rows, "a string, b string")
    found = df.select("a", "b", line_dedup.edit_similar(F.col("a"), F.col("b"), 0.7))
    for one, other, similar in found.collect():
        most = int(max(len(one), len(other)) * 0.3 + 1e-6)
        assert similar == (brute.edit_distance(one, other) <= most), (one, other)


def test_ends_of_long_lines_decide_nothing_wrongly(spark):
    """Long lines around the limit: edits all over, at one end, a passage moved, shared passages."""
    chance = random.Random(9)

    def words(n: int) -> list[str]:
        return ["".join(chance.choice("abcdefgh") for _ in range(chance.randint(1, 8))) for _ in range(n)]

    rows = []
    for _ in range(60):
        line = words(chance.randint(10, 50))
        text = " ".join(line)
        n = len(text)
        for share in (0.15, 0.19, 0.2, 0.21, 0.25):
            k = int(n * share)
            spread = list(text)
            for at in chance.sample(range(n), k):
                spread[at] = "z"
            rows.append((text, "".join(spread)))
            rows.append((text, "z" * k + text[k:]))
            rows.append((text, text[: n - k] + "z" * k))
            rows.append((text, "z" * k + " " + text))
            rows.append((text, text[k // 2 :] + text[: k // 2]))
            rows.append((text, text[k:]))
        passage = line[len(line) // 3 :]
        rows.append((text, " ".join([*words(len(line) // 3), *passage])))
        rows.append((text, " ".join([*passage, *words(len(line) // 3)])))
        rows.append((text, " ".join(words(len(line)))))
    rows = [(a.strip(), b.strip()) for a, b in rows]
    df = spark.createDataFrame(rows, "a string, b string")
    found = df.select("a", "b", line_dedup.edit_similar(F.col("a"), F.col("b"))).collect()
    for one, other, similar in found:
        most = int(max(len(one), len(other)) * 0.2 + 1e-6)
        assert similar == (brute.edit_distance(one, other) <= most), (one, other)
    assert 100 < sum(similar for *_, similar in found) < len(found) - 100


def test_crowded_buckets_lose_no_group(spark):
    """Numbers are linked if they are at most 3 apart; everything is in one bucket."""
    chance = random.Random(3)
    nodes = sorted(chance.sample(range(3000), 900))
    rows = spark.createDataFrame(
        [(1, n, n % 17, n, n - 5, n + 4) for n in nodes],
        "bucket int, node int, rank int, size int, low int, high int",
    )
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.where(F.col("b") - F.col("a") <= 3)

    got = {r["node"]: r["root"] for r in groups.link_groups(rows, verify).collect()}
    links = [(a, b) for a, b in zip(nodes, nodes[1:], strict=False) if b - a <= 3]
    want = brute.roots(nodes, links)
    members: dict = {}
    for node, root in want.items():
        members.setdefault(root, set()).add(node)
    assert {n: min(members[want[n]]) for n in nodes if len(members[want[n]]) > 1} == got


def test_one_dense_group_needs_few_pairs(spark):
    bounds = [F.lit(0).alias(c) for c in ("rank", "size", "low", "high")]
    rows = spark.range(2000).select(F.lit(1).alias("bucket"), F.col("id").alias("node"), *bounds)
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs

    found = groups.link_groups(rows, verify)
    assert found.agg(F.min("root"), F.max("root"), F.count("*")).first() == (0, 0, 2000)
    assert sum(seen) < 3 * 2000


def test_edited_copies_need_few_pairs(spark, monkeypatch):
    """Copies of one text, each with edits of its own: most can only be linked to the original."""
    chance = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    rows = [(1000, " ".join(base))]
    for doc in range(300):
        words = list(base)
        for at in chance.sample(range(150), chance.randint(1, 6)):
            words[at] = f"e{doc}x{at}"
        rows.append((doc, " ".join(words)))
    seen = []
    aligned = near_duplicates._aligned

    def counted(pairs, least):
        seen.append(pairs.count())
        return aligned(pairs, least)

    monkeypatch.setattr(near_duplicates, "_aligned", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates.near_duplicates(docs).collect()}
    assert got == brute.classes(dict(rows))
    assert sum(seen) < 6 * len(rows)


def test_trees_locate_edits():
    one = "First paragraph here.\nSecond one.\nThird paragraph, unchanged."
    other = one.replace("Second", "2nd")
    trees = fingerprints.tree(one), fingerprints.tree(other)
    assert fingerprints.parsed(fingerprints.printed(trees[0])) == trees[0]
    flat = [(i, j) for i, section in enumerate(trees[0][1]) for j in range(len(section))]
    assert fingerprints.edits(*trees) == [flat[1]]
    assert 0.5 < fingerprints.likeness(*trees) < 1
    assert fingerprints.tree("a b")[0] != fingerprints.tree("a  b")[0]


def test_repetition_terms():
    assert quality.repetition("") == (0.0, 0.0)
    assert quality.repetition("a a a a a")[0] == 0.8
    assert quality.repetition("x y\nx y")[1] == 0.5


def test_native_plans_have_no_python(spark, documents):
    for df in (
        licenses.find_licenses(documents),
        line_dedup.split_lines(documents, "doc_id", "text"),
        line_dedup.line_keys(line_dedup.split_lines(documents, "doc_id", "text")),
        line_dedup.without_copies(documents.limit(20)),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [w for w in ("Python", "Arrow", "Pandas", "CartesianProduct") if w in plan]
