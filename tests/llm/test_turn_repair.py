"""Conversation repair against all edits of short conversations, and long ones in stretches."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import product

import pytest
from conftest import SF
from pyspark.sql import functions as F

from rosterline.llm import turn_repair
from rosterline.llm.queries import QUERIES

VALID = re.compile(r"(s?(ua)+)?")


def every_repair(kinds: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """The smallest (cost, audit), by trying everything; four insertions are enough for any."""
    best = (1 << 60, "")
    edits = [[("D", "", 4)] for _ in kinds]
    for choices, (initial, must_go, broken) in zip(edits, kinds, strict=True):
        if not must_go:
            more = 3 if broken else 0
            choices += [("K", initial or "?", more), ("R", "u", 3 + more), ("R", "a", 3 + more)]
    inserted = [("".join(x), len(x)) for n in range(3) for x in product("ua", repeat=n)]
    for chosen in product(*edits):
        for gaps in product(inserted, repeat=len(kinds) + 1):
            roles, audit, cost = gaps[0][0], "I" * gaps[0][1], 3 * gaps[0][1]
            for (edit, role, price), (extra, n) in zip(chosen, gaps[1:], strict=True):
                roles, audit, cost = roles + role + extra, audit + edit + "I" * n, cost + price + 3 * n
            if (cost, audit) < best and VALID.fullmatch(roles):
                best = (cost, audit)
    return best


def test_cheapest_repair_of_all():
    kinds = [(x, False, b) for x in "sua" for b in (False, True)] + [("", False, False), ("u", True, False)]
    for n in range(3):
        for chosen in product(kinds, repeat=n):
            assert turn_repair.cheapest(turn_repair.cell_of(chosen)) == every_repair(chosen), chosen
    chance = random.Random(8)
    for _ in range(25):
        chosen = [chance.choice(kinds) for _ in range(3)]
        assert turn_repair.cheapest(turn_repair.cell_of(tuple(chosen))) == every_repair(chosen), chosen


def test_every_split_gives_the_same_cell():
    chance = random.Random(9)
    for _ in range(40):
        kinds = tuple(
            (chance.choice(["s", "u", "a", ""]), chance.random() < 0.2, chance.random() < 0.3)
            for _ in range(9)
        )
        whole = turn_repair.cell_of(kinds)
        for cut in range(1, 9):
            parts = turn_repair.cell_of(kinds[:cut]), turn_repair.cell_of(kinds[cut:])
            assert turn_repair.combined(*parts) == whole


def test_repaired_turns_follow_the_pattern():
    turns = [("assistant", "A."), ("system", "S."), ("user", "U.")]
    kinds = tuple((role[0], False, False) for role, _ in turns)
    cost, audit = turn_repair.cheapest(turn_repair.cell_of(kinds))
    assert (cost, audit) == every_repair(list(kinds))
    made = turn_repair.repaired(turns, audit)
    assert VALID.fullmatch("".join(role[0] for role, _ in made))


def summary(repaired) -> list[tuple]:
    """One row per conversation, with the hash of all its turns."""
    names = ["conv_id", "gaps", *turn_repair.Counts.NAMES, "cost", "audit"]
    heads = {r["conv_id"]: tuple(r[c] for c in names) for r in repaired.collect() if r["cost"] is not None}
    turns: dict = {}
    for row in sorted(repaired.collect(), key=lambda r: r["part"]):
        turns.setdefault(row["conv_id"], []).extend((t["role"], t["text"]) for t in row["turns"])
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in turn_repair.digests(repaired).collect()}
    for conv, found in turns.items():
        text = "\n".join(f"{role}:{text}" for role, text in found)
        if conv in hashes:
            assert hashes[conv] == hashlib.sha256(text.encode()).hexdigest()
    return sorted(((*head, tuple(turns[conv])) for conv, head in heads.items()), key=repr)


@pytest.fixture(scope="module")
def long_ones(spark):
    """A few conversations, null among them, with most rows in one."""
    chance = random.Random(5)
    rows = []
    for i in range(400):
        conv = chance.choice([1, 1, 1, 1, 2, None, 3])
        rows.append(
            (
                conv,
                chance.choice([None, *range(120)]),
                chance.choice(["user", "assistant", "user", "assistant", "system", "tool", None]),
                chance.choice([None, "", " \t", "Same text.", f"Text {i}.", f"Text {i}", f"Why {i}?\n"]),
                chance.random() < 0.9 and conv != 3,
            )
        )
    return spark.createDataFrame(
        rows, "conv_id bigint, turn bigint, role string, text string, there boolean"
    ).repartition(3)


@pytest.mark.parametrize("long", [3, 40])
def test_stretches_give_the_same_repair(long_ones, long):
    present = F.col("there")
    whole = summary(turn_repair.repair(long_ones, present=present))
    cut = turn_repair.repair(long_ones, present=present, long=long)
    assert cut.where("parts > 1").count() > 2
    assert summary(cut) == whole
    assert {row[0] for row in whole} == {1, 2, 3, None}
    assert next(row for row in whole if row[0] == 3) == (3, 0, 0, 0, 0, 0, 0, "", ())


def test_faults(spark):
    turns = spark.createDataFrame(
        [
            (1, 0, "user", "Q?"),
            (1, 1, "assistant", "A!"),
            (1, 2, "user", "Q?"),
            (1, 2, "user", "Q?"),
            (1, 5, "user", "cut off "),
            (1, 6, "assistant", "\t"),
            (1, 7, "assistant", "Done. \n"),
        ],
        "conv_id int, turn int, role string, text string",
    )
    row = turn_repair.repair(turns).collect()[0]
    assert (row["gaps"], row["blank"], row["duplicate"], row["truncated"]) == (2, 1, 2, 1)
    assert row["illegal"] == 3
    assert (row["cost"], row["audit"]) == (15, "KKDDKDK")
    assert [t["role"] for t in row["turns"]] == ["user", "assistant", "user", "assistant"]


def test_empty_table_and_clashing_columns(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "Q?", 9, 9, 9, 9)],
        "conv_id int, turn int, role string, text string, part int, digest int, tie int, cost int",
    )
    row = turn_repair.repair(turns).collect()[0]
    assert (row["cost"], row["audit"]) == (3, "KI")
    assert turn_repair.repair(turns.limit(0)).collect() == []


def test_query_has_every_conversation(spark):
    found = QUERIES["op12_turn_repair"](spark, SF)
    convs = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct()
    assert found.count() == convs.count()
    assert found.select("conv_id").exceptAll(convs).count() == 0
