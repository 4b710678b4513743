"""Lists of several fields, whose rows are shuffled once."""

from __future__ import annotations

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterline.operators.lists import (
    _cut,
    fields_in_parts,
    first_fields,
    further_fields,
    list_parts,
)


@pytest.mark.parametrize("max_keys", [3, 100_000])
def test_parts_of_fields_hold_every_item(spark, max_keys):
    """Keys of 1 to 40 items, the null key, a key with a third of all rows."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("h")).when(n % 41 < 40, F.concat(F.lit("k"), n % 41))
    rows = spark.range(2_000).select(key.alias("npi"), F.concat(F.lit("i"), n).alias("a"))
    others = rows.where(n % 2 == 0).select("npi", F.col("a").alias("b"))
    made, rest = fields_in_parts({"a": rows, "b": others}, "npi", 10, max_keys)
    first = first_fields(made, "npi", ["a", "b"]).collect()
    further = further_fields(made, "npi").unionByName(further_fields(rest, "npi")).collect()
    got = Counter()
    for row in first:
        got.update((row.npi, f, x) for f in ("a", "b") for x in row[f] or [])
    for row in further:
        assert row.part > 0 and len(row["items"]) < 40
        got.update((row.npi, row.field, x) for x in row["items"])
    want = Counter()
    for f, df in (("a", rows), ("b", others)):
        want.update((r[0], f, r[1]) for r in df.collect())
    assert got == want and max(got.values()) == 1
    assert all(row.more for row in first)


def test_rows_of_ordinary_keys_are_shuffled_once(spark):
    """Once for the lists; the other shuffles carry counts, and rows of broadcast keys."""
    df = spark.range(1_000).select(
        F.concat(F.lit("k"), F.col("id") % 50).alias("key"), F.col("id").cast("string").alias("x")
    )
    first = list_parts(df, ["key"], F.col("x"), "out", 5, first_only=True)
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [key") == 1
    assert "_salt" not in plan


def test_a_list_of_many_parts_is_cut_in_one_pass(spark):
    """3,000 items in parts of two: the work does not grow with items times parts."""
    items = F.sort_array(F.collect_list(F.col("id").cast("string")))
    rows = spark.range(60_000).groupBy((F.col("id") % 20).alias("k")).agg(items.alias("items"))
    parts = _cut(F.col("items"), F.size("items").cast("bigint"), 2)
    started = time.perf_counter()
    made = rows.select("k", F.explode(parts).alias("p")).select("k", "p.part", "p.items").collect()
    seconds = time.perf_counter() - started
    assert sorted(int(x) for r in made for x in r["items"]) == list(range(60_000))
    assert len({(r.k, r.part) for r in made}) == len(made)
    assert all(r["items"] == sorted(r["items"]) and 0 <= r.part <= 1_500 for r in made)
    plan = rows.select(parts)._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(transform" in plan and seconds < 30


def test_parts_of_a_list_come_out_of_one_broadcast(spark):
    df = spark.range(1_000).select(
        (F.col("id") % 3).alias("key"), F.col("id").cast("string").alias("x")
    )
    plan = list_parts(df, ["key"], F.col("x"), "out", 5)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("BroadcastHashJoin") == 1
