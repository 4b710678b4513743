"""A third of all rows sits on one key; some items are copied thousands of times."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterline.operators.joins import lookup_join
from rosterline.operators.lists import first_n, list_parts, multiset_parts, set_parts

MAX = 50


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: key h has 1,000, of which 400 are copies of one item."""
    n = F.col("id")
    key = F.when(n < 1000, F.lit("h")).otherwise(F.concat(F.lit("k"), (n % 200).cast("string")))
    item = F.when(n < 400, F.lit("copy")).otherwise(F.concat(F.lit("i"), n.cast("string")))
    return spark.range(3000).select(key.alias("key"), item.alias("item"))


def gathered(parts):
    got = Counter()
    for row in parts.collect():
        got.update((row.key, x) for x in row.out)
    return got


def expected(df):
    return Counter((r.key, r.item) for r in df.collect())


@pytest.mark.parametrize("max_keys", [5, 100_000])
def test_many_medium_keys_are_split(spark, max_keys):
    """60 keys of 200 items and the null key, none above a fifth of the rows."""
    key = F.when(F.col("id") % 61 < 60, F.concat(F.lit("k"), F.col("id") % 61))
    df = spark.range(61 * 200).select(key.alias("key"), F.col("id").cast("string").alias("item"))
    for gather in (list_parts, set_parts, multiset_parts):
        parts = gather(df, ["key"], F.col("item"), "out", 10, max_keys)
        assert gathered(parts) == expected(df)
        rows = parts.collect()
        assert {r.total for r in rows} == {200}
        assert max(len(r.out) for r in rows) < 30 and {r.part for r in rows} == set(range(21))


def test_copies_of_one_item_in_many_runs(spark):
    df = spark.range(25_000).select(F.lit(None).cast("string").alias("key"), F.lit("x").alias("item"))
    parts = multiset_parts(df, ["key"], F.col("item"), "out", 1)
    assert parts.agg(F.sum(F.size("out")), F.max(F.size("out")) < 20).first() == (25_000, True)


def test_list_parts_are_whole_and_small(spark, skewed):
    unique = skewed.distinct()
    parts = list_parts(unique, ["key"], F.col("item"), "out", MAX)
    assert gathered(parts) == expected(unique)
    hot = parts.where("key = 'h'").collect()
    assert len(hot) > 8 and max(len(r.out) for r in hot) < 2 * MAX
    assert {r.total for r in hot} == {601}
    ordinary = parts.where("key <> 'h'").collect()
    assert len(ordinary) == 200 and {(r.part, r.total) for r in ordinary} == {(0, 10)}
    assert all(r.out == sorted(r.out) for r in [*hot, *ordinary])


def test_copies_of_one_item_are_spread_and_kept(spark, skewed):
    parts = multiset_parts(skewed, ["key"], F.col("item"), "out", MAX)
    assert gathered(parts) == expected(skewed)
    hot = parts.where("key = 'h'").collect()
    assert max(len(r.out) for r in hot) < 2 * MAX
    assert sum("copy" in r.out for r in hot) > 8
    assert {r.total for r in hot} == {1000}


def test_sets_drop_copies_and_nulls(spark, skewed):
    nulls = skewed.withColumn("item", F.when(F.col("item") != "i500", F.col("item")))
    parts = set_parts(nulls, ["key"], F.col("item"), "out", MAX)
    want = {(r.key, r.item) for r in nulls.collect() if r.item is not None}
    assert gathered(parts) == Counter(dict.fromkeys(want, 1))


def test_first_part_alone_is_one_row_per_key(spark, skewed):
    first = list_parts(skewed.distinct(), ["key"], F.col("item"), "out", MAX, first_only=True)
    assert first.columns == ["key", "total", "out"]
    every = list_parts(skewed.distinct(), ["key"], F.col("item"), "out", MAX).where("part = 0")
    assert sorted(map(tuple, first.collect())) == sorted(
        map(tuple, every.select(*first.columns).collect())
    )


def test_parts_do_not_depend_on_how_rows_are_spread(spark, skewed):
    def parts(n):
        df = multiset_parts(skewed.repartition(n), ["key"], F.col("item"), "out", MAX)
        return sorted(map(repr, df.collect()))

    assert parts(1) == parts(13)


def test_first_n_counts_all_and_shows_n(spark, skewed):
    roster = first_n(skewed.distinct(), ["key"], "item", "out", "cnt", 40)
    hot = roster.where("key = 'h'").first()
    members = sorted({r.item for r in skewed.where("key = 'h'").collect()})
    assert hot.cnt == 601 and hot.out == members[:40]


def test_lookup_join_equals_a_left_join_and_reads_each_table_once(spark, skewed, tmp_path):
    nulls = skewed.withColumn("key", F.when(F.col("key") != "k7", F.col("key")))
    lookup = spark.createDataFrame([("h", 1), ("k1", 2), ("k2", 3)], "key string, a int")
    other = spark.createDataFrame([("h", "x"), ("k3", "y")], "key string, b string")
    tables = []
    for name, df in (("left", nulls), ("lookup", lookup), ("other", other)):
        df.write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    left, *rights = tables
    plain = left.join(lookup, "key", "left").join(other, "key", "left")
    safe = lookup_join(left, rights, ["key"])
    assert safe.columns == plain.columns
    assert Counter(map(tuple, safe.collect())) == Counter(map(tuple, plain.collect()))
    plan = safe._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 3
