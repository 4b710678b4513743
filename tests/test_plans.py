"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.frames import frame, npidata_with_slots, table
from checks.profile_queries import _tables as profile_tables
from rosterline.functions.fixed import CHANGE_COLUMNS
from rosterline.operators.addresses import address_usage
from rosterline.operators.history import se_intervals
from rosterline.operators.joins import salted_lookup_join
from rosterline.operators.lists import first_n
from rosterline.operators.payments import all_payments, payments_by_provider
from rosterline.operators.snapshots import change_frequency, latest_per_key, newest_dates
from rosterline.plans.flow import OutsideTables, profile_flow
from rosterline.plans.histories import license_se, otherid_se
from rosterline.session import staged
from rosterline.sources.store import append_snapshot, read_store

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_the_columns_they_need(spark):
    days = table(spark, SF, "events").selectExpr("user_id", "event_type", "cast(ts as date) d")
    plan = plan_of(se_intervals(days, ["user_id", "event_type"], "d"))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_an_interval_history_is_one_shuffle(spark):
    days = table(spark, SF, "events").selectExpr("user_id", "event_type", "cast(ts as date) d")
    assert plan_of(se_intervals(days, ["user_id", "event_type"], "d")).count("Exchange") == 1


@pytest.mark.parametrize("history", [otherid_se, license_se])
def test_slot_histories_explode_after_the_first_aggregation(spark, history):
    stored = npidata_with_slots(spark, SF)
    plan = plan_of(history(stored))
    explode = plan.index("Generate explode(")
    assert "collect_set" in plan[explode:]


def test_address_usage_reads_the_main_table_once(spark):
    npidata = spark.read.parquet(f"{SF}/orders.parquet")
    assert npidata.count()
    main, pl = frame(spark, SF, "npidata"), frame(spark, SF, "pl")
    plan = plan_of(address_usage(main, pl))
    assert plan.count("orders.parquet") == 2 and "FullOuter" not in plan


def test_latest_rows_take_two_scans_of_the_dates_they_need(spark, tmp_path):
    """The newest dates are a narrow table; wide rows are read twice, from pruned partitions."""
    append_snapshot(npidata_with_slots(spark, SF, "npidata_all"), str(tmp_path))
    stored = read_store(spark, str(tmp_path))
    plan = plan_of(latest_per_key(stored))
    assert "LeftSemi" in plan and "Window" not in plan
    assert len(re.findall(r"FileScan parquet \[[^]]*provider_first_name", plan)) == 2
    assert len(re.findall(r"PartitionFilters: \[[^]]*_input_file_date", plan)) == 2


def test_newest_dates_are_kept_by_snapshots(spark):
    """Snapshots in any order, some twice, give the dates of the whole."""
    rows = frame(spark, SF, "npidata").select("npi", "entity_type_code", "_input_file_date")
    parts = [rows.where(F.month("_input_file_date") == m) for m in (7, 1, 12, 3, 7)]
    held = None
    for part in parts:
        held = newest_dates(part, held=held)
    whole = newest_dates(rows.where(F.month("_input_file_date").isin(1, 3, 7, 12)))
    assert sorted(held.collect()) == sorted(whole.collect())
    wanted = rows.where(F.month("_input_file_date").isin(1, 3, 7, 12))
    got = latest_per_key(wanted, newest=staged(held, "newest"))
    assert sorted(got.collect()) == sorted(latest_per_key(wanted).collect())


def test_roster_limits_groups_before_the_shuffle(spark):
    members = table(spark, SF, "lineitem").select("l_suppkey", "l_partkey").distinct()
    plan = plan_of(first_n(members, ["l_suppkey"], "l_partkey", "out", "cnt", 40))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_a_hot_key_on_the_wide_side_of_a_join_is_split(spark):
    """A third of the rows belongs to one provider; the reader of its partition is split up."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = F.col("id")
        rows = spark.range(0, 30000, 1, 4).select(
            F.when(n % 3 == 0, F.lit("hot")).otherwise(n.cast("string")).alias("npi"),
            F.lit("1").alias("entity_type_code"),
            F.date_add(F.lit("2024-01-07").cast("date"), (n % 2).cast("int")).alias(
                "_input_file_date"
            ),
            F.sha2(n.cast("string"), 512).alias("wide"),
        )
        newest = latest_per_key(rows)
        assert len(newest.collect()) == 25000
        assert "skew=true" in plan_of(newest)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_only_the_bounded_hot_key_table_is_broadcast_by_hint(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paid = all_payments(frame(spark, SF, "general"), frame(spark, SF, "research"))
        plan = plan_of(payments_by_provider(paid))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 1 and "_load" in plan


def shuffles(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_the_join_of_the_profile_shuffles_nothing(spark):
    registry, outside = profile_tables(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        profile, _ = profile_flow(
            registry, OutsideTables(reval=outside.reval, pc_provider=outside.pc_provider)
        )
        plan = plan_of(profile)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 3
    assert "Exchange" not in plan


def test_wide_rows_are_shuffled_once_for_all_change_frequencies(spark):
    rates = change_frequency(npidata_with_slots(spark, SF, "npidata_all"), CHANGE_COLUMNS)
    plan = plan_of(rates)
    sets = [line for line in plan.splitlines() if "ObjectHashAggregate" in line and "collect_set" in line]
    assert len(sets) == 2  # before and after the shuffle
    assert "Expand" not in plan.split("collect_set")[1]


def test_a_third_of_the_rows_in_one_cell_is_dealt_out(spark):
    """No task of the join gets many more rows than others, and every row its list."""
    n = F.col("id")
    located = spark.range(0, 30_000, 1, 4).select(
        n.cast("string").alias("npi"),
        F.when(n % 3 == 0, F.lit("hot")).when(n % 3 == 1, F.concat(F.lit("c"), n % 500)).alias("cell"),
    )
    lists = located.select("cell").dropna().distinct().select(
        "cell", F.array_repeat(F.col("cell"), 250).alias("listed")
    )
    joined = salted_lookup_join(located, lists, "cell", rows=500)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = joined.withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in rows.groupBy("task").count().collect()]
        wrong = joined.where(
            (F.col("cell").isNull() != F.col("listed").isNull())
            | (F.get("listed", 249) != F.col("cell"))
        )
        assert wrong.count() == 0
        assert joined.select("npi").distinct().count() == joined.count() == 30_000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(sizes) == 16 and max(sizes) < 30_000 / 6
