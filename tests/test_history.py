from __future__ import annotations

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterline.functions.fixed import OTHER_ID_CORRECTIONS
from rosterline.operators.fold import OTHER_IDS, TAXONOMIES
from rosterline.operators.history import (
    array_intervals,
    entry_intervals,
    merge_intervals,
    se_intervals,
)
from rosterline.plans.histories import (
    endpoint_se,
    license_se,
    otherid_se,
    otherid_se_packed,
    othername_se,
    pl_se,
    taxonomy_se,
)

DAY0 = dt.date(2020, 1, 1)


def day(n: int) -> dt.date:
    return DAY0 + dt.timedelta(days=n)


def runs_by_hand(days: set[int], gap: int) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for d in sorted(days):
        if runs and d - runs[-1][1] <= gap:
            runs[-1][1] = d
        else:
            runs.append([d, d])
    return [tuple(r) for r in runs]


def observations(spark, data):
    return spark.createDataFrame(
        [(k, v, day(d)) for k, v, d in data], "npi string, value string, d date"
    )


def test_gap_of_45_days_joins_and_46_splits(spark, rows):
    df = observations(spark, [("1", "a", 0), ("1", "a", 45), ("1", "b", 0), ("1", "b", 46)])
    assert rows(se_intervals(df, ["npi", "value"], "d")) == [
        ("1", "a", day(0), day(45)),
        ("1", "b", day(0), day(0)),
        ("1", "b", day(46), day(46)),
    ]


def test_copies_do_not_matter_and_values_come_back(spark, rows):
    df = observations(
        spark, [("1", "a", 0)] * 3 + [("1", "a", 30), ("1", "a", 200), ("2", "a", 31)]
    )
    assert rows(se_intervals(df, ["npi", "value"], "d")) == [
        ("1", "a", day(0), day(30)),
        ("1", "a", day(200), day(200)),
        ("2", "a", day(31), day(31)),
    ]


def test_random_histories_match_the_rule_in_both_forms(spark):
    rng = random.Random(7)
    data = [
        (str(k), v, rng.randrange(900))
        for k in range(120)
        for v in "abc"
        for _ in range(rng.randrange(1, 25))
    ]
    want = {
        (k, v, day(s), day(e))
        for k, v in {(k, v) for k, v, _ in data}
        for s, e in runs_by_hand({d for k2, v2, d in data if (k2, v2) == (k, v)}, 45)
    }
    df = observations(spark, data).repartition(7)
    by_sets = {tuple(r) for r in se_intervals(df, ["npi", "value"], "d").collect()}
    points = df.select("npi", "value", F.col("d").alias("s"), F.col("d").alias("e"))
    by_window = {tuple(r) for r in merge_intervals(points, ["npi", "value"], "s", "e").collect()}
    assert by_sets == by_window == want


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.integers(0, 400), st.sets(st.sampled_from("abcd"))),
        min_size=1,
        max_size=40,
    )
)
def test_slot_histories_equal_exploding_every_snapshot(spark, snapshots):
    ids = "array<struct<identifier:string,type_code:string,state:string,issuer:string>>"
    df = spark.createDataFrame(
        [
            (str(k), day(d), [(v, "01", "", "") for v in sorted(values)] or None)
            for k, d, values in snapshots
        ],
        f"npi string, d date, {OTHER_IDS.name} {ids}",
    )
    values = {"v": F.col("_slot.identifier")}
    runs = array_intervals(df, "npi", OTHER_IDS.name, "d")
    got = {tuple(r) for r in entry_intervals(runs, "npi", OTHER_IDS.name, values).collect()}
    seen: dict[tuple[str, str], set[int]] = {}
    for k, d, present in snapshots:
        for v in present:
            seen.setdefault((str(k), v), set()).add(d)
    want = {
        (k, v, day(s), day(e)) for (k, v), days in seen.items() for s, e in runs_by_hand(days, 45)
    }
    assert got == want


def test_merging_keeps_overlapping_and_nested_intervals_together(spark, rows):
    df = spark.createDataFrame(
        [("k", day(s), day(e)) for s, e in [(0, 300), (10, 20), (330, 340), (386, 390), (386, 386)]],
        "k string, s date, e date",
    )
    assert rows(merge_intervals(df, ["k"], "s", "e")) == [
        ("k", day(0), day(340)),
        ("k", day(386), day(390)),
    ]


def npidata(spark, taxonomies=(), ids=()):
    tax = "array<struct<code:string,license_number:string,license_state:string,primary_switch:string>>"
    idt = "array<struct<identifier:string,type_code:string,state:string,issuer:string>>"
    data = [("1", day(d), t, None) for d, t in taxonomies] + [("1", day(d), None, i) for d, i in ids]
    return spark.createDataFrame(
        data, f"npi string, _input_file_date date, {TAXONOMIES.name} {tax}, {OTHER_IDS.name} {idt}"
    )


def test_taxonomies_start_anew_when_the_primary_switch_changes(spark, rows):
    df = npidata(
        spark,
        taxonomies=[
            (0, [("T1", "L1", "MA", "N"), ("T2", "L1", "MA", "Y")]),
            (30, [("T1", "L1", "MA", "Y"), ("", "", "", "N")]),
            (60, [("T1", "L1", "MA", "Y")]),
        ],
    )
    lookup = spark.createDataFrame([("T1", "Surgery")], "taxonomy_code string, taxonomy_desc string")
    assert rows(taxonomy_se(df, lookup)) == [
        ("1", "T1^N^Surgery^2020-01-01^2020-01-01", "T1", "N", "Surgery", day(0), day(0)),
        ("1", "T1^Y^Surgery^2020-01-31^2020-03-01", "T1", "Y", "Surgery", day(30), day(60)),
        ("1", "T2^Y^^2020-01-01^2020-01-01", "T2", "Y", "", day(0), day(0)),
    ]
    assert rows(license_se(df)) == [
        ("1", "L1^MA^2020-01-01^2020-03-01", "L1", "MA", day(0), day(60))
    ]


def test_other_ids_with_unknown_types_and_marks_inside(spark, rows):
    df = npidata(
        spark,
        ids=[
            (0, [("X", "05", "MI", ""), ("", "01", "", "")]),
            (30, [("X", "05", "MI", ""), ("Y^", "99", "", "|PLAN")]),
        ],
    )
    assert rows(otherid_se(df), "other_id_token") == [
        ("X^05^MI^^MEDICAID^2020-01-01^2020-01-31",),
        ("Y^99^^PLAN^^2020-01-31^2020-01-31",),
    ]


def test_listed_corrections_apply_to_packed_values_only_for_their_provider(spark, rows):
    npi, wrong, right = OTHER_ID_CORRECTIONS[2]
    df = spark.createDataFrame(
        [(npi, wrong, day(0)), (npi, right, day(30)), ("7", "A^01^^", day(0))],
        f"npi string, {OTHER_IDS.name} string, _input_file_date date",
    )
    assert rows(otherid_se_packed(df), "npi", "other_id", "other_id_dt_s", "other_id_dt_e") == [
        (npi, "000000379333", day(0), day(30)),
        (npi, "4788534", day(0), day(30)),
        ("7", "A", day(0), day(0)),
    ]


def test_other_names_of_organisations_and_persons(spark, rows):
    organisations = spark.createDataFrame(
        [("1", "ACME", "3", day(0)), ("1", "ACME", None, day(0)), ("1", None, "3", day(0))],
        "npi string, provider_other_organization_name string, "
        "provider_other_organization_name_type_code string, _input_file_date date",
    )
    persons = spark.createDataFrame(
        [("2", "DOE", "JO", None, "1", day(0)), ("3", None, None, None, "1", day(0))],
        "npi string, provider_other_last_name string, provider_other_first_name string, "
        "provider_other_middle_name string, provider_other_last_name_type_code string, "
        "_input_file_date date",
    )
    assert rows(othername_se(organisations, persons), "npi", "othername_token") == [
        ("1", "ACME^3^Doing Business As^2020-01-01^2020-01-01"),
        ("1", "ACME^^^2020-01-01^2020-01-01"),
        ("2", "JO DOE^1^Former Name^2020-01-01^2020-01-01"),
    ]


def test_endpoints_and_secondary_locations(spark, rows):
    endpoints = spark.createDataFrame(
        [("1", "DIRECT", "a@b", day(0)), ("1", None, "a@b", day(0)), ("1", "DIRECT", None, day(0))],
        "npi string, endpoint_type string, endpoint string, _input_file_date date",
    )
    assert rows(endpoint_se(endpoints), "endpoint_token") == [
        ("DIRECT^a@b^2020-01-01^2020-01-01",),
        ("^a@b^2020-01-01^2020-01-01",),
    ]
    pl = "provider_secondary_practice_location_address_"
    places = spark.createDataFrame(
        [("1", "L1", "L2", "C", "S", "12345", day(0)), ("1", None, None, None, None, None, day(9))],
        f"npi string, {pl}address_line_1 string, {pl}_address_line_2 string, {pl}_city_name string, "
        f"{pl}_state_name string, {pl}_postal_code string, _input_file_date date",
    )
    assert rows(pl_se(places)) == [
        ("1", "L1^L2^C^S^12345^2020-01-01^2020-01-01", day(0), day(0)),
        ("1", "^^^^^2020-01-10^2020-01-10", day(9), day(9)),
    ]
