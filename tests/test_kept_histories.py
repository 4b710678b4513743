"""Histories kept by snapshots: the rows of the whole, in any order of arrival."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rosterline.plans import kept_histories as kept
from rosterline.plans.histories import ENDPOINTS, ORGANISATION_NAMES, PERSON_NAMES, endpoint_se, othername_se

SCHEMA = "npi string, endpoint_type string, endpoint string, _input_file_date date"
DAY = dt.date(2024, 1, 1)


def snapshot(spark, *rows):
    return spark.createDataFrame([(n, "T", e, DAY + dt.timedelta(d)) for n, e, d in rows], SCHEMA)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xy"), st.integers(0, 300)), min_size=1, max_size=25),
    st.randoms(),
)
def test_any_order_gives_the_whole(spark, rows, observed, chance):
    days = sorted({d for _, _, d in observed})
    chance.shuffle(days)
    held = None
    for batch in (days[i : i + 4] for i in range(0, len(days), 4)):
        seen = snapshot(spark, *[x for x in observed if x[2] in batch])
        made = kept.with_snapshots(held, ENDPOINTS, seen).collect()
        held = spark.createDataFrame(made, "npi string, endpoint_type string, endpoint string, endpoint_dt_s date, endpoint_dt_e date")
    assert rows(ENDPOINTS.table(held)) == rows(endpoint_se(snapshot(spark, *observed)))


def test_gap_is_closed_by_a_late_snapshot(spark, rows, tmp_path):
    path = str(tmp_path)
    for day in (0, 90):
        kept.update_history(spark, path, ENDPOINTS, snapshot(spark, ("1", "e", day)))
    assert kept.read_history(spark, path, ENDPOINTS).count() == 2
    assert kept.update_history(spark, path, ENDPOINTS, snapshot(spark, ("1", "e", 45))) == [DAY + dt.timedelta(45)]
    (row,) = kept.read_history(spark, path, ENDPOINTS).collect()
    assert (row.endpoint_dt_e - row.endpoint_dt_s).days == 90


def test_a_snapshot_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    seen = snapshot(spark, ("1", "e", 3), ("2", "f", 3))
    assert len(kept.update_history(spark, path, ENDPOINTS, seen)) == 1
    assert kept.update_history(spark, path, ENDPOINTS, seen) == []
    assert kept.versions(spark, path) == [0]


def test_a_version_that_broke_off_is_written_again(spark, rows, tmp_path):
    path = str(tmp_path)
    kept.update_history(spark, path, ENDPOINTS, snapshot(spark, ("1", "e", 0)))
    snapshot(spark, ("9", "wrong", 9)).write.parquet(f"{path}/version=1/intervals")
    assert kept.versions(spark, path) == [0] and kept.held_dates(spark, path) == {DAY}
    for day in (10, 20, 30):
        kept.update_history(spark, path, ENDPOINTS, snapshot(spark, ("1", "e", day)))
    assert kept.versions(spark, path) == [2, 3]
    (row,) = kept.read_history(spark, path, ENDPOINTS).collect()
    assert (row.npi, row.endpoint_dt_e) == ("1", DAY + dt.timedelta(30))


def test_names_of_both_files_have_states_of_their_own(spark, rows):
    columns = "npi string, {} _input_file_date date"
    firms = spark.createDataFrame(
        [("1", "ACME", "3", DAY)],
        columns.format("provider_other_organization_name string, provider_other_organization_name_type_code string,"),
    )
    persons = spark.createDataFrame(
        [("2", "Jo", None, "Roe", "1", DAY)],
        columns.format(
            "provider_other_first_name string, provider_other_middle_name string, "
            "provider_other_last_name string, provider_other_last_name_type_code string,"
        ),
    )
    states = [
        kept.with_snapshots(None, history, df)
        for history, df in ((ORGANISATION_NAMES, firms), (PERSON_NAMES, persons))
    ]
    both = ORGANISATION_NAMES.table(states[0].unionByName(states[1]))
    assert rows(both) == rows(othername_se(firms, persons))


def test_nothing_to_read_before_the_first_snapshot(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        kept.read_history(spark, str(tmp_path / "none"), ENDPOINTS)
