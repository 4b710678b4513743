"""A store by files: late, changed, emptied and vanished files, loads that broke off."""

from __future__ import annotations

import csv
import datetime as dt
from functools import partial

import pytest

from rosterline.functions.fixed import SNAPSHOT_DATE
from rosterline.sources import file_store
from rosterline.sources.file_store import published_files, read_file_store
from rosterline.sources.readers import SOURCE_FILE, read_main_files, read_side_files
from rosterline.streaming.incremental import load_changed_files

OLD = dt.date(2019, 12, 8)
NEW = dt.date(2024, 1, 7)
read = partial(read_side_files, source=True)


def write(path, *lines):
    path.parent.mkdir(exist_ok=True)
    with open(path, "w", newline="") as out:
        csv.writer(out, quoting=csv.QUOTE_ALL).writerows(lines)


@pytest.fixture
def landing(tmp_path):
    write(tmp_path / "in" / "pl_a b_20191208.csv", ["NPI", "City"], ["1", "A"], ["2", "two\nlines"])
    write(tmp_path / "in" / "pl_c_20240107.csv", ["NPI", "City", "State"], ["3", "C", "MA"])
    return tmp_path / "in"


def load(spark, landing, per_load=200):
    paths = load_changed_files(spark, str(landing), str(landing.parent / "store"), read, per_load)
    return sorted(path.rsplit("/", 1)[-1] for path in paths)


def held(spark, landing, rows):
    store = read_file_store(spark, str(landing.parent / "store"))
    return rows(store, "npi", "city", "state", SNAPSHOT_DATE)


FIRST = [("1", "A", None, OLD), ("2", "two\nlines", None, OLD), ("3", "C", "MA", NEW)]


@pytest.mark.parametrize("per_load", [1, 200])
def test_files_are_loaded_once(spark, landing, rows, per_load):
    assert load(spark, landing, per_load) == ["pl_a b_20191208.csv", "pl_c_20240107.csv"]
    assert load(spark, landing, per_load) == []
    assert held(spark, landing, rows) == FIRST


def test_late_changed_and_vanished_files(spark, landing, rows):
    load(spark, landing)
    (landing / "pl_a b_20191208.csv").unlink()
    write(landing / "pl_late_20191208.csv", ["City", "NPI"], ["L", "9"])
    write(landing / "pl_c_20240107.csv", ["NPI", "City", "State"], ["3", "D", "MA"], ["4", "E", ""])
    opened = []

    def counted(session, paths):
        opened.extend(path.rsplit("/", 1)[-1] for path in paths)
        return read(session, paths)

    load_changed_files(spark, str(landing), str(landing.parent / "store"), counted)
    assert sorted(opened) == ["pl_c_20240107.csv", "pl_late_20191208.csv"]
    want = [*FIRST[:2], ("3", "D", "MA", NEW), ("4", "E", None, NEW), ("9", "L", None, OLD)]
    assert held(spark, landing, rows) == want


def test_an_emptied_file_has_no_rows(spark, landing, rows):
    load(spark, landing)
    write(landing / "pl_c_20240107.csv", ["NPI", "City", "State"])
    assert load(spark, landing) == ["pl_c_20240107.csv"]
    assert held(spark, landing, rows) == FIRST[:2]


def test_a_load_that_broke_off_is_not_seen(spark, landing, rows, monkeypatch):
    load(spark, landing)
    store = landing.parent / "store"
    write(landing / "pl_c_20240107.csv", ["NPI", "City", "State"], ["3", "D", "MA"])

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(file_store, "_enter", broken)
        with pytest.raises(OSError):
            load(spark, landing)
    assert held(spark, landing, rows) == FIRST
    assert load(spark, landing) == ["pl_c_20240107.csv"]
    assert held(spark, landing, rows) == [*FIRST[:2], ("3", "D", "MA", NEW)]
    # What is not counted goes with the load after.
    load(spark, landing)
    assert len(list(store.glob("*/_file=*"))) == 2


def test_other_dates_are_not_opened(spark, landing, rows):
    load(spark, landing)
    newest = read_file_store(spark, str(landing.parent / "store"), since=NEW)
    assert rows(newest, "npi") == [("3",)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_input_file_date" in plan


def test_files_without_a_date_are_passed_over(spark, landing):
    write(landing / "notes.csv", ["NPI"], ["1"])
    assert len(published_files(spark, str(landing))) == 2


def test_main_files_name_their_source(spark, tmp_path):
    path = tmp_path / "in" / "npidata_pfile_20050523-20191208.csv"
    write(path, ["NPI", "Entity Type Code"], ["1", "1"])
    (row,) = read_main_files(spark, [str(path)], source=True).collect()
    assert row[SOURCE_FILE].endswith(path.name) and SOURCE_FILE not in read_main_files(
        spark, [str(path)]
    ).columns
