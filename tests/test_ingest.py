from __future__ import annotations

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from rosterline.operators.fold import TAXONOMIES, pack
from rosterline.sources.headers import header_schema
from rosterline.sources.readers import (
    read_deactivated,
    read_main_files,
    read_side_files,
    read_taxonomy_lookup,
)
from rosterline.sources.store import (
    append_snapshot,
    ingest_pending,
    read_latest,
    read_store,
    snapshot_dates,
)
from rosterline.streaming.incremental import load_new_files

HEADER = [
    "NPI", "Entity Type Code", "Replacement NPI", "Provider First Name",
    "Healthcare Provider Taxonomy Code_1", "Provider License Number_1",
    "Provider License Number State Code_1", "Healthcare Provider Primary Taxonomy Switch_1",
    "Healthcare Provider Taxonomy Code_2", "Provider License Number_2",
    "Provider License Number State Code_2", "Healthcare Provider Primary Taxonomy Switch_2",
    "Last Update Date",
]
OLD = dt.date(2019, 12, 8)
NEW = dt.date(2024, 1, 7)


def write(path, *lines):
    with open(path, "w", newline="") as out:
        csv.writer(out, quoting=csv.QUOTE_ALL).writerows(lines)
    return str(path)


@pytest.fixture
def main_files(tmp_path):
    slots = ["T1", "L1", "MA", "N", "T2", "", "", "Y"]
    old = ["1", "1", "1", ' Ann "Q" ', *slots, "1/2/2019"]
    new = ["1", "", "1", "Ann, B", *[""] * 8, "13/40/2024", "01/02/2021"]
    return {
        write(tmp_path / "npidata_pfile_20050523-20191208.csv", HEADER, old): OLD,
        write(
            tmp_path / "npidata_pfile_20050523-20240107.csv", [*HEADER, "Certification Date"], new
        ): NEW,
    }


def test_header_schema_types_dates_by_name():
    schema = header_schema(["NPI", "Last Update Date"])
    assert [(f.name, f.dataType, f.nullable) for f in schema] == [
        ("npi", StringType(), True), ("last_update_date", DateType(), True)
    ]
    assert header_schema(["Last Update Date"], date_suffix=None)[0].dataType == StringType()


def test_main_files_with_and_without_the_newer_column(spark, main_files):
    got = {r["_input_file_date"]: r for r in read_main_files(spark, list(main_files)).collect()}
    old, new = got[OLD], got[NEW]
    assert "replacement_npi" not in old.asDict()
    assert old.provider_first_name == 'Ann "Q"' and new.provider_first_name == "Ann, B"
    assert old.last_update_date == dt.date(2019, 1, 2) and new.last_update_date is None
    assert old.certification_date is None and new.certification_date == dt.date(2021, 1, 2)
    assert new.entity_type_code is None and new[TAXONOMIES.name] is None
    packed = read_main_files(spark, list(main_files)).select(pack(TAXONOMIES.name, TAXONOMIES))
    assert {r[0] for r in packed.collect()} == {"T2^^^Y|T1^L1^MA^N", None}


def test_side_files_with_line_breaks_and_doubled_quotes(spark, tmp_path, rows):
    a = write(tmp_path / "endpoint_pfile_20050523-20191208.csv", ["NPI", "Endpoint"],
              ["1", 'say "hi"'], ["2", "two\nlines"])
    b = write(tmp_path / "endpoint_pfile_20050523-20240107.csv",
              ["NPI", "Endpoint Type", "Endpoint"], ["3", "X", "03/04/2020"])
    df = read_side_files(spark, [a, b])
    assert rows(df, "npi", "endpoint_type", "endpoint", "_input_file_date") == [
        ("1", None, 'say "hi"', OLD), ("2", None, "two\nlines", OLD), ("3", "X", "03/04/2020", NEW)
    ]


def test_deactivation_report_without_its_title_and_header(spark, tmp_path, rows):
    path = write(tmp_path / "report_20240108.csv", ["Deactivated NPIs as of Jan 8 2024", ""],
                 ["NPI", "NPPES Deactivation Date"], ["0123456789", "10/01/2005"],
                 ["22", "2006-02-03 00:00:00"], ["23", "unknown"])
    day = dt.date(2024, 1, 8)
    assert rows(read_deactivated(spark, [path])) == [
        ("0123456789", dt.date(2005, 10, 1), day), ("22", dt.date(2006, 2, 3), day),
        ("23", None, day),
    ]


def test_taxonomy_lookup(spark, tmp_path, rows):
    path = write(tmp_path / "codes.csv", ["Code", "Grouping", "Display Name"], ["T1", "g", "A, B"])
    assert rows(read_taxonomy_lookup(spark, path)) == [("T1", "A, B")]


def test_store_replaces_a_date_and_tolerates_new_columns(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    assert snapshot_dates(spark, path) == []
    first = spark.createDataFrame([("1", "a")], "npi string, x string")
    append_snapshot(first, path, OLD)
    append_snapshot(first.withColumn("y", F.lit("b")), path, NEW)
    append_snapshot(first.withColumn("y", F.lit("c")), path, NEW)
    assert snapshot_dates(spark, path) == [OLD, NEW]
    assert rows(read_store(spark, path), "npi", "x", "y", "_input_file_date") == [
        ("1", "a", "c", NEW), ("1", "a", None, OLD)
    ]
    newest = read_latest(spark, path)
    assert rows(newest, "y", "_input_file_date") == [("c", NEW)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_input_file_date" in plan


def test_pending_files_are_loaded_once(spark, main_files, tmp_path):
    path = str(tmp_path / "store")
    assert ingest_pending(spark, path, main_files, read_main_files) == sorted(main_files)
    assert ingest_pending(spark, path, main_files, read_main_files) == []
    assert read_store(spark, path).count() == 2


def test_new_files_are_picked_up_once(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    landing.mkdir()
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")
    calls = []

    def read(session, paths):
        calls.append(len(paths))
        return read_side_files(session, paths)

    def load():
        load_new_files(spark, str(landing), store, checkpoint, read)

    write(landing / "pl_pfile_20050523-20191208.csv", ["NPI", "City"], ["1", "A"])
    load()
    load()
    assert calls == [1]
    write(landing / "pl_pfile_20050523-20240107.csv", ["NPI", "City", "State"], ["1", "B", "MA"])
    load()
    assert calls == [1, 1]
    assert rows(read_store(spark, store), "npi", "city", "state", "_input_file_date") == [
        ("1", "A", None, OLD), ("1", "B", "MA", NEW)
    ]


def test_part_files_of_a_date_in_several_batches(spark, tmp_path, rows):
    """Four files of one date, one file a batch; then a late file of that date."""
    landing = tmp_path / "landing" / "pl_pfile_20050523-20191208"
    landing.mkdir(parents=True)
    store, checkpoint = str(tmp_path / "store"), str(tmp_path / "checkpoint")

    def load():
        load_new_files(
            spark, str(tmp_path / "landing" / "*"), store, checkpoint, read_side_files, 1
        )

    for part in range(4):
        write(landing / f"part-{part}.csv", ["NPI", "City"], *[[f"{part}-{i}", "A"] for i in range(25)])
    load()
    assert read_store(spark, store).count() == 100
    write(landing / "part-9.csv", ["City", "NPI"], ["B", "late"])
    load()
    load()
    got = read_store(spark, store)
    assert got.count() == 101
    assert rows(got.where("npi = 'late'"), "city", "_input_file_date") == [("B", OLD)]


def test_a_later_file_of_a_held_date_is_pending(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    one = write(tmp_path / "pl_a_20191208.csv", ["NPI", "City"], ["1", "A"])
    two = write(tmp_path / "pl_b_20191208.csv", ["NPI", "City"], ["2", "B"])
    assert ingest_pending(spark, path, {one: OLD}, read_side_files) == [one]
    assert ingest_pending(spark, path, {one: OLD, two: OLD}, read_side_files) == [two]
    assert ingest_pending(spark, path, {two: OLD}, read_side_files) == []
    assert rows(read_store(spark, path), "npi", "city") == [("1", "A"), ("2", "B")]


def test_a_folder_of_two_headers(spark, tmp_path, rows):
    folder = tmp_path / "endpoint_pfile_20050523-20191208"
    folder.mkdir()
    write(folder / "part-0.csv", ["NPI", "Endpoint"], ["1", "two\nlines"])
    write(folder / "part-1.csv", ["Endpoint", "NPI"], ["x", "2"])
    got = read_side_files(spark, [str(folder)])
    assert rows(got, "npi", "endpoint") == [("1", "two\nlines"), ("2", "x")]
