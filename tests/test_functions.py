from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterline.functions.dates import parse_us_date
from rosterline.functions.grid import assign_cell, cell_step
from rosterline.functions.text import (
    address_key,
    clean_street,
    header_name,
    normalize_header,
    null_if_blank,
    token,
    words,
)
from rosterline.operators.history import code_label
from rosterline.session import sizing
from rosterline.sources.manifest import (
    archive_kind,
    classify_file,
    harvest_links,
    month_series,
    path_snapshot_date,
    pending,
    snapshot_date,
)


def one(spark, *values):
    """The values of column expressions, in one row."""
    row = spark.range(1).select(*[v.alias(f"c{i}") for i, v in enumerate(values)]).first()
    return list(row)


@pytest.mark.parametrize(
    "raw, name",
    [
        ("NPI", "npi"),
        ("Entity Type Code", "entity_type_code"),
        ("Provider Address  City (Name)", "provider_address__city_name"),
        ("Größe/Zahl_1", "größezahl_1"),
    ],
)
def test_header_names_agree_in_python_and_spark(spark, raw, name):
    assert header_name(raw) == name
    assert one(spark, normalize_header(F.lit(raw))) == [name]


@pytest.mark.parametrize(
    "text, day",
    [
        ("1/2/2020", dt.date(2020, 1, 2)),
        ("01/02/2020", dt.date(2020, 1, 2)),
        ("12/31/1999", dt.date(1999, 12, 31)),
        ("02/30/2020", None),
        ("2020-01-02", None),
        ("1/2/20", None),
        ("", None),
        ("garbage", None),
        (None, None),
    ],
)
def test_us_dates(spark, text, day):
    assert one(spark, parse_us_date(F.lit(text).cast("string"))) == [day]


@pytest.mark.parametrize(
    "street, cleaned",
    [
        ("12 MAIN ST STE 4", "12 MAIN ST"),
        ("12 STEVENS RD", "12"),
        ("12 Main suite 4", "12 MAIN SUITE 4"),
        ("#5 OAK", ""),
        ("1 a. & b. Ave, Bldg 2", "1 A  B AVE"),
        ("straße 1 UNIT 2", "STRASSE"),
        ("9 OAK BUILDING 3 APT 2", "9 OAK"),
        ("7 Elm Street", "7 ELM STREET"),
    ],
)
def test_clean_street(spark, street, cleaned):
    assert one(spark, clean_street(F.lit(street))) == [cleaned]


def test_address_key_has_six_parts_whatever_the_text(spark):
    key = address_key(
        F.lit("1 A|B ST"), F.lit(None), F.lit("BOSTON"), F.lit("MA"), F.lit("123456789"), F.lit("US")
    )
    nothing = address_key(*[F.lit(None).cast("string")] * 6)
    assert one(spark, key, nothing) == ["1 AB ST||BOSTON|MA|12345|US", "|||||"]


def test_tokens_keep_empty_fields(spark):
    assert one(spark, token(F.lit("a"), F.lit(None), F.lit(dt.date(2020, 1, 2)))) == [
        "a^^2020-01-02"
    ]


def test_blank_text_is_null(spark):
    assert one(
        spark, null_if_blank(F.lit(" \t ")), null_if_blank(F.lit("\n a b "))
    ) == [None, "a b"]


def test_words_split_on_everything_but_letters_and_digits(spark):
    assert one(spark, words(F.lit("O'Neil-Smith, MD (42) Émile"))) == [
        ["o", "neil", "smith", "md", "42", "émile"]
    ]


def test_cells(spark):
    step = cell_step(12)
    assert 1e-4 < step < 2e-4
    same = assign_cell(F.lit(0.0001), F.lit(-19.9), 1.0)
    near = assign_cell(F.lit(0.9), F.lit(-19.01), 1.0)
    far = assign_cell(F.lit(1.0), F.lit(-19.9), 1.0)
    no = assign_cell(F.lit(None).cast("double"), F.lit(1.0), 1.0)
    values = one(spark, same, near, far, no)
    assert values[0] == values[1] == "90:160" and values[2] == "91:160" and values[3] == ""
    # At 60 degrees a column is twice as wide in degrees, so as wide in kilometres.
    polar = [assign_cell(F.lit(59.9999), F.lit(x), 0.01) for x in (0.001, 0.019, 0.021)]
    cells = one(spark, *polar)
    assert len(set(cells)) == 2


def test_sizing_grows_with_the_input():
    assert sizing(100 * 10**12, 4000)["spark.sql.shuffle.partitions"] == "745059"
    assert sizing(10**6, 8)["spark.sql.shuffle.partitions"] == "16"


def test_code_labels(spark):
    labels = {"01": "OTHER"}
    assert one(spark, code_label(F.lit("01"), labels), code_label(F.lit("99"), labels)) == [
        "OTHER", ""
    ]


@pytest.mark.parametrize(
    "name, day",
    [
        ("npidata_pfile_20050523-20240107.csv", dt.date(2024, 1, 7)),
        ("npidata_pfile_20050523-20240107_FileHeader.csv", dt.date(2024, 1, 7)),
        ("NPI Report 20240108.xlsx", dt.date(2024, 1, 8)),
        ("2024-01-07_003.csv", dt.date(2024, 1, 7)),
        ("readme.txt", None),
        ("x_20240199.csv", None),
    ],
)
def test_snapshot_dates(spark, name, day):
    assert one(spark, snapshot_date(F.lit(name))) == [day]


def test_snapshot_date_of_part_files_is_in_the_folder_name(spark):
    path = "file:/a/pl_pfile_20050523-20240107/part-00000-8c6fc4fd-6ab6-4ca6-c000.csv"
    assert one(spark, path_snapshot_date(F.lit(path))) == [dt.date(2024, 1, 7)]


def test_classify_files(spark, rows):
    names = spark.createDataFrame(
        [
            ("npidata_pfile_20050523-20240107.csv",),
            ("pl_pfile_20050523-20240107_fileheader.csv",),
            ("othername_pfile_20050523-20240107.csv",),
            ("NPPES_Data_Dissemination_010124_010724_Weekly.zip",),
            ("NPPES_Deactivated_NPI_Report_010824.zip",),
            ("NPPES_Data_Dissemination_January_2024.zip",),
            ("plan.csv",),
        ],
        "name string",
    )
    got = {r.name: (r.kind, r.folder, r.archive) for r in classify_file(names, "name").collect()}
    assert list(got.values()) == [
        ("npidata", "npidata", None),
        ("pl", "pl_header", None),
        ("othername", "othername", None),
        (None, None, "weekly"),
        (None, None, "deactivated"),
        (None, None, "monthly"),
        (None, None, None),
    ]
    assert one(spark, archive_kind(F.lit("a.csv"))) == [None]


def test_month_series_excludes_the_month_itself(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 31),)], "ref date")
    months = [r.month for r in month_series(df, "ref", 4).collect()]
    assert months == ["February_2024", "January_2024", "December_2023", "November_2023"]


def test_harvest_links(spark, rows):
    html = """<a href="./files/A_2024.zip">x</a> <A class='k' HREF='B.zip'>y</a>
        <a data-href="no.zip" href=C.zip>z</a> <a href="page.html">p</a> <area href="D.zip">
        <a
          href="http://h/q/E.zip" >"""
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert rows(harvest_links(pages, "html")) == [
        (1, "A_2024.zip"), (1, "B.zip"), (1, "C.zip"), (1, "E.zip")
    ]


def test_pending_offers_each_file_once(spark, rows):
    expected = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "file string")
    done = spark.createDataFrame([("a", 1), ("a", 2)], "file string, n int")
    assert rows(pending(expected, done, "file")) == [("b",), ("c",)]
