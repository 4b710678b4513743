from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterline.functions.fixed import SNAPSHOT_DATE
from rosterline.operators.affiliations import (
    affiliation_edges,
    affiliation_groups,
    affiliation_summary,
    employer_directory,
    employer_roster,
    size_bucket,
)
from rosterline.operators.lookup import browse, by_key, by_keys, search_text, search_words, word_index
from rosterline.operators.payments import all_payments, payments_by_provider
from rosterline.operators.rollups import also_known_as, clinician_facts, optout_dates
from rosterline.operators.snapshots import change_frequency, latest_partition, latest_per_key
from rosterline.plans.flow import OutsideTables, RegistryTables, directory_flow, profile_flow
from rosterline.plans.profile import (
    profile_base,
    profile_continuations,
    provider_profile,
    search_rows,
    read_documents,
    write_directory,
    write_documents,
    write_profiles,
)

OLD, NEW = dt.date(2024, 1, 7), dt.date(2024, 2, 11)


def reval_rows(*edges):
    """(group, member number) pairs as revalidation rows."""
    return [
        (g, f"Group {g}", "Jo", f"M{m:03}", None if m is None else str(m), f"I{m}", f"S{m % 3}",
         dt.date(2024, 1, 1 + m % 20), NEW)
        for g, m in edges
    ]


REVAL = (
    "group_pac_id string, group_legal_business_name string, individual_first_name string, "
    "individual_last_name string, individual_npi string, individual_pac_id string, "
    "individual_specialty_description string, individual_due_date date, _input_file_date date"
)


@pytest.fixture(scope="module")
def edges(spark):
    data = reval_rows(*[("A", m) for m in range(41)], ("B", 1), ("B", 1), ("B", 2), ("X", 3))
    old = [(*data[0][:-1], OLD), (*reval_rows(("B", 99))[0][:-1], OLD)]
    enrolled = [("900", "A"), ("800", "A"), ("700", "B")]
    return affiliation_edges(
        spark.createDataFrame(data + old, REVAL),
        spark.createDataFrame(enrolled, "npi string, pecos_asct_cntl_id string"),
    )


def test_edges_of_the_newest_date_with_the_smallest_group_number(edges):
    a = edges.where("group_pac_id = 'A'").first()
    assert a.group_npi == "800" and a.group_name_npi == "Group A^800"
    assert a.individual_name_npi == "Jo M000^0"
    assert edges.where("group_pac_id = 'X'").first().group_name_npi == "Group X"
    assert edges.count() == 45


def test_roster_shows_forty_and_counts_all(edges):
    got = {r.npi: r for r in employer_roster(edges).collect()}
    assert sorted(got) == ["700", "800"]
    assert got["800"].employee_cnt == 41 and len(got["800"].employees) == 40
    assert got["800"].employees == sorted(f"Jo M{m:03}^{m}" for m in range(41))[:40]
    assert got["700"].employee_cnt == 2


def test_summary_and_groups_per_individual(edges):
    one = affiliation_summary(edges).where("npi = '1'").first()
    assert (one.reval_due_date, one.reval_specialty, one.pac_id) == (dt.date(2024, 1, 2), "S1", "I1")
    groups = affiliation_groups(edges).where("npi = '1'").first()
    assert groups.groups == ["Group A^800", "Group B^700"] and groups.total == 2


def test_directory_of_a_large_group_has_several_rows(edges):
    rows = employer_directory(edges, max_items=10).where("npi = '800'").collect()
    assert len(rows) > 1 and {(r.employee_cnt, r.category, r.initial) for r in rows} == {
        (41, "10+", "G")
    }
    assert sorted(e for r in rows for e in r.employees) == sorted(
        f"Jo M{m:03}^{m}" for m in range(41)
    )


def test_members_without_a_group_can_be_kept(edges):
    kept = {r.npi: r for r in employer_directory(edges, ungrouped=True).collect()}
    assert kept[""].employees == ["Jo M003^3"] and kept[""].category == "sole"
    assert {r.npi for r in employer_roster(edges, ungrouped=True).collect()} == {"", "700", "800"}


def test_size_buckets(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 5, 6, 50, 51, 5000, 5001)], "n int")
    assert [r[0] for r in df.select(size_bucket("n")).collect()] == [
        "sole", "1+", "1+", "5+", "10+", "50+", "1000+", "5000+"
    ]


def payment(npi, amount, day=OLD, third="food"):
    return (npi, amount, day, "Co", "cash", third, None, None, "drug")


def payments(spark):
    start = "covered_recipient_npi string, total_amount_of_payment_usdollars double, " \
        "date_of_payment date, applicable_manufacturer_or_applicable_gpo_making_payment_name " \
        "string, form_of_payment_or_transfer_of_value string, "
    end = " string, indicate_drug_or_biological_or_device_or_medical_supply_1 string, " \
        "product_category_or_therapeutic_area_1 string, " \
        "name_of_drug_or_biological_or_device_or_medical_supply_1 string"
    general = spark.createDataFrame(
        [payment("1", 12345678.9), payment("1", 12345678.9), payment("1", None),
         payment(None, 1.0), payment("2", 5.0, None)],
        start + "nature_of_payment_or_transfer_of_value" + end,
    )
    research = spark.createDataFrame(
        [payment("1", 7.0, third="study")], start + "name_of_study" + end
    )
    return general, research


def test_payments_are_whole_and_never_in_scientific_notation(spark):
    got = payments_by_provider(all_payments(*payments(spark))).collect()
    assert [(r.npi, r.total) for r in got] == [("1", 3)]
    twice = "general^12345678.90^2024-01-07^Co^cash^food^^^drug"
    assert got[0].openpayments == [twice, twice, "research^7.00^2024-01-07^Co^cash^study^^^drug"]
    amounts = all_payments(*payments(spark)).select("amount").collect()
    assert amounts[0][0] == Decimal("12345678.90")


def snapshots(spark):
    return spark.createDataFrame(
        [("1", "1", "JO", OLD), ("1", None, None, NEW), ("2", "2", "ACME", NEW),
         ("2", "2", "ACME", NEW), ("2", "2", "ACM", OLD), ("3", None, None, OLD)],
        f"npi string, entity_type_code string, provider_first_name string, {SNAPSHOT_DATE} date",
    )


def test_older_typed_row_wins_over_newer_stub_and_ties_are_kept(spark, rows):
    assert rows(latest_per_key(snapshots(spark)), "npi", "provider_first_name") == [
        ("1", "JO"), ("2", "ACME"), ("2", "ACME")
    ]
    assert rows(latest_partition(snapshots(spark)), "npi") == [("1",), ("2",), ("2",)]


def test_change_frequency_leaves_out_nulls(spark, rows):
    got = rows(change_frequency(snapshots(spark), ["provider_first_name", SNAPSHOT_DATE]))
    assert got == [
        ("1", SNAPSHOT_DATE, 1.0), ("1", "provider_first_name", 1.0),
        ("2", SNAPSHOT_DATE, 2.0), ("2", "provider_first_name", 2.0),
    ]


def test_attribute_rollups(spark, rows):
    optout = spark.createDataFrame(
        [("1", OLD, NEW, NEW), ("1", NEW, OLD, NEW), ("2", OLD, NEW, OLD)],
        "npi string, optout_effective_date date, optout_end_date date, _input_file_date date",
    )
    assert rows(optout_dates(optout)) == [("1", NEW, NEW)]
    facts = spark.createDataFrame(
        [("1", None, "1999", "5", NEW), ("1", "MIT", None, "4", NEW)],
        "npi string, med_sch string, grd_yr string, telephone_number string, _input_file_date date",
    )
    assert rows(clinician_facts(facts)) == [("1", "MIT", "1999", "4")]
    names = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", "b")], "npi string, othername string")
    assert rows(also_known_as(names), "npi", "aka") == [("1", "(a, b)")]


def test_profile_marks_and_continues_long_lists(spark, rows):
    listed = spark.createDataFrame(
        [("1", "1", "JO", NEW), ("2", "1", "AL", NEW)],
        f"npi string, entity_type_code string, provider_first_name string, {SNAPSHOT_DATE} date",
    ).withColumns(
        {c: F.lit(None).cast("string") for c in (
            "provider_last_name_legal_name", "provider_organization_name_legal_business_name",
            "provider_first_line_business_practice_location_address",
            "provider_business_practice_location_address_city_name",
            "provider_business_practice_location_address_state_name")}
    )
    tokens = spark.createDataFrame(
        [("1", f"t{i:03}") for i in range(60)] + [("2", "u")], "npi string, token string"
    )
    from rosterline.operators.lists import list_parts

    first = list_parts(tokens, ["npi"], F.col("token"), "tokens", 10, first_only=True)
    every = list_parts(tokens, ["npi"], F.col("token"), "tokens", 10)
    got = {r.npi: r for r in provider_profile(profile_base(listed), [], [first]).collect()}
    assert got["1"].more_parts and not got["2"].more_parts and got["2"].tokens == ["u"]
    assert got["1"].name_search == "JO" and got["1"].address_search == ""
    rest = profile_continuations([every]).collect()
    assert {(r.npi, r.field) for r in rest} == {("1", "tokens")}
    whole = sorted([*got["1"].tokens, *[t for r in rest for t in r["items"]]])
    assert whole == [f"t{i:03}" for i in range(60)]


@pytest.fixture(scope="module")
def registry(spark):
    columns = [
        "npi", "entity_type_code", "provider_organization_name_legal_business_name",
        "provider_last_name_legal_name", "provider_first_name", "provider_middle_name",
        "provider_first_line_business_practice_location_address",
        "provider_business_practice_location_address_city_name",
        "provider_business_practice_location_address_state_name",
        "provider_other_last_name", "provider_other_first_name", "provider_other_middle_name",
        "provider_other_last_name_type_code",
    ]
    tax = "array<struct<code:string,license_number:string,license_state:string,primary_switch:string>>"
    idt = "array<struct<identifier:string,type_code:string,state:string,issuer:string>>"
    person = ("1", "1", None, "DOE", "JO", None, "1 A ST", "BOSTON", "MA", "ROE", None, None, "1",
              [("T1", "L1", "MA", "Y")], [("X", "05", "MI", "")], NEW)
    firm = ("800", "2", "ACME", *[None] * 3, "2 B ST", "BOSTON", "MA", *[None] * 4, None, None, NEW)
    npidata = spark.createDataFrame(
        [person, firm],
        ", ".join(f"{c} string" for c in columns)
        + f", healthcare_provider_taxonomies {tax}, other_provider_identifiers {idt}, "
        f"{SNAPSHOT_DATE} date",
    )
    pl = "provider_secondary_practice_location_address_"
    empty = {
        "othername": "npi string, provider_other_organization_name string, "
        "provider_other_organization_name_type_code string, _input_file_date date",
        "endpoint": "npi string, endpoint_type string, endpoint string, _input_file_date date",
        "pl": f"npi string, {pl}address_line_1 string, {pl}_address_line_2 string, "
        f"{pl}_city_name string, {pl}_state_name string, {pl}_postal_code string, "
        "_input_file_date date",
        "taxonomy_lookup": "taxonomy_code string, taxonomy_desc string",
    }
    return RegistryTables(npidata, *[spark.createDataFrame([], s) for s in empty.values()])


def test_profile_flow_without_outside_tables(spark, registry):
    profile, rest = profile_flow(registry, OutsideTables())
    got = {r.npi: r for r in profile.collect()}
    assert got["1"].name_search == "JO DOE (ROE)"
    assert got["1"].address_search == "1 A ST, BOSTON, MA"
    assert got["1"].taxonomies == ["T1^Y^^2024-02-11^2024-02-11"]
    assert got["1"].otherids == ["X^05^MI^^MEDICAID^2024-02-11^2024-02-11"]
    assert got["800"].licenses is None and got["800"].name_search == "ACME"
    assert rest.count() == 0


def test_profile_flow_with_outside_tables_keeps_both_id_lists(spark, registry):
    outside = OutsideTables(
        reval=spark.createDataFrame(reval_rows(("A", 1)), REVAL),
        pc_provider=spark.createDataFrame([("800", "A")], "npi string, pecos_asct_cntl_id string"),
        otherid_ccn_se=spark.createDataFrame([("800", "CCN^1")], "npi string, other_id_token string"),
        general_payments=payments(spark)[0],
        research_payments=payments(spark)[1],
    )
    neighbours = spark.createDataFrame(
        [("1", ["800^2^ACME"], None)], "npi string, npi_lst_b array<string>, npi_lst_m array<string>"
    )
    profile, _ = profile_flow(registry, outside, neighbours)
    assert len(profile.columns) == len(set(profile.columns))
    got = {r.npi: r for r in profile.collect()}
    assert got["800"].otherids_ccn == ["CCN^1"] and got["800"].otherids is None
    assert got["800"].employees == ["Jo M001^1"] and got["800"].employee_cnt == 1
    assert got["1"].groups == ["Group A^800"] and got["1"].npi_lst_b == ["800^2^ACME"]
    assert len(got["1"].openpayments) == 3
    assert directory_flow(outside).first().category == "sole"


def test_sinks_and_lookups(spark, edges, tmp_path, rows):
    directory = employer_directory(edges)
    docs = str(tmp_path / "docs")
    write_documents(directory, docs)
    write_documents(directory, docs)
    again = read_documents(spark, docs, "npi string, employees array<string>, employee_cnt bigint")
    assert rows(again, "npi", "employee_cnt") == [("700", 2), ("800", 41)]

    table = str(tmp_path / "directory")
    write_directory(directory, table)
    found = browse(spark.read.parquet(table), "10+", "G")
    assert rows(found, "npi") == [("800",)]
    assert "PartitionFilters: [isnotnull(category" in (
        found._jdf.queryExecution().executedPlan().toString()
    )

    profiles = str(tmp_path / "profiles")
    write_profiles(directory.select("npi", "employee_cnt"), profiles)
    hit = by_key(spark.read.parquet(profiles), "700")
    assert rows(hit) == [("700", 2)]
    assert "PushedFilters: [IsNotNull(npi), EqualTo(npi,700)]" in (
        hit._jdf.queryExecution().executedPlan().toString()
    )


def test_search_ranks_by_words_then_hits_then_key(spark):
    docs = spark.createDataFrame(
        [("1", "Red widget, red", None), ("2", "red", "Widget"), ("3", "RED", ""), ("4", "blue", "")],
        "npi string, name_search string, address_search string",
    )
    index = word_index(docs, "npi", ["name_search", "address_search"])
    want = [("1", 2, 3), ("2", 2, 2), ("3", 1, 1)]
    assert [tuple(r) for r in search_words(index, ["Widget", "red"], "npi").collect()] == want
    texts = ["name_search", "address_search"]
    assert [tuple(r) for r in search_text(docs, ["red", "widget"], "npi", texts).collect()] == want


def test_all_other_names_are_searched_and_told_of(spark, registry):
    """A provider with other names in several parts is found by each of them."""
    names = spark.createDataFrame(
        [("800", f"name{i:03}") for i in range(60)] + [("1", "roe")], "npi string, othername string"
    )
    first = also_known_as(names, 10, first_only=True, with_held=True)
    every = also_known_as(names, 10, with_held=True)
    profile = provider_profile(profile_base(registry.npidata), [], [first])
    got = {r.npi: r for r in profile.collect()}
    assert got["800"].more_parts and not got["1"].more_parts
    assert "held" not in profile.columns
    rows = search_rows(profile, profile_continuations([every]))
    words = {(r.npi, r.word): r.hits for r in word_index(rows, "npi", ["text"]).collect()}
    assert {w for npi, w in words if npi == "800"} >= {f"name{i:03}" for i in range(60)}
    assert words["800", "800"] == words["800", "boston"] == words["1", "roe"] == 1
    for i in (0, 31, 59):
        assert search_text(rows, [f"NAME{i:03}"], "npi", ["text"]).first().npi == "800"


def test_a_missing_key_opens_no_row_group(spark, tmp_path):
    """The key lies between minimum and maximum of the only row group: its Bloom filter has it not."""
    path = str(tmp_path / "profiles")
    held = spark.range(0, 20_000, 2).selectExpr("cast(1000000000 + id as string) as npi", "id")
    write_profiles(held.coalesce(1), path)

    def read_rows(found):
        found.collect()
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return scan.metrics().apply("numOutputRows").value()

    documents = spark.read.parquet(path)
    assert read_rows(by_key(documents, "1000000001")) == 0
    assert read_rows(by_keys(documents, ["1000000003", "1000000005"])) == 0
    assert by_key(documents, "1000000002").count() == 1
    assert by_keys(documents, ["1000000002", "1000000005", "1000000004"]).count() == 2
    plain = str(tmp_path / "plain")
    documents.orderBy("npi").coalesce(1).write.option("parquet.enable.dictionary", "false").parquet(plain)
    assert read_rows(by_key(spark.read.parquet(plain), "1000000001")) > 0
