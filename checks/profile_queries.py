"""Snapshots, payments, affiliations, profile, directory and lookups on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.address_queries import COLOCATION_SQL, colocated
from checks.frames import frame, npidata_with_slots, table
from checks.history_queries import (
    ENDPOINT_SQL,
    LICENSE_SQL,
    OTHERID_SQL,
    OTHERNAME_SQL,
    PL_SQL,
    TAXONOMY_SQL,
)
from checks.registry import check
from rosterline.functions.fixed import CHANGE_COLUMNS, SIZE_BUCKETS, SNAPSHOT_DATE
from rosterline.operators.affiliations import (
    affiliation_edges,
    affiliation_groups,
    affiliation_summary,
    employer_directory,
    employer_roster,
)
from rosterline.operators.lookup import (
    browse,
    by_key,
    search_text,
    search_words,
    word_index,
)
from rosterline.operators.payments import all_payments, payments_by_provider
from rosterline.operators.rollups import also_known_as, clinician_facts, optout_dates, token_list
from rosterline.operators.snapshots import change_frequency, latest_partition, latest_per_key
from rosterline.operators.word_store import (
    document_frequency,
    read_word_store,
    search_store,
    write_word_store,
)
from rosterline.plans.flow import OutsideTables, RegistryTables, profile_flow
from rosterline.plans.histories import otherid_se, othername_se
from rosterline.plans.profile import (
    PROFILE_COLUMNS as BASE,
)
from rosterline.plans.profile import (
    profile_continuations,
    read_documents,
    search_rows,
    with_search_text,
    write_directory,
    write_documents,
    write_profiles,
)
from rosterline.session import staged, work_folder


@check(
    "latest_partition",
    """SELECT o_orderkey, npi, _input_file_date FROM {npidata}
       WHERE _input_file_date = (SELECT max(_input_file_date) FROM {npidata})""",
)
def latest_partition_query(spark: SparkSession, sf: str) -> DataFrame:
    return latest_partition(
        frame(spark, sf, "npidata").select("o_orderkey", "npi", SNAPSHOT_DATE)
    )


LATEST_SQL = """
    SELECT n.* FROM {npidata} AS n JOIN (
      SELECT npi AS k, max(_input_file_date) AS newest FROM {npidata}
      WHERE entity_type_code IS NOT NULL GROUP BY npi) AS m
    ON npi = k AND _input_file_date = newest"""


@check(
    "latest_per_key",
    f"SELECT o_orderkey, npi, entity_type_code, _input_file_date FROM ({LATEST_SQL}) AS l",
)
def latest_per_key_query(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(
        frame(spark, sf, "npidata"), columns=["o_orderkey", "entity_type_code"]
    ).select("o_orderkey", "npi", "entity_type_code", SNAPSHOT_DATE)


PACKED_SQL = """
    (SELECT * FROM {npidata_all} LEFT JOIN (
       SELECT l_orderkey AS o_orderkey,
         string_agg(concat_ws('^', code, license_number, license_state, primary_switch), '|'
           ORDER BY l_linenumber) AS healthcare_provider_taxonomies,
         string_agg(concat_ws('^', identifier, type_code, state, issuer), '|'
           ORDER BY l_linenumber) AS other_provider_identifiers
       FROM {slots} GROUP BY 1) AS s USING (o_orderkey)
     LEFT JOIN (
       SELECT l_orderkey AS o_orderkey, string_agg(group_code, '|' ORDER BY l_linenumber)
         AS healthcare_provider_taxonomy_groups
       FROM {group_slots} GROUP BY 1) AS g USING (o_orderkey)) AS packed"""
PER_KEY_SQL = f"""
    SELECT entity_type_code, npi, {", ".join(f"count(DISTINCT {c}) AS {c}" for c in CHANGE_COLUMNS)}
    FROM {PACKED_SQL} WHERE entity_type_code IS NOT NULL GROUP BY 1, 2"""
CHANGE_SQL = f"""
    SELECT entity_type_code, colname, round(avg(n), 9) AS change_freq
    FROM (UNPIVOT ({PER_KEY_SQL}) ON {", ".join(CHANGE_COLUMNS)} INTO NAME colname VALUE n) AS u
    WHERE n > 0 GROUP BY 1, 2"""


def _changes(spark: SparkSession, sf: str, **options) -> DataFrame:
    npidata = npidata_with_slots(spark, sf, "npidata_all")
    rates = change_frequency(npidata, CHANGE_COLUMNS, **options)
    return rates.withColumn("change_freq", F.round("change_freq", 9))


@check("change_frequency", CHANGE_SQL)
def change_frequency_query(spark: SparkSession, sf: str) -> DataFrame:
    """All published columns, the three folded arrays among them."""
    return _changes(spark, sf)


@check("change_frequency_crowded", CHANGE_SQL)
def change_frequency_crowded_query(spark: SparkSession, sf: str) -> DataFrame:
    """Providers of more than ten rows are counted apart, as crowded ones are."""
    return _changes(spark, sf, crowded_rows=10)


PAYMENT_ROWS_SQL = " UNION ALL ".join(
    f"""SELECT covered_recipient_npi AS npi, concat_ws('^', '{kind}',
          CAST(CAST(total_amount_of_payment_usdollars AS decimal(18, 2)) AS string),
          CAST(date_of_payment AS string),
          coalesce(applicable_manufacturer_or_applicable_gpo_making_payment_name, ''),
          coalesce(form_of_payment_or_transfer_of_value, ''), coalesce({third}, ''),
          coalesce(indicate_drug_or_biological_or_device_or_medical_supply_1, ''),
          coalesce(product_category_or_therapeutic_area_1, ''),
          coalesce(name_of_drug_or_biological_or_device_or_medical_supply_1, '')) AS token
        FROM {{{kind}}} WHERE total_amount_of_payment_usdollars IS NOT NULL"""
    for kind, third in [
        ("general", "nature_of_payment_or_transfer_of_value"),
        ("research", "name_of_study"),
    ]
)
PAYMENTS_SQL = f"""
    SELECT npi, 0 AS part, count(*) AS total, string_agg(token, ';' ORDER BY token) AS openpayments
    FROM ({PAYMENT_ROWS_SQL}) AS p GROUP BY npi"""


def _payments(spark: SparkSession, sf: str) -> DataFrame:
    return all_payments(frame(spark, sf, "general"), frame(spark, sf, "research"))


@check("payments_by_provider", PAYMENTS_SQL)
def payments_query(spark: SparkSession, sf: str) -> DataFrame:
    return payments_by_provider(_payments(spark, sf)).withColumn(
        "openpayments", F.array_join("openpayments", ";")
    )


@check(
    "payments_equal_copies",
    """
    SELECT receiver AS npi, 0 AS part, count(*) AS total,
      md5(string_agg(token, ';' ORDER BY token)) AS openpayments
    FROM (SELECT lpad(CAST(l_suppkey AS varchar), 10, '0') AS receiver,
            concat_ws('^', 'general', '10.00', CAST(date_trunc('year', l_shipdate) AS date), '', '',
              l_returnflag, '', '', '') AS token FROM lineitem) AS t GROUP BY 1
    """,
)
def payments_copies_query(spark: SparkSession, sf: str) -> DataFrame:
    """Many equal payments per provider: they travel as counts and are all listed."""
    rows = table(spark, sf, "lineitem").select(
        F.lpad(F.col("l_suppkey").cast("string"), 10, "0").alias("npi"),
        F.lit("general").alias("type_of_payment"),
        F.lit("10.00").cast("decimal(18,2)").alias("amount"),
        F.trunc("l_shipdate", "year").alias("date_of_payment"),
        *[F.lit("").alias(f"op{i}") for i in (1, 2)],
        F.col("l_returnflag").alias("op3"),
        *[F.lit("").alias(f"op{i}") for i in (4, 5, 6)],
    )
    listed = payments_by_provider(rows)
    return listed.withColumn("openpayments", F.md5(F.array_join("openpayments", ";")))


EDGES_SQL = """
    SELECT r.*, group_npi,
      concat_ws('^', concat_ws(' ', individual_first_name, individual_last_name), individual_npi)
        AS individual_name_npi,
      concat_ws('^', group_legal_business_name, group_npi) AS group_name_npi
    FROM {reval} AS r LEFT JOIN (SELECT pecos_asct_cntl_id AS pac, min(npi) AS group_npi
      FROM {pc_provider} GROUP BY 1) AS g ON group_pac_id = pac
    WHERE _input_file_date = (SELECT max(_input_file_date) FROM {reval})"""
ROSTER_SQL = f"""
    SELECT npi, count(*) AS employee_cnt,
      string_agg(CASE WHEN rank <= 40 THEN member END, ';' ORDER BY member) AS employees
    FROM (SELECT npi, member, row_number() OVER (PARTITION BY npi ORDER BY member) AS rank
          FROM (SELECT DISTINCT group_npi AS npi, individual_name_npi AS member
                FROM ({EDGES_SQL}) AS e WHERE group_npi IS NOT NULL) AS d) AS m GROUP BY npi"""
SUMMARY_SQL = f"""
    SELECT individual_npi AS npi, max(individual_due_date) AS reval_due_date,
      min(individual_specialty_description) AS reval_specialty, min(individual_pac_id) AS pac_id
    FROM ({EDGES_SQL}) AS e WHERE individual_npi IS NOT NULL GROUP BY 1"""
GROUPS_SQL = f"""
    SELECT npi, 0 AS part, count(*) AS total, string_agg(g, ';' ORDER BY g) AS groups
    FROM (SELECT DISTINCT individual_npi AS npi, group_name_npi AS g FROM ({EDGES_SQL}) AS e
          WHERE individual_npi IS NOT NULL) AS d GROUP BY npi"""
BUCKET_SQL = " ".join(f"WHEN employee_cnt > {n} THEN '{label}'" for n, label in SIZE_BUCKETS)
DIRECTORY_SQL = f"""
    SELECT *, CASE {BUCKET_SQL} ELSE 'sole' END AS category,
      substring(group_name_npi, 1, 1) AS initial
    FROM (SELECT npi, 0 AS part, string_agg(DISTINCT individual_name_npi, ';'
            ORDER BY individual_name_npi) AS employees, min(group_name_npi) AS group_name_npi,
            count(DISTINCT individual_name_npi) AS employee_cnt
          FROM (SELECT *, group_npi AS npi FROM ({EDGES_SQL}) AS e
                WHERE group_npi IS NOT NULL) AS g GROUP BY npi) AS d"""


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return affiliation_edges(frame(spark, sf, "reval"), frame(spark, sf, "pc_provider"))


def _stored_edges(spark: SparkSession, sf: str) -> DataFrame:
    return staged(_edges(spark, sf), "edges")


@check("affiliation_edges", EDGES_SQL)
def edges_query(spark: SparkSession, sf: str) -> DataFrame:
    return _edges(spark, sf)


@check("employer_roster", ROSTER_SQL)
def roster_query(spark: SparkSession, sf: str) -> DataFrame:
    return employer_roster(_stored_edges(spark, sf)).withColumn("employees", F.array_join("employees", ";"))


@check("affiliation_summary", SUMMARY_SQL)
def summary_query(spark: SparkSession, sf: str) -> DataFrame:
    return affiliation_summary(_stored_edges(spark, sf))


@check("affiliation_groups", GROUPS_SQL)
def groups_query(spark: SparkSession, sf: str) -> DataFrame:
    return affiliation_groups(_stored_edges(spark, sf)).withColumn("groups", F.array_join("groups", ";"))


@check("employer_directory", DIRECTORY_SQL)
def directory_query(spark: SparkSession, sf: str) -> DataFrame:
    return employer_directory(_stored_edges(spark, sf)).withColumn(
        "employees", F.array_join("employees", ";")
    )


OPTOUT_SQL = """
    SELECT npi, max(optout_effective_date) AS optout_effective_date,
      max(optout_end_date) AS optout_end_date FROM {optout}
    WHERE _input_file_date = (SELECT max(_input_file_date) FROM {optout}) GROUP BY npi"""
NDF_SQL = """
    SELECT npi, min(med_sch) AS med_sch, min(grd_yr) AS grd_yr,
      min(telephone_number) AS telephone_number FROM {dac_ndf}
    WHERE _input_file_date = (SELECT max(_input_file_date) FROM {dac_ndf}) GROUP BY npi"""
AKA_SQL = f"""
    SELECT npi, 0 AS part, count(DISTINCT othername) AS total,
      '(' || string_agg(DISTINCT othername, ', ' ORDER BY othername) || ')' AS aka
    FROM ({OTHERNAME_SQL}) AS o GROUP BY npi"""


def list_sql(source: str, token: str, out: str) -> str:
    return f"""SELECT npi, 0 AS part, count(*) AS total,
        string_agg({token}, ';' ORDER BY {token}) AS {out} FROM ({source}) AS s GROUP BY npi"""


@check("optout_dates", OPTOUT_SQL)
def optout_query(spark: SparkSession, sf: str) -> DataFrame:
    return optout_dates(frame(spark, sf, "optout"))


@check("clinician_facts", NDF_SQL)
def clinician_query(spark: SparkSession, sf: str) -> DataFrame:
    return clinician_facts(frame(spark, sf, "dac_ndf"))


@check("also_known_as", AKA_SQL)
def aka_query(spark: SparkSession, sf: str) -> DataFrame:
    return also_known_as(othername_se(frame(spark, sf, "othername"), frame(spark, sf, "npidata")))


@check("token_list", list_sql(OTHERNAME_SQL, "othername_token", "othernames"))
def token_list_query(spark: SparkSession, sf: str) -> DataFrame:
    names = othername_se(frame(spark, sf, "othername"), frame(spark, sf, "npidata"))
    return token_list(names, "othername_token", "othernames").withColumn(
        "othernames", F.array_join("othernames", ";")
    )


PROFILE_LISTS = {
    "groups": GROUPS_SQL,
    "places": list_sql(PL_SQL, "pl_token", "places"),
    "taxonomies": list_sql(TAXONOMY_SQL, "taxonomy_token", "taxonomies"),
    "othernames": list_sql(OTHERNAME_SQL, "othername_token", "othernames"),
    "licenses": list_sql(LICENSE_SQL, "license_token", "licenses"),
    "endpoints": list_sql(ENDPOINT_SQL, "endpoint_token", "endpoints"),
    "otherids": list_sql(OTHERID_SQL, "other_id_token", "otherids"),
    "otherids_ccn": list_sql(
        f"SELECT * FROM ({OTHERID_SQL}) AS o WHERE other_id_type_code = '01'",
        "other_id_token",
        "otherids_ccn",
    ),
    "openpayments": PAYMENTS_SQL,
}
PROFILE_FACTS = {
    "reval_due_date, reval_specialty, pac_id": SUMMARY_SQL,
    "employee_cnt, employees": ROSTER_SQL,
    "optout_effective_date, optout_end_date": OPTOUT_SQL,
    "med_sch, grd_yr, telephone_number": NDF_SQL,
    "aka": AKA_SQL,
}
NEIGHBOURS = {"h3_b, h3_m, npi_cnt_b, npi_cnt_m, npi_lst_b, npi_lst_m": COLOCATION_SQL}
SIDES = {**PROFILE_FACTS, **NEIGHBOURS, **PROFILE_LISTS}
PROFILE_COLUMNS = [*BASE, *", ".join(SIDES).split(", ")]
SEARCH_SQL = """
    concat_ws(' ', provider_first_name, provider_last_name_legal_name,
      provider_organization_name_legal_business_name, aka) AS name_search,
    concat_ws(', ', provider_first_line_business_practice_location_address,
      provider_business_practice_location_address_city_name,
      provider_business_practice_location_address_state_name) AS address_search"""


def joins_sql(sides: dict[str, str]) -> str:
    return " ".join(
        f"LEFT JOIN (SELECT npi, {columns} FROM ({sql}) AS s{i}) AS j{i} USING (npi)"
        for i, (columns, sql) in enumerate(sides.items())
    )


LATEST_ALL_SQL = LATEST_SQL.replace("{npidata}", "{npidata_all}")
PROFILE_SQL = f"""
    SELECT {", ".join(PROFILE_COLUMNS)}, {SEARCH_SQL}, FALSE AS more_parts
    FROM ({LATEST_ALL_SQL}) AS latest {joins_sql(SIDES)}"""


def _tables(spark: SparkSession, sf: str) -> tuple[RegistryTables, OutsideTables]:
    npidata = staged(npidata_with_slots(spark, sf, "npidata_all"), "npidata")
    otherids = staged(otherid_se(npidata), "otherids")
    registry = RegistryTables(
        npidata,
        *[frame(spark, sf, n) for n in ("othername", "endpoint", "pl", "taxonomy_lookup")],
        otherids,
    )
    outside = OutsideTables(
        reval=frame(spark, sf, "reval"),
        pc_provider=frame(spark, sf, "pc_provider"),
        optout=frame(spark, sf, "optout"),
        dac_ndf=frame(spark, sf, "dac_ndf"),
        general_payments=frame(spark, sf, "general"),
        research_payments=frame(spark, sf, "research"),
        otherid_ccn_se=otherids.where(F.col("other_id_type_code") == "01"),
    )
    return registry, outside


def _as_text(profile: DataFrame) -> DataFrame:
    lists = [*PROFILE_LISTS, "employees", "npi_lst_b", "npi_lst_m"]
    return profile.withColumns({c: F.array_join(c, ";") for c in lists}).select(
        *PROFILE_COLUMNS, "name_search", "address_search", "more_parts"
    )


@check("provider_profile", PROFILE_SQL)
def profile_query(spark: SparkSession, sf: str) -> DataFrame:
    """All base columns, all outside tables, and the neighbours of both addresses."""
    _, neighbours = colocated(spark, sf)
    profile, _ = profile_flow(*_tables(spark, sf), neighbours)
    return _as_text(profile)


@check(
    "provider_profile_parts",
    f"""SELECT npi, field, token FROM (
          {" UNION ALL ".join(
              f"SELECT npi, '{out}' AS field, unnest(string_split({out}, ';')) AS token "
              f"FROM ({sql}) AS {out}_rows" for out, sql in PROFILE_LISTS.items())}
          UNION ALL SELECT DISTINCT npi, 'aka', othername FROM ({OTHERNAME_SQL}) AS o) AS t
        WHERE npi IN (SELECT npi FROM ({LATEST_ALL_SQL}) AS l)""",
)
def profile_parts_query(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of more than three items are cut: rows and continuations hold every item."""
    profile, further = profile_flow(*_tables(spark, sf), max_items=3)
    inner = F.expr("substring(aka, 2, length(aka) - 2)")
    lists = {**{c: F.col(c) for c in PROFILE_LISTS}, "aka": F.split(inner, ", ")}
    held = profile.dropDuplicates(["npi"])
    rows = [
        held.select("npi", F.lit(c).alias("field"), F.explode(x).alias("token"))
        for c, x in lists.items()
    ]
    rest = further.join(held.select("npi"), "npi", "left_semi").select(
        "npi", "field", F.explode("items").alias("token")
    )
    return reduce(DataFrame.unionByName, rows).unionByName(rest)


@check(
    "search_columns",
    f"SELECT o_orderkey, {SEARCH_SQL} FROM (SELECT *, o_orderkey || ' aka' AS aka "
    "FROM {npidata}) AS n",
)
def search_columns_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = frame(spark, sf, "npidata").withColumn(
        "aka", F.concat(F.col("o_orderkey").cast("string"), F.lit(" aka"))
    )
    return with_search_text(rows).select("o_orderkey", "name_search", "address_search")


@check(
    "profile_continuations",
    f"""SELECT npi, token, count(*) OVER (PARTITION BY npi) AS total
        FROM ({PAYMENT_ROWS_SQL}) AS p""",
)
def continuations_query(spark: SparkSession, sf: str) -> DataFrame:
    """Long lists cut into parts of about ten: first parts and continuations hold every item."""
    listed = staged(payments_by_provider(_payments(spark, sf), 10, 1_000_000), "parts")
    totals = listed.groupBy("npi").agg(F.max("total").alias("total"))
    first = listed.where(F.col("part") == 0).select("npi", F.col("openpayments").alias("items"))
    both = first.unionByName(profile_continuations([listed]).select("npi", "items"))
    return both.select("npi", F.explode("items").alias("token")).join(totals, "npi")


@check(
    "document_sink",
    f"SELECT npi, employee_cnt, category, initial, employees FROM ({DIRECTORY_SQL}) AS d",
)
def document_sink_query(spark: SparkSession, sf: str) -> DataFrame:
    """The directory as JSON lines, written twice: the second write replaces the first."""
    directory = staged(employer_directory(_stored_edges(spark, sf)), "directory")
    path = work_folder(spark, "documents")
    write_documents(directory.limit(0), path)
    write_documents(directory, path)
    schema = "npi string, employee_cnt bigint, category string, initial string, " \
        "employees array<string>"
    return read_documents(spark, path, schema).withColumn(
        "employees", F.array_join("employees", ";")
    )


@check(
    "browse_directory",
    f"""SELECT npi, group_name_npi, employee_cnt, category, initial FROM ({DIRECTORY_SQL}) AS d
        WHERE category = '10+' AND initial = 'S'""",
)
def browse_query(spark: SparkSession, sf: str) -> DataFrame:
    path = work_folder(spark, "directory")
    write_directory(employer_directory(_stored_edges(spark, sf)), path)
    return browse(spark.read.parquet(path), "10+", "S").select(
        "npi", "group_name_npi", "employee_cnt", "category", "initial"
    )


@check(
    "lookup_by_key",
    f"SELECT npi, entity_type_code, _input_file_date FROM ({LATEST_SQL}) AS l "
    "WHERE npi = (SELECT max(npi) FROM {npidata})",
)
def lookup_query(spark: SparkSession, sf: str) -> DataFrame:
    path = work_folder(spark, "profiles")
    write_profiles(
        latest_per_key(frame(spark, sf, "npidata"), columns=["entity_type_code"]), path
    )
    profiles = spark.read.parquet(path)
    newest = profiles.agg(F.max("npi")).scalar()
    return by_key(profiles, newest).select("npi", "entity_type_code", SNAPSHOT_DATE)


WORDS_SQL = r"""
    SELECT {key} AS {key}, word, count(*) AS hits FROM (
      SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+')) AS word
      FROM {source}) AS w WHERE word <> '' GROUP BY 1, 2"""


def search_sql(source: str, key: str, text: str, wanted: list[str], n: int) -> str:
    index = WORDS_SQL.format(source=source, key=key, text=text)
    listed = ", ".join(f"'{w}'" for w in wanted)
    return f"""
        SELECT {key}, count(word) AS words_matched, CAST(sum(hits) AS bigint) AS hits
        FROM ({index}) AS i WHERE word IN ({listed}) GROUP BY {key}
        ORDER BY words_matched DESC, hits DESC, {key} LIMIT {n}"""


@check("word_index", WORDS_SQL.format(source="documents", key="doc_id", text="text"))
def word_index_query(spark: SparkSession, sf: str) -> DataFrame:
    return word_index(table(spark, sf, "documents"), "doc_id", ["text"])


@check("search_documents", search_sql("documents", "doc_id", "text", ["the", "de", "und"], 100))
def search_documents_query(spark: SparkSession, sf: str) -> DataFrame:
    return search_text(table(spark, sf, "documents"), ["the", "de", "und"], "doc_id", ["text"], 100)


SEARCHED = ["Furniture", "NATION", "africa", "specialty", "o", "nosuchword"]


@check(
    "search_profiles",
    search_sql(
        f"(SELECT npi, concat_ws(' ', npi, name_search, address_search, reval_specialty) AS whole "
        f"FROM (SELECT npi, reval_specialty, {SEARCH_SQL} FROM ({LATEST_ALL_SQL}) AS latest "
        f"{joins_sql(PROFILE_FACTS)}) AS p) AS t",
        "npi", "whole", [w.lower() for w in SEARCHED], 300,
    ),
)
def search_profiles_query(spark: SparkSession, sf: str) -> DataFrame:
    """Words in number, names, address and specialty of the profiles, out of a stored index.

    Lists have two items a part, so most other names are in the continuations."""
    profile, further = profile_flow(*_tables(spark, sf), max_items=2)
    path = work_folder(spark, "word-store")
    write_word_store(search_rows(staged(profile, "profile"), further), "npi", ["text"], path)
    return search_store(read_word_store(spark, path), SEARCHED, "npi", 300)


@check(
    "document_frequency",
    f"""SELECT word, count(*) AS documents, CAST(sum(hits) AS bigint) AS hits
        FROM ({WORDS_SQL.format(source="documents", key="doc_id", text="text")}) AS i
        WHERE word IN ('the', 'de', 'und') GROUP BY word""",
)
def document_frequency_query(spark: SparkSession, sf: str) -> DataFrame:
    path = work_folder(spark, "word-store")
    write_word_store(table(spark, sf, "documents"), "doc_id", ["text"], path)
    return document_frequency(read_word_store(spark, path), ["the", "DE", "und", "nosuchword"])


@check(
    "search_index",
    search_sql("part", "p_partkey", "concat_ws(' ', p_name, p_brand, p_type)",
               ["red", "widget", "promo", "brand"], 200),
)
def search_index_query(spark: SparkSession, sf: str) -> DataFrame:
    index = word_index(table(spark, sf, "part"), "p_partkey", ["p_name", "p_brand", "p_type"])
    return search_words(index, ["Red", "widget", "PROMO", "brand"], "p_partkey", 200)
