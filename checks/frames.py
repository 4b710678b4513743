"""Registry-shaped inputs out of the given tables.

Each frame is one SELECT that both Spark and DuckDB understand, so the operators and the
oracle start from the same rows: an order is a provider's snapshot row, its lines are the
numbered slots. ``{name}`` stands for a table or another frame.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

ORGANISATION = "c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')"
NPI = "lpad(CAST(c_custkey AS string), 10, '0')"
SNAPSHOT = "CAST(o_orderdate AS date)"
YEARLY = "make_date(CAST(year(o_orderdate) AS int), 1, 1)"



def key_sql(*columns: str) -> str:
    """The address key written out in SQL."""
    parts = [f"replace(coalesce({c}, ''), '|', '')" for c in columns]
    parts[4] = f"substring({parts[4]}, 1, 5)"
    return " || '|' || ".join(parts)


PRACTICE_KEY = key_sql(
    "provider_first_line_business_practice_location_address",
    "provider_second_line_business_practice_location_address",
    "provider_business_practice_location_address_city_name",
    "provider_business_practice_location_address_state_name",
    "provider_business_practice_location_address_postal_code",
    "provider_business_practice_location_address_country_code_if_outside_us",
)
MAILING_KEY = key_sql(
    "provider_first_line_business_mailing_address",
    "provider_second_line_business_mailing_address",
    "provider_business_mailing_address_city_name",
    "provider_business_mailing_address_state_name",
    "provider_business_mailing_address_postal_code",
    "provider_business_mailing_address_country_code_if_outside_us",
)
PL_KEY = key_sql(
    "provider_secondary_practice_location_address_address_line_1",
    "provider_secondary_practice_location_address__address_line_2",
    "provider_secondary_practice_location_address__city_name",
    "provider_secondary_practice_location_address__state_name",
    "provider_secondary_practice_location_address__postal_code",
    "provider_secondary_practice_location_address__country_code_if_outside_us",
)

# Further columns of the main file, for the checks that take all published ones.
MORE_COLUMNS = f"""
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'DR.' END AS provider_name_prefix_text,
          CASE WHEN o_orderstatus = 'P' THEN 'JR.' END AS provider_name_suffix_text,
          CASE WHEN NOT {ORGANISATION} THEN substring(o_orderpriority, 1, 1) || 'D' END
            AS provider_credential_text,
          CASE WHEN o_orderpriority = '2-HIGH' THEN 'MS.' END AS provider_other_name_prefix_text,
          CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'SR.' END AS provider_other_name_suffix_text,
          CASE WHEN o_orderstatus = 'O' THEN substring(o_orderpriority, 1, 1) || 'N' END
            AS provider_other_credential_text,
          CASE WHEN {ORGANISATION} AND o_orderstatus = 'O' THEN n_name || ' ' || c_name END
            AS provider_other_organization_name,
          CASE WHEN {ORGANISATION} AND o_orderstatus = 'O' THEN substring(o_orderpriority, 1, 1) END
            AS provider_other_organization_name_type_code,
          lpad(CAST(n_nationkey * 7919 + length(o_orderpriority) AS string), 10, '5')
            AS provider_business_practice_location_address_telephone_number,
          CASE WHEN o_orderstatus = 'O' THEN lpad(CAST(n_nationkey AS string), 10, '6') END
            AS provider_business_practice_location_address_fax_number,
          lpad(CAST(n_nationkey * 104729 AS string), 10, '7')
            AS provider_business_mailing_address_telephone_number,
          CASE WHEN o_orderstatus = 'F' THEN lpad(o_orderpriority, 10, '8') END
            AS provider_business_mailing_address_fax_number,
          make_date(CAST(1990 + c_custkey % 10 AS int), 1, 1) AS provider_enumeration_date,
          {SNAPSHOT} AS last_update_date,
          CASE WHEN o_orderpriority = '3-MEDIUM' THEN make_date(2001, 2, 3) END
            AS npi_reactivation_date,
          CASE WHEN {ORGANISATION} THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END
            AS provider_gender_code,
          CASE o_orderstatus WHEN 'O' THEN 'Y' WHEN 'F' THEN 'N' ELSE 'X' END AS is_sole_proprietor,
          CASE WHEN o_orderstatus = 'F' THEN {SNAPSHOT} END AS certification_date,
          CASE WHEN {ORGANISATION} AND o_orderstatus = 'O' THEN 'PARENT OF ' || c_name END
            AS parent_organization_lbn,
          CASE WHEN {ORGANISATION} THEN n_name || ' ' || o_orderstatus END
            AS authorized_official_last_name,
          CASE WHEN {ORGANISATION} THEN r_name END AS authorized_official_first_name,
          CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'M' END
            AS authorized_official_middle_name,
          CASE WHEN {ORGANISATION} THEN o_orderpriority END
            AS authorized_official_title_or_position,
          CASE WHEN {ORGANISATION} THEN lpad(CAST(length(n_name) AS string), 10, '9') END
            AS authorized_official_telephone_number,
          CASE WHEN {ORGANISATION} THEN CASE o_orderstatus WHEN 'F' THEN 'Y' ELSE 'N' END END
            AS is_organization_subpart,
          CASE WHEN {ORGANISATION} THEN substring(o_orderpriority, 3, 2) END
            AS authorized_official_name_prefix_text,
          CASE WHEN o_orderstatus = 'P' THEN 'II' END AS authorized_official_name_suffix_text,
          CASE WHEN {ORGANISATION} AND o_orderstatus = 'F' THEN r_name || ' MD' END
            AS authorized_official_credential_text,"""

FRAMES = {
    "snapshot_rows": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate, o_totalprice,
               c_custkey, c_name, c_mktsegment, n_nationkey, n_name, r_name
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "npidata": f"""
        SELECT o_orderkey, {NPI} AS npi,
          CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
               WHEN {ORGANISATION} THEN '2' ELSE '1' END AS entity_type_code,
          CASE WHEN {ORGANISATION} THEN c_name || ' ' || c_mktsegment END
            AS provider_organization_name_legal_business_name,
          CASE WHEN NOT {ORGANISATION} THEN c_name END AS provider_last_name_legal_name,
          CASE WHEN NOT {ORGANISATION} THEN c_mktsegment END AS provider_first_name,
          CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS provider_middle_name,
          c_mktsegment || ' ' || n_name || CASE o_orderstatus
            WHEN 'F' THEN ' STE 4' WHEN 'O' THEN ', #5' ELSE '|B & Co.' END
            AS provider_first_line_business_practice_location_address,
          CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END
            AS provider_second_line_business_practice_location_address,
          n_name AS provider_business_practice_location_address_city_name,
          r_name AS provider_business_practice_location_address_state_name,
          lpad(CAST(n_nationkey * 1003001 AS string), 9, '0')
            AS provider_business_practice_location_address_postal_code,
          CASE WHEN r_name = 'AMERICA' THEN 'US' END
            AS provider_business_practice_location_address_country_code_if_outside_us,
          n_name || ' ' || c_mktsegment || ' BLDG 7'
            AS provider_first_line_business_mailing_address,
          CAST(NULL AS string) AS provider_second_line_business_mailing_address,
          n_name AS provider_business_mailing_address_city_name,
          r_name AS provider_business_mailing_address_state_name,
          lpad(CAST(n_nationkey AS string), 5, '0')
            AS provider_business_mailing_address_postal_code,
          'US' AS provider_business_mailing_address_country_code_if_outside_us,
          CASE WHEN o_orderstatus = 'O' THEN c_name END AS provider_other_last_name,
          CASE WHEN o_orderpriority = '2-HIGH' THEN c_mktsegment END
            AS provider_other_first_name,
          CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'Q' END
            AS provider_other_middle_name,
          CASE o_orderstatus WHEN 'O' THEN '5' WHEN 'F' THEN '1' END
            AS provider_other_last_name_type_code,
          {SNAPSHOT} AS _input_file_date
        FROM {{snapshot_rows}}""",
    "group_slots": """
        SELECT l_orderkey, l_linenumber, '193' || max(l_returnflag) AS group_code
        FROM {lineitem} WHERE l_linestatus = 'O' GROUP BY l_orderkey, l_linenumber""",
    "slots": """
        SELECT l_orderkey, l_linenumber,
          '20' || max(l_returnflag) || '0' || max(l_linestatus) AS code,
          CASE WHEN max(l_linestatus) = 'F' THEN 'L' || max(l_returnflag) ELSE '' END
            AS license_number,
          max(l_linestatus) AS license_state,
          CASE WHEN max(l_returnflag) = 'R' THEN 'Y' ELSE 'N' END AS primary_switch,
          CASE WHEN max(l_returnflag) = 'N' THEN ''
               ELSE 'ID' || max(l_returnflag) || max(l_linestatus) END AS identifier,
          '0' || CAST(l_linenumber AS string) AS type_code,
          max(l_linestatus) AS state,
          CASE WHEN max(l_returnflag) = 'A' THEN 'PLAN A' ELSE '' END AS issuer
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "taxonomy_lookup": """
        SELECT DISTINCT '20' || l_returnflag || '0' || l_linestatus AS taxonomy_code,
          'Name of ' || l_returnflag || l_linestatus AS taxonomy_desc
        FROM {lineitem} WHERE l_returnflag <> 'N'""",
    "othername": f"""
        SELECT {NPI} AS npi,
          CASE WHEN o_orderstatus <> 'P' THEN n_name || ' ' || o_orderstatus END
            AS provider_other_organization_name,
          CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '2-HIGH' THEN '3'
            WHEN '3-MEDIUM' THEN '9' END AS provider_other_organization_name_type_code,
          {SNAPSHOT} AS _input_file_date
        FROM {{snapshot_rows}}""",
    "endpoint": f"""
        SELECT {NPI} AS npi,
          CASE WHEN o_orderpriority <> '5-LOW' THEN substring(o_orderpriority, 1, 1) END
            AS endpoint_type,
          CASE WHEN o_orderstatus <> 'P' THEN 'mail@' || lower(n_name) || '.example' END
            AS endpoint,
          {SNAPSHOT} AS _input_file_date
        FROM {{snapshot_rows}}""",
    "pl": f"""
        SELECT {NPI} AS npi,
          n_name || ' PL' AS provider_secondary_practice_location_address_address_line_1,
          CASE WHEN o_orderstatus <> 'P' THEN 'FLOOR ' || o_orderstatus END
            AS provider_secondary_practice_location_address__address_line_2,
          n_name AS provider_secondary_practice_location_address__city_name,
          r_name AS provider_secondary_practice_location_address__state_name,
          lpad(CAST(n_nationkey * 1003001 AS string), 9, '0')
            AS provider_secondary_practice_location_address__postal_code,
          'US' AS provider_secondary_practice_location_address__country_code_if_outside_us,
          {SNAPSHOT} AS _input_file_date
        FROM {{snapshot_rows}}""",
    "reval": f"""
        SELECT 'P' || CAST(l_suppkey AS string) AS group_pac_id,
          s_name AS group_legal_business_name, c_mktsegment AS individual_first_name,
          c_name AS individual_last_name,
          CASE WHEN o_orderpriority <> '5-LOW' THEN {NPI} END AS individual_npi,
          'I' || CAST(c_custkey AS string) AS individual_pac_id,
          l_returnflag || ' SPECIALTY' AS individual_specialty_description,
          CAST(l_shipdate AS date) AS individual_due_date, {YEARLY} AS _input_file_date
        FROM {{snapshot_rows}} JOIN {{lineitem}} ON l_orderkey = o_orderkey
        JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    "pc_provider": """
        SELECT lpad(CAST(s_suppkey AS string), 10, '0') AS npi,
          'P' || CAST(s_suppkey AS string) AS pecos_asct_cntl_id
        FROM {supplier} WHERE s_acctbal >= 0
        UNION ALL
        SELECT lpad(CAST(s_suppkey + 1 AS string), 10, '0') AS npi,
          'P' || CAST(s_suppkey AS string) AS pecos_asct_cntl_id
        FROM {supplier} WHERE s_acctbal >= 0""",
    "optout": f"""
        SELECT {NPI} AS npi, {SNAPSHOT} AS optout_effective_date,
          {SNAPSHOT} + 730 AS optout_end_date, {YEARLY} AS _input_file_date
        FROM {{snapshot_rows}}""",
    "dac_ndf": f"""
        SELECT {NPI} AS npi,
          CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS med_sch,
          CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS string) END AS grd_yr,
          CAST(o_orderkey AS string) AS telephone_number, {YEARLY} AS _input_file_date
        FROM {{snapshot_rows}}""",
    "general": """
        SELECT lpad(CAST(l_partkey AS string), 10, '0') AS covered_recipient_npi,
          CASE WHEN l_discount < 0.1 THEN l_extendedprice END
            AS total_amount_of_payment_usdollars,
          CAST(l_shipdate AS date) AS date_of_payment,
          'S' || CAST(l_suppkey AS string)
            AS applicable_manufacturer_or_applicable_gpo_making_payment_name,
          l_linestatus AS form_of_payment_or_transfer_of_value,
          'nature ' || CAST(l_linenumber AS string) AS nature_of_payment_or_transfer_of_value,
          CAST(NULL AS string) AS indicate_drug_or_biological_or_device_or_medical_supply_1,
          'area' AS product_category_or_therapeutic_area_1,
          CASE WHEN l_linestatus = 'O' THEN 'drug' END
            AS name_of_drug_or_biological_or_device_or_medical_supply_1
        FROM {lineitem} WHERE l_returnflag <> 'R'""",
    "research": """
        SELECT lpad(CAST(l_partkey AS string), 10, '0') AS covered_recipient_npi,
          CASE WHEN l_discount < 0.1 THEN l_extendedprice END
            AS total_amount_of_payment_usdollars,
          CAST(l_shipdate AS date) AS date_of_payment,
          'S' || CAST(l_suppkey AS string)
            AS applicable_manufacturer_or_applicable_gpo_making_payment_name,
          l_linestatus AS form_of_payment_or_transfer_of_value,
          'study ' || CAST(l_orderkey AS string) AS name_of_study,
          CAST(NULL AS string) AS indicate_drug_or_biological_or_device_or_medical_supply_1,
          'area' AS product_category_or_therapeutic_area_1,
          CASE WHEN l_linestatus = 'O' THEN 'drug' END
            AS name_of_drug_or_biological_or_device_or_medical_supply_1
        FROM {lineitem} WHERE l_returnflag = 'R'""",
    "located_rows": f"""
        SELECT npi, entity_type_code, _input_file_date,
          concat_ws(' ', provider_first_name, provider_last_name_legal_name,
            provider_organization_name_legal_business_name) AS name,
          {PRACTICE_KEY} AS key_b, {MAILING_KEY} AS key_m,
          CAST(24 + n_nationkey AS double) + CAST(length(c_mktsegment) AS double) / 100 AS lat,
          CAST(2 * n_nationkey - 120 AS double) AS lng
        FROM {{npidata}} JOIN {{snapshot_rows}} USING (o_orderkey)""",
    "answers": """
        SELECT DISTINCT address_key,
          CASE WHEN address_key LIKE '%3-MEDIUM%' THEN 'No_Match' ELSE 'Match' END
            AS census_status,
          lat AS census_latitude, lng AS census_longitude
        FROM (SELECT key_b AS address_key, lat, lng FROM {located_rows}
              UNION ALL SELECT key_m AS address_key, lat, lng FROM {located_rows}) AS k""",
}
FRAMES["npidata_all"] = FRAMES["npidata"].replace(
    f"{SNAPSHOT} AS _input_file_date", f"{MORE_COLUMNS} {SNAPSHOT} AS _input_file_date"
)
# The same rows as yearly snapshots, so that the newest one has many providers.
FRAMES["npidata_yearly"] = FRAMES["npidata"].replace(
    f"{SNAPSHOT} AS _input_file_date", f"{YEARLY} AS _input_file_date"
)
FRAMES["located_yearly"] = FRAMES["located_rows"].replace("{npidata}", "{npidata_yearly}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inputs_of(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{([a-z_]+)\}", text)))


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A frame (or given table) as a DataFrame."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    text = FRAMES[name]
    return spark.sql(text, **{n: frame(spark, sf_dir, n) for n in inputs_of(text)})


def with_frames(query: str) -> str:
    """DuckDB text of ``query`` with every frame it uses as a CTE."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in inputs_of(text):
            if name not in TABLES and name not in order:
                need(FRAMES[name])
                order.append(name)

    need(query)
    plain = {name: re.sub(r"\{([a-z_]+)\}", r"\1", FRAMES[name]) for name in order}
    ctes = ", ".join(f"{name} AS ({text})" for name, text in plain.items())
    body = re.sub(r"\{([a-z_]+)\}", r"\1", query)
    if not ctes:
        return body
    stripped = body.lstrip()
    if stripped.upper().startswith("WITH "):
        return f"WITH {ctes}, {stripped[5:]}"
    return f"WITH {ctes} {body}"


#: Slot arrays of ``npidata`` and the columns of ``slots`` in them.
SLOT_ARRAYS = {
    "healthcare_provider_taxonomies": ["code", "license_number", "license_state", "primary_switch"],
    "other_provider_identifiers": ["identifier", "type_code", "state", "issuer"],
}


def npidata_with_slots(
    spark: SparkSession, sf_dir: str, rows: str = "npidata", wanted: tuple[str, ...] = (*SLOT_ARRAYS,)
) -> DataFrame:
    """``npidata`` with its slot arrays, as the snapshot store holds them: those ``wanted``, and the
    third one too, if ``rows`` is ``npidata_all``."""
    fields = [F.struct(*SLOT_ARRAYS[name]).alias(name) for name in wanted]
    lines = F.sort_array(F.collect_list(F.struct("l_linenumber", *fields)))
    arrays = (
        slots_by_order(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(lines.alias("_l"))
        .select(F.col("l_orderkey").alias("o_orderkey"), *[F.col(f"_l.{n}").alias(n) for n in wanted])
    )
    # Orders are shuffled before their many columns are made of few.
    orders = frame(spark, sf_dir, "snapshot_rows").repartition("o_orderkey")
    with_arrays = spark.sql(FRAMES[rows], snapshot_rows=orders).join(arrays, "o_orderkey", "left")
    if rows == "npidata":
        return with_arrays
    groups = (
        slots_by_order(spark, sf_dir, "group_slots")
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "group_code"))).alias("_l"))
        .select(
            F.col("l_orderkey").alias("o_orderkey"),
            F.transform("_l", lambda x: F.struct(x["group_code"].alias("taxonomy_group"))).alias(
                "healthcare_provider_taxonomy_groups"
            ),
        )
    )
    return with_arrays.join(groups, "o_orderkey", "left")


def slots_by_order(spark: SparkSession, sf_dir: str, name: str = "slots") -> DataFrame:
    """The frame of slots, its lines shuffled by order and once: grouping slots and collecting them
    by order needs no further shuffle, nor does a join on the order."""
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    return spark.sql(FRAMES[name], lineitem=lines)


def wide_main_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw wide form: seven numbered columns for every slot field."""
    names = {
        "code": "healthcare_provider_taxonomy_code",
        "license_number": "provider_license_number",
        "license_state": "provider_license_number_state_code",
        "primary_switch": "healthcare_provider_primary_taxonomy_switch",
        "identifier": "other_provider_identifier",
        "type_code": "other_provider_identifier_type_code",
        "state": "other_provider_identifier_state",
        "issuer": "other_provider_identifier_issuer",
    }
    # A slot's fields travel together; a pivot would compare every line with every column.
    numbered = F.when(
        F.col("l_linenumber").between(1, 7), F.struct("l_linenumber", F.struct(*names).alias("s"))
    )
    slots = (
        slots_by_order(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(F.map_from_entries(F.collect_list(numbered)).alias("_slots"))
    )
    tax, ids = list(names)[:4], list(names)[4:]
    return slots.select(
        F.col("l_orderkey").alias("o_orderkey"),
        *[
            F.try_element_at("_slots", F.lit(n))[field].alias(f"{names[field]}_{n}")
            for fields in (tax, ids)
            for n in range(1, 8)
            for field in fields
        ],
    )
