"""Start-end histories on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.frames import frame, npidata_with_slots, table
from checks.registry import check, intervals_sql
from rosterline.functions.fixed import (
    OTHER_ID_CORRECTIONS,
    OTHER_ID_TYPES,
    OTHER_NAME_TYPES,
    SNAPSHOT_DATE,
)
from rosterline.operators.fold import OTHER_IDS, TAXONOMIES, SlotGroup, pack
from rosterline.operators.history import apply_corrections, code_label, code_lookup, se_intervals
from rosterline.plans.histories import (
    OTHERIDS,
    PLACES,
    History,
    endpoint_se,
    license_se,
    otherid_se,
    otherid_rejects,
    otherid_se_packed,
    othername_se,
    pl_se,
    taxonomies,
    taxonomy_se,
)
from rosterline.plans.kept_histories import read_history, update_history
from rosterline.session import staged, work_folder


def labels_sql(code: str, labels: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE {code} {cases} ELSE '' END"


def tokens_sql(source: str, prefix: str, values: dict[str, str], token: str, keep: str) -> str:
    """Runs of ``values`` keys with described columns, dates and the export token."""
    keys = [k for k, v in values.items() if v == k]
    runs = intervals_sql(source, ["npi", *keys], 45)
    columns = ", ".join(f"{v} AS {k}" for k, v in values.items())
    fields = ", ".join([*values.values(), "CAST(dt_s AS string)", "CAST(dt_e AS string)"])
    return f"""
        SELECT npi, concat_ws('^', {fields}) AS {token}, {columns},
          dt_s AS {prefix}_dt_s, dt_e AS {prefix}_dt_e
        FROM ({runs}) AS r WHERE {keep}"""


SLOT_ROWS = "{slots} JOIN {npidata} ON l_orderkey = o_orderkey"

OTHERID_SQL = tokens_sql(
    f"""SELECT npi, identifier AS other_id, type_code AS other_id_type_code,
          state AS other_id_state, issuer AS other_id_issuer, _input_file_date AS d
        FROM {SLOT_ROWS}""",
    "other_id",
    {
        "other_id": "other_id",
        "other_id_type_code": "other_id_type_code",
        "other_id_state": "other_id_state",
        "other_id_issuer": "other_id_issuer",
        "other_id_type_desc": labels_sql("other_id_type_code", OTHER_ID_TYPES),
    },
    "other_id_token",
    "other_id <> ''",
)
TAXONOMY_SQL = tokens_sql(
    f"""SELECT npi, code AS taxonomy_code, primary_switch AS is_main, _input_file_date AS d
        FROM {SLOT_ROWS}""",
    "taxonomy",
    {
        "taxonomy_code": "taxonomy_code",
        "is_main": "is_main",
        "taxonomy_desc": """CASE WHEN substring(taxonomy_code, 3, 1) = 'N' THEN '' ELSE
            'Name of ' || substring(taxonomy_code, 3, 1) || substring(taxonomy_code, 5, 1) END""",
    },
    "taxonomy_token",
    "taxonomy_code <> ''",
)
LICENSE_SQL = tokens_sql(
    f"SELECT npi, license_number, license_state, _input_file_date AS d FROM {SLOT_ROWS}",
    "license",
    {"license_number": "license_number", "license_state": "license_state"},
    "license_token",
    "license_number <> ''",
)
NAME_VALUES = {
    "othername": "othername",
    "othername_type_code": "othername_type_code",
    "othername_type_desc": labels_sql("othername_type_code", OTHER_NAME_TYPES),
}
ORGANISATION_NAMES_SQL = tokens_sql(
    """SELECT npi, coalesce(provider_other_organization_name, '') AS othername,
         coalesce(provider_other_organization_name_type_code, '') AS othername_type_code,
         _input_file_date AS d FROM {othername}""",
    "othername", NAME_VALUES, "othername_token", "othername <> ''",
)
PERSON_NAMES_SQL = tokens_sql(
    """SELECT npi, concat_ws(' ', provider_other_first_name, provider_other_middle_name,
           provider_other_last_name) AS othername,
         coalesce(provider_other_last_name_type_code, '') AS othername_type_code,
         _input_file_date AS d FROM {npidata}""",
    "othername", NAME_VALUES, "othername_token", "othername <> ''",
)
OTHERNAME_SQL = f"{ORGANISATION_NAMES_SQL} UNION ALL {PERSON_NAMES_SQL}"
ENDPOINT_SQL = tokens_sql(
    """SELECT npi, coalesce(endpoint_type, '') AS endpoint_type,
         coalesce(endpoint, '') AS endpoint, _input_file_date AS d FROM {endpoint}""",
    "endpoint",
    {"endpoint_type": "endpoint_type", "endpoint": "endpoint"},
    "endpoint_token",
    "endpoint <> ''",
)
PL = "provider_secondary_practice_location_address_"
PL_RUNS_SQL = intervals_sql(
    f"""SELECT npi, coalesce({PL}address_line_1, '') AS a, coalesce({PL}_address_line_2, '') AS b,
          coalesce({PL}_city_name, '') AS c, coalesce({PL}_state_name, '') AS s,
          coalesce({PL}_postal_code, '') AS z, _input_file_date AS d FROM {{pl}}""",
    ["npi", "a", "b", "c", "s", "z"],
    45,
)
PL_SQL = f"""
    SELECT npi, concat_ws('^', a, b, c, s, z, CAST(dt_s AS string), CAST(dt_e AS string))
      AS pl_token, dt_s AS pl_dt_s, dt_e AS pl_dt_e FROM ({PL_RUNS_SQL}) AS r"""


@check(
    "se_intervals",
    intervals_sql("SELECT user_id, event_type, CAST(ts AS date) AS d FROM events",
                  ["user_id", "event_type"], 3),
)
def se_intervals_query(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "events").select(
        "user_id", "event_type", F.col("ts").cast("date").alias("d")
    )
    return se_intervals(days, ["user_id", "event_type"], "d", 3)


@check(
    "se_intervals_45_days",
    intervals_sql("SELECT l_suppkey, l_returnflag, CAST(l_shipdate AS date) AS d FROM lineitem",
                  ["l_suppkey", "l_returnflag"], 45),
)
def se_intervals_45_query(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("d")
    )
    return se_intervals(days, ["l_suppkey", "l_returnflag"], "d")



WRONG_SQL = " ".join(
    f"WHEN {i} THEN '{wrong}'" for i, (_, wrong, _) in enumerate(OTHER_ID_CORRECTIONS)
)
RIGHT_SQL = " ".join(
    f"WHEN npi = '{npi}' AND packed = '{wrong}' THEN '{right}'"
    for npi, wrong, right in OTHER_ID_CORRECTIONS
)
NPI_SQL = " ".join(f"WHEN {i} THEN '{npi}'" for i, (npi, _, _) in enumerate(OTHER_ID_CORRECTIONS))


@check(
    "apply_corrections",
    f"""
    SELECT o_orderkey, npi, CASE {RIGHT_SQL} ELSE packed END AS packed FROM (
      SELECT o_orderkey,
        CASE o_custkey % 5 {NPI_SQL} ELSE CAST(o_custkey AS varchar) END AS npi,
        CASE o_orderkey % {len(OTHER_ID_CORRECTIONS)} {WRONG_SQL} END AS packed
      FROM orders) AS o
    """,
)
def apply_corrections_query(spark: SparkSession, sf: str) -> DataFrame:
    """Every listed provider with its own and with the others' wrong values."""
    providers = F.array(*[F.lit(npi) for npi, _, _ in OTHER_ID_CORRECTIONS])
    wrong = F.array(*[F.lit(text) for _, text, _ in OTHER_ID_CORRECTIONS])
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.coalesce(
            F.get(providers, (F.col("o_custkey") % 5).cast("int")),
            F.col("o_custkey").cast("string"),
        ).alias("npi"),
        F.get(wrong, (F.col("o_orderkey") % len(OTHER_ID_CORRECTIONS)).cast("int")).alias("packed"),
    )
    return apply_corrections(rows, "npi", "packed")


@check(
    "otherid_rejects",
    """SELECT npi, _input_file_date, o_orderkey || '^05^MI^X^Y' AS slot
       FROM {npidata} WHERE o_orderkey % 3 = 0""",
)
def otherid_rejects_query(spark: SparkSession, sf: str) -> DataFrame:
    """Packed identifiers of which some have a field too many."""
    bad = F.when(F.col("o_orderkey") % 3 == 0, F.concat("o_orderkey", F.lit("^05^MI^X^Y")))
    packed = F.concat_ws("|", pack(OTHER_IDS.name, OTHER_IDS), bad)
    return otherid_rejects(npidata_with_slots(spark, sf).withColumn(OTHER_IDS.name, packed))


@check(
    "code_lookup",
    f"""
    SELECT l_orderkey, l_linenumber, code AS taxonomy_code,
      {labels_sql("type_code", OTHER_ID_TYPES)} AS type_desc,
      coalesce(taxonomy_desc, '') AS taxonomy_desc
    FROM {{slots}} LEFT JOIN {{taxonomy_lookup}} ON taxonomy_code = code
    """,
)
def code_lookup_query(spark: SparkSession, sf: str) -> DataFrame:
    slots = frame(spark, sf, "slots").select(
        "l_orderkey",
        "l_linenumber",
        F.col("code").alias("taxonomy_code"),
        code_label("type_code", OTHER_ID_TYPES).alias("type_desc"),
    )
    return code_lookup(slots, frame(spark, sf, "taxonomy_lookup"), "taxonomy_code", "taxonomy_desc")


def _with(spark: SparkSession, sf: str, group: SlotGroup) -> DataFrame:
    """``npidata`` with the one slot array that a history is made of."""
    return npidata_with_slots(spark, sf, wanted=(group.name,))


@check("otherid_se", OTHERID_SQL)
def otherid_se_query(spark: SparkSession, sf: str) -> DataFrame:
    return otherid_se(_with(spark, sf, OTHER_IDS))


@check("otherid_se_packed", OTHERID_SQL)
def otherid_se_packed_query(spark: SparkSession, sf: str) -> DataFrame:
    packed = _with(spark, sf, OTHER_IDS).withColumn(
        OTHER_IDS.name, pack(OTHER_IDS.name, OTHER_IDS)
    )
    return otherid_se_packed(packed)


@check("taxonomy_se", TAXONOMY_SQL)
def taxonomy_se_query(spark: SparkSession, sf: str) -> DataFrame:
    return taxonomy_se(_with(spark, sf, TAXONOMIES), frame(spark, sf, "taxonomy_lookup"))


@check("license_se", LICENSE_SQL)
def license_se_query(spark: SparkSession, sf: str) -> DataFrame:
    return license_se(_with(spark, sf, TAXONOMIES))


@check("othername_se_organisations", ORGANISATION_NAMES_SQL)
def othername_organisations_query(spark: SparkSession, sf: str) -> DataFrame:
    return othername_se(othername=frame(spark, sf, "othername"))


@check("othername_se_persons", PERSON_NAMES_SQL)
def othername_persons_query(spark: SparkSession, sf: str) -> DataFrame:
    return othername_se(npidata=frame(spark, sf, "npidata"))


@check("othername_se", OTHERNAME_SQL)
def othername_se_query(spark: SparkSession, sf: str) -> DataFrame:
    return othername_se(frame(spark, sf, "othername"), frame(spark, sf, "npidata"))


@check("endpoint_se", ENDPOINT_SQL)
def endpoint_se_query(spark: SparkSession, sf: str) -> DataFrame:
    return endpoint_se(frame(spark, sf, "endpoint"))


@check("pl_se", PL_SQL)
def pl_se_query(spark: SparkSession, sf: str) -> DataFrame:
    return pl_se(frame(spark, sf, "pl"))


# Months, all years together, in an order in which most are late; one comes twice.
ARRIVALS = [7, 1, 12, 3, 9, 10, 2, 6, 3, 4, 11, 5, 8]


def _kept(spark: SparkSession, history: History, rows: DataFrame) -> DataFrame:
    """The start-end table after the snapshots of twelve months, one call for each."""
    path = work_folder(spark, "history")
    rows = staged(rows.withColumn("_month", F.month(SNAPSHOT_DATE)), "snapshots", "_month")
    for month in ARRIVALS:
        update_history(spark, path, history, rows.where(F.col("_month") == month).drop("_month"))
    return read_history(spark, path, history)


@check("kept_otherids", OTHERID_SQL)
def kept_otherids_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = _with(spark, sf, OTHER_IDS).select("npi", OTHER_IDS.name, SNAPSHOT_DATE)
    return _kept(spark, OTHERIDS, rows)


@check("kept_places", PL_SQL)
def kept_places_query(spark: SparkSession, sf: str) -> DataFrame:
    return _kept(spark, PLACES, frame(spark, sf, "pl"))


@check("kept_taxonomies", TAXONOMY_SQL)
def kept_taxonomies_query(spark: SparkSession, sf: str) -> DataFrame:
    lookup = frame(spark, sf, "taxonomy_lookup")
    rows = _with(spark, sf, TAXONOMIES).select("npi", TAXONOMIES.name, SNAPSHOT_DATE)
    return _kept(spark, taxonomies(lookup), rows)
