"""Manifest, header, fold and store operators on the given tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.frames import frame, npidata_with_slots, table, wide_main_file
from checks.registry import check
from rosterline.functions.dates import parse_us_date
from rosterline.functions.text import header_name, normalize_header
from rosterline.operators.fold import (
    OTHER_IDS,
    TAXONOMIES,
    TAXONOMY_GROUPS,
    fold_repeated_groups,
    pack,
)
from rosterline.session import work_folder
from rosterline.sources.headers import header_schema
from rosterline.sources.manifest import (
    archive_name,
    classify_file,
    harvest_links,
    month_series,
    pending,
)
from rosterline.sources.readers import (
    drop_uninformative,
    read_deactivated,
    read_main_files,
    read_side_files,
)
from rosterline.sources.file_store import read_file_store
from rosterline.sources.store import append_snapshot, read_latest, read_store
from rosterline.streaming.incremental import load_changed_files, load_new_files


@check(
    "month_series",
    """
    SELECT npi, strftime(month_start - to_months(CAST(i AS int)), '%B_%Y') AS month,
      'NPPES_Data_Dissemination_' || strftime(month_start - to_months(CAST(i AS int)), '%B_%Y')
        || '.zip' AS file_name
    FROM (SELECT npi, date_trunc('month', max(_input_file_date)) AS month_start
          FROM {npidata} GROUP BY npi) CROSS JOIN range(1, 76) AS r(i)
    """,
)
def month_series_query(spark: SparkSession, sf: str) -> DataFrame:
    newest = frame(spark, sf, "npidata").groupBy("npi").agg(F.max("_input_file_date").alias("ref"))
    months = month_series(newest, "ref")
    return months.select("npi", "month", archive_name("month").alias("file_name"))


@check(
    "pending_files",
    """
    SELECT DISTINCT npi, file_name FROM (
      SELECT npi, 'NPPES_Data_Dissemination_'
        || strftime(month_start - to_months(CAST(i AS int)), '%B_%Y') || '.zip' AS file_name
      FROM (SELECT npi, date_trunc('month', max(_input_file_date)) AS month_start
            FROM {npidata} GROUP BY npi) CROSS JOIN range(1, 76) AS r(i)) AS expected
    WHERE (npi, file_name) NOT IN (
      SELECT (npi, 'NPPES_Data_Dissemination_' || strftime(_input_file_date, '%B_%Y') || '.zip')
      FROM {npidata})
    """,
)
def pending_files_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = frame(spark, sf, "npidata")
    newest = rows.groupBy("npi").agg(F.max("_input_file_date").alias("ref"))
    expected = month_series(newest, "ref").select("npi", archive_name("month").alias("file_name"))
    done = rows.select(
        "npi",
        archive_name(F.date_format("_input_file_date", "MMMM_yyyy")).alias("file_name"),
    )
    return pending(expected, done, ["npi", "file_name"])


@check(
    "harvest_links",
    r"""
    SELECT page_id, regexp_extract(href, '[^/]+$', 0) AS file_name FROM (
      SELECT page_id, unnest(regexp_extract_all(html,
        '(?is)<a(?:\s[^>]*)?\shref\s*=\s*"([^"]*)"', 1)) AS href FROM pages) AS links
    WHERE suffix(href, 'e')
    """,
)
def harvest_links_query(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "html")
    return harvest_links(pages, "html", suffix="e")


FILE_NAME_SQL = """
    CASE o_orderpriority WHEN '1-URGENT' THEN 'npidata_pfile_' WHEN '2-HIGH' THEN 'endpoint_pfile_'
      WHEN '3-MEDIUM' THEN 'othername_pfile_' WHEN '4-NOT SPECIFIED' THEN 'pl_pfile_'
      ELSE 'NPPES_Deactivated_' END
    || CASE WHEN o_orderpriority = '5-LOW' THEN 'NPI_Report_' ELSE '20050523-' END
    || replace(CAST(CAST(o_orderdate AS date) AS string), '-', '')
    || CASE WHEN o_orderpriority = '5-LOW' THEN '.zip'
            WHEN o_orderstatus = 'F' THEN '_FileHeader.csv'
            WHEN o_orderstatus = 'P' THEN '_Weekly.zip' ELSE '.csv' END
"""


@check(
    "classify_file",
    f"""
    SELECT o_orderkey, name, kind,
      CASE WHEN ends_with(lower(name), 'fileheader.csv') THEN kind || '_header' ELSE kind END
        AS folder,
      CASE WHEN NOT ends_with(name, '.zip') THEN NULL
           WHEN starts_with(name, 'NPPES_Deactivated') THEN 'deactivated'
           WHEN ends_with(name, '_Weekly.zip') THEN 'weekly' ELSE 'monthly' END AS archive,
      CAST(o_orderdate AS date) AS snapshot_date
    FROM (SELECT o_orderkey, o_orderdate, {FILE_NAME_SQL} AS name,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'npidata' WHEN '2-HIGH' THEN 'endpoint'
              WHEN '3-MEDIUM' THEN 'othername' WHEN '4-NOT SPECIFIED' THEN 'pl' END AS kind
          FROM orders) AS named
    """,
)
def classify_file_query(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "orders").select("o_orderkey", F.expr(FILE_NAME_SQL).alias("name"))
    return classify_file(names, "name")


@check(
    "normalize_header",
    r"""
    SELECT p_partkey, regexp_replace(replace(lower(p_name || '  (' || p_brand || ') ' || p_type),
      ' ', '_'), '\W+', '', 'g') AS header FROM part
    """,
)
def normalize_header_query(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat("p_name", F.lit("  ("), "p_brand", F.lit(") "), "p_type")
    return table(spark, sf, "part").select("p_partkey", normalize_header(raw).alias("header"))


@check(
    "parse_us_date",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
      THEN CAST(o_orderdate AS date) END AS parsed FROM orders
    """,
)
def parse_us_date_query(spark: SparkSession, sf: str) -> DataFrame:
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "M/d/yyyy"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("02/30/2020"))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    )
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", parse_us_date(text).alias("parsed"))


FOLDED_SQL = """
    SELECT l_orderkey AS o_orderkey,
      string_agg(concat_ws('^', code, license_number, license_state, primary_switch), '|'
        ORDER BY primary_switch = 'Y' DESC, l_linenumber) AS taxonomies,
      string_agg(concat_ws('^', identifier, type_code, state, issuer), '|'
        ORDER BY l_linenumber) AS identifiers
    FROM {slots} GROUP BY l_orderkey
"""


@check("fold_repeated_groups", FOLDED_SQL)
def fold_query(spark: SparkSession, sf: str) -> DataFrame:
    folded = fold_repeated_groups(wide_main_file(spark, sf))
    return folded.select(
        "o_orderkey",
        pack(TAXONOMIES.name, TAXONOMIES).alias("taxonomies"),
        pack(OTHER_IDS.name, OTHER_IDS).alias("identifiers"),
    )


@check("drop_uninformative", "SELECT o_orderkey, npi, entity_type_code FROM {npidata}")
def drop_uninformative_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = frame(spark, sf, "npidata").select("o_orderkey", "npi", "entity_type_code")
    return drop_uninformative(
        rows.withColumns(
            {
                "replacement_npi": F.col("npi"),
                "employer_identification_number_ein": F.lit("<UNAVAIL>"),
                "parent_organization_tin": F.lit("<UNAVAIL>"),
            }
        )
    )


STORED_SQL = """
    SELECT o_orderkey, o_orderstatus,
      CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
      make_date(year(o_orderdate), 1, 1) AS _input_file_date FROM orders
"""


def _order_store(spark: SparkSession, sf: str) -> str:
    """All orders as yearly snapshots: old ones lack a column, new ones are written twice."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("_input_file_date"),
    )
    path = work_folder(spark, "snapshots")
    recent = F.col("_input_file_date") >= F.lit("1998-01-01").cast("date")
    append_snapshot(rows.where(~recent).drop("o_orderpriority"), path)
    append_snapshot(rows.where(recent), path)
    append_snapshot(rows.where(recent), path)
    return path


@check("append_snapshot", STORED_SQL)
def append_snapshot_query(spark: SparkSession, sf: str) -> DataFrame:
    return read_store(spark, _order_store(spark, sf)).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "_input_file_date"
    )


@check(
    "read_latest_snapshot",
    f"""
    SELECT * FROM ({STORED_SQL}) AS s
    WHERE _input_file_date = (SELECT make_date(max(year(o_orderdate)), 1, 1) FROM orders)
    """,
)
def read_latest_query(spark: SparkSession, sf: str) -> DataFrame:
    return read_latest(spark, _order_store(spark, sf)).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "_input_file_date"
    )


def _csv_folder(df: DataFrame, folder: str, name: str) -> str:
    """Write ``df`` as a folder of CSV files that is named like a published file."""
    path = f"{folder}/{name}"
    df.write.options(header=True, quoteAll=True, escape='"').csv(path)
    return path


@check(
    "ingest_main_file",
    """
    SELECT npi, entity_type_code, o.o_orderdate AS last_update_date,
      DATE '2024-01-07' AS _input_file_date, taxonomies, identifiers
    FROM (SELECT o_orderkey, npi, entity_type_code FROM {npidata}) AS n
    JOIN (SELECT o_orderkey AS k, CAST(o_orderdate AS date) AS o_orderdate FROM orders) AS o
      ON n.o_orderkey = o.k
    LEFT JOIN (""" + FOLDED_SQL + """) AS f ON f.o_orderkey = n.o_orderkey
    """,
)
def ingest_main_file_query(spark: SparkSession, sf: str) -> DataFrame:
    """CSV out, CSV in: raw header names, US dates, blanks, numbered columns."""
    rows = frame(spark, sf, "npidata").select(
        "o_orderkey",
        F.concat(F.lit(" "), "npi", F.lit("\t")).alias("NPI"),
        F.col("entity_type_code").alias("Entity Type Code"),
        F.date_format("_input_file_date", "MM/dd/yyyy").alias("Last Update Date"),
        F.lit("x").alias("Replacement NPI"),
    )
    wide = wide_main_file(spark, sf)
    raw = rows.join(wide, "o_orderkey", "left").drop("o_orderkey")
    path = _csv_folder(raw, work_folder(spark, "main"), "npidata_pfile_20050523-20240107")
    stored = read_main_files(spark, [path])
    return stored.select(
        "npi",
        "entity_type_code",
        "last_update_date",
        "_input_file_date",
        pack(TAXONOMIES.name, TAXONOMIES).alias("taxonomies"),
        pack(OTHER_IDS.name, OTHER_IDS).alias("identifiers"),
    )


@check(
    "ingest_side_files",
    """
    SELECT npi, provider_other_organization_name,
      CASE WHEN year(_input_file_date) >= 1998
           THEN provider_other_organization_name_type_code END
        AS provider_other_organization_name_type_code,
      CASE WHEN year(_input_file_date) >= 1998 THEN DATE '2001-12-31'
           ELSE DATE '1997-12-31' END AS _input_file_date
    FROM {othername}
    """,
)
def ingest_side_files_query(spark: SparkSession, sf: str) -> DataFrame:
    """Two headers: the older files lack the last column, which must not shift the others."""
    rows = frame(spark, sf, "othername")
    names = {
        "npi": "NPI",
        "provider_other_organization_name": "Provider Other Organization Name",
        "provider_other_organization_name_type_code":
            "Provider Other Organization Name Type Code",
    }
    assert all(header_name(raw) == name for name, raw in names.items())
    raw = rows.select(*[F.col(c).alias(raw) for c, raw in names.items()], "_input_file_date")
    recent = F.year("_input_file_date") >= 1998
    folder = work_folder(spark, "side")
    old = raw.where(~recent).drop("_input_file_date", list(names.values())[2])
    new = raw.where(recent).drop("_input_file_date")
    paths = [
        _csv_folder(old, folder, "othername_pfile_20050523-19971231"),
        _csv_folder(new, folder, "othername_pfile_20050523-20011231"),
    ]
    return read_side_files(spark, paths).select(*names, "_input_file_date")


@check(
    "ingest_line_breaks",
    """SELECT CAST(doc_id AS varchar) AS npi, md5(replace(text, chr(13) || chr(10), chr(10))) AS text,
         lang, DATE '2024-01-07' AS _input_file_date FROM documents""",
)
def ingest_line_breaks_query(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with line breaks, quotes and commas in a folder of part files, read by ranges."""
    raw = table(spark, sf, "documents").select(
        F.col("doc_id").alias("NPI"), F.col("text").alias("Text"), F.col("lang").alias("Lang")
    )
    path = _csv_folder(raw, work_folder(spark, "broken"), "othername_pfile_20050523-20240107")
    read = read_side_files(spark, [path])
    return read.select("npi", F.md5(F.col("text").cast("binary")).alias("text"), "lang", "_input_file_date")


@check(
    "fold_taxonomy_groups",
    """SELECT l_orderkey AS o_orderkey, string_agg(group_code, '|' ORDER BY l_linenumber) AS groups
       FROM {group_slots} GROUP BY 1""",
)
def fold_taxonomy_groups_query(spark: SparkSession, sf: str) -> DataFrame:
    """The third group of numbered columns, of one field."""
    name = "healthcare_provider_taxonomy_group"
    wide = (
        frame(spark, sf, "group_slots")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .pivot("l_linenumber", list(range(1, 8)))
        .agg(F.max("group_code"))
    )
    numbered = wide.select("o_orderkey", *[F.col(str(n)).alias(f"{name}_{n}") for n in range(1, 8)])
    folded = fold_repeated_groups(numbered)
    return folded.select("o_orderkey", pack(TAXONOMY_GROUPS.name, TAXONOMY_GROUPS).alias("groups"))


@check(
    "ingest_deactivated",
    """SELECT npi, _input_file_date AS deactivation_date, DATE '2024-01-08' AS _input_file_date
       FROM {npidata}""",
)
def ingest_deactivated_query(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV report with a title row and a header row before the data rows."""
    rows = frame(spark, sf, "npidata").select(
        "npi", F.date_format("_input_file_date", "MM/dd/yyyy").alias("when")
    )
    path = f"{work_folder(spark, 'deactivated')}/deactivated_npi_report_20240108"
    rows.toDF("Deactivated NPI list", "as of 2024").write.options(header=True).csv(path)
    rows.limit(0).toDF("NPI", "Deactivation Date").write.mode("append").options(
        header=True
    ).csv(path)
    return read_deactivated(spark, [path])


@check(
    "header_schema",
    """SELECT CAST(o_orderkey AS varchar) AS npi, CAST(o_orderdate AS date) AS last_update_date,
         o_orderstatus AS provider_gender_code FROM orders""",
)
def header_schema_query(spark: SparkSession, sf: str) -> DataFrame:
    """A file with ISO dates read with the schema that its header asks for."""
    header = ["NPI", "Last Update Date", "Provider Gender Code"]
    raw = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date"), "o_orderstatus"
    )
    path = _csv_folder(raw.toDF(*header), work_folder(spark, "typed"), "npidata")
    return spark.read.options(header=True, enforceSchema=True).csv(
        path, schema=header_schema(header)
    )


@check(
    "incremental_load",
    """SELECT npi, endpoint_type, endpoint, CASE WHEN year(_input_file_date) >= 1998
         THEN DATE '2001-12-31' ELSE DATE '1997-12-31' END AS _input_file_date FROM {endpoint}""",
)
def incremental_load_query(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals in a landing folder, three calls: every file is loaded once."""
    rows = frame(spark, sf, "endpoint")
    recent = F.year("_input_file_date") >= 1998
    folder = work_folder(spark, "landing")
    store, checkpoint = f"{folder}/store", f"{folder}/checkpoint"
    for arrived, name in [
        (~recent, "endpoint_pfile_20050523-19971231"),
        (recent, "endpoint_pfile_20050523-20011231"),
    ]:
        _csv_folder(rows.where(arrived).drop("_input_file_date"), f"{folder}/in", name)
        load_new_files(spark, f"{folder}/in/*", store, checkpoint, read_side_files)
    load_new_files(spark, f"{folder}/in/*", store, checkpoint, read_side_files)
    return read_store(spark, store).select("npi", "endpoint_type", "endpoint", "_input_file_date")


@check(
    "incremental_load_parts",
    """SELECT npi, endpoint_type, endpoint, CASE WHEN year(_input_file_date) >= 1998
         THEN DATE '2001-12-31' ELSE DATE '1997-12-31' END AS _input_file_date FROM {endpoint}""",
)
def incremental_load_parts_query(spark: SparkSession, sf: str) -> DataFrame:
    """Several part files of each date, two files a batch, and a late file of a loaded date."""
    rows = frame(spark, sf, "endpoint")
    recent = F.year("_input_file_date") >= 1998
    late = F.pmod(F.xxhash64("npi"), F.lit(7)) == 0
    folder = work_folder(spark, "landing")
    store, checkpoint = f"{folder}/store", f"{folder}/checkpoint"

    def arrive(arrived: DataFrame, name: str) -> None:
        shown = arrived.drop("_input_file_date").repartition(5, "npi")
        _csv_folder(shown, f"{folder}/in", name)
        load_new_files(spark, f"{folder}/in/*", store, checkpoint, read_side_files, 2)

    arrive(rows.where(~recent & ~late), "endpoint_pfile_20050523-19971231")
    arrive(rows.where(recent), "endpoint_pfile_20050523-20011231")
    arrive(rows.where(~recent & late), "endpoint_late_20050523-19971231")
    return read_store(spark, store).select("npi", "endpoint_type", "endpoint", "_input_file_date")


def _publish(df: DataFrame, folder: str, name: str) -> str:
    """``df`` as part files of one date, under the same paths whenever that is done."""
    spark = df.sparkSession
    made = _csv_folder(df.repartition(3, "npi"), f"{folder}/made", work_folder(spark, "x")[-8:])
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(made).getFileSystem(spark._jsc.hadoopConfiguration())
    out = f"{folder}/in/{name}"
    files.mkdirs(place(out))
    parts = sorted(e.getPath().toString() for e in files.globStatus(place(f"{made}/part-*")))
    for number, part in enumerate(parts):
        target = place(f"{out}/part-{number}.csv")
        files.delete(target, False)
        files.rename(place(part), target)
    return out


@check(
    "incremental_load_changed",
    """SELECT npi, endpoint_type, endpoint, CASE WHEN year(_input_file_date) >= 1998
         THEN DATE '2001-12-31' ELSE DATE '1997-12-31' END AS _input_file_date FROM {endpoint}""",
)
def incremental_load_changed_query(spark: SparkSession, sf: str) -> DataFrame:
    """Files that are published again, files that leave the folder, and a late file of their date."""
    rows = frame(spark, sf, "endpoint")
    recent = F.year("_input_file_date") >= 1998
    late = F.pmod(F.xxhash64("npi"), F.lit(7)) == 0
    folder = work_folder(spark, "landing")
    store = f"{folder}/store"

    def arrive(arrived: DataFrame, name: str) -> str:
        out = _publish(arrived.drop("_input_file_date"), folder, name)
        load_changed_files(spark, f"{folder}/in/*", store, partial(read_side_files, source=True), 4)
        return out

    gone = arrive(rows.where(~recent & ~late), "endpoint_pfile_20050523-19971231")
    draft = rows.where(recent).withColumn("endpoint", F.concat(F.lit("draft of "), "endpoint"))
    arrive(draft, "endpoint_pfile_20050523-20011231")
    place = spark._jvm.org.apache.hadoop.fs.Path(gone)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    arrive(rows.where(recent), "endpoint_pfile_20050523-20011231")
    arrive(rows.where(~recent & late), "endpoint_late_20050523-19971231")
    return read_file_store(spark, store).select(
        "npi", "endpoint_type", "endpoint", "_input_file_date"
    )


@check("stored_slots_round_trip", FOLDED_SQL)
def stored_slots_query(spark: SparkSession, sf: str) -> DataFrame:
    """Slot arrays of the snapshot rows packed for export; the store keeps primary slots first."""
    rows = npidata_with_slots(spark, sf).where(F.col(TAXONOMIES.name).isNotNull())
    primary = F.filter(TAXONOMIES.name, lambda s: s["primary_switch"] == "Y")
    others = F.filter(TAXONOMIES.name, lambda s: s["primary_switch"] != "Y")
    return rows.select(
        "o_orderkey",
        pack(F.concat(primary, others), TAXONOMIES).alias("taxonomies"),
        pack(OTHER_IDS.name, OTHER_IDS).alias("identifiers"),
    )
