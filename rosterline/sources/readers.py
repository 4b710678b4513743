"""CSV files of the registry as typed DataFrames, one distributed scan per file header."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.dates import parse_us_date
from rosterline.functions.fixed import SNAPSHOT_DATE, UNINFORMATIVE_COLUMNS
from rosterline.functions.text import null_if_blank, strip
from rosterline.operators.fold import fold_repeated_groups, folded_sources
from rosterline.sources.headers import files_by_header, header_schema
from rosterline.sources.manifest import path_snapshot_date
from rosterline.sources.records import parse_records, read_records

# Quotes inside quoted fields are doubled in all registry files.
CSV_OPTIONS = {"escape": '"'}

#: The file that a row comes from, where it is asked for.
SOURCE_FILE = "_source_file"


def read_csv_files(
    spark: SparkSession,
    paths: Iterable[str],
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    multi_line: bool | None = None,
    source: bool = False,
) -> DataFrame:
    """All files (or folders of part files) as text plus the snapshot date in their names.

    Files with the same header are one scan, whatever folder they are in; ``shape`` runs on each
    such scan before the scans are put together by name, a column that a file lacks being null.
    Files with line breaks inside quotes are found by a scan of their text, which ``multi_line``
    saves if it is known, and their records are put together from lines; all files are split.
    With ``source`` rows have the path of their file too.
    """
    added = [SNAPSHOT_DATE, *([SOURCE_FILE] if source else [])]

    def stamps(file: Column) -> list[Column]:
        return [path_snapshot_date(file).alias(SNAPSHOT_DATE), file.alias(SOURCE_FILE)][: len(added)]

    parts = []
    for (header, broken), group in files_by_header(spark, paths, multi_line).items():
        schema = header_schema(header, date_suffix=None)
        if broken:
            records = read_records(spark, group).select("record", *stamps(F.col("file")))
            dated = parse_records(records, schema.names, keep=tuple(added))
        else:
            raw = spark.read.options(header=True, **CSV_OPTIONS).schema(schema).csv(group)
            dated = raw.select("*", *stamps(F.col("_metadata.file_path")))
        parts.append(shape(dated))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def clean_main_columns(df: DataFrame) -> DataFrame:
    """Dates by name, other columns stripped with blanks as null; slot columns left as they are."""
    slots = folded_sources(df.columns)

    def cleaned(name: str) -> Column:
        if name in slots or name in (SNAPSHOT_DATE, SOURCE_FILE):
            return F.col(name)
        if name.endswith("_date"):
            return parse_us_date(name).alias(name)
        return null_if_blank(name).alias(name)

    return df.select(*[cleaned(name) for name in df.columns])


def drop_uninformative(df: DataFrame) -> DataFrame:
    return df.drop(*UNINFORMATIVE_COLUMNS)


def shape_main(df: DataFrame) -> DataFrame:
    """Raw main-file columns to stored ones."""
    return fold_repeated_groups(clean_main_columns(drop_uninformative(df)))


def read_main_files(
    spark: SparkSession,
    paths: Iterable[str],
    multi_line: bool | None = None,
    source: bool = False,
) -> DataFrame:
    return read_csv_files(spark, paths, shape_main, multi_line, source)


def read_side_files(
    spark: SparkSession,
    paths: Iterable[str],
    multi_line: bool | None = None,
    source: bool = False,
) -> DataFrame:
    """Endpoint, other-name or secondary-location files: every column stays text."""
    return read_csv_files(spark, paths, multi_line=multi_line, source=source)


def read_deactivated(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """CSV renderings of the deactivation report: a title row, a header row, then npi and date.

    Title and header are told by content, not by line number, so files split freely.
    """
    raw = spark.read.schema("npi string, deactivation_date string").csv(list(paths))
    return raw.select(
        strip("npi").alias("npi"),
        F.coalesce(
            parse_us_date(strip("deactivation_date")),
            F.try_to_timestamp(F.substring(strip("deactivation_date"), 1, 10), F.lit("yyyy-MM-dd"))
            .cast("date"),
        ).alias("deactivation_date"),
        path_snapshot_date(F.col("_metadata.file_path")).alias(SNAPSHOT_DATE),
    ).where(F.col("npi").rlike("^[0-9]+$"))


def read_taxonomy_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Code list as ``taxonomy_code, taxonomy_desc``."""
    raw = spark.read.options(header=True, multiLine=True, **CSV_OPTIONS).csv(path)
    return raw.select(
        F.col("Code").alias("taxonomy_code"), F.col("Display Name").alias("taxonomy_desc")
    )
