"""Which files exist, what they are, and which are still to be loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.dates import compact_date, month_label
from rosterline.functions.fixed import (
    DEACTIVATION_ARCHIVE_PREFIX,
    HEADER_MEMBER_SUFFIX,
    MEMBER_KINDS,
    MONTHLY_ARCHIVE_PREFIX,
    WEEKLY_ARCHIVE_SUFFIX,
)
from rosterline.functions.text import col_of

# Fixed value: months of history that are asked for.
HISTORY_MONTHS = 75

# An <a> tag's href value, quoted either way or bare.
LINK_PATTERN = r"""(?is)<a(?:\s[^>]*)?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def month_series(
    df: DataFrame, ref_date: str, months: int = HISTORY_MONTHS, out: str = "month"
) -> DataFrame:
    """Each row once per month before ``ref_date``'s month, as ``January_2024`` labels."""
    back = F.explode(F.sequence(F.lit(1), F.lit(months))).alias("_back")
    first_of_month = F.trunc(F.col(ref_date), "month")
    return (
        df.select("*", back)
        .withColumn(out, month_label(F.add_months(first_of_month, -F.col("_back"))))
        .drop("_back")
    )


def archive_name(month: Column | str) -> Column:
    """Name of the monthly archive for a month label."""
    return F.concat(F.lit(MONTHLY_ARCHIVE_PREFIX), col_of(month), F.lit(".zip"))


def harvest_links(
    pages: DataFrame, html: str, suffix: str = ".zip", out: str = "file_name"
) -> DataFrame:
    """Base names of all links that end with ``suffix``, one row per link."""
    found = F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK_PATTERN), F.lit(1)))
    bare = F.regexp_replace(F.col("_href"), r"""^["']|["']$""", "")
    return (
        pages.select(*[c for c in pages.columns if c != html], found.alias("_href"))
        .withColumn("_href", bare)
        .where(F.col("_href").endswith(suffix))
        .withColumn(out, F.regexp_extract("_href", "[^/]+$", 0))
        .drop("_href")
    )


def pending(expected: DataFrame, done: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows of ``expected`` whose key is not in ``done``, each key once."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return expected.dropDuplicates(keys).join(
        done.select(*keys).distinct(), keys, "left_anti"
    )


def file_kind(name: Column | str) -> Column:
    """``npidata``, ``endpoint``, ``othername`` or ``pl``, by prefix; null for others."""
    return F.coalesce(
        *[F.when(col_of(name).startswith(f"{k}_"), F.lit(k)) for k in MEMBER_KINDS]
    )


def is_header_file(name: Column | str) -> Column:
    return F.lower(col_of(name)).endswith(HEADER_MEMBER_SUFFIX)


def archive_kind(name: Column | str) -> Column:
    """``weekly``, ``deactivated`` or ``monthly`` for archives, null for other files."""
    stem = file_stem(name)
    return F.when(
        F.lower(col_of(name)).endswith(".zip"),
        F.when(stem.startswith(DEACTIVATION_ARCHIVE_PREFIX), F.lit("deactivated"))
        .when(stem.endswith(WEEKLY_ARCHIVE_SUFFIX), F.lit("weekly"))
        .otherwise(F.lit("monthly")),
    )


def file_stem(name: Column | str) -> Column:
    return F.regexp_replace(col_of(name), r"\.[^.]*$", "")


def snapshot_date(name: Column | str) -> Column:
    """Date in a file name: end of a ``start-end`` range, a dated block, or the last 8 digits."""
    stem = file_stem(name)
    block_day = F.regexp_extract(stem, r"(\d{4}-\d{2}-\d{2})_\d{3}", 1)
    return F.coalesce(
        compact_date(F.regexp_extract(stem, r"(\d{8})-(\d{8})", 2)),
        compact_date(F.translate(block_day, "-", "")),
        compact_date(F.right(stem, F.lit(8))),
    )


def path_snapshot_date(path: Column | str) -> Column:
    """``snapshot_date`` of the last part of a path, else of the folder that holds it."""
    parts = F.split(col_of(path), "/")
    return F.coalesce(
        snapshot_date(F.element_at(parts, -1)), snapshot_date(F.try_element_at(parts, F.lit(-2)))
    )


def classify_file(df: DataFrame, name: str) -> DataFrame:
    """Add ``kind``, ``folder``, ``archive`` and ``snapshot_date`` to rows of file names."""
    kind = file_kind(name)
    return df.select(
        "*",
        kind.alias("kind"),
        F.when(is_header_file(name), F.concat(kind, F.lit("_header")))
        .otherwise(kind)
        .alias("folder"),
        archive_kind(name).alias("archive"),
        snapshot_date(name).alias("snapshot_date"),
    )
