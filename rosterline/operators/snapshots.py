"""Newest snapshots and how often columns change between snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.functions.fixed import SNAPSHOT_DATE
from rosterline.session import staged


def latest_partition(df: DataFrame, date_col: str = SNAPSHOT_DATE) -> DataFrame:
    """Rows of the newest date; the scalar subquery prunes partitions when Spark runs it."""
    newest = df.agg(F.max(date_col).alias("newest")).scalar()
    return df.where(F.col(date_col) == newest)


def newest_dates(
    df: DataFrame,
    key: str = "npi",
    date_col: str = SNAPSHOT_DATE,
    kind: str | None = "entity_type_code",
    held: DataFrame | None = None,
) -> DataFrame:
    """``key`` and the newest date of its rows with a ``kind``.

    ``held`` is such a table of other snapshots, earlier or later ones: with each new snapshot the
    table is brought up to date from that snapshot's rows alone.
    """
    typed = df.where(F.lit(True) if kind is None else F.col(kind).isNotNull())
    rows = typed.where(F.col(key).isNotNull()).select(key, date_col)
    both = rows if held is None else rows.unionByName(held.select(key, date_col))
    return both.groupBy(key).agg(F.max(date_col).alias(date_col))


def latest_per_key(
    df: DataFrame,
    key: str = "npi",
    date_col: str = SNAPSHOT_DATE,
    kind: str | None = "entity_type_code",
    columns: list[str] | None = None,
    newest: DataFrame | None = None,
) -> DataFrame:
    """Rows of each key's newest date among rows with a ``kind``; ties are kept.

    ``newest`` is the stored result of ``newest_dates``; without it, it is made from three narrow
    columns and staged. It names the few dates of which rows are wanted, so a store's other
    partitions are not opened. Rows of the last date with a kind meet no join; older rows, and rows
    of the last date without a kind, are held against ``newest``.
    """
    known = staged(newest_dates(df, key, date_col, kind), "newest") if newest is None else newest
    # As many dates as there are snapshots, at most.
    dates = sorted(row[0] for row in known.select(date_col).distinct().collect())
    out = df.columns if columns is None else [*dict.fromkeys([key, date_col, *columns])]
    if not dates:
        return df.select(*out).limit(0)
    wanted = df.select(*dict.fromkeys([*out, *([] if kind is None else [kind])]))
    has_kind = F.lit(True) if kind is None else F.col(kind).isNotNull()
    at_last = F.col(date_col) == F.lit(dates[-1])
    found = wanted.where(at_last & has_kind & F.col(key).isNotNull())
    rest = wanted.where(F.col(date_col).isin(dates) & ~(at_last & has_kind))
    older = rest.join(known, [key, date_col], "left_semi")
    return found.unionByName(older).select(*out)


#: Rows of a key from which its columns are counted apart, and keys that this can be done for.
CROWDED_ROWS = 100_000
MAX_CROWDED_KEYS = 100_000


def change_frequency(
    df: DataFrame,
    columns: list[str],
    key: str = "npi",
    kind: str = "entity_type_code",
    date_col: str = SNAPSHOT_DATE,
    crowded_rows: int = CROWDED_ROWS,
) -> DataFrame:
    """``kind, colname, change_freq``: mean number of distinct values per key and column.

    Nulls and empty arrays do not count, nor keys without any value in a column. The rows of a key
    are reduced to the set of their versions, a hash for each column (so arrays are as cheap as
    other columns), in one shuffle; all columns are counted from that set. The date differs in every
    snapshot and has a set of its own. Keys with more than ``crowded_rows`` rows, and more than
    1/``MAX_CROWDED_KEYS`` of all, are left out of that, and their columns become rows that spread.
    """
    typed = df.where(F.col(kind).isNotNull())
    loads = typed.groupBy(kind, key).agg(F.count(F.lit(1)).alias("_load"))
    share = F.col("_load") * F.lit(MAX_CROWDED_KEYS) > loads.agg(F.sum("_load")).scalar()
    crowded = F.broadcast(
        loads.where((F.col("_load") > crowded_rows) & share).select(
            F.col(kind).alias("_kind"), F.col(key).alias("_key")
        )
    )
    same = (F.col(kind) == F.col("_kind")) & F.col(key).eqNullSafe(F.col("_key"))
    values = [c for c in columns if c != date_col]
    counts = _per_key(typed.join(crowded, same, "left_anti"), values, key, kind, date_col)
    sums = _sums(counts, [*values, *([date_col] if date_col in columns else [])], kind)
    apart = _crowded_sums(typed.join(crowded, same, "left_semi"), columns, key, kind)
    return (
        sums.unionByName(apart)
        .groupBy(kind, "colname")
        .agg((F.sum("_sum") / F.sum("_keys")).alias("change_freq"))
        .where(F.col("change_freq").isNotNull())
    )


def _counts(df: DataFrame, column: str) -> Column:
    """Whether a row has a value: not null, and not an array without elements."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return F.coalesce(F.size(column) > 0, F.lit(False))
    return F.col(column).isNotNull()


def _per_key(
    rows: DataFrame, values: list[str], key: str, kind: str, date_col: str
) -> DataFrame:
    """``kind, key`` and the number of distinct values in each column."""
    marks = [
        F.when(_counts(rows, c), F.xxhash64(c)).alias(f"_{i}") for i, c in enumerate(values)
    ]
    versions = rows.groupBy(kind, key).agg(
        F.collect_set(F.struct(F.lit(0).alias("_"), *marks)).alias("_versions"),
        F.size(F.collect_set(date_col)).alias(date_col),
    )

    def distinct(i: int) -> Column:
        found = F.transform("_versions", lambda v: v[f"_{i}"])
        return F.size(F.filter(F.array_distinct(found), lambda mark: mark.isNotNull()))

    return versions.select(
        kind, key, date_col, *[distinct(i).alias(c) for i, c in enumerate(values)]
    )


def _sums(counts: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """``kind, colname, _sum, _keys``: distinct values, and keys with any, of all keys."""
    totals = counts.groupBy(kind).agg(
        *[F.sum(c).alias(f"_sum_{i}") for i, c in enumerate(columns)],
        *[F.count_if(F.col(c) > 0).alias(f"_keys_{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("colname"),
                F.col(f"_sum_{i}").alias("_sum"),
                F.nullif(F.col(f"_keys_{i}"), F.lit(0)).alias("_keys"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return totals.select(kind, F.explode(entries).alias("_e")).select(kind, "_e.*")


def _crowded_sums(rows: DataFrame, columns: list[str], key: str, kind: str) -> DataFrame:
    """``_sums`` of a few keys with very many rows: values spread by what they are."""

    def text(c: str) -> Column:
        is_array = isinstance(rows.schema[c].dataType, T.ArrayType)
        return F.when(_counts(rows, c), F.to_json(c) if is_array else F.col(c).cast("string"))

    per_key = (
        rows.select(kind, key, *[text(c).alias(c) for c in columns])
        .unpivot([kind, key], columns, "colname", "value")
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy(kind, key, "colname")
        .agg(F.count("value").alias("_n"))
    )
    return per_key.groupBy(kind, "colname").agg(
        F.sum("_n").alias("_sum"), F.count("_n").alias("_keys")
    )
