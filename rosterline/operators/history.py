"""Start-end histories: when was a value there, from dated observations of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.fixed import OTHER_ID_CORRECTIONS
from rosterline.functions.text import col_of

# Fixed value: days between two observations up to which a value counts as unbroken.
GAP_DAYS = 45


def merge_intervals(
    df: DataFrame, keys: list[str], start: str, end: str, gap_days: int = GAP_DAYS
) -> DataFrame:
    """Intervals of each key, joined where no more than ``gap_days`` lie between them.

    Intervals of a key are gathered as a set, copies dropped before the only shuffle, and joined
    inside its row: what a key holds is bounded by the calendar, not by the number of rows.
    """
    interval = F.struct(F.col(start).alias("s"), F.col(end).alias("e"))
    held = df.groupBy(*keys).agg(F.array_sort(F.collect_set(interval)).alias("_held"))
    runs = F.explode(joined_intervals(F.col("_held"), gap_days)).alias("_run")
    return held.select(*keys, runs).select(
        *keys, F.col("_run.s").alias(start), F.col("_run.e").alias(end)
    )


def joined_intervals(held: Column, gap_days: int) -> Column:
    """A sorted array<struct<s, e>> with neighbours joined; the array has one entry at least."""

    def step(done: Column, x: Column) -> Column:
        open_run = done["open"]
        near = F.coalesce(F.datediff(x["s"], open_run["e"]) <= gap_days, F.lit(False))
        longer = F.struct(open_run["s"].alias("s"), F.greatest(open_run["e"], x["e"]).alias("e"))
        return F.when(
            near, F.struct(done["closed"].alias("closed"), longer.alias("open"))
        ).otherwise(
            F.struct(
                F.concat(done["closed"], F.array(open_run)).alias("closed"), x.alias("open")
            )
        )

    first = F.struct(
        F.slice(held, 1, 0).alias("closed"), F.get(held, F.lit(0)).alias("open")
    )
    rest = F.slice(held, F.lit(2), F.size(held))
    return F.aggregate(rest, first, step, lambda done: F.concat(done["closed"], F.array(done["open"])))


def se_intervals(
    df: DataFrame,
    keys: list[str],
    date: str,
    gap_days: int = GAP_DAYS,
    start: str = "dt_s",
    end: str = "dt_e",
) -> DataFrame:
    """``keys, start, end`` of every unbroken run of observation dates.

    A step of more than ``gap_days`` closes a run at the last date seen. Dates of a key are
    gathered as a set, so copies are dropped before the only shuffle and an array never holds
    more than one entry per day.
    """
    seen = (
        df.where(F.col(date).isNotNull())
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set(date)).alias("_days"))
    )
    runs = F.explode(islands(F.col("_days"), gap_days)).alias("_run")
    return seen.select(*keys, runs).select(
        *keys, F.col("_run.s").alias(start), F.col("_run.e").alias(end)
    )


def islands(days: Column, gap_days: int) -> Column:
    """Runs of a sorted date array as array<struct<s, e>>."""
    firsts = F.filter(
        days,
        lambda d, i: (i == 0) | (F.datediff(d, F.get(days, i - 1)) > gap_days),
    )
    lasts = F.filter(
        days,
        lambda d, i: (i == F.size(days) - 1) | (F.datediff(F.get(days, i + 1), d) > gap_days),
    )
    return F.arrays_zip(firsts.alias("s"), lasts.alias("e"))


def array_intervals(
    df: DataFrame, key: str, slots: str, date: str, gap_days: int = GAP_DAYS
) -> DataFrame:
    """``key, slots, dt_s, dt_e``: histories of whole arrays, nulls left out.

    Most snapshots repeat the array of the one before, so this is far smaller than its input.
    """
    return se_intervals(df.where(F.col(slots).isNotNull()), [key, slots], date, gap_days)


def entry_intervals(
    runs: DataFrame,
    key: str,
    slots: str,
    values: dict[str, Column],
    gap_days: int = GAP_DAYS,
    start: str = "dt_s",
    end: str = "dt_e",
) -> DataFrame:
    """Histories of the entries of arrays out of ``array_intervals``; ``values`` are of ``_slot``.

    Only the few distinct arrays of a key are exploded; the intervals of one entry in different
    arrays are merged after that. Runs of a union are the merged runs of its parts, so this
    equals exploding every snapshot, with a fraction of the rows.
    """
    entries = runs.select(
        key, F.col("dt_s").alias(start), F.col("dt_e").alias(end), F.explode(slots).alias("_slot")
    ).select(key, start, end, *[value.alias(name) for name, value in values.items()])
    return merge_intervals(entries, [key, *values], start, end, gap_days)


def apply_corrections(df: DataFrame, npi: str, packed: str) -> DataFrame:
    """Replace the listed wrong packed values of listed providers."""
    fixed = F.create_map(
        *[
            F.lit(text)
            for provider, wrong, right in OTHER_ID_CORRECTIONS
            for text in (f"{provider}:{wrong}", right)
        ]
    )
    found = F.try_element_at(fixed, F.concat(F.col(npi), F.lit(":"), F.col(packed)))
    return df.withColumn(packed, F.coalesce(found, F.col(packed)))


def code_label(code: Column | str, labels: dict[str, str]) -> Column:
    """Text of a code out of a short fixed table; unknown codes give ''."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, col_of(code)), F.lit(""))


def code_lookup(df: DataFrame, lookup: DataFrame, code: str, label: str) -> DataFrame:
    """Left join of a code list; unknown codes give ''. Spark sizes the list for broadcast."""
    listed = lookup.groupBy(code).agg(F.min(label).alias(label))
    return df.join(listed, code, "left").withColumn(label, F.coalesce(label, F.lit("")))
