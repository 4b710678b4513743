"""Lists of items per key whose rows stay small, however many items one key has.

A plain ``collect_list`` puts a whole group into one task and one row. Here a key with very
many items gets several rows, told apart by ``part``; all parts together are the whole list.
Keys of ordinary size have part 0 only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ITEMS = 5_000
MAX_HOT_KEYS = 100_000
RUNS_AT_ONCE = 10_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cut(items: Column, load: Column, max_items: int) -> Column:
    """The lists of all parts of a key, as array<struct<part, items>>: one up to ``max_items``.

    Items are sorted by part and cut where the part changes, whatever the number of parts.
    """
    parts = (load / F.lit(max_items)).cast("bigint") + 1

    def placed(x: Column) -> Column:
        part = F.pmod(F.xxhash64(x), parts).cast("int")
        return F.struct(part.alias("part"), x.alias("item"))

    def part_of(entries: Column, i: Column) -> Column:
        return F.get(entries, i)["part"]

    def cut(entries: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(entries) - 1),
            lambda i: (i == 0) | (part_of(entries, i) != part_of(entries, i - 1)),
        )
        return _let(starts, lambda starts: between(entries, starts))

    def between(entries: Column, starts: Column) -> Column:
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(entries)))

        def piece(a: Column, b: Column) -> Column:
            held = F.transform(F.sequence(a, b - 1), lambda i: F.get(entries, i)["item"])
            return F.struct(part_of(entries, a).alias("part"), held.alias("items"))

        return F.zip_with(starts, ends, piece)

    whole = F.array(F.struct(F.lit(0).alias("part"), items.alias("items")))
    many = _let(F.sort_array(F.transform(items, placed)), cut)
    return F.when(load <= max_items, whole).when(F.size(items) > 0, many)


def _placed(
    rows: DataFrame, keys: list[str], load: Column, max_items: int, max_keys: int
) -> DataFrame:
    """``rows`` with ``_few``, the load of a broadcast key, and ``_slot``, the part of its list that
    the row goes to, 0 for all other keys."""
    loads = rows.groupBy(*keys).agg(load.alias("_load"))
    share = F.col("_load") * F.lit(max_keys) > loads.agg(F.sum("_load")).scalar()
    few = F.broadcast(
        loads.where((F.col("_load") > max_items) & share).select(
            *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_load").alias("_few")
        )
    )
    same = reduce(Column.__and__, [rows[k].eqNullSafe(few[f"_key_{k}"]) for k in keys])
    parts = (F.col("_few") / F.lit(max_items)).cast("bigint") + 1
    slot = F.coalesce(F.pmod(F.xxhash64("_item"), parts).cast("int"), F.lit(0))
    return rows.join(few, same, "left").select(*rows.columns, "_few", slot.alias("_slot"))


def _gathered(
    placed: DataFrame, keys: list[str], by: list[str], load: Column, max_items: int
) -> DataFrame:
    """``keys, part, items, _load`` of ``placed`` rows, which are shuffled once, by ``by``."""
    return (
        placed.repartition(*by)
        .groupBy(*keys, "_slot")
        .agg(
            F.sort_array(F.collect_list("_item")).alias("items"),
            load.alias("_load"),
            F.max("_few").alias("_few"),
        )
        # The rows of a broadcast key are those of one part.
        .withColumn("_here", F.when(F.col("_few").isNull(), F.col("_load")).otherwise(0))
        .select(
            *keys,
            "_slot",
            F.explode(_cut(F.col("items"), F.col("_here"), max_items)).alias("_p"),
            F.coalesce("_few", F.when(F.col("_load") > max_items, F.col("_load"))).alias("_load"),
        )
        .select(*keys, (F.col("_slot") + F.col("_p.part")).alias("part"), "_p.items", "_load")
    )


def _load_of(weight: Column | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def gathered_parts(
    rows: DataFrame,
    keys: list[str],
    by: list[str],
    max_items: int = MAX_ITEMS,
    max_keys: int = MAX_HOT_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """``keys, part, items, _load``: sorted lists of the column ``_item``; ``_load`` is null for keys
    of ``max_items`` and fewer. Rows are shuffled once, by ``by``, which are some of the ``keys``.
    The second table has further parts of broadcast keys, the first is left in the order of ``by``.

    Every key with more than ``max_items`` items gets parts, also the null key; the hash makes
    the part a function of the row, so a recomputed task places it alike. Of the keys with parts,
    ``max_keys`` at most hold over 1/``max_keys`` of all items each: these are broadcast, and only
    their first parts go where the other rows go. All others fit in a row, which is cut into parts
    after the shuffle.
    """
    load = _load_of(None)
    placed = _placed(rows, keys, load, max_items, max_keys)
    lists = _gathered(placed.where(F.col("_slot") == 0), keys, by, load, max_items)
    rest = _gathered(
        placed.where(F.col("_slot") > 0), keys, [*keys, "_slot"], load, max_items
    )
    return lists, rest


def _with_totals(
    rows: DataFrame,
    keys: list[str],
    weight: Column | None,
    items: Column,
    out: str,
    max_items: int,
    max_keys: int,
    first_only: bool,
) -> DataFrame:
    """One row per key and part; ``total`` is the number of items in all parts of the key.

    All parts come out of one shuffle and one broadcast; ``first_only`` leaves the further ones and
    the ``part`` column out.
    """
    load = _load_of(weight)
    placed = _placed(rows, keys, load, max_items, max_keys)
    if first_only:
        placed = placed.where(F.col("_slot") == 0)
    lists = _gathered(placed, keys, [*keys, "_slot"], load, max_items)
    by = keys if first_only else [*keys, "part"]
    wanted = lists.where(F.col("part") == 0) if first_only else lists
    made = wanted.select(*by, items.alias(out), "_load")
    total = F.coalesce(F.col("_load"), F.size(out).cast("bigint"))
    return made.select(*by, total.alias("total"), out)


def list_parts(
    df: DataFrame,
    keys: list[str],
    item: Column,
    out: str,
    max_items: int = MAX_ITEMS,
    max_keys: int = MAX_HOT_KEYS,
    first_only: bool = False,
) -> DataFrame:
    """``keys, part, total, out``: sorted lists of the items of each key. One shuffle of the rows.

    For items that are (nearly) unique within their key: see ``set_parts`` and
    ``multiset_parts`` for others.
    """
    rows = df.select(*keys, item.alias("_item"))
    return _with_totals(
        rows, keys, None, F.col("items"), out, max_items, max_keys, first_only
    )


def set_parts(
    df: DataFrame,
    keys: list[str],
    item: Column,
    out: str,
    max_items: int = MAX_ITEMS,
    max_keys: int = MAX_HOT_KEYS,
    first_only: bool = False,
) -> DataFrame:
    """``list_parts`` of the distinct non-null items; copies go before the first shuffle."""
    rows = df.select(*keys, item.alias("_member")).where(F.col("_member").isNotNull()).distinct()
    return list_parts(rows, keys, F.col("_member"), out, max_items, max_keys, first_only)


def multiset_parts(
    df: DataFrame,
    keys: list[str],
    item: Column,
    out: str,
    max_items: int = MAX_ITEMS,
    max_keys: int = MAX_HOT_KEYS,
    first_only: bool = False,
) -> DataFrame:
    """``list_parts`` that keeps copies, even if one item makes up most of the rows.

    Copies are counted before the first shuffle and travel as a count. The copies of an item are
    cut into runs, a fiftieth of a list at most, that are placed one by one.
    """
    run_length = max(1, max_items // 50)
    counted = df.groupBy(*keys, item.alias("_item")).agg(F.count(F.lit(1)).alias("_n"))
    last_run = F.floor((F.col("_n") - 1) / F.lit(run_length)).cast("bigint")
    left = F.col("_n") - F.col("_run") * F.lit(run_length)
    # Runs are numbered in two steps, so that no array grows with the copies of one item.
    first = F.sequence(F.lit(0).cast("bigint"), last_run, F.lit(RUNS_AT_ONCE).cast("bigint"))
    upto = F.least(last_run, F.col("_first") + (RUNS_AT_ONCE - 1))
    runs = (
        counted.select("*", F.explode(first).alias("_first"))
        .select("*", F.explode(F.sequence("_first", upto)).alias("_run"))
        .withColumn("_n", F.least(F.lit(run_length), left).cast("int"))
    )
    entry = F.struct("_item", "_run", "_n")
    copies = F.flatten(F.transform("items", lambda e: F.array_repeat(e["_item"], e["_n"])))
    rows = runs.select(*keys, entry.alias("_item"))
    return _with_totals(
        rows, keys, F.col("_item._n"), copies, out, max_items, max_keys, first_only
    )


def first_n(
    members: DataFrame, keys: list[str], item: str, out: str, count_out: str, n: int
) -> DataFrame:
    """``keys, count_out, out``: how many members a key has and its first ``n`` in order.

    ``members`` holds each member of a key once. Each task passes on ``n`` rows per key at most
    (Spark limits the ranked group before the shuffle), and counting is pre-aggregated.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(item))
    shown = (
        members.withColumn("_rank", rank)
        .where(F.col("_rank") <= n)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(item)).alias(out))
    )
    counts = members.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_out))
    return counts.join(shown, keys, "inner")


def fields_in_parts(
    items: dict[str, DataFrame],
    key: str,
    max_items: int = MAX_ITEMS,
    max_keys: int = MAX_HOT_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """``key, field, part, items, _load``: several lists, each of ``key`` and one other column, in
    one table and the further parts of very long ones in another. One shuffle, by ``key``, builds
    the lists of all fields."""
    rows = [
        df.select(key, F.lit(field).alias("field"), F.col(_other(df, key)).alias("_item"))
        for field, df in items.items()
    ]
    together = reduce(DataFrame.unionByName, rows)
    return gathered_parts(together, [key, "field"], [key], max_items, max_keys)


def _other(df: DataFrame, key: str) -> str:
    (column,) = [c for c in df.columns if c != key]
    return column


def first_fields(parts: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key``, the first part of every field's list, and ``more``: whether any has further parts.

    ``parts`` is the first table of ``fields_in_parts``; in buckets of ``key`` it is not shuffled. A field without
    items is null.
    """
    lists = (
        parts.where(F.col("part") == 0)
        .groupBy(key)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("field", "items"))).alias("_lists"),
            F.max(F.coalesce(F.col("_load") > F.size("items"), F.lit(False))).alias("more"),
        )
    )
    return lists.select(
        key, *[F.try_element_at("_lists", F.lit(f)).alias(f) for f in fields], "more"
    )


def further_fields(parts: DataFrame, key: str) -> DataFrame:
    """``key, field, part, items`` of the parts that follow the first."""
    return parts.where(F.col("part") > 0).select(key, "field", "part", "items")
