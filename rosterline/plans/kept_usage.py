"""Address usage that is kept up to date by snapshots, in whatever order these come.

The state is the set of providers of each address and use, in a form that sets can be merged in: a
provider number is a bucket of 32,768 numbers and a place in it (Spark's bitmap functions), and an
address has a row for each bucket that it has numbers in. Up to ``FEW`` places of a bucket are a
list, more are a bitmap of 4 kB. So the few providers of most addresses cost a few bytes each, an
address with a third of all providers is many rows of 4 kB and no group of unbounded size, and a
snapshot that says what is known leaves the state as long as it was.

Counts are exact. An npi that is no plain number is a row of its own; a null one keeps its address
in the table and is not counted, as in ``address_usage``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.fixed import SNAPSHOT_DATE
from rosterline.operators.addresses import address_uses
from rosterline.plans.kept_histories import held_dates, held_table, write_version
from rosterline.session import staged

#: Places of a bucket that are kept as a list.
FEW = 256

KEYS = ["address_key", "use", "bucket", "other"]
TABLE = "uses"


def _numbered(uses: DataFrame) -> DataFrame:
    """``uses`` by bucket and place; eighteen digits fit into a long."""
    plain = F.col("npi").rlike("^[1-9][0-9]{0,17}$")
    number = F.when(plain, F.col("npi")).cast("bigint")
    return uses.select(
        "address_key",
        "use",
        F.bitmap_bucket_number(number).alias("bucket"),
        F.when(~plain, F.col("npi")).alias("other"),
        F.bitmap_bit_position(number).cast("int").alias("place"),
        F.lit(None).cast("binary").alias("bits"),
    )


def with_uses(held: DataFrame | None, uses: DataFrame, few: int = FEW) -> DataFrame:
    """The state after ``uses`` (npi, use, address_key): one shuffle of the state and the new rows,
    and a second one of the buckets that are bitmaps or become one."""
    rows = _numbered(uses)
    if held is not None:
        rows = rows.unionByName(held.select(*KEYS, F.explode_outer("places").alias("place"), "bits"))
    # A bucket has 32,768 places, so the set is bounded.
    gathered = staged(
        rows.groupBy(*KEYS).agg(F.collect_set("place").alias("places"), F.max("bits").alias("bits")),
        "uses",
    )
    short = F.col("bits").isNull() & (F.size("places") <= few)
    long = gathered.where(~short)
    added = long.select(*KEYS, F.explode("places").alias("place"))
    bitmaps = (
        added.groupBy(*KEYS)
        .agg(F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("bits"))
        .unionByName(long.where(F.col("bits").isNotNull()).select(*KEYS, "bits"))
        .groupBy(*KEYS)
        .agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    nothing = F.lit(None).cast("array<int>").alias("places")
    return gathered.where(short).unionByName(bitmaps.select(*KEYS, nothing, "bits"))


def usage_of(state: DataFrame) -> DataFrame:
    """``address_usage`` of all that is in the state."""
    held = F.coalesce(F.bitmap_count("bits"), F.size("places").cast("bigint"))
    providers = held + F.col("other").isNotNull().cast("bigint")
    counts = [
        F.sum(F.when(F.col("use") == use, providers)).alias(f"npi_{use}_cnt")
        for use in ("b1", "b2", "m1")
    ]
    return state.groupBy("address_key").agg(*counts)


def update_usage(
    spark: SparkSession, path: str, npidata: DataFrame, pl: DataFrame, few: int = FEW
) -> list[dt.date]:
    """Take the snapshots in both tables into the state at ``path``; the dates that were new.

    The main file and the secondary locations of a date come in one call: a date that the state
    has is left out.
    """
    known = held_dates(spark, path)
    # As many dates as there are snapshots in the call.
    dates = npidata.select(SNAPSHOT_DATE).unionByName(pl.select(SNAPSHOT_DATE)).distinct().collect()
    new = sorted({row[0] for row in dates} - {None} - known)
    if new:
        fresh = F.col(SNAPSHOT_DATE).isin(new)
        uses = address_uses(npidata.where(fresh), pl.where(fresh))
        state = with_uses(held_table(spark, path, TABLE), uses, few)
        write_version(spark, path, TABLE, state, known | set(new))
    return new


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    held = held_table(spark, path, TABLE)
    if held is None:
        raise FileNotFoundError(f"no snapshot has been taken into {path}")
    return usage_of(held)
