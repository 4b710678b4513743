"""Kept histories do not write all intervals again with every snapshot, and lose none for it."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from rosterline.plans import kept_histories as kept
from rosterline.plans.histories import ENDPOINTS, endpoint_se

SCHEMA = "npi string, endpoint_type string, endpoint string, _input_file_date date"
DAY = dt.date(2024, 1, 1)


def test_state_grows_by_the_snapshot_alone(spark, rows, tmp_path):
    days = [40 * i % 600 for i in range(9)]
    made = [
        spark.createDataFrame(
            [(n, "T", e, DAY + dt.timedelta(d)) for n in (None, "1", "2") for e in ("x", f"y{d % 3}")], SCHEMA
        )
        for d in days
    ]
    sizes, so_far = [], None
    for seen in made:
        kept.update_history(spark, str(tmp_path), ENDPOINTS, seen)
        newest = kept.versions(spark, str(tmp_path))[-1]
        sizes.append(sum(
            spark.read.parquet(str(p)).count()
            for p in Path(tmp_path).iterdir()
            if p.name in (f"merged={newest}", f"added={newest}")
        ))
        so_far = seen if so_far is None else so_far.unionByName(seen)
        got = rows(kept.read_history(spark, str(tmp_path), ENDPOINTS))
        assert got == rows(endpoint_se(so_far))
    assert [n for n in sizes if n != 6] == [sizes[kept.UNMERGED]]
    assert not list(Path(tmp_path).glob("added=0"))  # merged, and of no version that stays


def test_intervals_inside_a_version_are_taken_over(spark, rows, tmp_path):
    path = str(tmp_path)
    first = spark.createDataFrame([("1", "T", "x", DAY)], SCHEMA)
    kept.with_snapshots(None, ENDPOINTS, first).write.parquet(f"{path}/version=0/intervals")
    first.select("_input_file_date").write.parquet(f"{path}/version=0/dates")
    assert rows(kept.read_history(spark, path, ENDPOINTS)) == rows(endpoint_se(first))
    so_far = first
    for days in (20, 200):
        seen = spark.createDataFrame([("1", "T", "x", DAY + dt.timedelta(days))], SCHEMA)
        kept.update_history(spark, path, ENDPOINTS, seen)
        so_far = so_far.unionByName(seen)
        assert rows(kept.read_history(spark, path, ENDPOINTS)) == rows(endpoint_se(so_far))
