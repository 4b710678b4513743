"""Intervals of a key are joined in one shuffle, whatever overlaps and copies there are."""

from __future__ import annotations

import datetime as dt
import random

from rosterline.operators.history import merge_intervals

DAY = dt.date(2020, 1, 1)


def plain(intervals, gap):
    runs = []
    for s, e in sorted(set(intervals)):
        if runs and s - runs[-1][1] <= gap:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    return [tuple(r) for r in runs]


def test_merged_in_one_shuffle(spark):
    chance = random.Random(5)
    held = {}
    for key in [None, "a", "b", "c", "d"]:
        starts = [chance.randrange(900) for _ in range(chance.choice([1, 2, 20, 60]))]
        held[key] = [(s, s + chance.choice([0, 0, 3, 100])) for s in starts for _ in (1, 2)]
    rows = [
        (k, "v", DAY + dt.timedelta(s), DAY + dt.timedelta(e)) for k, x in held.items() for s, e in x
    ]
    df = spark.createDataFrame(rows, "npi string, v string, s date, e date")
    merged = merge_intervals(df, ["npi", "v"], "s", "e", 45)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan
    got = {}
    for npi, _, s, e in merged.collect():
        got.setdefault(npi, []).append(((s - DAY).days, (e - DAY).days))
    assert {k: sorted(x) for k, x in got.items()} == {k: plain(x, 45) for k, x in held.items()}
