"""Co-location takes the rows of all snapshots, not those of the newest one alone."""

from __future__ import annotations

import datetime as dt

from checks.registry import QUERIES

DAYS = [dt.date(1995, 3, 1), dt.date(1996, 3, 1), dt.date(1997, 3, 1)]


def test_lists_hold_all_snapshots(spark, tmp_path):
    tables = {
        "region": ([(1, "AMERICA")], "r_regionkey long, r_name string"),
        "nation": ([(3, "PERU", 1)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": (
            [(c, f"C{c}", "MACHINERY", 3) for c in (1, 2)],
            "c_custkey long, c_name string, c_mktsegment string, c_nationkey long",
        ),
        "orders": (
            [(10 * c + i, c, "F", "2-HIGH", day, 1.0) for c in (1, 2) for i, day in enumerate(DAYS)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, "
            "o_orderdate date, o_totalprice double",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    made = QUERIES["colocation_lists"](spark, str(tmp_path)).collect()
    assert len(made) == 2 * len(DAYS)
    for row in made:
        assert row.npi_cnt_b == row.npi_cnt_m == 2 * len(DAYS)
        assert len(row.npi_lst_b.split(";")) == len(row.npi_lst_m.split(";")) == 2 * len(DAYS)
