"""Numbered columns of the main file: made in one shuffle, blank slots left out."""

from __future__ import annotations

from checks.frames import wide_main_file
from rosterline.operators.fold import OTHER_IDS, TAXONOMIES, fold_repeated_groups


def test_slots_of_unseen_signs_are_dropped_and_others_kept(spark):
    texts = [" ", " ", "\t x", " y", "é", "", " z", None]
    columns = [f"other_provider_identifier_{i}" for i in range(1, len(texts) + 1)]
    schema = ", ".join(f"{c} string" for c in columns)
    row = fold_repeated_groups(spark.createDataFrame([texts], schema)).first()
    assert [s.identifier for s in row[OTHER_IDS.name]] == ["\t x", " y", "é", " z"]
    assert TAXONOMIES.name not in row.asDict()


def test_wide_rows_take_one_shuffle(spark, tmp_path):
    """Lines that come twice, lines without a number or beyond the seventh, an order without any."""
    lines = [(1, 1, "A", "F"), (1, 1, "N", "O"), (1, 7, "R", "F"), (1, None, "A", "F"), (2, 8, "A", "F")]
    schema = "l_orderkey bigint, l_linenumber int, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    wide = wide_main_file(spark, str(tmp_path))
    prepared = wide._jdf.queryExecution().executedPlan().toString()
    assert prepared.count("Exchange hashpartitioning") == 1
    rows = {r.o_orderkey: r.asDict() for r in wide.collect()}
    assert set(rows) == {1, 2} and len(wide.columns) == 57
    assert rows[1]["healthcare_provider_taxonomy_code_1"] == "20N0O"
    assert rows[1]["healthcare_provider_primary_taxonomy_switch_7"] == "Y"
    assert rows[1]["healthcare_provider_taxonomy_code_2"] is None
    assert all(v is None for k, v in rows[2].items() if k != "o_orderkey")
