"""Texts with line breaks are written and read by several tasks."""

from __future__ import annotations

from checks import source_queries
from checks.registry import QUERIES


def test_texts_with_line_breaks_are_not_one_task(spark, tmp_path, monkeypatch):
    rows = [(i, f'line {i}\n"two", three', "en" if i % 2 else None) for i in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    documents.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    seen, write = [], source_queries._csv_folder
    monkeypatch.setattr(
        source_queries, "_csv_folder",
        lambda df, *rest: (seen.append(df.rdd.getNumPartitions()), write(df, *rest))[1],
    )
    made = QUERIES["ingest_line_breaks"](spark, str(tmp_path))
    assert sorted(int(r.npi) for r in made.collect()) == list(range(40))
    assert seen[0] > 1
