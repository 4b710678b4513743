"""The stored word index: the same answers as without it, from few files."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rosterline.operators.lookup import search_text, word_index
from rosterline.operators.word_store import (
    document_frequency,
    postings_of,
    read_word_store,
    search_store,
    word_counts,
    write_word_store,
)


@pytest.fixture(scope="module")
def documents(spark):
    """1,000 documents of which all hold one word, and two rows for some keys."""
    n = F.col("id")
    return spark.range(0, 1_000, 1, 4).select(
        F.lpad((n % 900).cast("string"), 4, "0").alias("npi"),
        F.concat_ws(
            " ", F.lit("Common"), F.concat(F.lit("w"), n % 97), F.concat(F.lit("x"), n % 13), F.lit("common")
        ).alias("text"),
    )


@pytest.fixture(scope="module")
def store(spark, documents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("words"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        write_word_store(documents, "npi", ["text"], path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return read_word_store(spark, path)


def test_words_are_counted_inside_the_row(spark, rows):
    docs = spark.createDataFrame([("a", "b a b, B c", "a"), ("b", "", None), ("c", None, None)], "k string, t string, u string")
    assert rows(word_counts(docs, "k", ["t", "u"]), "k", "word", "hits") == [
        ("a", "a", 2), ("a", "b", 3), ("a", "c", 1)
    ]


def test_postings_are_the_word_index(documents, store, rows):
    columns = ("word", "npi", "hits")
    assert rows(store.postings, *columns) == rows(word_index(documents, "npi", ["text"]), *columns)


def test_search_is_the_search_of_the_texts(documents, store):
    wanted = ["W5", "common", "x3", "absent"]
    got = search_store(store, wanted, "npi", 50).collect()
    assert got == search_text(documents, wanted, "npi", ["text"], 50).collect()
    assert search_store(store, ["absent"], "npi").collect() == []
    assert search_store(store, [], "npi").collect() == []


def files_read(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if "FileScan" in node.nodeName() or node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numFiles").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan)
    return sum(found)


def test_a_search_opens_only_its_words_files(store):
    ranges = store.ranges.collect()
    assert len(ranges) > 4
    assert files_read(postings_of(store, ["w50"])) <= 2
    assert files_read(postings_of(store, ["zzz"])) == 0
    whole = sum(row["postings"] for row in ranges)
    assert whole == store.postings.count()


def test_a_word_of_all_documents_goes_over_several_ranges(store, rows):
    held = store.postings.where("word = 'common'").select("range").distinct().count()
    assert held > 1
    assert rows(document_frequency(store, ["COMMON", "absent"])) == [("common", 900, 2000)]


def test_one_shuffle(spark, documents):
    counted = word_counts(documents, "npi", ["text"]).repartitionByRange("word", "npi")
    plan = counted.groupBy("word", "npi").agg(F.sum("hits"))._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert len(re.findall(r"\bExchange\b", physical)) == 1
