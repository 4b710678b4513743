"""A word store is made of texts that are read and split once."""

from __future__ import annotations

from pyspark.sql import functions as F

from rosterline.operators.word_store import read_word_store, write_word_store


def test_text_is_read_once_for_a_word_store(spark, tmp_path):
    """The passes that look for the ends of ranges do not split texts again."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    docs = spark.range(500).select(
        F.col("id").cast("string").alias("npi"), F.concat(F.lit("a b w"), F.col("id")).alias("t")
    )
    write_word_store(docs.select("npi", seen("t").alias("t")), "npi", ["t"], str(tmp_path / "w"))
    assert read.value == 500
    store = read_word_store(spark, str(tmp_path / "w"))
    assert store.postings.count() == 1500
    assert store.words.where("word = 'a'").first().documents == 500
    assert sum(r.postings for r in store.ranges.collect()) == 1500
