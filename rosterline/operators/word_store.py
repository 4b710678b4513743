"""A stored word index: postings in ranges of words, so that a search opens only its words' files.

Postings (``word, key, hits``) are ranged by word and key, one folder for each range; a word with
very many documents goes over several ranges. ``ranges`` has the first and last word of each, and
``words`` in how many documents each word is.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.functions.text import words
from rosterline.operators.lookup import search_words
from rosterline.session import staged


@dataclass(frozen=True)
class WordStore:
    """The tables of a written index."""

    postings: DataFrame
    ranges: DataFrame
    words: DataFrame


def word_counts(documents: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """``word, key, hits`` of each row: words are counted inside the row, before any shuffle.

    Rows without words go after the explode: a filter on words would split every text again.
    """
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in texts])
    sorted_words = documents.select(key, F.sort_array(words(text)).alias("_words"))
    last = F.size("_words") - 1
    firsts = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == 0) | (F.get("_words", i) != F.get("_words", i - 1)),
    )
    some = F.when(F.size("_words") > 0, firsts)
    numbered = sorted_words.select(key, "_words", some.alias("_firsts"))
    ends = F.concat(F.slice("_firsts", F.lit(2), F.size("_firsts")), F.array(F.size("_words")))
    entries = F.zip_with(
        "_firsts",
        ends,
        lambda a, b: F.struct(F.get("_words", a).alias("word"), (b - a).cast("bigint").alias("hits")),
    )
    exploded = numbered.select(key, F.explode_outer(entries).alias("_e"))
    return exploded.where(F.col("_e").isNotNull()).select("_e.word", key, "_e.hits")


def write_word_store(documents: DataFrame, key: str, texts: list[str], path: str) -> None:
    """Write the index of ``documents``, in which a key may have several rows. One shuffle.

    Equal words of a key meet in the range that they are written to, so they are added up there.
    Counts are stored first: the passes that look for the ranges' ends then read no text. Ranges and
    words are made of the words of each range, for which the postings are read once.
    """
    counts = staged(word_counts(documents, key, texts), "word-counts")
    ranged = counts.repartitionByRange("word", key)
    postings = ranged.groupBy("word", key).agg(F.sum("hits").alias("hits"))
    (
        postings.withColumn("range", F.spark_partition_id())
        .sortWithinPartitions("range", "word", key)
        .write.mode("overwrite")
        .partitionBy("range")
        .parquet(f"{path}/postings")
    )
    spark = documents.sparkSession
    held = spark.read.parquet(f"{path}/postings")
    by_range = staged(
        held.groupBy("range", "word").agg(
            F.count("*").alias("documents"), F.sum("hits").alias("hits")
        ),
        "range-words",
    )
    by_range.groupBy("range").agg(
        F.min("word").alias("first"),
        F.max("word").alias("last"),
        F.sum("documents").alias("postings"),
    ).write.mode("overwrite").parquet(f"{path}/ranges")
    counted = by_range.groupBy("word").agg(
        F.sum("documents").alias("documents"), F.sum("hits").alias("hits")
    )
    counted.repartitionByRange("word").sortWithinPartitions("word").write.mode(
        "overwrite"
    ).parquet(f"{path}/words")


def read_word_store(spark: SparkSession, path: str) -> WordStore:
    return WordStore(*[spark.read.parquet(f"{path}/{x}") for x in ("postings", "ranges", "words")])


def postings_of(store: WordStore, wanted: Iterable[str]) -> DataFrame:
    """The postings of some words: other ranges' folders are not opened.

    Only the numbers of the ranges that hold one of the words come to the driver.
    """
    asked = sorted({w.lower() for w in wanted})
    holds: Column = reduce(
        Column.__or__, [F.lit(w).between(F.col("first"), F.col("last")) for w in asked], F.lit(False)
    )
    numbers = [row["range"] for row in store.ranges.where(holds).select("range").collect()]
    return store.postings.where(F.col("range").isin(numbers) & F.col("word").isin(asked))


def search_store(store: WordStore, wanted: Iterable[str], key: str, n: int = 20) -> DataFrame:
    """``search_words`` on a stored index."""
    asked = list(wanted)
    return search_words(postings_of(store, asked), asked, key, n)


def document_frequency(store: WordStore, wanted: Iterable[str]) -> DataFrame:
    """``word, documents, hits`` of some words; a word that no document has is left out."""
    return store.words.where(F.col("word").isin(sorted({w.lower() for w in wanted})))
