"""Finding documents again: by key, by category, by words."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.text import words

# Profile columns that can be searched.
SEARCH_FIELDS = ["npi", "name_search", "address_search", "reval_specialty"]


def by_key(documents: DataFrame, value: str, key: str = "npi") -> DataFrame:
    return documents.where(F.col(key) == value)


def by_keys(documents: DataFrame, values: Iterable[str], key: str = "npi") -> DataFrame:
    """The documents of several keys, of which there are as many as a caller asks for at once.

    A literal list, so that row groups are skipped by minima, maxima and Bloom filters; Spark hands
    lists of up to ``spark.sql.parquet.pushdown.inFilterThreshold`` values down one by one.
    """
    return documents.where(F.col(key).isin(sorted(set(values))))


def browse(directory: DataFrame, category: str, initial: str) -> DataFrame:
    """Both columns are partition columns of the written directory, so other files are skipped."""
    return directory.where((F.col("category") == category) & (F.col("initial") == initial))


def word_index(documents: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """``word, key, hits``: how often each word is in the given texts of a document."""
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in texts])
    return (
        documents.select(key, F.explode(words(text)).alias("word"))
        .groupBy("word", key)
        .agg(F.count(F.lit(1)).alias("hits"))
        .select("word", key, "hits")
    )


def search_words(index: DataFrame, wanted: Iterable[str], key: str, n: int = 20) -> DataFrame:
    """Best ``n`` documents: most wanted words matched, then most hits, then key."""
    asked = sorted({w.lower() for w in wanted})
    return (
        index.where(F.col("word").isin(asked))
        .groupBy(key)
        .agg(F.count("word").alias("words_matched"), F.sum("hits").alias("hits"))
        .orderBy(F.desc("words_matched"), F.desc("hits"), F.asc(key))
        .limit(n)
    )


def search_text(
    documents: DataFrame, wanted: Iterable[str], key: str, texts: list[str], n: int = 20
) -> DataFrame:
    """``search_words`` without a stored index: other words are dropped before the shuffle."""
    asked = sorted({w.lower() for w in wanted})
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in texts])
    matched = F.filter(words(text), lambda w: w.isin(asked))
    index = (
        documents.select(key, F.explode(matched).alias("word"))
        .groupBy("word", key)
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    return search_words(index, asked, key, n)
