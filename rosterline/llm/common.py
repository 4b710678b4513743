"""Helpers that several operators share: stored intermediates, bounded broadcasts, text chunks."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.session import work_folder

#: A side is broadcast up to so many rows and so many stored bytes; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 24 * 1024 * 1024

#: Spark's cleaner of shuffles and broadcasts looks ten times a second for what was collected.
CLEANER_SECONDS = 0.3

#: Texts are worked on in chunks of about so many characters, so that Python's lists stay small.
CHUNK_CHARS = 1_000_000


def _folder(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


class Stored:
    """A DataFrame written to the cluster's shared folder and read back.

    The files cut the lineage, outlive lost executors, and can go once nothing reads them.
    """

    def __init__(self, df: DataFrame, purpose: str, compression: str = "snappy"):
        self.spark = df.sparkSession
        self.path = work_folder(self.spark, purpose)
        df.write.option("compression", compression).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def bytes(self) -> int:
        files, root = _folder(self.spark, self.path)
        return files.getContentSummary(root).getLength()

    def rows(self) -> int:
        return self.df.count()

    def drop(self) -> None:
        files, root = _folder(self.spark, self.path)
        files.delete(root, True)

    def side(self) -> DataFrame:
        """For a join: with a broadcast hint if it is proven to be small, else without."""
        if self.bytes() <= BROADCAST_BYTES and self.rows() <= BROADCAST_ROWS:
            return F.broadcast(self.df)
        return self.df


def shuffles_freed(spark: SparkSession) -> None:
    """Have the executors delete shuffle files whose tables have been stored and that nothing reads.

    Spark deletes them once the driver has collected what described them, which may be long after.
    What the first collection finds is let go by Spark's cleaner before the second finds the rest.
    """
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(CLEANER_SECONDS)
    spark._jvm.System.gc()


def text_of(col: str = "text") -> Column:
    """The text as a string, empty for null."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def input_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts: one narrow scan, one number."""
    return docs.agg(F.sum(F.octet_length(text_of(text_col)))).first()[0] or 0


def chunks(sizes: list[int], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts of ``most`` characters together, one text at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


#: A column that a text operator adds: its name, Spark's type and Arrow's.
Field = tuple[str, T.DataType, pa.DataType]


def map_texts(
    docs: DataFrame,
    text: Column,
    keep: tuple[str, ...],
    fields: list[Field],
    start: Callable[[], Callable[[list[str], dict[str, pa.Array]], list]],
    most: int = CHUNK_CHARS,
) -> DataFrame:
    """``keep`` and new columns that are computed from each row's text, without a shuffle.

    ``start`` runs once in a task and returns the function that turns the texts of a chunk, and
    its other columns, into the values of the new columns. Other columns pass untouched.
    """
    given = docs.select(*keep, text.alias("__text"))
    types = [kind for _, _, kind in fields]
    names = [*keep, *(name for name, _, _ in fields)]
    schema = T.StructType(
        list(given.schema)[:-1] + [T.StructField(name, kind) for name, kind, _ in fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            sizes = pc.binary_length(batch.column(len(keep))).to_pylist()
            for a, b in chunks(sizes, most):
                part = batch.slice(a, b - a)
                others = {name: part.column(i) for i, name in enumerate(keep)}
                made = work(part.column(len(keep)).to_pylist(), others)
                arrays = [
                    x if isinstance(x, pa.Array) else pa.array(x, kind)
                    for x, kind in zip(made, types, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*others.values(), *arrays], names)

    return given.mapInArrow(run, schema)
