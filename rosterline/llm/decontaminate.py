"""Benchmark decontamination by Wu-Manber search over words.

The words of the test strings are cut into windows. Windows of one length share a shift table:
for each block of words it says how far the search may jump until that block can end a window.
Where the jump is zero, the hash of the window's last block selects the windows that can stand
there, and a direct comparison of all words confirms an occurrence. Test strings shorter than a
window are windows of their own, searched with tables of their own length.

The tables of the test strings are broadcast in parts of a bounded size. Each part is one pass over
the documents, whose results are stored before the next, so a larger test set adds passes, not
memory: a task holds the tables of one part. Documents are never shuffled. Rows of equal item id
and text are one test string, so that parts, which are dealt by the hash of both, are even.

Defined cases: a null text has no words; a document or test string without words is in no
occurrence; equal test strings are all reported; a null item id is searched for but not listed;
repeated documents get equal results; extra columns are ignored; empty tables give no hits. Item ids
of whole numbers are listed as such, those of any other type as strings.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.llm.common import Field, Stored, map_texts, text_of

WINDOW = 13

#: Words of a block of the shift table, fewer for windows that are shorter.
BLOCK = 3

#: UTF-8 bytes of test strings in one broadcast part.
PART_BYTES = 4 * 1024 * 1024

#: A document is contaminated if one word in so many, or more, stands in an occurrence.
ONE_IN = 20

#: ASCII other than digits and letters separates words, A-Z are lower-cased, the rest stays.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
    else 0x20
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class Tables:
    """Shift table and suffix buckets for windows of one length."""

    def __init__(self, length: int, windows: Iterable[tuple[bytes, ...]]):
        self.length = length
        self.block = min(BLOCK, length)
        self.most = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[bytes, ...]]] = {}
        for window in windows:
            for end in range(self.block, length + 1):
                block, far = window[end - self.block : end], length - end
                if far < self.shift.get(block, self.most):
                    self.shift[block] = far
            self.buckets.setdefault(window[length - self.block :], []).append(window)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """Start and window of every occurrence, from left to right."""
        length, block, most, shift = self.length, self.block, self.most, self.shift
        end, size = length, len(words)
        while end <= size:
            suffix = tuple(words[end - block : end])
            far = shift.get(suffix, most)
            if far:
                end += far
                continue
            found = tuple(words[end - length : end])
            for window in self.buckets[suffix]:
                if window == found:
                    yield end - length, window
            end += 1


class Searcher:
    """All windows of a set of test strings."""

    def __init__(self, items: list[tuple[int | str | None, str | None]], length: int):
        self.items: dict[tuple[bytes, ...], set[int | str]] = {}
        for item, text in items:
            words = words_of(text or "")
            size = min(length, len(words))
            for start in range(len(words) - size + 1 if size else 0):
                holders = self.items.setdefault(tuple(words[start : start + size]), set())
                if item is not None:
                    holders.add(item)
        lengths = {len(w) for w in self.items}
        self.tables = [
            Tables(n, [w for w in self.items if len(w) == n]) for n in sorted(lengths)
        ]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int | str]]:
        """Occurrences as word ranges, and the ids of their items."""
        spans, items = [], set()
        for table in self.tables:
            for start, window in table.find(words):
                spans.append((start, start + table.length))
                items |= self.items[window]
        return spans, items


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges without overlaps, in order; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


_SPANS = "array<struct<start:bigint,stop:bigint>>"
_WORDS = ("n_words", T.LongType(), pa.int64())
_RANGES = (
    "spans",
    T.ArrayType(
        T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    ),
    pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
)


def _fields(ids: T.DataType) -> list[Field]:
    arrow = pa.int64() if isinstance(ids, T.LongType) else pa.string()
    return [_WORDS, _RANGES, ("items", T.ArrayType(ids), pa.list_(arrow))]


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``keep``, ``n_words``, ``n_hit``, ``spans`` and ``items`` of every document.

    ``spans`` are word ranges (numbered from 0, the end excluded) that occurrences cover, without
    overlaps; ``items`` the sorted ids of the test strings that occur; ``n_hit`` counts words.
    """
    spark = docs.sparkSession
    whole = isinstance(benchmark.schema[item_id].dataType, T.IntegralType)
    ids = T.LongType() if whole else T.StringType()
    given = benchmark.select(
        F.col(item_id).cast(ids).alias("item"), F.col(item_text).cast("string").alias("text")
    )
    stored = Stored(given.where(F.col("text").isNotNull()).distinct(), "tests")
    tests = stored.df
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))

    found = docs.select(
        *keep,
        text_of(text_col).alias("__body"),
        F.expr(f"cast(array() AS {_SPANS})").alias("spans"),
        F.array().cast(T.ArrayType(ids)).alias("items"),
    )
    passed: Stored | None = None
    for number in range(parts):
        rows = tests.where(part == number).collect()  # at most about part_bytes
        shared = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in rows])

        def start(shared=shared):
            searcher = Searcher(shared.value, window)

            def work(texts: list[str], others: dict[str, pa.Array]) -> list:
                counts, spans, items = [], [], []
                for text, old_spans, old_items in zip(
                    texts, others["__spans"].to_pylist(), others["__items"].to_pylist(), strict=True
                ):
                    words = words_of(text)
                    new_spans, new_items = searcher.search(words)
                    old = [(s["start"], s["stop"]) for s in old_spans]
                    spans.append([{"start": a, "stop": b} for a, b in merged([*old, *new_spans])])
                    items.append(sorted(new_items.union(old_items)))
                    counts.append(len(words))
                return [counts, spans, items]

            return work

        before = found.withColumnsRenamed({"spans": "__spans", "items": "__items"})
        found = map_texts(
            before, F.col("__body"), (*keep, "__body", "__spans", "__items"), _fields(ids), start
        ).drop("__spans", "__items")
        if number + 1 < parts:
            last, passed = passed, Stored(found.drop("n_words"), "passed", "zstd")
            found = passed.df
            shared.unpersist()
            if last is not None:
                last.drop()
    stored.drop()
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(*keep, "n_words", hit.alias("n_hit"), "spans", "items")


def contaminated(one_in: int = ONE_IN) -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    one_in: int = ONE_IN,
    **options,
) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated.

    A document is contaminated if occurrences cover a word, and one word in ``one_in`` or more.
    """
    columns = docs.columns
    packed = docs.select(F.struct("*").alias("__row"), text_of(text_col).alias("__whole"))
    found = find_windows(packed, benchmark, "__whole", keep=("__row",), **options)
    clean = ~contaminated(one_in)
    return found.where(clean).select(*[F.col("__row").getField(c).alias(c) for c in columns])
