"""Packing of token sequences by minimum bin slack.

Every document is its ids and one more id that ends it. It is cut into full windows and one rest;
rests are packed so that windows are filled exactly where lengths allow it. Only lengths matter
for that, so the plan is made on the number of rests of each length, at most one number for each
length up to the window's, whatever the size of the corpus:

* the longest rest that is left opens a window; a subset-sum table in the bits of one integer
  tells which sums the other rests can make, and the multiset that comes closest to the capacity
  is read back from the tables, with the count of each length;
* the same multiset fills as many windows as the counts allow, in one step of the plan;
* what no multiset can fill is filled with the first tokens of another rest, the most numerous
  one; what is left of that goes back to the lengths. So only the last window of all is not full.

Rests of a length are numbered in the tasks that cut them; the numbers become places in the plan
by the counts of the tasks before, so no rows are sorted or gathered for it, and one length may be
that of most documents.

Defined cases: a null text is an empty one and is the ending id alone; repeated rows, and rows of
equal ids, are documents of their own; a null id stays null; extra columns are ignored; an empty
table gives an empty result; a text of any length is encoded as a whole.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from rosterline.llm.bpe import read_ranks
from rosterline.llm.common import Stored, chunks, text_of

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 2048
END_ID = 1

#: Characters that both libraries class alike; texts with others go to the slower one.
_PLAIN = regex.compile(r"[\x00-ɏ]*+")


class Encoder:
    """Ids of texts, as ``tokenizers`` gives them without adding special tokens."""

    def __init__(self, path: str, ranks_path: str, pattern: str):
        self.whole = Tokenizer.from_file(path)
        special = {
            token.content: number
            for number, token in self.whole.get_added_tokens_decoder().items()
        }
        self.special = tuple(special)
        self.fast = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={}
        )

    def ids(self, text: str) -> list[int]:
        if _PLAIN.fullmatch(text) and not any(token in text for token in self.special):
            return self.fast.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def _encoder(path: str, ranks_path: str, pattern: str) -> Encoder:
    return Encoder(path, ranks_path, pattern)


def cut_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """The windows and rests of all documents.

    ``ids`` are unsigned 32-bit numbers, least byte first; ``task`` and ``place`` tell which of
    the pieces of its length a piece is: the ``place``-th of its task.
    """
    path = public_tokenizers.path(vocabulary)
    ranks_path = public_tokenizers.path(vocabulary.replace(".json", ".tiktoken"))
    pattern = public_tokenizers.PATTERN
    given = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    names = ["id", "doc_tokens", "start", "length", "ids", "task", "place"]
    schema = T.StructType(
        [
            T.StructField("id", given.schema["id"].dataType),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("task", T.IntegerType()),
            T.StructField("place", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, ranks_path, pattern)
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_pylist()
            for a, b in chunks(sizes):
                part = batch.slice(a, b - a)
                rows: list[tuple] = []
                for number, text in enumerate(part.column(1).to_pylist()):
                    ids = encoder.ids(text)
                    ids.append(end_id)
                    held = np.array(ids, "<u4").tobytes()
                    for start in range(0, len(ids), window):
                        length = min(window, len(ids) - start)
                        piece = held[4 * start : 4 * (start + length)]
                        rows.append((number, len(ids), start, length, piece, seen[length]))
                        seen[length] += 1
                number, tokens, start, length, pieces, place = zip(*rows, strict=True)
                arrays = [
                    part.column(0).take(pa.array(number, pa.int32())),
                    pa.array(tokens, pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.array(pieces, pa.binary()),
                    pa.array([task] * len(rows), pa.int32()),
                    pa.array(place, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return given.mapInArrow(run, schema)


def closest_sum(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset, as length -> count, of at most ``counts`` whose sum comes closest to
    ``capacity`` without going beyond; of several the one with the longest lengths first found."""
    full = (1 << (capacity + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x in counts if x <= capacity and counts[x] > 0), reverse=True):
        left = min(counts[length], capacity // length)
        taken = 1
        while left:
            taken = min(taken, left)
            steps.append((length, taken, reach))
            reach |= reach << (length * taken) & full
            left -= taken
            taken *= 2
        if reach >> capacity & 1:
            break
    at = reach.bit_length() - 1
    found: dict[int, int] = defaultdict(int)
    for length, taken, before in reversed(steps):
        if not before >> at & 1:
            found[length] += taken
            at -= length * taken
    return dict(found)


#: Of a slot: the length of the pieces that it takes, the first and the last of their numbers, the
#: stretch of each that it holds; the member of the step that the first one is, the members of a
#: window, and the window and offset of the step's first member.
SLOT = (
    "of_length bigint, first bigint, last bigint, cut_from bigint, cut_length bigint, "
    "member bigint, members bigint, window bigint, at bigint"
)


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple]:
    """Slots for all pieces, given how many there are of each length."""
    held: dict[int, deque] = defaultdict(deque)
    left: dict[int, int] = {}
    for length, n in counts.items():
        held[length].append((length, 0, 0, n))
        left[length] = n
    slots: list[tuple] = []
    windows = 0

    def take(length: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(length it was cut to, stretch's start, first number, count) of ``n`` rests."""
        left[length] -= n
        if not left[length]:
            del left[length]
        while n:
            root, start, first, some = held[length].popleft()
            if some > n:
                held[length].appendleft((root, start, first + n, some - n))
                some = n
            yield root, start, first, some
            n -= some

    def fill(length: int, members: int, times: int, at: int, keep: int | None = None) -> None:
        """Put ``members`` rests of a length, or their first ``keep`` tokens, into each window."""
        member = 0
        size = keep or length
        for root, start, first, some in take(length, members * times):
            slots.append(
                (root, first, first + some - 1, start, size, member, members, windows, at)
            )
            member += some
            if keep:
                held[length - keep].append((root, start + keep, first, some))
                left[length - keep] = left.get(length - keep, 0) + some

    while left:
        longest = max(left)
        rest = {**left, longest: left[longest] - 1}
        chosen = closest_sum(rest, window - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[length] // n for length, n in chosen.items())
        slack = window - sum(length * n for length, n in chosen.items())
        spare = {x: left[x] - chosen.get(x, 0) for x in left}
        cut = max((n, x) for x, n in spare.items()) if slack else (0, 0)
        if cut[0]:
            times = min(times, left[cut[1]] // (chosen.get(cut[1], 0) + 1))
        at = 0
        for length, n in sorted(chosen.items(), reverse=True):
            fill(length, n, times, at)
            at += length * n
        if cut[0]:
            fill(cut[1], 1, times, at, slack)
        windows += times
    return slots


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """``id_col``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id`` and ``offset``
    of every piece; see ``cut_windows`` for ``ids``."""
    spark = docs.sparkSession
    cut = cut_windows(docs, id_col, text_col, vocabulary, window, end_id)
    pieces = Stored(cut, "pieces", "zstd")
    counts = Stored(
        pieces.df.groupBy("length", "task").agg((F.max("place") + 1).alias("n")), "counts"
    )
    # One number for each length up to the window's, whatever the input.
    totals = counts.df.groupBy("length").agg(F.sum("n").alias("n")).collect()
    slots = plan({row["length"]: row["n"] for row in totals}, window)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = Stored(
        counts.df.select("length", "task", (F.sum("n").over(before) - F.col("n")).alias("earlier")),
        "earlier",
    )
    counts.drop()
    numbered = pieces.df.join(offsets.side(), ["length", "task"]).withColumn(
        "number", F.col("place") + F.col("earlier")
    )
    # Slots grow with the window, not with the corpus: a step uses up a length.
    placed = numbered.join(
        F.broadcast(spark.createDataFrame(slots, SLOT)),
        (F.col("length") == F.col("of_length")) & F.col("number").between(F.col("first"), F.col("last")),
    )
    member = F.col("member") + F.col("number") - F.col("first")
    return placed.select(
        F.col("id").alias(id_col),
        (F.col("start") + F.col("cut_from")).alias("start"),
        F.col("cut_length").alias("length"),
        F.substring("ids", 4 * F.col("cut_from").cast("int") + 1, 4 * F.col("cut_length").cast("int")).alias("ids"),
        "doc_tokens",
        (F.col("window") + F.floor(member / F.col("members"))).alias("sequence_id"),
        (F.col("at") + member % F.col("members") * F.col("cut_length")).alias("offset"),
    )
