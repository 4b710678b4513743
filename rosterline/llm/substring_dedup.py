"""Removal of word passages that repeat across documents.

A passage is a window of 50 words; a word goes if it stands in a window that also starts in a
document with a smaller id. Fixed-block anchors find the places: every document is cut into
non-overlapping blocks of half a window, which are the index, and every rolling window of the
same size probes it. Two documents that share a window share a block of either at least. Hits are
then extended: all windows around them are compared, and windows that lie on one another become
maximal spans.

Probes are packed. A task groups the hashes of its documents first: of a hash that several of
them hold, it settles their matches itself and sends one occurrence on, so that a passage in a
third of all documents sends one row per task. What is left is dealt by hash into buckets of a
bounded number of rows. Anchors are matched by 39 bits besides the bucket, which may give hits too
many, never too few; windows by 128 bits.

Defined cases: a null text has no words; words are cut at ASCII blanks; a null id is smaller than
all others; texts that are equal are settled beforehand, all words of the copies with greater ids
go if they fill a window; rows of equal id do not remove words of each other; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.llm.common import Field, Stored, input_bytes, map_texts, text_of
from rosterline.llm.windows import Words

WINDOW = 50

#: UTF-8 bytes of the texts whose hashes a task groups at once, and of a bucket's texts.
CHUNK_BYTES = 16 * 1024 * 1024

LEAST_BUCKETS = 48


def joined_words(text: str) -> bytes:
    return b" ".join(text.encode().split())


class Rows:
    """Hashed windows: two hashes, document (number in ``nodes``), place, and a flag."""

    def __init__(self, nodes, keys, doc, place, first, second, flag):
        self.nodes, self.keys = nodes, keys
        self.doc, self.place = doc, place
        self.first, self.second, self.flag = first, second, flag

    def take(self, at: np.ndarray) -> Rows:
        return Rows(
            self.nodes, self.keys, self.doc[at], self.place[at],
            self.first[at], self.second[at], self.flag[at],
        )

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The order by hash, where groups of equal hashes begin in it, and their sizes."""
        order = np.lexsort((self.doc, self.second, self.first))
        one, two = self.first[order], self.second[order]
        new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[: len(order)]
        starts = np.flatnonzero(new)
        return order, starts, np.diff(np.append(starts, len(order)))


def _split(rows: Rows, anchors: bool, final: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows that match another document's, and those that have to go on to a bucket.

    Anchors match if two documents hold the hash (and, finally, one of them as a block of the
    index); windows if a smaller key holds it.
    """
    n = len(rows.doc)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    order, starts, sizes = rows.groups()
    matched, onward = np.zeros(n, bool), np.zeros(n, bool)
    key = rows.keys[rows.doc[order]]
    least = np.repeat(np.minimum.reduceat(key, starts), sizes)
    if anchors:
        node = rows.nodes[rows.doc[order]]
        several = np.minimum.reduceat(node, starts) != np.maximum.reduceat(node, starts)
        flags = np.maximum.reduceat(rows.flag[order], starts)
        hit = several & (flags > 0) if final else several
        matched[order] = np.repeat(hit, sizes)
        # One row stands for a group of several documents, with the flag of all of them.
        onward[order] = ~np.repeat(several, sizes)
        lead = order[starts[several]]
        onward[lead] = True
        rows.flag[lead] = flags[several]
    else:
        matched[order] = key > least
        onward[order] = key == least
    return matched, onward


_PACKED = pa.schema(
    [("bucket", pa.int32())]
    + [(name, pa.binary()) for name in ("nodes", "keys", "counts", "places", "first", "second")]
)
_HITS = pa.schema([("node", pa.int64()), ("places", pa.list_(pa.int32()))])


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Numbers as planes of bytes: the planes that are mostly zero compress to nothing."""
    shown = np.ascontiguousarray(values.astype(kind))
    return shown.view(np.uint8).reshape(len(shown), -1).T.tobytes()


def _unplaned(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack(rows: Rows, bucket: int, anchors: bool) -> list:
    """A row for ``bucket``; ``rows`` are in the order of document and place."""
    new = np.append(True, rows.doc[1:] != rows.doc[:-1])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(rows.doc)))
    step = rows.place.copy()
    step[1:] -= np.where(new[1:], 0, rows.place[:-1])
    held = rows.doc[starts]
    if anchors:  # 39 bits of the hash and the flag
        short = (rows.first >> np.uint64(24)) & ~np.uint64(1) | rows.flag.astype(np.uint64)
        first = short.view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()
        second = b""
    else:
        first, second = rows.first.tobytes(), rows.second.tobytes()
    return [
        bucket, rows.nodes[held].tobytes(), b"" if anchors else rows.keys[held].tobytes(),
        _planes(counts, "<u4"), _planes(step, "<u4"), first, second,
    ]


def _unpack(packed: list[dict], anchors: bool) -> Rows:
    parts: list[list[np.ndarray]] = [[] for _ in range(7)]
    held = 0
    for row in packed:
        nodes = np.frombuffer(row["nodes"], np.int64)
        counts = _unplaned(row["counts"], "<u4").astype(np.int64)
        doc = np.repeat(np.arange(len(nodes)), counts)
        step = _unplaned(row["places"], "<u4").astype(np.int64)
        sums = np.cumsum(step)
        starts = np.cumsum(counts) - counts
        place = sums - np.repeat(sums[starts] - step[starts], counts)
        if anchors:
            short = np.zeros((len(step), 8), np.uint8)
            short[:, :5] = np.frombuffer(row["first"], np.uint8).reshape(5, -1).T
            first = short.view(np.uint64).ravel()
            flag = (first & np.uint64(1)).astype(np.uint8)
            first = first & ~np.uint64(1)
            second, keys = np.zeros(len(step), np.uint8), nodes
        else:
            first = np.frombuffer(row["first"], np.uint64)
            second = np.frombuffer(row["second"], np.uint64)
            flag, keys = np.zeros(len(step), np.uint8), np.frombuffer(row["keys"], np.int64)
        for part, values in zip(
            parts,
            (nodes, keys, (doc + held).astype(np.int32), place.astype(np.int32), first, second, flag),
            strict=True,
        ):
            part.append(values)
        held += len(nodes)
    return Rows(*(np.concatenate(part) for part in parts))


def _hits(rows: Rows, matched: np.ndarray) -> pa.RecordBatch:
    """``node`` and ``places`` of the matched rows."""
    at = np.flatnonzero(matched)
    at = at[np.lexsort((rows.place[at], rows.doc[at]))]
    doc = rows.doc[at]
    starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])[: len(doc)])
    places = pa.ListArray.from_arrays(
        np.append(starts, len(doc)).astype(np.int32), rows.place[at].astype(np.int32)
    )
    return pa.RecordBatch.from_arrays([pa.array(rows.nodes[doc[starts]]), places], schema=_HITS)


def _matches(
    docs: DataFrame,
    columns: list[str],
    windows: Callable[[dict], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]],
    anchors: bool,
    buckets: int,
) -> DataFrame:
    """``node`` and ``places`` of the windows that match another document's.

    ``docs`` has ``node``, ``key``, ``text`` and what else ``windows`` needs; ``windows`` makes
    places, hashes and flags out of a row. The result has several rows for a document.
    """
    out = "bucket int, nodes binary, keys binary, counts binary, places binary, " + (
        "first binary, second binary, node bigint, found array<int>"
    )

    def settle(held: list[dict]) -> Iterator[pa.RecordBatch]:
        made = [windows(row) for row in held]
        sizes = [len(m[0]) for m in made]
        if not sum(sizes):
            return
        rows = Rows(
            np.array([row["node"] for row in held], np.int64),
            np.array([row["key"] for row in held], np.int64),
            np.repeat(np.arange(len(held), dtype=np.int32), sizes),
            *(np.concatenate(x) for x in zip(*made, strict=True)),
        )
        matched, onward = _split(rows, anchors, final=False)
        hits = _hits(rows, matched)
        # Settled hits ride along to a bucket of their document, spread like the others.
        yield _whole([[int(n) % buckets] for n in hits.column(0).to_pylist()], hits)
        rows = rows.take(np.flatnonzero(onward))
        bucket = (rows.first % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)[: len(order)])
        packed = [
            _pack(rows.take(order[a:b]), int(bucket[order[a]]), anchors)
            for a, b in zip(edges, np.append(edges[1:], len(order)), strict=True)
        ]
        yield _whole(packed, None)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for row in batch.slice(at, 500).to_pylist():
                    row["words"] = joined_words(row.pop("text"))
                    size += len(row["words"])
                    held.append(row)
                    if size >= CHUNK_BYTES:
                        yield from settle(held)
                        held, size = [], 0
        yield from settle(held)

    def resolve(table: pa.Table) -> pa.Table:
        packed = table.filter(pc.is_valid(table.column("first")))
        ready = table.filter(pc.is_valid(table.column("node")))
        done = pa.table(
            [ready.column("node"), ready.column("found")], schema=_HITS
        )
        if not packed.num_rows:
            return done
        rows = _unpack(packed.select(_PACKED.names).to_pylist(), anchors)
        matched, _ = _split(rows, anchors, final=True)
        return pa.concat_tables([done, pa.Table.from_batches([_hits(rows, matched)])])

    packed = docs.select("node", "key", "text", *columns).mapInArrow(probe, out)
    return packed.groupBy("bucket").applyInArrow(resolve, "node bigint, places array<int>")


def _whole(packed: list[list], hits: pa.RecordBatch | None) -> pa.RecordBatch:
    """A batch of packed rows (bucket and six fields), or of hits (bucket only)."""
    n = len(packed)
    if hits is None:
        columns = [
            pa.array([row[i] for row in packed], field.type) for i, field in enumerate(_PACKED)
        ]
        found = [pa.nulls(n, field.type) for field in _HITS]
    else:
        columns = [pa.array([row[0] for row in packed], pa.int32())]
        columns += [pa.nulls(n, pa.binary()) for _ in _PACKED.names[1:]]
        found = hits.columns
    return pa.RecordBatch.from_arrays(columns + list(found), [*_PACKED.names, "node", "found"])


def _anchor_windows(block: int, window: int):
    def windows(row: dict):
        words = Words(row["words"])
        first = words.hashes(block) if len(words) >= window else np.zeros(0, np.uint64)
        place = np.arange(len(first), dtype=np.int32)
        flag = (place % block == 0).astype(np.uint8)
        return place, first, np.zeros(len(first), np.uint8), flag

    return windows


def _full_windows(block: int, window: int):
    def windows(row: dict):
        words = Words(row["words"])
        count = len(words) - window + 1
        near = np.zeros(count + 1, np.int32)
        hits = np.array(row["hits"], np.int64)
        np.add.at(near, np.clip(hits - (window - block), 0, count), 1)
        np.add.at(near, np.clip(hits + 1, 0, count), -1)
        place = np.flatnonzero(np.cumsum(near)[:count] > 0).astype(np.int32)
        return (
            place, words.hashes(window)[place], words.hashes(window, 1)[place],
            np.zeros(len(place), np.uint8),
        )

    return windows


def _gathered(matches: DataFrame, purpose: str) -> Stored:
    """``node`` and all its ``places``, as many as the document has words at most."""
    return Stored(
        matches.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")),
        purpose,
    )


_SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
)
_FIELDS: list[Field] = [
    ("n_words", T.LongType(), pa.int64()),
    ("spans", _SPANS, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ("kept", T.StringType(), pa.string()),
]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``id_col``, ``n_words``, ``n_removed``, ``spans`` and ``kept`` of every document.

    ``spans`` are the removed word ranges (from 0, the end excluded), as long as they can be;
    ``kept`` is the text of the words that stay, with single blanks.
    """
    block = window // 2
    buckets = max(LEAST_BUCKETS, -(-input_bytes(docs, text_col) // CHUNK_BYTES))
    given = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("key"),
        text_of(text_col).alias("text"),
    ).withColumn("mark", F.unhex(F.md5(F.col("text").cast("binary"))))
    equal = Stored(
        given.groupBy("mark")
        .agg(F.min("key").alias("least"), F.max("key").alias("most"))
        .where(F.col("most") > F.col("least"))
        .select(F.col("mark").alias("equal"), "least"),
        "equal",
    )
    told = given.join(equal.side(), F.col("mark") == F.col("equal"), "left").select(
        "id",
        "key",
        "text",
        F.xxhash64("key", "mark").alias("node"),
        F.coalesce(F.col("key") > F.col("least"), F.lit(False)).alias("copy"),
    )
    single = told.where(~F.col("copy"))
    anchors = _gathered(
        _matches(single, [], _anchor_windows(block, window), True, buckets), "anchors"
    )
    hits = anchors.side().select(F.col("node").alias("hit"), F.col("places").alias("hits"))
    around = single.join(hits, F.col("node") == F.col("hit"))
    found = _gathered(
        _matches(around, ["hits"], _full_windows(block, window), False, buckets), "repeats"
    )
    anchors.drop()

    def start():
        def work(texts: list[str], others: dict[str, pa.Array]) -> list:
            counts, spans, kept = [], [], []
            for text, copy, places in zip(
                texts, others["copy"].to_pylist(), others["places"].to_pylist(), strict=True
            ):
                words = text.encode().split()
                starts = range(len(words) - window + 1) if copy else sorted(places or ())
                ranges: list[list[int]] = []
                for place in starts:
                    if ranges and place <= ranges[-1][1]:
                        ranges[-1][1] = place + window
                    else:
                        ranges.append([place, place + window])
                left, at = [], 0
                for a, b in ranges:
                    left += words[at:a]
                    at = b
                counts.append(len(words))
                spans.append([{"start": a, "stop": b} for a, b in ranges])
                kept.append(b" ".join(left + words[at:]).decode())
            return [counts, spans, kept]

        return work

    repeats = found.side().select(F.col("node").alias("repeat"), "places")
    final = told.join(repeats, F.col("node") == F.col("repeat"), "left")
    made = map_texts(final, F.col("text"), ("id", "copy", "places"), _FIELDS, start)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return made.select(
        F.col("id").alias(id_col), "n_words", removed.alias("n_removed"), "spans", "kept"
    )
