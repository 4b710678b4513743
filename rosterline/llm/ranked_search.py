"""Ranked lexical search by Block-Max MaxScore over an index of documents.

The index is cut into segments of about ``SEGMENT_CHARS`` characters. A segment holds a posting
list for each of its terms: documents, in the order of their ids, and term counts, in blocks of
``BLOCK`` that are packed on their own. A block's impacts are those of its (count, document
length) pairs that no other pair of the block beats in both, so its largest score is known for any
corpus size and average length, and segments can be added without touching others.

A search weighs terms by the whole corpus and goes through every segment that holds one of them:

* lists whose largest scores together cannot beat the lowest of the best results so far are not
  essential; only documents of essential lists are candidates;
* block maxima of the other lists reject candidates before any of those blocks is unpacked, and
  again after each list that has been looked up;
* the best results of segments are merged in two rounds, a few segments at a time first.

A document's score is ``scored`` summed over the query's terms, in whole numbers. Queries are dealt
into blocks of ``QUERY_BLOCK``; a task holds one segment and the lists of one block of queries.

Defined cases: a null text has no terms; documents without a term are not in the index and do not
count; repeated rows are documents of their own, rows with equal query ids are one query; a null id
comes before all others; ties go to the smaller id; a query without terms has no results; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.llm.common import Stored, text_of

#: Characters of the texts that make a segment; a longer text makes one of its own.
SEGMENT_CHARS = 16_000_000

#: Postings in a block.
BLOCK = 128

#: Documents of a segment that are looked at together.
SPAN = 2048

#: Queries that are searched together, about.
QUERY_BLOCK = 256

#: Segments whose results are merged first.
MERGED = 64

#: Bytes of a text whose words are counted at once.
_STRETCH = 1_000_000

#: Bytes that are no part of a term become blanks, A-Z lower case.
_CLEAN = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def terms(text: Column) -> Column:
    """The terms of a text, in order."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def counted(text: str) -> Counter:
    """How often each term stands in a text."""
    clean = text.encode().translate(_CLEAN)
    found: Counter = Counter()
    start = 0
    while start < len(clean):
        end = clean.find(b" ", start + _STRETCH)
        end = len(clean) if end < 0 else end
        found.update(clean[start:end].split())
        start = end
    return found


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in ``data``."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


class _Segment:
    """The documents of a segment while it is filled."""

    def __init__(self):
        self.chars = 0
        self.words: dict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.term, self.count = array("i"), array("q")
        self.sizes, self.lengths, self.ids = [], [], []

    def add(self, id_: pa.Array, text: str) -> None:
        self.chars += len(text)
        found = counted(text)
        if found:
            self.term.extend(map(self.words.__getitem__, found))
            self.count.extend(found.values())
            self.sizes.append(len(found))
            self.lengths.append(found.total())
            self.ids.append(id_)

    def lists(self) -> tuple[list[bytes], np.ndarray, list[pa.Array], pa.Array, np.ndarray]:
        """Terms in order, documents of each, [blocks, impacts, payload], ids and lengths."""
        ids = pa.concat_arrays(self.ids)
        order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        length = np.array(self.lengths, np.int64)[order]
        names = sorted(self.words)
        at = np.empty(len(names), np.int64)
        at[[self.words[x] for x in names]] = np.arange(len(names))
        term = at[np.frombuffer(self.term, np.int32)]
        doc = np.repeat(rank, self.sizes)
        count = np.frombuffer(self.count, np.int64)
        order_p = np.lexsort((doc, term))
        term, doc, count = term[order_p], doc[order_p], count[order_p]
        packed, df = _packed(term, doc, count, length[doc])
        return names, df, packed, ids.take(pa.array(order)), length


def _packed(
    term: np.ndarray, doc: np.ndarray, count: np.ndarray, length: np.ndarray
) -> tuple[list[pa.Array], np.ndarray]:
    """[blocks, impacts, payload] of every list and its number of documents.

    A block is (last document, offset, bytes of a number, pairs in its impacts); its payload has the
    steps from document to document and then the counts.
    """
    new = np.append(True, term[1:] != term[:-1])
    firsts = np.flatnonzero(new)
    df = np.diff(np.append(firsts, len(term)))
    inner = np.arange(len(term)) - np.repeat(firsts, df)
    starts = np.flatnonzero(inner % BLOCK == 0)
    some = np.diff(np.append(starts, len(term)))
    block = np.repeat(np.arange(len(starts)), some)
    step = doc - np.where(new, 0, np.append(0, doc[:-1]))
    most = np.maximum.reduceat(np.maximum(step, count), starts)
    width = 1 + (most > 0xFF) + 2 * (most > 0xFFFF)
    end = np.cumsum(2 * some * width)
    begin = end - 2 * some * width
    data = np.empty(end[-1], np.uint8)
    place = begin[block] + (np.arange(len(term)) - starts[block]) * width[block]
    for values, to in ((step, place), (count, place + (some * width)[block])):
        for byte in range(4):
            held = width[block] > byte
            data[to[held] + byte] = values[held] >> 8 * byte & 0xFF
    # Within a block by length; a pair stays if its count beats all of the shorter documents'.
    order = np.lexsort((-count, length, block))
    key = block << 32 | count[order]
    best = np.maximum.accumulate(key)
    stays = np.append(True, key[1:] > best[:-1])
    pairs = np.add.reduceat(stays.astype(np.int64), starts)
    impacts = np.stack([count[order][stays], length[order][stays]], 1).astype("<i4")
    blocks_of = -(-df // BLOCK)
    first_block = np.cumsum(blocks_of) - blocks_of
    blocks = np.stack(
        [doc[starts + some - 1], begin - np.repeat(begin[first_block], blocks_of), width, pairs], 1
    ).astype("<i4")
    edges = np.append(first_block, len(starts))
    pair_edges = np.append(0, np.cumsum(pairs))[edges]
    data_edges = np.append(begin, end[-1])[edges]
    return [
        _binary(16 * edges, blocks),
        _binary(8 * pair_edges, impacts),
        _binary(data_edges, data),
    ], df


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """Posting lists of all segments, and for each segment a row without term: the ids of its
    documents, their lengths (``payload``) and the sum of those (``words``)."""
    given = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = given.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("term", T.StringType()),
            T.StructField("df", T.LongType()),
            T.StructField("words", T.LongType()),
            T.StructField("blocks", T.BinaryType()),
            T.StructField("impacts", T.BinaryType()),
            T.StructField("payload", T.BinaryType()),
            T.StructField("ids", T.ArrayType(kind)),
        ]
    )

    def rows(number: int, segment: _Segment) -> Iterator[pa.RecordBatch]:
        if not segment.ids:
            return
        names, df, packed, ids, lengths = segment.lists()
        size, many = len(ids), len(names)
        listed = pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), ids)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([None], pa.string()),
                pa.array([size], pa.int64()),
                pa.array([int(lengths.sum())], pa.int64()),
                pa.array([None], pa.binary()),
                pa.array([None], pa.binary()),
                pa.array([lengths.astype("<i8").tobytes()], pa.binary()),
                listed,
            ],
            schema.names,
        )
        step = 20_000
        for a in range(0, many, step):
            some = names[a : a + step]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * len(some), pa.int64()),
                    pa.array(some, pa.binary()).cast(pa.string()),
                    pa.array(df[a : a + step], pa.int64()),
                    pa.nulls(len(some), pa.int64()),
                    *[x.slice(a, len(some)) for x in packed],
                    pa.nulls(len(some), listed.type),
                ],
                schema.names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        segment = _Segment()
        for batch in batches:
            for i in range(batch.num_rows):
                segment.add(batch.column(0).slice(i, 1), batch.column(1)[i].as_py())
                if segment.chars >= segment_chars:
                    yield from rows(number, segment)
                    number, segment = number + 1, _Segment()
        yield from rows(number, segment)

    return given.mapInArrow(run, schema)


def scored(weight, count, measure):
    """What a term of that weight adds to a document that holds it ``count`` times."""
    return weight * ((1_000_000_000 * count) // (1000 * count + 20 * measure))


class Postings:
    """A posting list of a segment; blocks are unpacked when they are first asked for."""

    def __init__(self, row: dict, n: int, total: int, measures: np.ndarray):
        self.weight, self.measures = row["weight"], measures
        blocks = np.frombuffer(row["blocks"], "<i4").reshape(-1, 4).astype(np.int64)
        self.last, self.offset, self.width = blocks[:, 0], blocks[:, 1], blocks[:, 2]
        self.count = np.full(len(blocks), BLOCK)
        self.count[-1] = row["df"] - BLOCK * (len(blocks) - 1)
        self.payload, self.unpacked = row["payload"], {}
        pairs = np.frombuffer(row["impacts"], "<i4").reshape(-1, 2).astype(np.int64)
        ends = np.cumsum(blocks[:, 3])
        highest = scored(self.weight, pairs[:, 0], measure(pairs[:, 1], n, total))
        self.bounds = np.append(np.maximum.reduceat(highest, ends - blocks[:, 3]), 0)
        self.bound = int(self.bounds.max())

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of a block."""
        if i not in self.unpacked:
            some, width = int(self.count[i]), int(self.width[i])
            held = np.frombuffer(self.payload, f"<u{width}", 2 * some, int(self.offset[i]))
            docs = np.cumsum(held[:some], dtype=np.int64) + (self.last[i - 1] if i else 0)
            self.unpacked[i] = docs, scored(
                self.weight, held[some:].astype(np.int64), self.measures[docs]
            )
        return self.unpacked[i]

    def within(self, start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Documents from ``start`` to before ``end`` and their scores, block by block."""
        for i in range(int(np.searchsorted(self.last, start)), len(self.last)):
            docs, scores = self.block(i)
            a, b = np.searchsorted(docs, (start, end))
            if a < b:
                yield docs[a:b], scores[a:b]
            if self.last[i] >= end - 1:
                break

    def of(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Scores of single documents, which lie in those blocks; 0 where the list lacks them."""
        out = np.zeros(len(docs), np.int64)
        edges = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(docs)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a < b:
                held, scores = self.block(int(blocks[a]))
                at = np.minimum(np.searchsorted(held, docs[a:b]), len(held) - 1)
                out[a:b] = np.where(held[at] == docs[a:b], scores[at], 0)
        return out


def measure(length, n: int, total: int):
    """A document's length against the average of all ``n`` documents of ``total`` terms."""
    return 50 + (50 * length * n) // total


def best(
    lists: list[Postings], size: int, k: int, span: int = SPAN
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents of a segment of ``size`` and their scores, best first."""
    lists = sorted(lists, key=lambda x: x.bound)
    bounds = np.cumsum([x.bound for x in lists])
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = 0
    for start in range(0, size, span):
        end = min(start + span, size)
        # Later documents lose ties, so what cannot go beyond ``least`` is out.
        split = int(np.searchsorted(bounds, least, side="right"))
        if split == len(lists):
            break
        sums = np.zeros(end - start, np.int64)
        for held in lists[split:]:
            for found, added in held.within(start, end):
                sums[found - start] += added
        near = np.flatnonzero(sums)
        mine = sums[near]
        near += start
        blocks = [np.searchsorted(held.last, near) for held in lists[:split]]
        above = [held.bounds[at] for held, at in zip(lists, blocks, strict=False)]
        open_ = np.sum(above, axis=0) if above else np.zeros(len(near), np.int64)
        alive = np.flatnonzero(mine + open_ > least)
        for i in range(split - 1, -1, -1):
            if not len(alive):
                break
            open_[alive] -= above[i][alive]
            some = alive[above[i][alive] > 0]
            mine[some] += lists[i].of(near[some], blocks[i][some])
            alive = alive[mine[alive] + open_[alive] > least]
        docs = np.append(docs, near[alive])
        scores = np.append(scores, mine[alive])
        kept = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[kept], scores[kept]
        least = int(scores[-1]) if len(scores) == k else 0
    return docs, scores


def _merged(found: DataFrame, keys: list[Column | str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 50,
    query_id_col: str = "item_id",
    text_col: str = "text",
    span: int = SPAN,
) -> DataFrame:
    """``query_id_col``, ``rank`` (from 1), ``id`` and ``score`` of each query's ``k`` best.

    ``index`` is a stored result of ``build_index``.
    """
    segments = index.where(F.col("term").isNull())
    stats = segments.agg(F.sum("df"), F.sum("words")).first()
    n, total = stats[0] or 0, stats[1] or 1
    wanted = Stored(
        queries.select(
            F.col(query_id_col).alias("query"), F.explode(terms(text_of(text_col))).alias("term")
        ).distinct(),
        "queries",
    )
    n_blocks = max(1, -(-wanted.df.select("query").distinct().count() // QUERY_BLOCK))
    asked = wanted.df.groupBy(
        F.pmod(F.xxhash64("query"), F.lit(n_blocks)).cast("int").alias("block"), "term"
    ).agg(F.collect_list(F.struct("query")).alias("queries"))
    lists = index.where(F.col("term").isNotNull())
    names = Stored(wanted.df.select("term").distinct(), "terms")
    spread = lists.select("term", "df").join(names.side(), "term").groupBy("term").agg(
        F.sum("df").alias("all_df")
    )
    weight = F.floor(1000 * F.log((F.lit(2.0 * n) + 2) / (2 * F.col("all_df") + 1)))
    weighed = Stored(
        asked.join(spread, "term")
        .select("block", "term", "queries", weight.cast("long").alias("weight"))
        .where(F.col("weight") > 0),
        "weights",
    )
    parts = ["segment", "block", "weight", "queries", "df", "blocks", "impacts", "payload", "ids"]
    held = lists.drop("ids").join(weighed.side(), "term").withColumn(
        "ids", F.lit(None).cast(index.schema["ids"].dataType)
    )
    there = segments.withColumns(
        {
            "block": F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))),
            "weight": F.lit(None).cast("long"),
            "queries": F.lit(None).cast(weighed.df.schema["queries"].dataType),
        }
    )
    query_type = wanted.df.schema["query"].dataType
    schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("query", query_type),
            T.StructField("id", index.schema["ids"].dataType.elementType),
            T.StructField("score", T.LongType()),
        ]
    )

    def run(group: pa.Table) -> pa.Table:
        head = group.filter(pc.is_null(group["weight"])).to_pylist()[0]
        rows = group.filter(pc.is_valid(group["weight"])).drop_columns(["ids"]).to_pylist()
        lengths = np.frombuffer(head["payload"], "<i8")
        measures = measure(lengths, n, total)
        by: dict = defaultdict(list)
        for row in rows:
            held = Postings(row, n, total, measures)
            for query in row["queries"]:
                by[query["query"]].append(held)
        names, at, scores = [], [], []
        for query, lists in by.items():
            docs, found = best(lists, len(lengths), k, span)
            names += [query] * len(docs)
            at.append(docs)
            scores.append(found)
        docs = np.concatenate([*at, np.zeros(0, np.int64)])
        kinds = group.schema
        ids = pa.array(head["ids"], kinds.field("ids").type.value_type).take(pa.array(docs))
        asked_type = kinds.field("queries").type.value_type.field(0).type
        return pa.Table.from_arrays(
            [
                pa.array([head["segment"]] * len(docs), pa.int64()),
                pa.array(names, asked_type),
                ids,
                pa.array(np.concatenate([*scores, np.zeros(0, np.int64)]), pa.int64()),
            ],
            schema.names,
        )

    both = held.select(*parts).unionByName(there.select(*parts))
    found = both.groupBy("segment", "block").applyInArrow(run, schema)
    few = _merged(found, ["query", F.pmod(F.xxhash64("segment"), F.lit(MERGED))], k)
    return _merged(few.drop("rank"), ["query"], k).select(
        F.col("query").alias(query_id_col), "rank", "id", "score"
    )
