"""Near-duplicate documents by Order MinHash.

A document is the sequence of its k-mers, runs of five lower-cased words, each labelled with how
often the same run stood before it, so that all are different. A sketch takes the k-mers with the
smallest values of a random function and keeps them in the order of the text: two documents share
a sketch if they share those k-mers and their order. Documents with a common sketch are candidates;
the alignment of their k-mers, within the band of diagonals that the asked similarity leaves,
decides. Similarity is the number of aligned k-mers over all k-mers of both, 0.8 or more by
default: the share of common word runs, if they stand in the same order.

Texts with equal words are one candidate, however often they occur. A k-mer that no other
candidate has cannot be aligned, so the number of the others bounds how similar a candidate can
be to any other, and how large that one may be; candidates that can have no partner drop out, and
pairs of other sizes are not made. Candidates with few k-mers of their own, in the middle of a
group of edited copies, are compared first. Groups are the connected documents; see ``groups``
for how large ones are found without all pairs.

Defined cases: a null text is an empty one; texts without a word are compared as they stand, blanks
at the ends aside; fewer words than a k-mer has are one k-mer; groups are named by their smallest
id; a null id names a group only if it has no other; repeated rows are in one group; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.llm.common import Field, Stored, map_texts, text_of
from rosterline.llm.groups import crowded, link_groups
from rosterline.llm.windows import Words, mixed

KMER_WORDS = 5
SIMILARITY = 0.8

#: Sketches of a document, and k-mers in each: at a similarity of 0.8 a pair of long texts has a
#: common sketch with probability 1 - (1 - 0.8 ** 6) ** 24 = 0.9993.
SKETCHES = 24
SAMPLED = 6

#: Documents of so few k-mers get, besides, sketches of ``OF_SHORT`` k-mers: six k-mers that are drawn
#: from few agree less often. Pairs with a longer document are found with probability 0.9989 or more.
#: Three k-mers of one of 4 or more agree with a chance of 0.4 at least, so all but 0.6 ** 24 of the
#: shorter pairs are found; three that stand in one order are few texts' by chance, a single one,
#: such as a common header's, is not.
SHORT = 75
OF_SHORT = 3

_WORD = regex.compile(r"\w+")
_SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def canonical(text: str) -> bytes:
    """The words of a text in lower case, with single blanks; the text itself if it has none."""
    return (" ".join(_WORD.findall(text.lower())) or text.strip()).encode()


def kmers(joined: bytes, size: int = KMER_WORDS) -> np.ndarray:
    """Occurrence-labelled k-mers in text order, as different 64-bit numbers."""
    words = Words(joined)
    plain = words.hashes(min(size, max(1, len(words))))
    order = np.argsort(plain, kind="stable")
    ranked = plain[order]
    new = np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)]
    firsts = np.flatnonzero(new)
    label = np.empty(len(plain), np.uint64)
    label[order] = np.arange(len(plain)) - firsts[np.cumsum(new) - 1] if len(plain) else 0
    return mixed(plain + label * np.uint64(0xD6E8FEB86659FD93))


def _sketch(values: np.ndarray, shown: np.ndarray, seeds: np.ndarray, sampled: int) -> np.ndarray:
    """One number per seed: the sampled k-mers in text order."""
    drawn = mixed(values[None, :] ^ seeds[:, None])
    if drawn.shape[1] > sampled:
        taken = np.sort(np.argpartition(drawn, sampled - 1, axis=1)[:, :sampled], axis=1)
    else:
        taken = np.broadcast_to(np.arange(drawn.shape[1]), drawn.shape)
    out = seeds + np.uint64(sampled)
    for column in range(taken.shape[1]):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + shown[taken[:, column]])
    return out


def sketches(values: np.ndarray) -> np.ndarray:
    """The Order MinHash sketches of labelled k-mers, none for a text without any."""
    if not len(values):
        return np.zeros(0, np.uint64)
    step = max(1, 2_000_000 // len(values))
    found = [
        _sketch(values, values, _SEEDS[a : a + step], SAMPLED) for a in range(0, SKETCHES, step)
    ]
    if len(values) <= SHORT:
        found.append(_sketch(values, values, ~_SEEDS, OF_SHORT))
    return np.concatenate(found)


def similarity(one: np.ndarray, other: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned k-mers over all k-mers of both; exact from ``least`` on, below it perhaps less.

    As labelled k-mers are different, the best alignment is the longest increasing run of the
    places at which the k-mers of one text stand in the other.
    """
    n, m = len(one), len(other)
    if not n or not m or min(n, m) < least * max(n, m):
        return float(n == m == 0)
    order = np.argsort(other)
    at = np.minimum(np.searchsorted(other, one, sorter=order), m - 1)
    places = order[at]
    # An alignment of x k-mers leaves n - x and m - x out; no k-mer moves farther than that.
    need = least * (n + m) / (1 + least)
    band = max(n, m) - need + 1
    near = (other[places] == one) & (np.abs(places - np.arange(n)) <= band)
    tails: list[int] = []
    for place in places[near].tolist():
        spot = bisect_left(tails, place)
        if spot == len(tails):
            tails.append(place)
        else:
            tails[spot] = place
    return len(tails) / (n + m - len(tails))


def _signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``digest`` of the words and ``sketches`` of every document."""

    def start():
        def work(texts: list[str], _) -> list:
            joined = [canonical(text) for text in texts]
            found = [sketches(kmers(words)) for words in joined]
            return [[md5(words).digest() for words in joined], [x.view(np.int64) for x in found]]

        return work

    fields: list[Field] = [
        ("digest", T.BinaryType(), pa.binary()),
        ("sketches", T.ArrayType(T.LongType()), pa.list_(pa.int64())),
    ]
    given = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("body"))
    return map_texts(given, F.col("body"), ("id",), fields, start)


def _bodies(docs: DataFrame, wanted: Stored) -> DataFrame:
    """``node`` (digest) and ``words`` of the wanted (id, digest), each digest once."""

    def start():
        def work(texts: list[str], _) -> list:
            joined = [canonical(text) for text in texts]
            return [[md5(words).digest() for words in joined], joined]

        return work

    fields: list[Field] = [
        ("made", T.BinaryType(), pa.binary()),
        ("words", T.BinaryType(), pa.binary()),
    ]
    side = wanted.side().select(F.col("id").alias("wanted_id"), F.col("digest").alias("node"))
    picked = docs.join(side, F.col("id").eqNullSafe(F.col("wanted_id")))
    made = map_texts(picked, F.col("body"), ("node",), fields, start)
    return made.where(F.col("made") == F.col("node")).select("node", "words")


def _reach(bodies: DataFrame, least: float) -> DataFrame:
    """``node``, ``rank``, ``size``, ``low`` and ``high`` of the candidates that can have a partner.

    With s of its n k-mers in other candidates too, x aligned of n and m are x / (n + m - x) at
    most ``least`` or more only if m <= s * (1 + 1 / least) - n.
    """

    def start():
        def work(texts: list[bytes], _) -> list:
            found = [kmers(words) for words in texts]
            return [[len(x) for x in found], [x.view(np.int64) for x in found]]

        return work

    fields: list[Field] = [
        ("size", T.LongType(), pa.int64()),
        ("kmers", T.ArrayType(T.LongType()), pa.list_(pa.int64())),
    ]
    made = map_texts(bodies, F.col("words"), ("node",), fields, start)
    single = (
        made.select("node", F.explode("kmers").alias("kmer"))
        .groupBy("kmer")
        .agg(F.count("*").alias("n"), F.min("node").alias("node"))
        .where(F.col("n") == 1)
        .groupBy("node")
        .agg(F.count("*").alias("own"))
    )
    known = made.select("node", "size").join(single, "node", "left").select(
        "node", "size", F.coalesce("own", F.lit(0)).alias("own")
    )
    slack = F.lit(1e-6)
    high = F.least(
        F.floor((F.col("size") - F.col("own")) * F.lit(1 + 1 / least) - F.col("size") + slack),
        F.floor(F.col("size") / F.lit(least) + slack),
    )
    ranged = known.select(
        "node",
        (F.col("own") / F.greatest("size", F.lit(1))).alias("rank"),
        "size",
        F.ceil(F.col("size") * F.lit(least) - slack).alias("low"),
        high.alias("high"),
    )
    return ranged.where(F.col("high") >= F.col("low"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = SIMILARITY,
) -> DataFrame:
    """``id_col``, ``digest`` (of the document's words), ``root`` (a digest of its group's, the same
    for all of them) and ``class_id`` (the group's smallest id) of every row."""
    signed = Stored(_signatures(docs, id_col, text_col), "signatures")
    texts = signed.df.groupBy("digest").agg(
        F.min("id").alias("id"), F.first("sketches").alias("sketches")
    )
    drawn = texts.select(
        F.explode("sketches").alias("bucket"), F.col("digest").alias("node"), "id"
    )
    members = Stored(crowded(drawn.distinct()), "candidates")
    wanted = Stored(members.df.select(F.col("node").alias("digest"), "id").distinct(), "wanted")
    given = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("body"))
    bodies = Stored(_bodies(given, wanted).dropDuplicates(["node"]), "bodies")
    reach = Stored(_reach(bodies.df, least), "reach")
    rows = members.df.select("bucket", "node").join(reach.side(), "node")

    def verify(pairs: DataFrame) -> DataFrame:
        one = bodies.df.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
        other = bodies.df.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
        return _aligned(pairs.join(one, "a").join(other, "b"), least)

    roots = link_groups(rows, verify, once=True)
    for table in (members, wanted, bodies, reach):
        table.drop()
    known = signed.df.select("id", "digest")
    if roots is None:
        grouped = known.withColumn("root", F.col("digest"))
    else:
        grouped = known.join(
            roots.select(F.col("node").alias("digest"), "root"), "digest", "left"
        ).withColumn("root", F.coalesce("root", "digest"))
    grouped = Stored(grouped, "grouped").df
    names = grouped.groupBy("root").agg(F.min("id").alias("class_id"))
    names = Stored(names, "classes")
    return grouped.join(names.side(), "root").select(
        F.col("id").alias(id_col), "digest", "root", "class_id"
    )


def _aligned(pairs: DataFrame, least: float) -> DataFrame:
    """Those pairs (a, b) whose words align."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                words = zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)
                linked = [
                    similarity(kmers(one), kmers(other), least) >= least for one, other in words
                ]
                kept = part.filter(pa.array(linked, pa.bool_()))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    given = pairs.select("a", "b", "words_a", "words_b")
    return given.mapInArrow(run, "a binary, b binary")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each group, of the smallest id.

    If an id has several texts, each is in a group of its own right: only rows of one group go for
    one another. Of several rows with the id and the words that stay, the smallest is left.
    """
    found = near_duplicates(docs, id_col, text_col, least).withColumnRenamed(id_col, "__id")
    found = Stored(found.select("__id", "digest", "root"), "found")
    kept = Stored(
        found.df.groupBy("root")
        .agg(F.min(F.struct("__id", "digest")).alias("first"))
        .select("first.__id", F.col("first.digest").alias("__digest")),
        "kept",
    )
    rows = found.df.groupBy("__id").agg(
        F.count("*").alias("__rows"), (F.min("digest") != F.max("digest")).alias("__several")
    )
    repeated = Stored(rows.where(F.col("__rows") > 1).select("__id", "__several"), "repeated")
    same_id = F.col(id_col).eqNullSafe(F.col("__id"))
    if repeated.df.isEmpty():
        return docs.join(kept.side(), same_id, "left_semi").select(*docs.columns)
    single = docs.join(repeated.side(), same_id, "left_anti")
    single = single.join(kept.side(), same_id, "left_semi")
    others = docs.join(repeated.side(), same_id, "left_semi")
    marked = _with_digest(others, text_col).join(
        kept.side(), same_id & (F.col("__made") == F.col("__digest"))
    )
    one = (
        marked.groupBy("__id", "__digest")
        .agg(F.min(F.struct(text_of(text_col).alias("__body"), *docs.columns)).alias("__row"))
        .select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
    )
    return single.select(*docs.columns).unionByName(one)


def _with_digest(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``__made``, the digest of a row's words."""

    def start():
        def work(texts: list[str], _) -> list:
            return [[md5(canonical(text)).digest() for text in texts]]

        return work

    fields: list[Field] = [("__made", T.BinaryType(), pa.binary())]
    return map_texts(docs, text_of(text_col), tuple(docs.columns), fields, start)
