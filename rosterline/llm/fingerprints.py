"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections.

A paragraph is a line; its leaves are runs of four words of a sentence, so that an edit changes
the leaves of its own sentence and no other. A section is a of paragraphs that ends after a paragraph whose digest is divisible by four: an insertion moves
at most the borders near it. A node's digest covers its children's digests, the root's also
the exact text, so that roots are equal for equal texts and only for them. Two trees are compared
from the top: equal digests end the search, differing branches locate the edits.

The printed fingerprint holds the root and the leaves' short digests and sizes, level by level:
``root:leaf,leaf|leaf;leaf`` with ``|`` between paragraphs and ``;`` between sections. Likeness is
the share of characters that stand in common leaves.

Defined cases: a null text is an empty one, without leaves; empty texts are alike (1), and not
like any other (0); rows of equal id and text follow one another; a null id comes before all
others; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.llm.common import map_texts, text_of

#: Bytes of text in one range of ids that follow one another.
RANGE_BYTES = 16 * 1024 * 1024

#: Words of a leaf.
LEAF_WORDS = 4

_SENTENCE = re.compile(r"(?<=[.!?])\s+")

#: Root; sections of paragraphs of leaves: 24 bits of digest, then the number of characters.
Tree = tuple[str, list[list[list[int]]]]

_SIZE_BITS = 40
_SIZES = (1 << _SIZE_BITS) - 1


def _leaves_of(paragraph: str) -> list[int]:
    leaves = []
    for sentence in _SENTENCE.split(paragraph):
        words = sentence.split()
        for at in range(0, len(words), LEAF_WORDS):
            run = " ".join(words[at : at + LEAF_WORDS])
            leaves.append((crc32(run.encode()) & 0xFFFFFF) << _SIZE_BITS | len(run))
    return leaves


def tree(text: str) -> Tree:
    """Root and leaves of a text."""
    sections, open_section, spine = [], [], []
    for paragraph in text.split("\n"):
        leaves = _leaves_of(paragraph)
        if not leaves:
            continue
        node = blake2b(array("Q", leaves).tobytes(), digest_size=8).digest()
        open_section.append(leaves)
        spine.append(node)
        if node[-1] % 4 == 0:
            sections.append(open_section)
            open_section = []
            spine.append(b";")
    if open_section:
        sections.append(open_section)
    # Blanks are in no leaf, so the root takes in the exact text as well.
    root = blake2b(b"".join(spine), digest_size=16)
    root.update(blake2b(text.encode()).digest())
    return root.hexdigest(), sections


def printed(made: Tree) -> str:
    root, sections = made
    body = ";".join(
        "|".join(
            ",".join([f"{leaf >> _SIZE_BITS:06x}{leaf & _SIZES:x}" for leaf in leaves])
            for leaves in section
        )
        for section in sections
    )
    return f"{root}:{body}"


def parsed(fingerprint: str) -> Tree:
    root, _, body = fingerprint.partition(":")
    sections = [
        [
            [int(leaf[:6], 16) << _SIZE_BITS | int(leaf[6:], 16) for leaf in leaves.split(",")]
            for leaves in section.split("|")
        ]
        for section in body.split(";")
        if body
    ]
    return root, sections


def _leaves(sections: list) -> Counter:
    found: Counter = Counter()
    for section in sections:
        for leaves in section:
            found.update(leaves)
    return found


def likeness(one: Tree, other: Tree) -> float:
    """1 for equal roots, else the share of characters in leaves that both trees have."""
    if one[0] == other[0]:
        return 1.0
    return _shared(_leaves(one[1]), _leaves(other[1]))


def _shared(mine: Counter, yours: Counter) -> float:
    total = sum([(leaf & _SIZES) * n for found in (mine, yours) for leaf, n in found.items()])
    if not total:  # texts of blanks that are not the same
        return 0.0
    both = mine.keys() & yours.keys()
    return 2 * sum([(leaf & _SIZES) * min(mine[leaf], yours[leaf]) for leaf in both]) / total


def edits(one: Tree, other: Tree) -> list[tuple[int, int]]:
    """Section and paragraph numbers of ``one`` that no branch of ``other`` equals."""
    if one[0] == other[0]:
        return []
    sections = {repr(section) for section in other[1]}
    paragraphs = {tuple(leaves) for section in other[1] for leaves in section}
    return [
        (i, j)
        for i, section in enumerate(one[1])
        if repr(section) not in sections
        for j, leaves in enumerate(section)
        if tuple(leaves) not in paragraphs
    ]


def fingerprints(
    docs: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    against: tuple[str, ...] = (),
    locate: bool = True,
) -> DataFrame:
    """``keep``, ``fingerprint`` and, for each text column in ``against``, what compares it:
    ``fingerprint_<name>``, ``likeness_<name>`` and, if asked to ``locate``, ``edited_<name>``,
    the places (section, paragraph) of the text that the other text does not have."""
    others = tuple(f"__other_{name}" for name in against)
    given = docs.select(
        *keep,
        text_of(text_col).alias("__whole"),
        *[text_of(name).alias(other) for name, other in zip(against, others, strict=True)],
    )
    place = pa.struct([("section", pa.int32()), ("paragraph", pa.int32())])
    spark_place = T.StructType(
        [T.StructField(n, T.IntegerType()) for n in ("section", "paragraph")]
    )
    fields = [("fingerprint", T.StringType(), pa.string())]
    for name in against:
        fields += [
            (f"fingerprint_{name}", T.StringType(), pa.string()),
            (f"likeness_{name}", T.DoubleType(), pa.float64()),
        ]
        if locate:
            fields.append((f"edited_{name}", T.ArrayType(spark_place), pa.list_(place)))

    def start():
        def work(texts: list[str], columns: dict[str, pa.Array]) -> list:
            trees = [tree(text) for text in texts]
            held = [_leaves(sections) for _, sections in trees]
            made = [[printed(t) for t in trees]]
            for other in others:
                theirs = [tree(text) for text in columns[other].to_pylist()]
                pairs = list(zip(trees, theirs, strict=True))
                made.append([printed(t) for t in theirs])
                made.append(
                    [
                        1.0 if a[0] == b[0] else _shared(mine, _leaves(b[1]))
                        for (a, b), mine in zip(pairs, held, strict=True)
                    ]
                )
                if locate:
                    made.append(
                        [[{"section": i, "paragraph": j} for i, j in edits(a, b)] for a, b in pairs]
                    )
            return made

        return work

    found = map_texts(given, F.col("__whole"), (*keep, *others), fields, start)
    return found.drop(*others)


def with_next(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``id_col``, ``text`` and ``next_text``, the text that follows by id; after the last, the first.

    ``size`` is the number of UTF-8 bytes of all texts. Ids are cut into ranges at quantiles; a
    range also gets a copy of the rows with the id that opens the next range. Each range is
    sorted where it lies and read as a stream, so texts are shuffled once.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    given = docs.select(
        F.col(id_col).alias("id"), key.alias("key"), text_of(text_col).alias("text")
    )
    ranges = max(1, -(-size // RANGE_BYTES))
    cuts = [i / ranges for i in range(1, ranges)]
    found = given.agg(
        F.min("key").alias("first"),
        (F.percentile_approx("key", cuts, 100 * ranges) if cuts else F.array()).alias("cuts"),
    ).first()
    if found["first"] is None:
        return given.select("id", "text", F.col("text").alias("next_text"))
    bounds = sorted({found["first"], *(found["cuts"] or ())})
    opens = F.array(*[F.lit(b).cast("long") for b in bounds])
    own = F.size(F.filter(opens, lambda b: b <= F.col("key"))) - 1
    copies = F.array(
        F.struct(own.alias("part"), F.lit(0).alias("copy")),
        F.when(
            F.array_contains(opens, F.col("key")),
            F.struct(F.pmod(own - 1, F.lit(len(bounds))).alias("part"), F.lit(1).alias("copy")),
        ),
    )
    dealt = (
        given.withColumn("to", F.explode(F.array_compact(copies)))
        .select("to.part", "to.copy", "key", "id", "text")
        .repartition(len(bounds), "part")
        .sortWithinPartitions("part", "copy", "key", "text")
        .select("part", "copy", "id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last own row of a range, which waits for the row after it

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal held
            for part, copy, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is not None and held[0] == part:
                    yield held[1], held[2], text
                    held = None
                if not copy:
                    held = part, doc, text

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                made = list(rows(whole.slice(at, 256)))
                columns = list(zip(*made, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], whole.schema.field("id").type),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.string()),
                    ],
                    ["id", "text", "next_text"],
                )

    kind = given.schema["id"].dataType.simpleString()
    return dealt.mapInArrow(run, f"id {kind}, text string, next_text string")


def half_replaced(text: Column, other: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by as much of the start of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half)
    )
