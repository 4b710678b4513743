"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes with the counts of the byte that
followed. A byte costs -log2 of its share in the longest context that has seen it, plus the cost
of the escapes from the longer ones (an escape has as many counts as the context has different
followers); below the empty context all 256 bytes are alike. The statistics are frozen after
learning, so that costs are tabulated once. A text belongs to the language that gives it the
shortest code; the score is that language's share in the sum of the probabilities of the whole
text.

Counting covers all texts that are learned from: tasks count, Spark adds up, and no count is left
out. Languages are scored in passes over tables of ``PASS_GRAMS`` sequences together, one whole
language at least, so that a further language makes a further pass and not a larger table.

Defined cases: a text that is null or has no letter is ``und`` with score 0; if nothing can be
learned, all are; texts of equal code length get the first language of the alphabet; repeated
rows count as often as they stand there; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.llm.common import Field, Stored, map_texts, text_of

UNKNOWN = "und"

#: Byte sequences of four in the tables of a pass, unless a single language has more.
PASS_GRAMS = 4_000_000

_START = b"\n\n\n"
_LETTER = regex.compile(r"\p{L}")


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte sequences that end at each byte of the lower-cased texts; bytes of each text."""
    data = [_START + text.lower().encode() for text in texts]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    grams = flat[:-3] << 24 | flat[1:-2] << 16 | flat[2:-1] << 8 | flat[3:]
    inside = np.ones(len(flat), bool)
    starts = np.cumsum(sizes) - sizes
    for k in range(3):
        inside[starts + k] = False
    return grams[inside[3:]], sizes - 3


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang``, ``gram`` (four bytes as a number) and ``n`` over all rows with a language."""
    given = docs.select(
        F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text")
    ).where(F.col("lang").isNotNull() & (F.length("text") > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str, texts: list[str]) -> None:
            keys, n = np.unique(_grams(texts)[0], return_counts=True)
            if lang in counts:
                old, m = counts[lang]
                keys, back = np.unique(np.concatenate([old, keys]), return_inverse=True)
                n = np.bincount(back, np.concatenate([m, n])).astype(np.int64)
            counts[lang] = keys, n

        for batch in batches:
            by: dict[str, list[str]] = {}
            held: dict[str, int] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by.setdefault(lang, []).append(text)
                held[lang] = held.get(lang, 0) + len(text)
                if held[lang] > 2_000_000:
                    add(lang, by.pop(lang))
                    held[lang] = 0
            for lang, texts in by.items():
                add(lang, texts)
        for lang, (keys, n) in counts.items():
            for a in range(0, len(keys), 100_000):
                part = keys[a : a + 100_000].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part)),
                        pa.array(part),
                        pa.array(n[a : a + 100_000].astype(np.int64)),
                    ],
                    ["lang", "gram", "n"],
                )

    counted = given.mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Tree:
    """Code lengths of one language: sorted sequences of each order, from the longest on."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        self.orders = []
        for order in (3, 2, 1, 0):
            keys, back = np.unique(gram & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            count = np.bincount(back, n, minlength=len(keys))
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            different = np.bincount(of, minlength=len(contexts))
            whole = np.log2(np.bincount(of, count, minlength=len(contexts)) + different)
            self.orders.append(
                (
                    keys.astype(np.uint32),
                    (whole[of] - np.log2(count)).astype(np.float32),
                    contexts.astype(np.uint32),
                    (whole - np.log2(different)).astype(np.float32),
                )
            )

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each of the ``grams`` after those before it."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for order, (keys, cost, contexts, escape) in zip((3, 2, 1, 0), self.orders, strict=True):
            wanted = grams[left] & np.uint32((1 << 8 * (order + 1)) - 1)
            seen, at = _find(keys, wanted)
            out[left[seen]] += cost[at[seen]]
            left, wanted = left[~seen], wanted[~seen]
            known, at = _find(contexts, wanted >> np.uint32(8))
            out[left[known]] += escape[at[known]]
        out[left] += 8
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether and where each of the ``wanted`` is in the sorted ``keys``, which are not empty."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def lengths(trees: list[Tree], texts: list[str]) -> np.ndarray:
    """Code length in bits of each text (rows) in each language (columns)."""
    grams, sizes = _grams(texts)
    out = np.zeros((len(texts), len(trees)))
    full = np.flatnonzero(sizes)
    if len(full):
        different, back = np.unique(grams, return_inverse=True)
        starts = (np.cumsum(sizes) - sizes)[full]
        for number, tree in enumerate(trees):
            out[full, number] = np.add.reduceat(tree.costs(different)[back], starts)
    return out


def _best(langs: list[str], texts: list[str], bits: np.ndarray) -> tuple[list[str], list[float]]:
    """Language and score of each text, from its code lengths."""
    found, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    lettered = [i for i, text in enumerate(texts) if text and _LETTER.search(text)]
    if langs and lettered:
        bits = bits[lettered]
        best = bits.argmin(axis=1)
        less = bits.min(axis=1, keepdims=True) - bits
        share = 1 / np.exp2(np.maximum(less, -1000)).sum(axis=1)
        for i, lang, score in zip(lettered, best.tolist(), share.tolist(), strict=True):
            found[i], scores[i] = langs[lang], score
    return found, scores


class Learned:
    """Counts of all languages, stored, and the languages of each pass."""

    def __init__(self, counted: DataFrame):
        self.counts = Stored(counted, "grams")
        sizes = self.counts.df.groupBy("lang").agg(F.count("*").alias("n")).collect()
        sizes = sorted((r["lang"], r["n"]) for r in sizes)
        self.langs = [lang for lang, _ in sizes]
        self.passes: list[list[str]] = []
        held = 0
        for lang, n in sizes:
            if not self.passes or held + n > PASS_GRAMS:
                self.passes.append([])
                held = 0
            self.passes[-1].append(lang)
            held += n

    def trees(self, langs: list[str]) -> list[Tree]:
        made = []
        for lang in langs:
            rows = self.counts.df.where(F.col("lang") == lang).select("gram", "n").toArrow()
            made.append(Tree(*(rows.column(c).to_numpy() for c in ("gram", "n"))))
        return made


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Learned:
    """The counts of all languages, from all rows of ``docs`` that name one."""
    return Learned(count_grams(docs, text_col, lang_col))


_FIELDS: list[Field] = [
    ("lang_pred", T.StringType(), pa.string()),
    ("score", T.DoubleType(), pa.float64()),
]
_BITS: list[Field] = [("__more", T.ArrayType(T.DoubleType()), pa.list_(pa.float64()))]


def identify(
    docs: DataFrame, learned: Learned, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` of every text.

    Between passes texts and code lengths are stored, so that a task holds the tables of one.
    """
    context, langs = docs.sparkSession.sparkContext, learned.langs
    passes = learned.passes or [[]]
    given = docs.select(*keep, text_of(text_col).alias("__given"))
    for number, part in enumerate(passes):
        shared = context.broadcast(learned.trees(part))
        before = ("__bits",) if number else ()
        last = number == len(passes) - 1

        def start(shared=shared, last=last):
            trees = shared.value

            def work(texts: list[str], others: dict[str, pa.Array]) -> list:
                bits = lengths(trees, texts)
                if "__bits" in others:
                    bits = np.hstack([np.array(others["__bits"].to_pylist()), bits])
                return list(_best(langs, texts, bits)) if last else [bits.tolist()]

            return work

        fields = _FIELDS if last else _BITS
        kept = (*keep, *before) if last else (*keep, "__given", *before)
        found = map_texts(given, F.col("__given"), kept, fields, start)
        if last:
            return found.drop("__bits")
        given = found.drop("__bits").withColumnRenamed("__more", "__bits")
        given = Stored(given, "bits").df


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    rest = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))
    return F.coalesce(rest == fold, F.lit(False))
