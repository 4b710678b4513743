"""Byte-level BPE by merge replay over the distinct words of a shard of the corpus.

A task takes the distinct pieces of the documents it holds, keeps an inverted index from each
adjacent token pair to the positions where it stands, and applies the merges in rank order; a
merge touches only the positions of its pair and their two neighbours. Nothing is shuffled: a
document's ids are put together in the task that read it.

Defined cases: a null text is an empty text and has no ids; special tokens have no meaning, their
strings are ordinary text; repeated rows give repeated results; extra columns are ignored; an
empty table gives an empty result; a text of any length is worked on in pieces.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.llm.common import CHUNK_CHARS, chunks, map_texts, text_of

VOCABULARY = "byte_bpe_50k.tiktoken"

#: Characters of the texts whose distinct pieces go through one replay.
SHARD_CHARS = 4_000_000

#: Pieces whose ids a worker remembers; when there are more, it begins anew.
REMEMBERED = 150_000

#: Pieces of a text that are held at once.
PIECES_AT_ONCE = 200_000

#: Rows whose ids are Python lists at the same time in decoding.
ROWS_AT_ONCE = 200


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file with a base64 token and a rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeReplay:
    """Applies the merges of a rank table to many distinct pieces at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()] + [-1], np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that neighbours make, -1 where there is no such token."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        found = self.keys[np.minimum(at, len(self.keys) - 1)] == key
        return self.made[np.where(found, at, -1)]

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and the number of ids of each."""
        token, sizes = self._singles(pieces)
        size = len(token)
        word = np.append(np.repeat(np.arange(len(pieces), dtype=np.int32), sizes), np.int32(-1))
        token = np.append(token, -1)
        after = np.append(np.arange(1, size + 1, dtype=np.int32), np.int32(size))
        before = np.arange(-1, size, dtype=np.int32)
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def note(ranks: np.ndarray, at: np.ndarray) -> None:
            """Enter positions into the inverted index, under the ranks of their pairs."""
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            edges = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(at)]
            for rank, a, b in zip(ranks[edges[:-1]].tolist(), edges, edges[1:], strict=False):
                if rank in places:
                    places[rank].append(at[a:b])
                else:
                    places[rank] = [at[a:b]]
                    heappush(queue, rank)

        inner = np.flatnonzero(word[:-1] == word[1:])
        note(self.ranks_of(token[inner], token[inner + 1]), inner)
        while queue:
            rank = heappop(queue)
            held = places.pop(rank)
            i = np.sort(np.concatenate(held)) if len(held) > 1 else np.sort(held[0])
            j = after[i]
            alive = (token[i] >= 0) & (word[i] == word[j])
            i, j = i[alive], j[alive]
            same = self.ranks_of(token[i], token[j]) == rank
            i, j = i[same], j[same]
            if not len(i):
                continue
            # One merge of a word at a time, the leftmost: it may make a pair of a smaller rank.
            lead = np.append(True, word[i[1:]] != word[i[:-1]])
            rest = i[~lead]
            if len(rest):
                note(np.full(len(rest), rank), rest)
                i, j = i[lead], j[lead]
            k = after[j]
            token[i], token[j] = rank, -1
            after[i] = k
            before[k] = i
            h = before[i]
            left, right = word[h] == word[i], word[k] == word[i]
            h, k = h[left], k[right]
            note(
                self.ranks_of(
                    np.append(token[h], np.full(len(k), rank)),
                    np.append(np.full(len(h), rank), token[k]),
                ),
                np.append(h, i[right]),
            )
        alive = token[:-1] >= 0
        return token[:-1][alive], np.bincount(word[:-1][alive], minlength=len(pieces))

    def _singles(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Byte tokens of every piece; a piece that is a token itself is that one token."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        starts = np.cumsum(sizes) - sizes
        flat[starts[whole >= 0]] = whole[whole >= 0]
        keep = np.repeat(whole < 0, sizes)
        keep[starts] = True
        return flat[keep], np.where(whole < 0, sizes, 1)


class Numbers(dict):
    """Numbers pieces in the order in which they are first seen."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Encoder:
    """Ids of texts, by the replay over their distinct pieces."""

    def __init__(self, path: str, pattern: str):
        self.replay = MergeReplay(read_ranks(path))
        self.pattern = regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.ids = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Replay the merges over the pieces that were numbered since the last call."""
        new = [p.encode() for p in islice(self.numbers, len(self.sizes), None)]
        if new:
            ids, sizes = self.replay.encode(new)
            self.ids = np.append(self.ids, ids.astype(np.int32))
            self.sizes = np.append(self.sizes, sizes)

    def _number(self, text: str) -> np.ndarray:
        """The numbers of a text's pieces."""
        out, matches = array("i"), self.pattern.finditer(text)
        if len(text) < CHUNK_CHARS:
            out.extend(map(self.numbers.__getitem__, self.pattern.findall(text)))
            return np.frombuffer(out, np.int32)
        while pieces := [m[0] for m in islice(matches, PIECES_AT_ONCE)]:
            out.extend(map(self.numbers.__getitem__, pieces))
        return np.frombuffer(out, np.int32)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for start, stop in chunks(list(map(len, texts)), SHARD_CHARS):
            if len(self.numbers) > REMEMBERED:
                self._forget()
            numbered = [self._number(text) for text in texts[start:stop]]
            self._learn()
            starts = np.cumsum(self.sizes) - self.sizes
            for numbers in numbered:
                sizes = self.sizes[numbers]
                ends = np.cumsum(sizes)
                shift = np.repeat(starts[numbers] - (ends - sizes), sizes)
                yield self.ids[shift + np.arange(len(shift))]


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(
    docs: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    ids_col: str = "ids",
) -> DataFrame:
    """``keep`` and the token ids of every text.

    ``path`` names the rank file as each machine of the cluster has it; if it is not given,
    every worker asks its own installation.
    """

    def start():
        encoder = _encoder(path or public_tokenizers.path(VOCABULARY), pattern)

        def work(texts: list[str], _) -> list:
            ids = list(encoder.encode(texts))
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            return [pa.ListArray.from_arrays(ends, np.concatenate(ids, dtype=np.int32))]

        return work

    field = (ids_col, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))
    return map_texts(docs, text_of(text_col), keep, [field], start, SHARD_CHARS)


def decode(
    encoded: DataFrame,
    ids_col: str = "ids",
    keep: tuple[str, ...] = ("doc_id", "ids"),
    path: str | None = None,
    bytes_col: str = "decoded",
) -> DataFrame:
    """``keep`` and the bytes of every row's ids; null ids give no bytes."""
    given = encoded.select(*keep, F.col(ids_col).cast("array<int>").alias("__ids"))
    schema = T.StructType(
        list(given.schema)[:-1] + [T.StructField(bytes_col, T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path or public_tokenizers.path(VOCABULARY))
        tokens = {rank: token for token, rank in ranks.items()}
        for batch in batches:
            column = batch.column(len(keep))
            for at in range(0, len(column), ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids = part.column(len(keep)).to_pylist()
                decoded = [b"".join(map(tokens.__getitem__, x or ())) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(decoded, pa.binary())], [*keep, bytes_col]
                )

    return given.mapInArrow(run, schema)
