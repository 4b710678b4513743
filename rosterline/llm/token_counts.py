"""Token counts by a linear longest-match automaton.

The vocabulary is a trie of bytes. Each node has a failure link and the number of tokens that are
popped when it is followed; both are computed once, in breadth order. A piece is read byte by
byte, every byte moves forward in the trie or follows links that are paid for by earlier bytes,
and the tokens are counted without being built.

Defined cases: a null text is an empty text and counts 0; repeated rows count alike; extra
columns are ignored; an empty table gives an empty result; long texts are read in pieces.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable
from functools import lru_cache
from itertools import islice

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rosterline.llm.bpe import PIECES_AT_ONCE, REMEMBERED, VOCABULARY, read_ranks
from rosterline.llm.common import map_texts, text_of


class LongestMatch:
    """Greedy longest-match counts; every byte has to be a token, so each text can be split."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.step: dict[int, int] = {}  # node * 256 + byte -> node; 0 is the root
        token = [False]
        for entry in vocabulary:
            node = 0
            for byte in entry:
                key = node << 8 | byte
                node = self.step.get(key, 0)
                if not node:
                    node = self.step[key] = len(token)
                    token.append(False)
            token[node] = True
        if not all(token[self.step.get(b, 0)] for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        below: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.step.items():
            below.setdefault(key >> 8, []).append((key & 255, node))
        self.fail = [0] * len(token)
        self.popped = [0] * len(token)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in below.get(parent, ()):
                queue.append(node)
                if token[node]:  # the whole node is a token: pop it, go on at the root
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                at, count = self.fail[parent], self.popped[parent]
                while (at << 8 | byte) not in self.step:
                    count += self.popped[at]
                    at = self.fail[at]
                self.fail[node] = self.step[at << 8 | byte]
                self.popped[node] = count

    def count(self, piece: bytes) -> int:
        step, fail, popped = self.step, self.fail, self.popped
        node = total = 0
        for byte in piece:
            while (new := step.get(node << 8 | byte, 0)) == 0:
                total += popped[node]
                node = fail[node]
            node = new
        while node:
            total += popped[node]
            node = fail[node]
        return total


class Counter:
    """Counts of texts; the counts of pieces seen before are remembered."""

    def __init__(self, path: str, pattern: str):
        self.automaton = LongestMatch(read_ranks(path))
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def counts(self, text: str) -> tuple[int, int]:
        """Pieces and tokens of a text."""
        pieces = tokens = 0
        matches = self.pattern.finditer(text)
        while found := [m[0] for m in islice(matches, PIECES_AT_ONCE)]:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            known = self.known
            for piece in found:
                count = known.get(piece)
                if count is None:
                    count = known[piece] = self.automaton.count(piece.encode())
                tokens += count
            pieces += len(found)
        return pieces, tokens


@lru_cache(maxsize=2)
def _counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def count_tokens(
    docs: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``keep``, the pieces of the pattern in every text and its greedy longest-match tokens.

    ``path`` names the vocabulary file as each machine of the cluster has it.
    """

    def start():
        counter = _counter(path or public_tokenizers.path(VOCABULARY), pattern)

        def work(texts: list[str], _) -> list:
            counts = [counter.counts(text) for text in texts]
            return [[c[0] for c in counts], [c[1] for c in counts]]

        return work

    fields = [(n, T.LongType(), pa.int64()) for n in ("n_pieces", "n_tokens")]
    return map_texts(docs, text_of(text_col), keep, fields, start)
