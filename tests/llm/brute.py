"""Plain versions of the operators that SQL cannot express, for small tables."""

from __future__ import annotations

import string
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import regex

#: One byte each, and not in normalised lines.
_SIGNS = string.ascii_uppercase + "!#$%&()*+,-./:;<=>?@[]^_{|}~"


def roots(nodes: list, links: list[tuple]) -> dict:
    """node -> some member of its connected group, the same for all of them."""
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in links:
        parent[find(a)] = find(b)
    return {node: find(node) for node in nodes}


def edit_distance(one: str, other: str) -> int:
    row = list(range(len(other) + 1))
    for i, a in enumerate(one, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(other, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def _close(norms: list[str], least: float) -> list[tuple[int, int]]:
    """All pairs of lines of which the longer one is ``1 - least`` of its length edits away at most.

    An edit takes away two pairs of neighbouring letters at most, so lines that share too few of
    them are not compared. DuckDB's distance is one of bytes: letters beyond ASCII get signs that
    no line has.
    """
    beyond = sorted({c for norm in norms for c in norm if c > "\x7f"})
    assert len(beyond) <= len(_SIGNS)
    plain = str.maketrans(dict(zip(beyond, _SIGNS, strict=False)))
    held = [x.translate(plain) for x in norms]
    sizes = np.array([len(x) for x in held])
    counts = np.zeros((len(held), 509), np.int16)
    for i, x in enumerate(held):
        letters = np.frombuffer(x.encode(), np.uint8).astype(int)
        np.add.at(counts[i], (letters[:-1] * 31 + letters[1:]) % 509, 1)
    near = []
    for i in range(len(held)):
        longer = np.maximum(sizes[i], sizes[i + 1 :])
        most = np.floor((1 - least) * longer + 1e-6)
        j = np.flatnonzero(np.abs(sizes[i] - sizes[i + 1 :]) <= most)
        shared = np.minimum(counts[i], counts[i + 1 + j]).sum(axis=1)
        j = j[shared >= longer[j] - 1 - 2 * most[j]]
        near += [(i, int(k) + i + 1, int(most[k])) for k in j]
    base = duckdb.connect()
    base.register("line", pa.table({"i": range(len(held)), "n": held}))
    columns = zip("abm", zip(*near, strict=True), strict=True) if near else [("a", []), ("b", []), ("m", [])]
    base.register("near", pa.table({name: pa.array(list(x), pa.int64()) for name, x in columns}))
    return base.execute(
        "SELECT a, b FROM near JOIN line x ON a = x.i JOIN line y ON b = y.i "
        "WHERE levenshtein(x.n, y.n) <= m"
    ).fetchall()


def kept_lines(docs: list[tuple], least: float = 0.8) -> list[str]:
    """The text that line dedup leaves of each (id, text): edit similarity decides for all pairs."""
    places = defaultdict(list)
    for number, (doc, text) in enumerate(docs):
        for pos, line in enumerate(text.split("\n")):
            norm = regex.sub(r"[\x00-\x1F\x21-\x2F\x3A-\x60\x7B-\x7F ]+", " ", line.lower())
            if norm.strip(" "):
                places[norm.strip(" ")].append((doc, pos, number))
    norms = list(places)
    links = _close(norms, least)
    groups = defaultdict(list)
    found = roots(list(range(len(norms))), links)
    for i, root in found.items():
        groups[root] += places[norms[i]]
    gone = defaultdict(set)
    for held in groups.values():
        for _, pos, number in sorted(held)[1:]:
            gone[number].add(pos)
    return [
        "\n".join(x for pos, x in enumerate(text.split("\n")) if pos not in gone[number])
        for number, (_, text) in enumerate(docs)
    ]


def ordered_kmers(text: str, size: int = 5) -> list[tuple]:
    words = regex.findall(r"\w+", text.lower()) or [text.strip()]
    seen: dict[tuple, int] = defaultdict(int)
    out = []
    for i in range(max(1, len(words) - size + 1)):
        kmer = tuple(words[i : i + size])
        out.append((kmer, seen[kmer]))
        seen[kmer] += 1
    return out


def aligned_share(one: list, other: list) -> float:
    """Longest common subsequence over all k-mers, by the plain table."""
    row = [0] * (len(other) + 1)
    for a in one:
        last = 0
        for j, b in enumerate(other, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1] / (len(one) + len(other) - row[-1])


def classes(docs: dict[int, str], least: float = 0.8) -> dict[int, int]:
    """doc_id -> smallest id among its near duplicates."""
    held = {doc: ordered_kmers(text) for doc, text in docs.items()}
    by = defaultdict(list)
    for doc, kmers in held.items():
        for kmer in kmers:
            by[kmer].append(doc)
    shared: dict[tuple, int] = defaultdict(int)
    for found in by.values():
        for i, a in enumerate(found):
            for b in found[i + 1 :]:
                shared[a, b] += 1
    links = [
        (a, b)
        for (a, b), n in shared.items()
        if n / (len(held[a]) + len(held[b]) - n) >= least
        and aligned_share(held[a], held[b]) >= least
    ]
    groups = defaultdict(list)
    for doc, root in roots(list(docs), links).items():
        groups[root].append(doc)
    return {doc: min(found) for found in groups.values() for doc in found}
