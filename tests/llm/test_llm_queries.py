"""The queries on the smallest tables: against SQL, or against plain versions."""

from __future__ import annotations

import base64
import hashlib
import zlib

import brute
import duckdb
import public_tokenizers
import pytest
import regex
import tiktoken
from conftest import SF

from checks.verify import rows_of
from rosterline.llm import fingerprints
from rosterline.llm.queries import ORACLE, QUERIES


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    db = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = db.execute(ORACLE[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_line_dedup_equals_plain_version(spark, texts):
    docs = sorted(texts.items())
    want = dict(zip(texts, [None] * len(texts), strict=True))
    for (doc, _), kept in zip(docs, brute.kept_lines(docs), strict=True):
        want[doc] = sha(kept.encode())
    got = {r["doc_id"]: r for r in QUERIES["op1_line_dedup"](spark, SF).collect()}
    assert {doc: r["kept_sha256"] for doc, r in got.items()} == want
    assert sum(r["n_removed"] for r in got.values()) > 0


def test_near_duplicates_equal_plain_version(spark, texts):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op5_near_duplicates"](spark, SF).collect()}
    assert got == brute.classes(texts)


def test_byte_bpe_equals_library(spark, texts):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    for row in QUERIES["op6_byte_bpe"](spark, SF).collect():
        text = texts[row["doc_id"]]
        ids = library.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(" ".join(map(str, ids)).encode())
        assert row["decoded_sha256"] == sha(text.encode())


def test_languages_of_held_out_documents(spark, documents):
    langs = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    rows = QUERIES["op7_language_id"](spark, SF).collect()
    assert len(rows) == len(langs)
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_fingerprints_of_edited_documents(spark, texts):
    order = sorted(texts)
    rows = {r["doc_id"]: r for r in QUERIES["op8_fingerprints"](spark, SF).collect()}
    assert sorted(rows) == order
    for i, doc in enumerate(order):
        text, after = texts[doc], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        tree = fingerprints.tree(text)
        row = rows[doc]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == sha(edited.encode())
        assert row["fingerprint"] == fingerprints.printed(tree)
        assert row["edited_fingerprint"] == fingerprints.printed(fingerprints.tree(edited))
        assert row["near_edited"] == fingerprints.likeness(tree, fingerprints.tree(edited))
        assert row["near_next"] == fingerprints.likeness(tree, fingerprints.tree(after))
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) > 0.9 * len(rows)


def test_quality_of_held_out_documents(spark):
    marks = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    rows = QUERIES["op9_quality"](spark, SF).collect()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
        assert row["predicted"] == (row["score"] >= 0.5)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert sum(r["predicted"] == marks[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_token_counts_equal_greedy_matching(spark, texts):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = {base64.b64decode(line.split()[0]) for line in open(path, "rb")}
    longest = max(map(len, tokens))
    pattern = regex.compile(public_tokenizers.PATTERN)

    def greedy(piece: bytes) -> int:
        count = 0
        while piece:
            size = next(n for n in range(min(longest, len(piece)), 0, -1) if piece[:n] in tokens)
            piece, count = piece[size:], count + 1
        return count

    for row in QUERIES["op10_token_counts"](spark, SF).collect():
        pieces = pattern.findall(texts[row["doc_id"]])
        assert row["n_pieces"] == len(pieces)
        assert row["n_tokens"] == sum(greedy(p.encode()) for p in pieces)
