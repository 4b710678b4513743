"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm import (
    bpe,
    decontaminate,
    fingerprints,
    language,
    licenses,
    line_dedup,
    near_duplicates,
    packing,
    quality,
    ranked_search,
    substring_dedup,
    token_counts,
    turn_repair,
)
from rosterline.llm.common import Stored, input_bytes

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select(
        "doc_id", "text", F.size(F.split("text", "\n")).cast("long").alias("n_lines")
    )
    kept = line_dedup.without_copies(docs)
    return kept.select(
        "doc_id",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("__removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_windows(
        _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    names = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


_DIGITS_AND_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_DIGITS_AND_LETTERS}') AS w
  FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_DIGITS_AND_LETTERS}') AS w
  FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
  FROM item, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM item_window),
hit AS (
  SELECT r, i, d.k, item_id FROM (
    SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM doc, sizes, unnest(range(1, len(w) - k + 2)) AS t(i)) AS d
  JOIN item_window USING (k, s)),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + k)) AS t(p) GROUP BY r),
names AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit) AS one GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN names USING (r)
"""


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(_documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


OP3_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s
  FROM doc, unnest(range(1, len(w) - 48)) AS t(i) WHERE len(w) >= 50),
least_id AS (SELECT s, min(doc_id) AS least_id FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT r, p FROM (
    SELECT r, i FROM win JOIN least_id USING (s) WHERE doc_id > least_id) AS hit,
    unnest(range(i, i + 50)) AS t(p)),
word AS (
  SELECT doc.r, u.p, w[u.p] AS word FROM doc, unnest(range(1, len(w) + 1)) AS u(p)
  ANTI JOIN gone ON doc.r = gone.r AND u.p = gone.p),
left_over AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM word GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN left_over USING (r)
"""


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(_documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_matches",
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join("whole_text", ",").alias("whole_text"),
    )


OP4_SQL = f"""
WITH known AS (
  SELECT DISTINCT license_id, replace({licenses.canonical_sql("text")}, chr(10), ' ') AS unit
  FROM (VALUES {licenses.known_sql()}) AS t(license_id, text)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, {licenses.canonical_sql("coalesce(text, '')")} AS form
  FROM documents),
unit AS (
  SELECT r, replace(form, chr(10), ' ') AS unit, 1 AS entire FROM doc WHERE form <> ''
  UNION ALL SELECT r, unnest(string_split(form, chr(10))), 0 FROM doc WHERE form <> ''),
hit AS (SELECT r, entire, license_id FROM unit JOIN known USING (unit)),
per AS (
  SELECT r, count(*) AS n_matches,
    string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS licenses,
    string_agg(DISTINCT license_id, ',' ORDER BY license_id) FILTER (entire = 1) AS whole_text
  FROM hit GROUP BY r)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses,
  coalesce(whole_text, '') AS whole_text
FROM doc LEFT JOIN per USING (r)
"""


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", "class_id")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(_documents(spark, sf_dir)))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    trees = language.learn(docs.where(~language.held_out("doc_id", 4, 2)))
    found = language.identify(docs, trees)
    return found.withColumn("held_out", language.held_out("doc_id", 4, 2))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    pairs = fingerprints.with_next(docs, "doc_id", "text", input_bytes(docs))
    texts = pairs.select(
        F.col("id").alias("doc_id"),
        "text",
        "next_text",
        fingerprints.half_replaced(F.col("text"), F.col("next_text")).alias("edited_text"),
        F.length("text").cast("long").alias("n_chars"),
    ).withColumn("edited_sha256", F.sha2(F.col("edited_text").cast("binary"), 256))
    found = fingerprints.fingerprints(
        texts,
        keep=("doc_id", "n_chars", "edited_sha256"),
        against=("edited_text", "next_text"),
        locate=False,
    )
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        F.col("fingerprint_edited_text").alias("edited_fingerprint"),
        F.col("likeness_edited_text").alias("near_edited"),
        F.col("likeness_next_text").alias("near_next"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learned = labels.where(~language.held_out("doc_id", 3, 1))
    found = quality.score(docs, quality.fit(docs, learned))
    return found.select(
        "doc_id",
        language.held_out("doc_id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = Stored(ranked_search.build_index(_documents(spark, sf_dir)), "index", "zstd")
    found = ranked_search.search(index.df, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=50)
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


OP11_SQL = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_DIGITS_AND_LETTERS}') AS t
  FROM documents),
size AS (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n FROM doc WHERE len(t) > 0),
whole AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM size),
posting AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM doc) AS x GROUP BY r, term),
item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_DIGITS_AND_LETTERS}')) AS term
  FROM benchmark),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM posting, whole WHERE term IN (SELECT term FROM item) GROUP BY term, big_n),
scored AS (
  SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf
    + 20 * (50 + (50 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM item JOIN weight USING (term) JOIN posting USING (term) JOIN size USING (r), whole
  GROUP BY item_id, r),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored JOIN size USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _damaged(turns: DataFrame) -> DataFrame:
    """``turns`` after the damage that the number of each row says, and ``there``."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    number = F.crc32(F.concat(names[0], F.lit(":"), names[1]).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    damaged = turns.select(
        "conv_id",
        "turn",
        F.when(number == 4, "user").otherwise(role).alias("role"),
        F.when(number == 1, "")
        .when(number == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        (number != 0).alias("there"),
        F.when(number == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("times"),
    )
    return damaged.withColumn("time", F.explode("times")).drop("times", "time")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    repaired = Stored(turn_repair.repair(turns, present=F.col("there")), "repaired").df
    heads = repaired.where(F.col("cost").isNotNull())
    long = turn_repair.digests(repaired).withColumnsRenamed(
        {"conv_id": "of", "repaired_sha256": "of_parts"}
    )
    hashed = F.sha2(turn_repair.said(F.col("turns")).cast("binary"), 256)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return heads.join(long, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id",
        *numbers,
        "audit",
        F.coalesce("of_parts", hashed).alias("repaired_sha256"),
    )


def _op12_sql() -> str:
    """A walk through the turns of a conversation with the best edits for each state.

    An element is a list of four texts, one for each state: the cost in 12 digits, the audit, a zero
    byte, and the repaired turns, so that the smallest text is the best; 'x' means no way. A turn
    is a list of (initial, must go, breaks off, role, text).
    """

    def made(way: str, cost: str, edit: str, line: str = "''") -> str:
        number = f"lpad(CAST(CAST(left({way}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0')"
        audit = f"split_part(substr({way}, 13), chr(0), 1)"
        said = f"substr({way}, 14 + length({audit}))"
        return (
            f"CASE WHEN {way} = 'x' THEN 'x' ELSE "
            f"{number} || {audit} || '{edit}' || chr(0) || {said} || {line} END"
        )

    def with_insertions(states: str) -> str:
        """States 0 to 3 are elements 1 to 4; an insertion leads from 0, 1, 3 to 2 and from 2 to 3."""
        user, agent = "'user:' || chr(10)", "'assistant:' || chr(10)"
        for to, ways in (("3", "124"), ("4", "3"), ("3", "4")):
            line = user if to == "3" else agent
            best = ", ".join([f"s[{to}]", *[made(f"s[{w}]", "3", "I", line) for w in ways]])
            items = ", ".join(f"least({best})" if str(i) == to else f"s[{i}]" for i in range(1, 5))
            states = f"list_transform([{states}], lambda s : [{items}])[1]"
        return states

    stays = "CASE WHEN t[3] = '1' THEN 3 ELSE 0 END"

    def edited(to: int) -> str:
        ways = [made(f"a[{to}]", "4", "D")]
        for way, initial in {1: [], 2: [(1, "s")], 3: [(1, "u"), (2, "u"), (4, "u")], 4: [(3, "a")]}[to]:
            keep = made(f"a[{way}]", stays, "K", "t[4] || ':' || t[5] || chr(10)")
            ways.append(f"CASE WHEN t[2] = '0' AND t[1] = '{initial}' THEN {keep} ELSE 'x' END")
            if initial != "s":
                role = {"u": "user", "a": "assistant"}[initial]
                new = made(f"a[{way}]", f"3 + {stays}", "R", f"'{role}:' || t[5] || chr(10)")
                ways.append(f"CASE WHEN t[2] = '0' THEN {new} ELSE 'x' END")
        return f"least({', '.join(ways)})"

    step = with_insertions("[" + ", ".join(edited(to) for to in range(1, 5)) + "]")
    begin = with_insertions("['000000000000' || chr(0), 'x', 'x', 'x']")
    crc_step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    table = "c"
    for _ in range(8):
        table = f"list_transform([{table}], lambda c : {crc_step})[1]"
    return f"""
WITH named AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role,
    coalesce(text, ' ') AS text, list_transform(
      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x : CAST(ascii(x) AS BIGINT)) AS bytes
  FROM conversations),
numbered AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda h, b :
    xor(h >> 8, list_transform([xor(h & 255, b)], lambda c : {table})[1])), 4294967295) % 20 AS n
  FROM named),
damaged AS (
  SELECT r, conv_id, turn, CASE WHEN n = 4 THEN 'user' ELSE role END AS role,
    CASE n WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN n = 3 THEN [1, 2] ELSE [1] END) AS time
  FROM numbered WHERE n <> 0),
placed AS (
  SELECT *, regexp_replace(text, '[ \t\n\x0B\f\r]+$', '') AS said, row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, r, time) AS place,
    row_number() OVER (
      PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, r, time) AS nth
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN said = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM placed),
told AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
    list([left(role, 1), CASE WHEN fault IN ('blank', 'duplicate') THEN '1' ELSE '0' END,
      CASE WHEN fault = 'truncated' THEN '1' ELSE '0' END, role, text] ORDER BY place) AS turns
  FROM faulty GROUP BY conv_id),
walked AS (
  SELECT *, list_reduce(list_prepend({begin}, turns), lambda a, t : {step}) AS ways FROM told),
best AS (SELECT *, least(ways[1], ways[4]) AS best FROM walked),
ended AS (
  SELECT *, split_part(substr(best, 13), chr(0), 1) AS audit FROM best)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(CAST(left(best, 12) AS BIGINT), 0) AS cost,
  coalesce(audit, '') AS audit,
  sha256(coalesce(left(substr(best, 14 + length(audit)),
    greatest(length(substr(best, 14 + length(audit))) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN ended AS e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_documents(spark, sf_dir))
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_language_id": op7_language_id,
    "op8_fingerprints": op8_fingerprints,
    "op9_quality": op9_quality,
    "op10_token_counts": op10_token_counts,
    "op11_ranked_search": op11_ranked_search,
    "op12_turn_repair": op12_turn_repair,
    "op13_packing": op13_packing,
}

ORACLE: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op3_substring_dedup": OP3_SQL,
    "op4_license_scan": OP4_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_turn_repair": _op12_sql(),
}
