"""Licence scans by canonical digest lookup.

A text is brought into a canonical form: letters A-Z in lower case, lines that begin with a
copyright mark left out, equivalent spellings made one, everything but digits and letters turned
into single blanks. The digest of the whole canonical text, and of each canonical line, is hash-
joined to the digests of known licence texts and notices, made in the same way. Only SQL functions
are used. Nothing but digests of the units is joined, and only matches are gathered.

Defined cases: a null text has no units; units without a digit or letter match nothing; the same
digest known under several names gives all of them; repeated rows get equal results; a null id is
kept; extra columns are ignored; empty tables give no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import Stored, text_of
from rosterline.llm.license_texts import TEXTS

# Names and wordings of published licences and notices.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    *TEXTS,
]

#: Spellings that count as one, in canonical form.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("per cent", "percent"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Patterns and what replaces them, in order; lines stay apart.
STEPS = [
    (r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*", "\n"),
    (r"[^a-z0-9\n\x{80}-\x{10FFFF}]+", " "),
    (r" *\n[ \n]*", "\n"),
    (r"^[ \n]+|[ \n]+$", ""),
]


def canonical(text: Column) -> Column:
    """Canonical lines of a text, joined by line feeds; lines without content are gone."""
    made = F.translate(text, UPPER, LOWER)
    for pattern, new in STEPS:
        made = F.regexp_replace(made, pattern, new)
    for spelling, usual in SPELLINGS:
        made = F.replace(made, F.lit(spelling), F.lit(usual))
    return made


def digest(canonical_text: Column) -> Column:
    """Digest of canonical text whose line breaks do not count."""
    return F.md5(F.translate(canonical_text, "\n", " ").cast("binary"))


def known_texts(spark: SparkSession) -> DataFrame:
    """``license_id`` and ``text`` of the built-in notices and texts."""
    rows = [F.struct(F.lit(n).alias("license_id"), F.lit(t).alias("text")) for n, t in KNOWN]
    return spark.range(1).select(F.inline(F.array(*rows)))


def find_licenses(
    docs: DataFrame,
    known: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``whole_text``, ``licenses`` and ``n_matches`` of every document.

    ``whole_text`` names the licences that the entire text is, ``licenses`` those of any unit
    (sorted arrays); ``n_matches`` counts the units, the whole text and its lines, that match.
    ``known`` has ``license_id`` and ``text``, as many rows as one likes.
    """
    spark = docs.sparkSession
    made = canonical(text_of("text"))
    digests = Stored(
        (known_texts(spark) if known is None else known)
        .select(F.col("license_id").cast("string").alias("license_id"), made.alias("form"))
        .where(F.col("form") != "")
        .select("license_id", digest(F.col("form")).alias("unit"))
        .distinct(),
        "licenses",
    )
    given = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    # Rows are told apart by id and text, so that repeated ids do no harm.
    mark = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("mark")
    forms = given.select("id", mark, made.alias("form")).where(F.col("form") != "")
    lines = F.transform(
        F.split("form", "\n"), lambda line: F.struct(digest(line).alias("unit"), F.lit(0).alias("whole"))
    )
    whole = F.array(F.struct(digest(F.col("form")).alias("unit"), F.lit(1).alias("whole")))
    units = forms.select("id", "mark", F.explode(F.concat(whole, lines)).alias("u"))
    found = (
        units.select("id", "mark", "u.unit", "u.whole")
        .join(digests.side(), "unit")
        .groupBy("id", "mark", "unit", "license_id")
        .agg(F.count("*").alias("n"), F.max("whole").alias("whole"))
        .groupBy("id", "mark")
        .agg(
            F.array_sort(
                F.collect_set(F.when(F.col("whole") == 1, F.col("license_id")))
            ).alias("whole_text"),
            F.array_sort(F.collect_set("license_id")).alias("licenses"),
            F.sum("n").alias("n_matches"),
        )
    )
    # Copies of one row would meet at the same match, once each: the matches are one per key.
    rows, hits = given.select("id", mark).alias("r"), found.alias("f")
    none = F.expr("cast(array() AS array<string>)")
    return rows.join(
        hits, F.col("r.id").eqNullSafe(F.col("f.id")) & (F.col("r.mark") == F.col("f.mark")), "left"
    ).select(
        F.col("r.id").alias(id_col),
        F.coalesce("whole_text", none).alias("whole_text"),
        F.coalesce("licenses", none).alias("licenses"),
        F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
    )


def canonical_sql(column: str) -> str:
    """The canonical form as DuckDB writes it."""
    made = f"translate({column}, '{UPPER}', '{LOWER}')"
    for pattern, new in STEPS:
        shown = "chr(10)" if new == "\n" else f"'{new}'"
        made = f"regexp_replace({made}, '{pattern}', {shown}, 'g')"
    for spelling, usual in SPELLINGS:
        made = f"replace({made}, '{spelling}', '{usual}')"
    return made


def known_sql() -> str:
    return ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN
    )
