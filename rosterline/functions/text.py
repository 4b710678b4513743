"""Text expressions: headers, names, addresses, packed values and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterline.functions.fixed import STREET_END_MARKERS

FIELD_MARK = "^"
SLOT_MARK = "|"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_empty(c: Column | str) -> Column:
    return F.coalesce(col_of(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    """Remove white space of every kind at both ends (``trim`` only knows blanks)."""
    return F.regexp_replace(col_of(c), r"(?U)^\s+|\s+$", "")


def null_if_blank(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def header_name(name: str) -> str:
    """Column name for a header cell: lower case, blanks to ``_``, other signs dropped."""
    return "".join(ch for ch in name.lower().replace(" ", "_") if ch == "_" or ch.isalnum())


def normalize_header(c: Column | str) -> Column:
    """``header_name`` for header cells held in a column."""
    return F.regexp_replace(F.translate(F.lower(col_of(c)), " ", "_"), r"(?U)\W+", "")


def joined(sep: str, *cols: Column | str) -> Column:
    """Join with ``sep``, skipping nulls."""
    return F.concat_ws(sep, *[col_of(c) for c in cols])


def token(*cols: Column | str) -> Column:
    """One export token: every field kept in place, nulls as empty text."""
    return F.concat_ws(FIELD_MARK, *[or_empty(c) for c in cols])


def address_key(
    line1: Column | str,
    line2: Column | str,
    city: Column | str,
    state: Column | str,
    postal_code: Column | str,
    country: Column | str,
) -> Column:
    """Six-part key; pipes inside parts are removed so that it always splits into six."""

    def part(c: Column | str) -> Column:
        return F.translate(or_empty(c), SLOT_MARK, "")

    return F.concat_ws(
        SLOT_MARK,
        part(line1),
        part(line2),
        part(city),
        part(state),
        F.substring(part(postal_code), 1, 5),
        part(country),
    )


def clean_street(c: Column | str) -> Column:
    """Upper-case street without unit part, dots, commas and ampersands.

    Markers are looked up in the text as written, so lower-case ones do not cut.
    """
    street = col_of(c)
    found = [F.nullif(F.instr(street, m), F.lit(0)) for m in STREET_END_MARKERS]
    cut = F.least(*found)
    upper = F.upper(street)
    kept = F.when(cut.isNull(), upper).otherwise(F.substr(upper, F.lit(1), cut - 1))
    return strip(F.translate(kept, ".,&", ""))


def words(c: Column | str) -> Column:
    """Lower-case words of a text, an array."""
    return F.filter(F.split(F.lower(col_of(c)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
