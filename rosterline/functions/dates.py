"""Date expressions; source text is never trusted, failures become null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterline.functions.text import col_of


def parse_us_date(c: Column | str) -> Column:
    """``MM/DD/YYYY`` text (one or two digits for month and day) to a date."""
    text = col_of(c)
    shaped = F.when(text.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), text)
    return F.try_to_timestamp(shaped, F.lit("M/d/yyyy")).cast("date")


def compact_date(c: Column | str) -> Column:
    """``yyyyMMdd`` text to a date."""
    shaped = F.when(col_of(c).rlike("^[0-9]{8}$"), col_of(c))
    return F.try_to_timestamp(shaped, F.lit("yyyyMMdd")).cast("date")


def month_label(c: Column | str) -> Column:
    """``January_2024`` style label of the month of a date."""
    return F.date_format(col_of(c), "MMMM_yyyy")
