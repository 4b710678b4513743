"""Address usage kept by snapshots: the counts of the whole, after each of several months."""

from __future__ import annotations

import datetime as dt

import pytest

from rosterline.functions.fixed import MAILING_COLUMNS, PL_COLUMNS, PRACTICE_COLUMNS, SNAPSHOT_DATE
from rosterline.operators.addresses import address_usage
from rosterline.plans import kept_usage as kept

MONTHS = [dt.date(2024, m, 1) for m in (3, 1, 2)]


def tables(spark, seen):
    """``seen``: (month, npi, practice, mailing, secondary street or None)."""

    def typed(columns, data):
        schema = ", ".join(f"`{c}` string" for c in ["npi", *columns]) + f", {SNAPSHOT_DATE} date"
        return spark.createDataFrame(data, schema)

    def at(street):
        return [street, None, "B", "MA", "02139", None]

    main = typed(
        [*PRACTICE_COLUMNS.values(), *MAILING_COLUMNS.values()],
        [(npi, *at(b), *at(m), month) for month, npi, b, m, _ in seen],
    )
    pl = typed(
        PL_COLUMNS.values(), [(npi, *at(s), month) for month, npi, _, _, s in seen if s is not None]
    )
    return main, pl


def observed():
    """A hall that most providers use, one address each, odd numbers, equal months."""
    out = []
    for turn, month in enumerate(MONTHS):
        for i in range(turn * 40, 100 + turn * 40):
            npi = str(1_000_000_000 + i * 997)
            out.append((month, npi, "HALL", f"{i} ROAD", "HALL" if i % 3 == 0 else None))
        out += [(month, npi, "HALL", "ODD", "ODD") for npi in ("007", "7", "abc", "", None, "9" * 25)]
    return out


@pytest.mark.parametrize("few", [0, 3, 256])
def test_counts_after_each_month_are_those_of_the_whole(spark, rows, tmp_path, few):
    seen, path = observed(), str(tmp_path)
    for turn, month in enumerate(MONTHS):
        part = tables(spark, [s for s in seen if s[0] == month])
        assert kept.update_usage(spark, path, *part, few=few) == [month]
        so_far = tables(spark, [s for s in seen if s[0] in MONTHS[: turn + 1]])
        assert rows(kept.read_usage(spark, path)) == rows(address_usage(*so_far))
    assert kept.update_usage(spark, path, *part, few=few) == []


def test_what_is_known_leaves_the_state_as_it_was(spark, rows):
    seen = observed()
    uses = kept.address_uses(*tables(spark, seen))
    once = kept.with_uses(None, uses, few=3)
    twice = kept.with_uses(once, uses, few=3)
    columns = [*kept.KEYS, "bits"]
    assert rows(twice, *columns) == rows(once, *columns)
    assert twice.where("size(places) > 3").isEmpty()
    hall = twice.where("address_key like 'HALL%' and use = 'b1' and bits is not null")
    # Many rows of one address: a group is no larger than a bucket of numbers.
    assert hall.count() > 1


def test_no_snapshot(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        kept.read_usage(spark, str(tmp_path))
    empty = tables(spark, [])
    assert kept.update_usage(spark, str(tmp_path), *empty) == []
