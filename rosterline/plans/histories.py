"""Start-end tables of every repeated attribute of a provider.

Each table has the typed value columns, ``<prefix>_dt_s`` / ``<prefix>_dt_e`` and one
``^``-joined export token per row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.fixed import (
    OTHER_ID_TYPES,
    OTHER_NAME_TYPES,
    PL_COLUMNS,
    SNAPSHOT_DATE,
)
from rosterline.functions.text import joined, or_empty, token
from rosterline.operators.fold import OTHER_IDS, TAXONOMIES, SlotGroup, malformed_slots, unpack
from rosterline.operators.history import (
    GAP_DAYS,
    apply_corrections,
    array_intervals,
    code_label,
    code_lookup,
    entry_intervals,
    se_intervals,
)


def slot_field(name: str) -> Column:
    """A slot's field without the two marks that separate fields and slots in packed text."""
    return F.translate(or_empty(F.col(f"_slot.{name}")), "^|", "")


def finish(df: DataFrame, prefix: str, values: list[str], token_col: str) -> DataFrame:
    start, end = f"{prefix}_dt_s", f"{prefix}_dt_e"
    return df.select(
        "npi", token(*values, start, end).alias(token_col), *values, start, end
    )


@dataclass(frozen=True)
class History:
    """What a start-end table is made of: its values in each snapshot row, and its last steps.

    ``seen`` gives ``npi``, the values and the snapshot date; ``table`` makes the published table
    of their intervals.
    """

    prefix: str
    values: tuple[str, ...]
    seen: Callable[[DataFrame], DataFrame]
    table: Callable[[DataFrame], DataFrame]

    @property
    def keys(self) -> list[str]:
        return ["npi", *self.values]

    @property
    def dates(self) -> tuple[str, str]:
        return f"{self.prefix}_dt_s", f"{self.prefix}_dt_e"


# Value columns of the tables of slots, by the slot's field.
OTHERID_VALUES = {
    "other_id": "identifier",
    "other_id_type_code": "type_code",
    "other_id_state": "state",
    "other_id_issuer": "issuer",
}
TAXONOMY_VALUES = {"taxonomy_code": "code", "is_main": "primary_switch"}
LICENSE_VALUES = {"license_number": "license_number", "license_state": "license_state"}


def _slot_values(fields: dict[str, str]) -> dict[str, Column]:
    return {name: slot_field(field) for name, field in fields.items()}


def _slots_seen(group: SlotGroup, fields: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    def seen(rows: DataFrame) -> DataFrame:
        slots = rows.select("npi", SNAPSHOT_DATE, F.explode(group.name).alias("_slot"))
        values = [value.alias(name) for name, value in _slot_values(fields).items()]
        return slots.select("npi", *values, SNAPSHOT_DATE)

    return seen


def array_runs(npidata: DataFrame, group: SlotGroup, gap_days: int = GAP_DAYS) -> DataFrame:
    """Histories of whole slot arrays, which the tables of single entries start from."""
    return array_intervals(npidata, "npi", group.name, SNAPSHOT_DATE, gap_days)


def otherid_se(npidata: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    runs = entry_intervals(
        array_runs(npidata, OTHER_IDS, gap_days), "npi", OTHER_IDS.name,
        _slot_values(OTHERID_VALUES), gap_days, "other_id_dt_s", "other_id_dt_e",
    )
    return otherid_table(runs)


def otherid_table(runs: DataFrame) -> DataFrame:
    values = [*OTHERID_VALUES]
    described = runs.where(F.col("other_id") != "").withColumn(
        "other_id_type_desc", code_label("other_id_type_code", OTHER_ID_TYPES)
    )
    return finish(described, "other_id", [*values, "other_id_type_desc"], "other_id_token")


def otherid_se_packed(
    npidata: DataFrame, packed: str = OTHER_IDS.name, gap_days: int = GAP_DAYS
) -> DataFrame:
    """``otherid_se`` of packed text, listed wrong values put right before it is split.

    Slots with another number of fields have no columns to go to: see ``otherid_rejects``.
    """
    right = apply_corrections(npidata.select("npi", packed, SNAPSHOT_DATE), "npi", packed)
    return otherid_se(
        right.select("npi", unpack(packed, OTHER_IDS).alias(OTHER_IDS.name), SNAPSHOT_DATE),
        gap_days,
    )


def otherid_rejects(npidata: DataFrame, packed: str = OTHER_IDS.name) -> DataFrame:
    """``npi``, snapshot date and ``slot``: what ``otherid_se_packed`` cannot split, row by row."""
    right = apply_corrections(npidata.select("npi", packed, SNAPSHOT_DATE), "npi", packed)
    slots = F.explode(malformed_slots(packed, OTHER_IDS))
    return right.select("npi", SNAPSHOT_DATE, slots.alias("slot"))


def taxonomy_se(
    npidata: DataFrame, taxonomy_lookup: DataFrame, gap_days: int = GAP_DAYS
) -> DataFrame:
    """A change of the primary switch starts a new interval."""
    return taxonomy_se_of(array_runs(npidata, TAXONOMIES, gap_days), taxonomy_lookup, gap_days)


def taxonomy_se_of(
    runs: DataFrame, taxonomy_lookup: DataFrame, gap_days: int = GAP_DAYS
) -> DataFrame:
    """``taxonomy_se`` from the histories of whole taxonomy arrays."""
    entries = entry_intervals(
        runs, "npi", TAXONOMIES.name, _slot_values(TAXONOMY_VALUES), gap_days,
        "taxonomy_dt_s", "taxonomy_dt_e",
    )
    return taxonomy_table(entries, taxonomy_lookup)


def taxonomy_table(entries: DataFrame, taxonomy_lookup: DataFrame) -> DataFrame:
    described = code_lookup(
        entries.where(F.col("taxonomy_code") != ""),
        taxonomy_lookup,
        "taxonomy_code",
        "taxonomy_desc",
    )
    return finish(
        described, "taxonomy", ["taxonomy_code", "is_main", "taxonomy_desc"], "taxonomy_token"
    )


def license_se(npidata: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    """The taxonomy of a licence is left out, so one licence on two slots is one value."""
    return license_se_of(array_runs(npidata, TAXONOMIES, gap_days), gap_days)


def license_se_of(runs: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    """``license_se`` from the histories of whole taxonomy arrays."""
    entries = entry_intervals(
        runs, "npi", TAXONOMIES.name, _slot_values(LICENSE_VALUES), gap_days,
        "license_dt_s", "license_dt_e",
    )
    return license_table(entries)


def license_table(entries: DataFrame) -> DataFrame:
    return finish(
        entries.where(F.col("license_number") != ""),
        "license", list(LICENSE_VALUES), "license_token",
    )


def othername_se(
    othername: DataFrame | None = None,
    npidata: DataFrame | None = None,
    gap_days: int = GAP_DAYS,
) -> DataFrame:
    """Other names of organisations (side file) and of persons (main file), in one table."""
    seen = []
    if othername is not None:
        seen.append(_organisation_names(othername))
    if npidata is not None:
        seen.append(_person_names(npidata))
    sources = [
        se_intervals(
            names, _NAME_KEYS, SNAPSHOT_DATE, gap_days, "othername_dt_s", "othername_dt_e"
        )
        for names in seen
    ]
    return othername_table(sources[0] if len(sources) == 1 else sources[0].unionByName(sources[1]))


_NAME_KEYS = ["npi", "othername", "othername_type_code"]


def _organisation_names(othername: DataFrame) -> DataFrame:
    return _names(
        othername,
        or_empty("provider_other_organization_name"),
        or_empty("provider_other_organization_name_type_code"),
    )


def _person_names(npidata: DataFrame) -> DataFrame:
    person = joined(
        " ",
        "provider_other_first_name",
        "provider_other_middle_name",
        "provider_other_last_name",
    )
    return _names(npidata, person, or_empty("provider_other_last_name_type_code"))


def othername_table(names: DataFrame) -> DataFrame:
    return finish(
        names.withColumn(
            "othername_type_desc", code_label("othername_type_code", OTHER_NAME_TYPES)
        ),
        "othername", ["othername", "othername_type_code", "othername_type_desc"],
        "othername_token",
    )


def _names(df: DataFrame, name: Column, type_code: Column) -> DataFrame:
    return df.select(
        "npi",
        name.alias("othername"),
        type_code.alias("othername_type_code"),
        SNAPSHOT_DATE,
    ).where(F.col("othername") != "")


def endpoint_se(endpoint: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    return _whole(ENDPOINTS, endpoint, gap_days)


def _endpoints(endpoint: DataFrame) -> DataFrame:
    return endpoint.select(
        "npi",
        or_empty("endpoint_type").alias("endpoint_type"),
        or_empty("endpoint").alias("endpoint"),
        SNAPSHOT_DATE,
    ).where(F.col("endpoint") != "")


def pl_se(pl: DataFrame, gap_days: int = GAP_DAYS) -> DataFrame:
    """Secondary practice locations; only the token and the dates are kept."""
    return _whole(PLACES, pl, gap_days)


_PL_PARTS = ["line1", "line2", "city", "state", "postal_code"]


def _places(pl: DataFrame) -> DataFrame:
    return pl.select(
        "npi", *[or_empty(PL_COLUMNS[p]).alias(p) for p in _PL_PARTS], SNAPSHOT_DATE
    )


def _whole(history: History, rows: DataFrame, gap_days: int) -> DataFrame:
    """A start-end table out of all snapshots at once."""
    start, end = history.dates
    runs = se_intervals(
        history.seen(rows), history.keys, SNAPSHOT_DATE, gap_days, start, end
    )
    return history.table(runs)


OTHERIDS = History(
    "other_id", tuple(OTHERID_VALUES), _slots_seen(OTHER_IDS, OTHERID_VALUES), otherid_table
)
LICENSES = History(
    "license", tuple(LICENSE_VALUES), _slots_seen(TAXONOMIES, LICENSE_VALUES), license_table
)
ORGANISATION_NAMES = History(
    "othername", tuple(_NAME_KEYS[1:]), _organisation_names, othername_table
)
PERSON_NAMES = History("othername", tuple(_NAME_KEYS[1:]), _person_names, othername_table)
ENDPOINTS = History(
    "endpoint",
    ("endpoint_type", "endpoint"),
    _endpoints,
    lambda runs: finish(runs, "endpoint", ["endpoint_type", "endpoint"], "endpoint_token"),
)
PLACES = History(
    "pl",
    tuple(_PL_PARTS),
    _places,
    lambda runs: finish(runs, "pl", _PL_PARTS, "pl_token").drop(*_PL_PARTS),
)


def taxonomies(taxonomy_lookup: DataFrame) -> History:
    return History(
        "taxonomy",
        tuple(TAXONOMY_VALUES),
        _slots_seen(TAXONOMIES, TAXONOMY_VALUES),
        lambda runs: taxonomy_table(runs, taxonomy_lookup),
    )
