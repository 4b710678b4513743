"""From stored snapshot tables to the tables the profile is made of."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.operators.affiliations import (
    affiliation_edges,
    affiliation_summary,
    employer_directory,
    employer_roster,
)
from rosterline.operators.fold import TAXONOMIES
from rosterline.operators.lists import MAX_ITEMS, fields_in_parts, first_fields, further_fields
from rosterline.operators.payments import all_payments, payments_by_provider
from rosterline.operators.places import (
    address_cells,
    cell_organisations,
    colocation_lists,
    located_providers,
)
from rosterline.operators.rollups import clinician_facts, optout_dates
from rosterline.operators.snapshots import latest_partition
from rosterline.plans.histories import (
    array_runs,
    endpoint_se,
    license_se_of,
    otherid_se,
    othername_se,
    pl_se,
    taxonomy_se_of,
)
from rosterline.plans.profile import joined_profile, profile_base, profile_continuations
from rosterline.session import staged, staged_buckets, staged_together


@dataclass(frozen=True)
class RegistryTables:
    """Stored snapshot tables of the registry's own files."""

    npidata: DataFrame
    othername: DataFrame
    endpoint: DataFrame
    pl: DataFrame
    taxonomy_lookup: DataFrame
    #: ``otherid_se`` of ``npidata``, if it is stored already.
    otherids: DataFrame | None = None


@dataclass(frozen=True)
class OutsideTables:
    """Tables from other publishers; any of them may be missing."""

    reval: DataFrame | None = None
    pc_provider: DataFrame | None = None
    optout: DataFrame | None = None
    dac_ndf: DataFrame | None = None
    otherid_ccn_se: DataFrame | None = None
    general_payments: DataFrame | None = None
    research_payments: DataFrame | None = None


def history_tables(tables: RegistryTables) -> dict[str, DataFrame]:
    """All start-end tables, by the name of their list column in the profile.

    Taxonomies and licences come from the same arrays, whose histories are made once.
    """
    made = {} if tables.otherids is not None else {"otherids": otherid_se(tables.npidata)}
    runs = staged(array_runs(tables.npidata, TAXONOMIES), "taxonomy-runs")
    return {
        "places": pl_se(tables.pl),
        "taxonomies": taxonomy_se_of(runs, tables.taxonomy_lookup),
        "othernames": othername_se(tables.othername, tables.npidata),
        "licenses": license_se_of(runs),
        "endpoints": endpoint_se(tables.endpoint),
        **made,
    }


# Token column of each start-end table.
TOKEN_COLUMNS = {
    "places": "pl_token",
    "taxonomies": "taxonomy_token",
    "othernames": "othername_token",
    "licenses": "license_token",
    "endpoints": "endpoint_token",
    "otherids": "other_id_token",
    "otherids_ccn": "other_id_token",
}


def colocation(npidata: DataFrame, answers: DataFrame, step: float) -> tuple[DataFrame, DataFrame]:
    """Cell organisations and provider lists of the newest snapshot, both staged once."""
    cells = staged(address_cells(answers, step), "cells")
    located = staged(located_providers(latest_partition(npidata), cells), "located")
    organisations = staged(cell_organisations(located), "organisations")
    return organisations, colocation_lists(located, organisations)


def profile_facts(outside: OutsideTables, edges: DataFrame | None) -> list[DataFrame]:
    """Outside attributes, one row per npi each."""
    facts = []
    if edges is not None:
        facts += [affiliation_summary(edges), employer_roster(edges)]
    if outside.optout is not None:
        facts.append(optout_dates(outside.optout))
    if outside.dac_ndf is not None:
        facts.append(clinician_facts(outside.dac_ndf))
    return facts


def list_items(
    histories: dict[str, DataFrame], outside: OutsideTables, edges: DataFrame | None
) -> dict[str, DataFrame]:
    """npi and item of every list column of the profile, but for the payments."""
    tokens = {**histories, "otherids_ccn": outside.otherid_ccn_se}
    items = {
        name: history.select("npi", TOKEN_COLUMNS[name])
        for name, history in tokens.items()
        if history is not None
    }
    if edges is not None:
        of = edges.select(F.col("individual_npi").alias("npi"), "group_name_npi")
        items["groups"] = of.dropna().distinct()
    if "othernames" in histories:
        items["aka"] = histories["othernames"].select("npi", "othername").distinct()
    return items


def profile_flow(
    tables: RegistryTables,
    outside: OutsideTables,
    neighbours: DataFrame | None = None,
    max_items: int = MAX_ITEMS,
) -> tuple[DataFrame, DataFrame]:
    """Provider profile, and the continuations of lists that are too long for one row.

    All lists but the payments are built by one aggregation. The sides are written in buckets of
    npi, each once, so that the join of the profile shuffles nothing.
    """
    together = history_tables(tables)
    if outside.reval is not None and outside.pc_provider is not None:
        together["edges"] = affiliation_edges(outside.reval, outside.pc_provider)
    if outside.general_payments is not None and outside.research_payments is not None:
        paid = all_payments(outside.general_payments, outside.research_payments)
        together["payments"] = payments_by_provider(paid, max_items)
    histories = staged_together(together)
    edges, payments = histories.pop("edges", None), histories.pop("payments", None)
    if tables.otherids is not None:
        histories["otherids"] = tables.otherids
    items = list_items(histories, outside, edges)
    made, rest = fields_in_parts(items, "npi", max_items)
    parts = staged_buckets(made, "list-parts", "npi")
    lists = first_fields(parts, "npi", list(items))
    if "aka" in items:
        names = F.concat(F.lit("("), F.array_join("aka", ", "), F.lit(")"))
        lists = lists.withColumn("aka", names)
    further = further_fields(parts, "npi").unionByName(
        further_fields(staged(rest, "list-rest"), "npi")
    )
    sides = {"lists": lists}
    for i, fact in enumerate(profile_facts(outside, edges)):
        sides[f"fact-{i}"] = fact
    if payments is not None:
        more = F.col("total") > F.size("openpayments")
        sides["payments"] = payments.where(F.col("part") == 0).select(
            "npi", "openpayments", more.alias("more")
        )
        further = further.unionByName(profile_continuations([payments]))
    if neighbours is not None:
        sides["neighbours"] = neighbours.drop("entity_type_code", "name")
    bucketed = [staged_buckets(side, name, "npi") for name, side in sides.items()]
    base = staged_buckets(profile_base(tables.npidata), "base", "npi")
    return joined_profile(base, bucketed), further


def directory_flow(outside: OutsideTables) -> DataFrame:
    return employer_directory(
        staged(affiliation_edges(outside.reval, outside.pc_provider), "edges")
    )
