"""The reference's warehouse layout, for running our operators against it.

* ``layout_spec`` builds the ``StarSchemaSpec`` of its star schema (three
  dimensions, seventeen facts) so ``operators.validator.validate`` runs
  every check category against a real catalog schema.  Truth values are a
  parameter (``TruthSpec`` list); none are shipped here.
* ``publish_section_views`` creates one view per section of the long table
  (plus the geography passthrough) with comments, and
  ``retire_star_tables`` drops the star tables (dry run by default), the two
  steps of the rebuild script.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from civicstat.operators.validator import SpotSpec, StarSchemaSpec, SumCloseSpec, TotalEqualSpec, TruthSpec
from civicstat.plans import dashboards as D
from civicstat.sources.catalog import register_catalog_view, retire_tables

# Star tables and their expected row counts, in the reference's order.
EXPECTED_ROWS = {
    "geography_dim": 7,
    "timeframe_dim": 20,
    "source_dim": 12,
    "hna_demographics_csd_2021": 7,
    "hna_housing_indicators_csd_2021": 7,
    "hna_income_categories_csd_2021": 35,
    "hna_housing_deficit_csd_2021": 175,
    "hna_rental_supply_csd_2021": 7,
    "hna_priority_groups_csd_2021": 41,
    "hna_economic_snapshot_csd_2021": 7,
    "hna_structure_type_csd_2006_2021": 56,
    "hna_shelter_cost_csd_2006_2021": 40,
    "hna_income_distribution_csd_2006_2021": 144,
    "hna_dwelling_values_csd_2006_2021": 56,
    "hna_median_income_csd_2006_2021": 8,
    "cmhc_rental_market_csd_2016_2025": 70,
    "cmhc_housing_starts_csd_2016_2024": 400,
    "hna_chn_tenure_csd_2016_2021": 14,
    "ei_recipients_csd_2016_2024": 63,
    "hna_building_permits_csd_2016_2024": 112,
}
DIMENSIONS = ("geography_dim", "timeframe_dim", "source_dim")
GEO_FACTS = tuple(t for t in EXPECTED_ROWS if t not in DIMENSIONS)
TIMEFRAME_FACTS = (
    "hna_structure_type_csd_2006_2021", "hna_shelter_cost_csd_2006_2021",
    "hna_income_distribution_csd_2006_2021", "hna_dwelling_values_csd_2006_2021",
    "hna_median_income_csd_2006_2021", "cmhc_rental_market_csd_2016_2025",
    "cmhc_housing_starts_csd_2016_2024", "hna_chn_tenure_csd_2016_2021",
    "ei_recipients_csd_2016_2024", "hna_building_permits_csd_2016_2024",
)
COMMUNITY_KEYS = ("airdrie", "cochrane", "okotoks", "chestermere", "strathmore", "rockyview", "crossfield")
VERIFIED_COMMUNITIES = ("airdrie", "cochrane")
CENSUS_YEARS = (2006, 2011, 2016, 2021)
SOURCE_COUNT = 12
# Table naming standard: <source>_<topic>_csd_<year>[_<year>] for facts, <name>_dim for dimensions.
NAME_PATTERN = r"^([a-z]+_dim|[a-z]+(_[a-z]+)+_csd_[0-9]{4}(_[0-9]{4})?)$"
SECTIONS = ("demographics", "core_housing_need", "affordability", "housing_supply", "growth_projections",
            "economic_indicators", "priority_populations", "rental_market")


def layout_spec(truths: Sequence[TruthSpec] = (), expected_objects: int | None = len(EXPECTED_ROWS),
                extra_spots: Sequence[SpotSpec] = ()) -> StarSchemaSpec:
    """Spec of the star schema: counts, keys, FKs, nulls, consistency, traceability, spots."""
    return StarSchemaSpec(
        expected_rows=EXPECTED_ROWS,
        geo_facts=GEO_FACTS,
        timeframe_facts=TIMEFRAME_FACTS,
        expected_geo_keys=COMMUNITY_KEYS,
        expected_census_years=CENSUS_YEARS,
        expected_sources=SOURCE_COUNT,
        truths=tuple(truths),
        total_equal=(TotalEqualSpec("priority_total=chn_total", D.PRIORITY_GROUPS, "chn_count",
                                    D.HOUSING_INDICATORS, "chn_total",
                                    left_filter=f"priority_group = '{D.COMMUNITY_TOTAL}'"),),
        sum_close=(SumCloseSpec("income_sum~=households", D.INCOME_CATEGORIES, "household_count",
                                D.DEMOGRAPHICS, "households", bound=10),),
        spots=(
            SpotSpec("bachelor rent row present (airdrie 2024)", D.RENTAL_MARKET,
                     "geography_key = 'airdrie' AND timeframe_id = 2024", minimum=1),
            SpotSpec("bachelor rent suppressed (airdrie 2024)", D.RENTAL_MARKET,
                     "geography_key = 'airdrie' AND timeframe_id = 2024 AND rent_bachelor IS NOT NULL", maximum=0),
            SpotSpec("co-op units all 0", D.RENTAL_SUPPLY, "co_op_units != 0", maximum=0),
            SpotSpec("smallest communities present", D.DEMOGRAPHICS,
                     "geography_key IN ('crossfield', 'strathmore')", minimum=2),
        ) + tuple(extra_spots),
        expected_objects=expected_objects,
        name_pattern=NAME_PATTERN,
        verified=VERIFIED_COMMUNITIES,
    )


def publish_section_views(spark: SparkSession, source_table: str, target_schema: str,
                          geography_table: str | None = None,
                          comments: Mapping[str, str] | None = None,
                          sections: Sequence[str] = SECTIONS) -> DataFrame:
    """One ``v_<section>`` view per section over the long table, with comments.

    Returns (object_name, action, status) rows; a failing statement is
    reported, not raised, like the rebuild script's OK / FAIL lines.
    """
    comments = comments or {}
    rows = []
    targets = [(f"{target_schema}.v_{s}", s) for s in sections]
    if geography_table:
        targets.insert(0, (f"{target_schema}.v_geography", None))
    for name, section in targets:
        try:
            register_catalog_view(spark, name, geography_table if section is None else source_table,
                                  section=section, comment=comments.get(section or "geography"))
            rows.append((name, "create view", "OK"))
        except Exception as e:  # noqa: BLE001 - reported per object
            rows.append((name, "create view", "FAIL: " + str(e).splitlines()[0][:100]))
    return spark.createDataFrame(rows, "object_name string, action string, status string")


def retire_star_tables(spark: SparkSession, schema: str, dry_run: bool = True) -> DataFrame:
    """Drop the twenty star tables of ``schema`` (dry run by default)."""
    return retire_tables(spark, [f"{schema}.{t}" for t in EXPECTED_ROWS], dry_run=dry_run)
