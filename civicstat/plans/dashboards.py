"""The twenty star-schema dashboard queries as DataFrame functions.

Each function takes a table accessor ``t(name) -> DataFrame`` (for example
``Tables(spark, catalog="cat.schema")``) and returns the query's frame.
Facts join the small geography dimension on ``geography_id`` (broadcast
after Spark's size check); filters on the community key are applied to the
dimension side, and the fact side only reads the columns it projects.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstat.functions.labels import COST_BAND_ORDER, INCOME_BAND_ORDER, INCOME_TIER_ORDER, category_ordinal
from civicstat.operators.star import coverage_union

Accessor = Callable[[str], DataFrame]

# Table names of the star schema read by the dashboard queries.
GEOGRAPHY_DIM = "geography_dim"
DEMOGRAPHICS = "hna_demographics_csd_2021"
HOUSING_INDICATORS = "hna_housing_indicators_csd_2021"
INCOME_CATEGORIES = "hna_income_categories_csd_2021"
HOUSING_DEFICIT = "hna_housing_deficit_csd_2021"
RENTAL_SUPPLY = "hna_rental_supply_csd_2021"
PRIORITY_GROUPS = "hna_priority_groups_csd_2021"
ECONOMIC_SNAPSHOT = "hna_economic_snapshot_csd_2021"
STRUCTURE_TYPE = "hna_structure_type_csd_2006_2021"
SHELTER_COST = "hna_shelter_cost_csd_2006_2021"
INCOME_DISTRIBUTION = "hna_income_distribution_csd_2006_2021"
DWELLING_VALUES = "hna_dwelling_values_csd_2006_2021"
MEDIAN_INCOME = "hna_median_income_csd_2006_2021"
RENTAL_MARKET = "cmhc_rental_market_csd_2016_2025"
HOUSING_STARTS = "cmhc_housing_starts_csd_2016_2024"
CHN_TENURE = "hna_chn_tenure_csd_2016_2021"
EI_RECIPIENTS = "ei_recipients_csd_2016_2024"
BUILDING_PERMITS = "hna_building_permits_csd_2016_2024"
COMMUNITY_TOTAL = "community_total"
DEFAULT_COMMUNITY = "airdrie"          # community key the single-community queries filter on


def _facts(t: Accessor, fact: str, cols: list, community: str | None = None) -> DataFrame:
    """fact JOIN geography_dim, optionally restricted to one community key."""
    g = t(GEOGRAPHY_DIM).select("geography_id", "geography_key", "geography")
    if community is not None:
        g = g.filter(F.col("geography_key") == community)
    return t(fact).join(g, "geography_id").select(*cols)


def _c(name, alias=None):
    return F.col(name).alias(alias or name)


def regional_overview(t: Accessor) -> DataFrame:
    return _facts(t, DEMOGRAPHICS, [
        _c("geography", "community"), _c("pop_2021", "population_2021"), _c("pop_2016", "population_2016"),
        _c("growth_5yr_pct", "growth_pct"), "households", "median_income", "median_rent", "tenant_pct",
    ]).orderBy(F.col("population_2021").desc())


def core_housing_need(t: Accessor) -> DataFrame:
    return _facts(t, HOUSING_INDICATORS, [
        _c("geography", "community"), "chn_total", _c("chn_pct", "chn_rate"), _c("chn_owner_pct", "owner_rate"),
        _c("chn_renter_pct", "renter_rate"), "inadequate_count", "unsuitable_count", "unaffordable_count",
    ]).orderBy(F.col("chn_rate").desc())


def income_categories(t: Accessor) -> DataFrame:
    return _facts(t, INCOME_CATEGORIES, [
        _c("geography", "community"), "income_tier", "household_pct", "household_count", "max_shelter_cost",
    ]).orderBy("community", category_ordinal("income_tier", INCOME_TIER_ORDER))


def rental_supply(t: Accessor) -> DataFrame:
    return _facts(t, RENTAL_SUPPLY, [
        _c("geography", "community"), "total_rental", "primary_rental", "secondary_rental", "primary_pct",
        "subsidized", "subsidized_pct", "below_market", "co_op_units", "affordable_net_change",
    ]).orderBy(F.col("total_rental").desc())


def structure_types(t: Accessor) -> DataFrame:
    return _facts(t, STRUCTURE_TYPE, [
        _c("geography", "community"), _c("timeframe_id", "year"), "structure_type", "dwelling_count",
    ]).orderBy("community", "year", "structure_type")


def economic_snapshot(t: Accessor) -> DataFrame:
    return _facts(t, ECONOMIC_SNAPSHOT, [
        _c("geography", "community"), "unemployment_rate_2021", _c("lim_all_pop_pct", "low_income_pct"),
        "avg_sale_price", "owner_income", "renter_income", "net_commuter_flow_2021", "net_commuter_flow_change_pct",
    ]).orderBy(F.col("unemployment_rate_2021").desc())


def vacancy_trends(t: Accessor) -> DataFrame:
    return (_facts(t, RENTAL_MARKET, [_c("geography", "community"), _c("timeframe_id", "year"),
                                      "vacancy_rate", "avg_rent", "rent_yoy_change"])
            .filter(F.col("vacancy_rate").isNotNull()).orderBy("community", "year"))


def rent_trends(t: Accessor) -> DataFrame:
    return (_facts(t, RENTAL_MARKET, [_c("geography", "community"), _c("timeframe_id", "year"), "avg_rent"])
            .filter(F.col("avg_rent").isNotNull()).orderBy("community", "year"))


def _starts(t: Accessor, dimension: str, label: str, community: str) -> DataFrame:
    f = t(HOUSING_STARTS).filter(F.col("dimension_type") == dimension)
    g = t(GEOGRAPHY_DIM).filter(F.col("geography_key") == community).select("geography_id", "geography")
    return (f.join(g, "geography_id")
            .select(_c("geography", "community"), _c("timeframe_id", "year"), _c("category", label), "starts_count")
            .orderBy("year", label))


def starts_by_structure(t: Accessor, community: str = DEFAULT_COMMUNITY) -> DataFrame:
    return _starts(t, "structure_type", "category", community)


def starts_by_tenure(t: Accessor, community: str = DEFAULT_COMMUNITY) -> DataFrame:
    return _starts(t, "tenure", "tenure", community)


def ei_series(t: Accessor) -> DataFrame:
    return _facts(t, EI_RECIPIENTS, [_c("geography", "community"), _c("timeframe_id", "year"),
                                     "recipient_count"]).orderBy("community", "year")


def priority_groups(t: Accessor, community: str = DEFAULT_COMMUNITY) -> DataFrame:
    """Detail rows only: the stored community total is excluded."""
    return (_facts(t, PRIORITY_GROUPS, ["priority_group", "chn_count", "chn_rate"], community)
            .filter(F.col("priority_group") != COMMUNITY_TOTAL).orderBy(F.col("chn_count").desc()))


def shelter_cost(t: Accessor, community: str = DEFAULT_COMMUNITY) -> DataFrame:
    return (_facts(t, SHELTER_COST, [_c("timeframe_id", "year"), "cost_band", "household_count"], community)
            .orderBy("year", category_ordinal("cost_band", COST_BAND_ORDER)))


def income_distribution(t: Accessor, community: str = DEFAULT_COMMUNITY, tenure: str = "total") -> DataFrame:
    return (_facts(t, INCOME_DISTRIBUTION, [_c("timeframe_id", "year"), "tenure", "income_band", "household_count"],
                   community)
            .filter(F.col("tenure") == tenure)
            .orderBy("year", category_ordinal("income_band", INCOME_BAND_ORDER)))


def median_income(t: Accessor) -> DataFrame:
    return _facts(t, MEDIAN_INCOME, [
        _c("geography", "community"), _c("timeframe_id", "year"), "median_total", "median_owner",
        "median_renter", "avg_total", "avg_owner", "avg_renter"]).orderBy("community", "year")


def dwelling_values(t: Accessor, community: str = DEFAULT_COMMUNITY,
                    excluded: tuple = ("other", "high_rise")) -> DataFrame:
    return (_facts(t, DWELLING_VALUES, [_c("timeframe_id", "year"), "structure_type", "avg_dwelling_value"],
                   community)
            .filter(~F.col("structure_type").isin(list(excluded)) & (F.col("avg_dwelling_value") > 0))
            .orderBy("year", "structure_type"))


def chn_by_tenure(t: Accessor) -> DataFrame:
    return _facts(t, CHN_TENURE, [
        _c("geography", "community"), _c("timeframe_id", "year"), "chn_owner_count", "chn_owner_rate",
        "chn_renter_count", "chn_renter_rate"]).orderBy("community", "year")


def building_permits(t: Accessor, community: str = DEFAULT_COMMUNITY) -> DataFrame:
    return _facts(t, BUILDING_PERMITS, [_c("geography", "community"), _c("timeframe_id", "year"),
                                        "permit_sector", "permit_count"], community).orderBy("year", "permit_sector")


def housing_deficit(t: Accessor, community: str = DEFAULT_COMMUNITY) -> DataFrame:
    return (_facts(t, HOUSING_DEFICIT, ["income_tier", "household_size", "deficit_count", "deficit_unsubsidized",
                                        "deficit_subsidized"], community)
            .filter(F.col("deficit_count") > 0)
            .orderBy(category_ordinal("income_tier", INCOME_TIER_ORDER), "household_size"))


COMPLETENESS_TABLES = (DEMOGRAPHICS, STRUCTURE_TYPE, EI_RECIPIENTS, HOUSING_STARTS, PRIORITY_GROUPS)


def completeness_summary(t: Accessor, tables: tuple = COMPLETENESS_TABLES) -> DataFrame:
    """Rows per community in each fact, stacked (inner join: zero cells absent;
    see ``operators.profile.coverage_matrix`` for the grid with zeros)."""
    g = t(GEOGRAPHY_DIM).select("geography_id", "geography")
    parts = {name: t(name).select("geography_id").join(g, "geography_id") for name in tables}
    return coverage_union(parts, "geography").orderBy("table_name", "community")


DASHBOARD = {
    "regional_overview": regional_overview, "core_housing_need": core_housing_need,
    "income_categories": income_categories, "rental_supply": rental_supply, "structure_types": structure_types,
    "economic_snapshot": economic_snapshot, "vacancy_trends": vacancy_trends, "rent_trends": rent_trends,
    "starts_by_structure": starts_by_structure, "starts_by_tenure": starts_by_tenure, "ei_series": ei_series,
    "priority_groups": priority_groups, "shelter_cost": shelter_cost, "income_distribution": income_distribution,
    "median_income": median_income, "dwelling_values": dwelling_values, "chn_by_tenure": chn_by_tenure,
    "building_permits": building_permits, "housing_deficit": housing_deficit,
    "completeness_summary": completeness_summary,
}
