"""The notebook's indicator analyses as DataFrame functions over a long table.

Every function takes the long indicator table (``dashboard_section,
geography, geography_id, geography_type, characteristic, timeframe,
indicator_value, data_source``; the value may arrive as text or decimal) and
returns the frame behind one chart or table: the selection, reshaping,
ordering and "latest" logic run on the cluster, and only this (small)
result is for the caller to collect or plot.

Reshaping follows the reference's choices: pivots fill absent cells with 0
except the comparison tables; "latest" uses parsed years, never the text
maximum of the period.  Functions that filter by a global value (latest
year, median, fallback tier) accept ``share_input=True`` to compute their
input once (a checkpoint) instead of once per plan part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicstat.functions.labels import case_like, first_token, map_with_fallback, strip_literals
from civicstat.operators import longform as L
from civicstat.operators import profile as P
from civicstat.operators import rank
from civicstat.operators import reshape as R

# Section names and the characteristic names / patterns the
# analyses select on.
DEMOGRAPHICS = "demographics"
CORE_HOUSING_NEED = "core_housing_need"
AFFORDABILITY = "affordability"
HOUSING_SUPPLY = "housing_supply"
GROWTH_PROJECTIONS = "growth_projections"
ECONOMIC_INDICATORS = "economic_indicators"
PRIORITY_POPULATIONS = "priority_populations"
RENTAL_MARKET = "rental_market"
DEMOGRAPHIC_TABLE = ("Population", "Households", "Median Household Income", "Median Age",
                     "Employment Rate (%)", "Unemployment Rate (%)")
TENURE_RATES = ("Owner (rate)", "Renter (rate)")
RENTAL_UNITS = ("Primary Rental Units", "Secondary Rental Units")
RENTAL_INVENTORY = ("All Rental HHs", "Private rental market housing units", "Subsidized rental housing units")
NAICS_INDUSTRIES = (
    "44-45 Retail trade",
    "23 Construction",
    "62 Health care and social assistance",
    "54 Professional, scientific and technical services",
    "48-49 Transportation and warehousing",
    "21 Mining, quarrying, and oil and gas extraction",
    "61 Educational services",
    "91 Public administration",
    "72 Accommodation and food services",
    "31-33 Manufacturing",
)
NAICS_SHORT = {
    "44-45 Retail trade": "Retail",
    "23 Construction": "Construction",
    "62 Health care and social assistance": "Healthcare",
    "54 Professional, scientific and technical services": "Professional Svcs",
    "48-49 Transportation and warehousing": "Transportation",
    "21 Mining, quarrying, and oil and gas extraction": "Oil & Gas/Mining",
    "61 Educational services": "Education",
    "91 Public administration": "Public Admin",
    "72 Accommodation and food services": "Food & Accomm",
    "31-33 Manufacturing": "Manufacturing",
}

# The per-section exploration listings (S11): whether the
# source column is shown, and the sort order.
LISTINGS = {
    DEMOGRAPHICS: (True, ("geography", "characteristic", "timeframe")),
    CORE_HOUSING_NEED: (False, ("geography", "timeframe", "characteristic")),
    AFFORDABILITY: (False, ("geography", "characteristic")),
    HOUSING_SUPPLY: (True, ("geography", "characteristic", "timeframe")),
    GROWTH_PROJECTIONS: (False, ("geography", "characteristic")),
    ECONOMIC_INDICATORS: (True, ("geography", "characteristic", "timeframe")),
    PRIORITY_POPULATIONS: (False, ("geography", "characteristic")),
    RENTAL_MARKET: (True, ("geography", "characteristic", "timeframe")),
}

_VAL = "indicator_value"


def exploration_listing(long: DataFrame, section: str) -> DataFrame:
    """One section's rows, projected and sorted as its exploration cell."""
    from civicstat.sources.catalog import listing
    with_source, order = LISTINGS[section]
    cols = ["geography", "characteristic", "timeframe", _VAL] + (["data_source"] if with_source else [])
    return listing(L.normalise_value(long), section, cols, list(order))


def _prep(long: DataFrame) -> DataFrame:
    return L.with_year(L.normalise_value(long))


def _values(df: DataFrame, column: str, values: Sequence | None) -> list:
    return list(values) if values is not None else R.pivot_values(df, column)


def _ranked(long, section, characteristic, period, ascending=False) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=section, characteristics=[characteristic], periods=[period])
    order = F.col(_VAL).asc_nulls_first() if ascending else F.col(_VAL).desc_nulls_last()
    return sel.select("geography", _VAL).orderBy(order, "geography")


def _wide(sel: DataFrame, column: str, values, fill=0, index="geography") -> DataFrame:
    return R.pivot_unique(sel, index, column, _VAL, _values(sel, column, values), fill=fill)


def _stacked(sel: DataFrame, fragments: Sequence[str]) -> DataFrame:
    """Long form behind a stacked bar: value (0 for absent cells) and its base."""
    cells = sel.select("geography", "characteristic", F.coalesce(F.col(_VAL), F.lit(0.0)).alias(_VAL))
    out = R.stack_offsets(cells, "geography", "characteristic", _VAL)
    return out.withColumn("short_label", strip_literals("characteristic", fragments)) \
              .orderBy("geography", "characteristic")


# ---- 1 demographics ------------------------------------------------------

def population_by_community(long: DataFrame, period: str = "2011") -> DataFrame:
    return _ranked(long, DEMOGRAPHICS, "Population", period)


def population_compare(long: DataFrame, periods: Sequence[str] = ("2006", "2011")) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=DEMOGRAPHICS, characteristics=["Population"], periods=periods)
    cols = sorted(periods)
    return _wide(sel, "timeframe", cols).orderBy(cols[-1])


def dwelling_mix(long: DataFrame, period: str = "2011") -> DataFrame:
    sel = L.select_indicators(_prep(long), section=DEMOGRAPHICS, like="Dwelling:%", periods=[period])
    return _stacked(sel, ["Dwelling: "])


def demographics_table(long: DataFrame, period: str = "2011",
                       characteristics: Sequence[str] = DEMOGRAPHIC_TABLE, geographies=None) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=DEMOGRAPHICS, characteristics=characteristics, periods=[period])
    return _wide(sel, "geography", geographies, fill=None, index="characteristic").orderBy("characteristic")


# ---- 2 core housing need -------------------------------------------------

def chn_rate(long: DataFrame, period: str = "2021") -> DataFrame:
    return _ranked(long, CORE_HOUSING_NEED, "CHN rate", period)


def tenure_rates(long: DataFrame, period: str = "2021") -> DataFrame:
    sel = L.select_indicators(_prep(long), section=CORE_HOUSING_NEED, characteristics=TENURE_RATES, periods=[period])
    return _wide(sel, "characteristic", TENURE_RATES).orderBy("geography")


def chn_rate_compare(long: DataFrame, periods: Sequence[str] = ("2016", "2021")) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=CORE_HOUSING_NEED, characteristics=["CHN rate"], periods=periods)
    return _wide(sel, "timeframe", sorted(periods)).orderBy(sorted(periods)[-1])


def chn_by_income(long: DataFrame, period: str = "2021", values=None) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=CORE_HOUSING_NEED, like="%income HH in CHN", periods=[period])
    return _wide(sel, "characteristic", values).orderBy("geography")


# ---- 3 affordability -----------------------------------------------------

def median_income(long: DataFrame, period: str = "2021") -> DataFrame:
    return _ranked(long, AFFORDABILITY, "Median household income", period)


def rent_thresholds(long: DataFrame, period: str = "2021", values=None) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=AFFORDABILITY, like="Rent at%AMHI", periods=[period])
    return _wide(sel, "characteristic", values).orderBy("geography")


def affordability_table(long: DataFrame, period: str = "2021", geographies=None) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=AFFORDABILITY, periods=[period])
    return _wide(sel, "geography", geographies, fill=None, index="characteristic").orderBy("characteristic")


# ---- 4 housing supply ----------------------------------------------------

def rental_units(long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(wide table, duplicate cells).  No period filter, as in the reference:
    several periods per cell show up in the duplicate report instead of
    raising."""
    sel = L.select_indicators(_prep(long), section=HOUSING_SUPPLY, characteristics=RENTAL_UNITS)
    latest = rank.latest_per_group(sel, ["geography", "characteristic"], "year", [_VAL])
    return (_wide(latest, "characteristic", RENTAL_UNITS).orderBy("geography"),
            R.duplicate_cells(sel, "geography", "characteristic"))


def vacancy_latest_year(long: DataFrame, share_input: bool = False) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=HOUSING_SUPPLY, characteristics=["Vacancy Rate"])
    return rank.latest_global(sel, "year", share_input).select("geography", "year", _VAL).orderBy(_VAL)


def rental_inventory(long: DataFrame) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=HOUSING_SUPPLY, characteristics=RENTAL_INVENTORY)
    latest = rank.latest_per_group(sel, ["geography", "characteristic"], "year", [_VAL])
    return _stacked(latest, [" housing units", " rental market"])


# ---- 5 growth projections ------------------------------------------------

def projected_by_income(long: DataFrame, period: str = "2031", values=None) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=GROWTH_PROJECTIONS, like="%AMHI%", periods=[period])
    return _wide(sel, "characteristic", values).orderBy("geography")


def projected_by_size(long: DataFrame, period: str = "2031") -> DataFrame:
    sel = L.select_indicators(_prep(long), section=GROWTH_PROJECTIONS, like="%person%", periods=[period])
    return _stacked(sel, [])


def growth_table(long: DataFrame, period: str = "2031", geographies=None) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=GROWTH_PROJECTIONS, periods=[period])
    return _wide(sel, "geography", geographies, fill=None, index="characteristic").orderBy("characteristic")


# ---- 6 economic indicators -----------------------------------------------

def _series(long, section, **sel) -> DataFrame:
    s = L.select_indicators(_prep(long), section=section, **sel)
    return s.select("geography", "year", "timeframe", _VAL).orderBy("geography", "year")


def residential_permits_series(long: DataFrame) -> DataFrame:
    return _series(long, ECONOMIC_INDICATORS, like="%Residential%number%")


def ei_series(long: DataFrame) -> DataFrame:
    return _series(long, ECONOMIC_INDICATORS, characteristics=["EI Recipients"])


def permits_by_sector_latest(long: DataFrame, values=None) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=ECONOMIC_INDICATORS, like="Building Permits%number%",
                              not_like="%value%")
    latest = rank.latest_per_group(sel, ["geography", "characteristic"], "year", [_VAL])
    return _wide(latest, "characteristic", values).orderBy("geography")


def labour_force_top_industries(census: DataFrame, geo_dim: DataFrame, k: int = 6,
                                industries: Sequence[str] = NAICS_INDUSTRIES, communities=None,
                                share_input: bool = False, rules=(("%Rocky View%", "Rocky View"),),
                                labels: Mapping[str, str] = NAICS_SHORT) -> DataFrame:
    """Top-k industries by total workers, workers per (short label, community).

    census(geography_id, characteristic, indicator_value) joins the
    geography dimension; the IN list is a literal list (P5), the community
    label comes from a searched CASE over ``rules`` with a split fallback
    (F2, F3), the short label from ``labels`` with the name as fallback (F5).
    """
    c = L.normalise_value(census.filter(F.col("characteristic").isin(list(industries))))
    community = case_like("geography", list(rules), first_token(F.col("geography"), ","))
    rows = c.join(geo_dim.select("geography_id", "geography"), "geography_id").select(
        community.alias("community"), F.col("characteristic").alias("industry"), F.col(_VAL).alias("workers"))
    top = rank.keep_top_k(rows, "industry", "workers", k, "sum")
    labelled = top.withColumn("short", map_with_fallback("industry", labels))
    if share_input and communities is None:   # column discovery and pivot read it once
        from civicstat.session import materialize
        labelled = materialize(labelled)
    cols = _values(labelled, "community", communities)
    return R.pivot_agg(labelled, "short", "community", F.avg("workers"), cols, fill=0).orderBy("short")


# ---- 7 priority populations ----------------------------------------------

def priority_rates_avg(long: DataFrame, period: str = "2021", share_input: bool = False) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=PRIORITY_POPULATIONS, like="%rate%", periods=[period])
    a = sel.groupBy("characteristic").agg(F.avg(_VAL).alias("avg_rate"), F.count(F.lit(1)).alias("n_communities"),
                                          F.count(_VAL).alias("n_values"))
    return rank.above_median(a, "avg_rate", share_input=share_input).orderBy(F.col("avg_rate").desc())


def priority_top_groups(long: DataFrame, period: str = "2021", k: int = 6) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=PRIORITY_POPULATIONS, like="%rate%", periods=[period])
    top = rank.keep_top_k(sel, "characteristic", _VAL, k, "avg")
    return _wide(top, "characteristic", None).orderBy("geography")


# ---- 8 rental market -----------------------------------------------------

def vacancy_latest_per_community(long: DataFrame, share_input: bool = False) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=RENTAL_MARKET)
    picked = L.fallback_select(sel, [F.col("characteristic").like("Vacancy Rate%Total%"),
                                     F.col("characteristic").like("Vacancy Rate%")], share_input)
    latest = rank.latest_per_group(picked, "geography", "year", [_VAL], tiebreak=["characteristic"])
    return latest.select("geography", "year", "characteristic", _VAL).orderBy(_VAL)


def average_rent_latest(long: DataFrame, values=None) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=RENTAL_MARKET, like="Average Rent%")
    cols = _values(sel, "characteristic", values)
    return R.pivot_latest(sel, "geography", "characteristic", _VAL, "year", cols, fill=0).orderBy("geography")


def rent_trend(long: DataFrame) -> DataFrame:
    return _series(long, RENTAL_MARKET, any_like=["Avg Monthly Rent%", "Average Rent%Total%"])


def vacancy_trend(long: DataFrame) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=RENTAL_MARKET, like="Vacancy Rate%")
    return R.ordered_series(R.mean_series(sel, ["geography", "year"], _VAL, "mean_rate"), ["geography", "year"])


def housing_starts_latest(long: DataFrame, share_input: bool = False) -> DataFrame:
    sel = L.select_indicators(_prep(long), section=RENTAL_MARKET, like="Housing Starts%")
    latest = rank.latest_global(sel, "year", share_input)
    cells = latest.groupBy("geography", "characteristic").agg(F.sum(_VAL).alias(_VAL))
    return _stacked(cells, ["Housing Starts - ", "Housing Starts "])


# ---- summary ---------------------------------------------------------------

def completeness(long: DataFrame, approx: bool = False) -> DataFrame:
    return P.completeness_rollup(L.normalise_value(long), approx).orderBy("is_total", "dashboard_section")


REPORT = {
    "1.1": population_by_community, "1.2": population_compare, "1.3": dwelling_mix, "1.4": demographics_table,
    "2.1": chn_rate, "2.2": tenure_rates, "2.3": chn_rate_compare, "2.4": chn_by_income,
    "3.1": median_income, "3.2": rent_thresholds, "3.3": affordability_table,
    "4.1": rental_units, "4.2": vacancy_latest_year, "4.3": rental_inventory,
    "5.1": projected_by_income, "5.2": projected_by_size, "5.3": growth_table,
    "6.1": residential_permits_series, "6.2": ei_series, "6.3": permits_by_sector_latest,
    "6.4": labour_force_top_industries,
    "7.1": priority_rates_avg, "7.2": priority_top_groups,
    "8.1": vacancy_latest_per_community, "8.2": average_rent_latest, "8.3": rent_trend, "8.4": vacancy_trend,
    "8.5": housing_starts_latest, "summary": completeness,
}
