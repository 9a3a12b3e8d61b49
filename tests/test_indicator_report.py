"""Notebook analyses on an invented long table (values arrive as text)."""

import inspect

import pytest

from civicstat.plans import indicator_report as IR

G = [("Alderton", "1"), ("Brookfield", "2"), ("Cedarvale", "3")]


def _rows():
    out = []

    def add(section, char, tf, vals, src="s"):
        for (g, gid), v in zip(G, vals):
            if v is not False:
                out.append((section, g, gid, "CSD", char, tf, None if v is None else str(v), src))
    add("demographics", "Population", "2006", [100, 50, 70])
    add("demographics", "Population", "2011", [120, 60, None])
    add("demographics", "Population", "Percentage of all HHs", [5, 5, 5])
    add("demographics", "Dwelling: Single", "2011", [10, 20, 30])
    add("demographics", "Dwelling: Row", "2011", [1, False, 3])
    add("demographics", "Households", "2011", [40, 20, "n/a"])
    add("core_housing_need", "CHN rate", "2016", [7.0, 6.0, 5.0])
    add("core_housing_need", "CHN rate", "2021", [7.7, 6.8, 5.0])
    add("core_housing_need", "Owner (rate)", "2021", [4.6, 3.6, False])
    add("core_housing_need", "Very low income HH in CHN", "2021", [100, 50, 20])
    add("affordability", "Median household income", "2021", [110000, 113000, 95000])
    add("affordability", "Rent at 30% of AMHI", "2021", [1500, 1400, 1300])
    add("housing_supply", "Primary Rental Units", "2019", [1, 2, 3])
    add("housing_supply", "Primary Rental Units", "2021", [1543, 212, 520])
    add("housing_supply", "Secondary Rental Units", "2021", [3892, 1738, False])
    add("housing_supply", "Vacancy Rate", "2022", [2.0, 3.0, 4.0])
    add("housing_supply", "Vacancy Rate", "2023", [1.5, 2.5, False])
    add("housing_supply", "All Rental HHs", "2021", [5435, 1950, 1818])
    add("growth_projections", "Households at 30% AMHI", "2031", [10, 20, 30])
    add("growth_projections", "1 person", "2031", [5, 6, 7])
    add("growth_projections", "2 person", "2031", [8, 9, 10])
    add("economic_indicators", "Building Permits - Residential (number)", "2022", [10, 11, 12])
    add("economic_indicators", "Building Permits - Residential (number)", "2023", [13, False, 15])
    add("economic_indicators", "Building Permits - Residential (value)", "2023", [1e6, 2e6, 3e6])
    add("economic_indicators", "EI Recipients", "2016", [1361, 443, 245])
    add("priority_populations", "Seniors CHN rate", "2021", [9.0, 5.0, 4.0])
    add("priority_populations", "Youth (rate)", "2021", [12.0, 8.0, None])
    add("rental_market", "Vacancy Rate - Bachelor", "2023", [1.0, 2.0, 3.0])
    add("rental_market", "Vacancy Rate - Bachelor", "2024", [1.1, False, 3.3])
    add("rental_market", "Average Rent - Total", "2023", [1600, 1300, 1200])
    add("rental_market", "Average Rent - Total", "2024", [1650, None, 1250])
    add("rental_market", "Housing Starts - Single", "2024", [30, 10, 5])
    add("rental_market", "Housing Starts - Single", "2023", [20, 10, 5])
    return out


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame(_rows(), "dashboard_section string, geography string, geography_id string, "
                                          "geography_type string, characteristic string, timeframe string, "
                                          "indicator_value string, data_source string")


@pytest.fixture(scope="module")
def census(spark):
    rows = [("1", "23 Construction", 500.0), ("1", "44-45 Retail trade", 300.0), ("2", "23 Construction", 200.0),
            ("2", "99 Not listed", 999.0), ("3", "61 Educational services", 50.0)]
    geo = [("1", "Alderton, Town"), ("2", "Rocky View Brookfield, MD"), ("3", "Cedarvale, City")]
    return (spark.createDataFrame(rows, "geography_id string, characteristic string, indicator_value double"),
            spark.createDataFrame(geo, "geography_id string, geography string"))


def test_every_analysis_runs(long, census):
    assert len(IR.REPORT) == 29
    for key, fn in IR.REPORT.items():
        if key == "6.4":
            out = fn(*census)
        else:
            out = fn(long)
        for df in (out if isinstance(out, tuple) else (out,)):
            df.collect()


def test_population_ranked_numeric(long):
    assert [(r.geography, r.indicator_value) for r in IR.population_by_community(long).collect()] == [
        ("Alderton", 120.0), ("Brookfield", 60.0), ("Cedarvale", None)]


def test_population_compare_filled_and_sorted(long):
    got = [(r.geography, r["2006"], r["2011"]) for r in IR.population_compare(long).collect()]
    assert got == [("Cedarvale", 70.0, 0.0), ("Brookfield", 50.0, 60.0), ("Alderton", 100.0, 120.0)]


def test_dwelling_stack(long):
    got = {(r.geography, r.short_label): (r.indicator_value, r.offset) for r in IR.dwelling_mix(long).collect()}
    assert ("Brookfield", "Row") not in got                 # absent cell: contributes 0 to the stack
    assert got[("Brookfield", "Single")] == (20.0, 0.0)
    assert got[("Alderton", "Single")] == (10.0, 1.0)       # 'Row' sorts before 'Single'


def test_tenure_rates_absent_renter_column(long):
    wide = IR.tenure_rates(long)
    assert wide.columns == ["geography", "Owner (rate)", "Renter (rate)"]
    assert {r["Renter (rate)"] for r in wide.collect()} == {0.0}


def test_rental_units_latest_and_duplicates(long):
    wide, dups = IR.rental_units(long)
    got = {r.geography: r["Primary Rental Units"] for r in wide.collect()}
    assert got == {"Alderton": 1543.0, "Brookfield": 212.0, "Cedarvale": 520.0}
    assert dups.count() == 3


def test_vacancy_latest_year_drops_stale(long):
    assert [r.geography for r in IR.vacancy_latest_year(long).collect()] == ["Alderton", "Brookfield"]


def test_permits_latest_per_community(long):
    got = {r.geography: r["Building Permits - Residential (number)"] for r in IR.permits_by_sector_latest(long).collect()}
    assert got == {"Alderton": 13.0, "Brookfield": 11.0, "Cedarvale": 15.0}


def test_labour_force(census):
    out = IR.labour_force_top_industries(*census, k=2)
    got = {r.short: (r["Alderton"], r["Rocky View"]) for r in out.collect()}
    assert got == {"Construction": (500.0, 200.0), "Retail": (300.0, 0.0)}


def test_priority_rates_avg_median_flag(long):
    got = {r.characteristic: (r.avg_rate, r.n_communities, r.above_median) for r in IR.priority_rates_avg(long).collect()}
    assert got == {"Youth (rate)": (10.0, 3, True), "Seniors CHN rate": (6.0, 3, False)}


def test_vacancy_fallback_and_rent_latest(long):
    got = {r.geography: (r.year, r.indicator_value) for r in IR.vacancy_latest_per_community(long).collect()}
    assert got == {"Alderton": (2024, 1.1), "Brookfield": (2023, 2.0), "Cedarvale": (2024, 3.3)}
    rent = {r.geography: r["Average Rent - Total"] for r in IR.average_rent_latest(long).collect()}
    assert rent == {"Alderton": 1650.0, "Brookfield": 1300.0, "Cedarvale": 1250.0}


def test_housing_starts_latest_year_stack(long):
    got = {r.geography: r.indicator_value for r in IR.housing_starts_latest(long).collect()}
    assert got == {"Alderton": 30.0, "Brookfield": 10.0, "Cedarvale": 5.0}


def test_completeness_summary(long):
    rows = {r.dashboard_section: r for r in IR.completeness(long).collect()}
    assert rows["demographics"].latest_period == "Percentage of all HHs"
    assert rows["demographics"].latest_year == 2011
    assert rows["TOTAL"].is_total


def test_exploration_listings(long):
    assert len(IR.LISTINGS) == 8
    demo = IR.exploration_listing(long, "demographics")
    assert demo.columns == ["geography", "characteristic", "timeframe", "indicator_value", "data_source"]
    chn = IR.exploration_listing(long, "core_housing_need")
    assert chn.columns == ["geography", "characteristic", "timeframe", "indicator_value"]
    got = [(r.geography, r.timeframe, r.characteristic) for r in chn.collect()]
    assert got == sorted(got)                       # geography, timeframe, characteristic order
    assert IR.exploration_listing(long, "affordability").count() == 6


def test_shared_input_variants_equal_lazy(long):
    for fn in (IR.vacancy_latest_year, IR.priority_rates_avg, IR.vacancy_latest_per_community,
               IR.housing_starts_latest):
        lazy = sorted(map(tuple, fn(long).collect()))
        shared = sorted(map(tuple, fn(long, share_input=True).collect()))
        assert lazy == shared, fn.__name__
