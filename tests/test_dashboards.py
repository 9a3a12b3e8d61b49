"""The twenty dashboard queries on an invented two-community star schema."""

import pytest

from civicstat.plans import dashboards as D

GEO = [("11", "alderton", "Alderton"), ("12", "brookfield", "Brookfield")]


@pytest.fixture(scope="module")
def t(spark):
    mk = spark.createDataFrame
    tables = {
        D.GEOGRAPHY_DIM: mk(GEO, "geography_id string, geography_key string, geography string"),
        D.DEMOGRAPHICS: mk([("11", "S", 73795, 61190, 20.6, 26295, 110000, 1650, 20.7),
                            ("12", "S", 31470, 25640, 22.7, 12100, 113000, 1292, 16.3),
                            ("99", "S", 1, 1, 0.0, 1, 1, 1, 0.0)],
                           "geography_id string, source_id string, pop_2021 long, pop_2016 long, growth_5yr_pct double,"
                           " households long, median_income long, median_rent long, tenant_pct double"),
        D.HOUSING_INDICATORS: mk([("11", 1990, 7.7, 4.6, 19.6, 565, 970, 5450), ("12", 800, 6.8, 3.6, 23.4, 270, 265, 2265)],
                                 "geography_id string, chn_total long, chn_pct double, chn_owner_pct double,"
                                 " chn_renter_pct double, inadequate_count long, unsuitable_count long, unaffordable_count long"),
        D.INCOME_CATEGORIES: mk([("11", "high", 37.5, 9861, 3000), ("11", "very_low", 1.3, 337, 500),
                                 ("11", "median", 26.5, 6973, 2500), ("11", "unknown_tier", 0.0, 0, 0)],
                                "geography_id string, income_tier string, household_pct double, household_count long,"
                                " max_shelter_cost long"),
        D.RENTAL_SUPPLY: mk([("11", 5435, 1543, 3892, 28.4, 95, 1.7, 10, 0, -5)],
                            "geography_id string, total_rental long, primary_rental long, secondary_rental long,"
                            " primary_pct double, subsidized long, subsidized_pct double, below_market long,"
                            " co_op_units long, affordable_net_change long"),
        D.STRUCTURE_TYPE: mk([("11", 2021, "single", 100), ("11", 2016, "row", 50)],
                             "geography_id string, timeframe_id int, structure_type string, dwelling_count long"),
        D.ECONOMIC_SNAPSHOT: mk([("11", 11.1, 7.0, 418400, 121000, 74500, -100, 2.5)],
                                "geography_id string, unemployment_rate_2021 double, lim_all_pop_pct double,"
                                " avg_sale_price long, owner_income long, renter_income long,"
                                " net_commuter_flow_2021 long, net_commuter_flow_change_pct double"),
        D.RENTAL_MARKET: mk([("11", 2023, 1.5, 1600.0, 3.0), ("11", 2024, None, 1650.0, 3.1), ("12", 2024, 2.0, None, None)],
                            "geography_id string, timeframe_id int, vacancy_rate double, avg_rent double,"
                            " rent_yoy_change double"),
        D.HOUSING_STARTS: mk([("11", 2020, "structure_type", "single", 10), ("11", 2020, "tenure", "owner", 7),
                              ("12", 2020, "tenure", "rental", 3)],
                             "geography_id string, timeframe_id int, dimension_type string, category string,"
                             " starts_count long"),
        D.EI_RECIPIENTS: mk([("11", 2016, 1361), ("12", 2016, 443)],
                            "geography_id string, timeframe_id int, recipient_count long"),
        D.PRIORITY_GROUPS: mk([("11", "community_total", 1990, 7.7), ("11", "seniors", 300, 9.0),
                               ("11", "youth", 500, 12.0), ("12", "seniors", 100, 5.0)],
                              "geography_id string, priority_group string, chn_count long, chn_rate double"),
        D.SHELTER_COST: mk([("11", 2021, "r2000_plus", 5), ("11", 2021, "under_500", 9)],
                           "geography_id string, timeframe_id int, cost_band string, household_count long"),
        D.INCOME_DISTRIBUTION: mk([("11", 2021, "total", "over_100k", 5), ("11", 2021, "total", "under_20k", 3),
                                   ("11", 2021, "owner", "under_20k", 1)],
                                  "geography_id string, timeframe_id int, tenure string, income_band string,"
                                  " household_count long"),
        D.DWELLING_VALUES: mk([("11", 2021, "single", 500000.0), ("11", 2021, "other", 1.0), ("11", 2021, "row", 0.0)],
                              "geography_id string, timeframe_id int, structure_type string, avg_dwelling_value double"),
        D.MEDIAN_INCOME: mk([("11", 2021, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)],
                            "geography_id string, timeframe_id int, median_total double, median_owner double,"
                            " median_renter double, avg_total double, avg_owner double, avg_renter double"),
        D.CHN_TENURE: mk([("11", 2021, 955, 4.6, 1035, 19.7)],
                         "geography_id string, timeframe_id int, chn_owner_count long, chn_owner_rate double,"
                         " chn_renter_count long, chn_renter_rate double"),
        D.BUILDING_PERMITS: mk([("11", 2020, "residential", 10)],
                               "geography_id string, timeframe_id int, permit_sector string, permit_count long"),
        D.HOUSING_DEFICIT: mk([("11", "low", 2, 10, 8, 2), ("11", "very_low", 1, 5, 5, 0), ("11", "high", 1, 0, 0, 0)],
                              "geography_id string, income_tier string, household_size int, deficit_count long,"
                              " deficit_unsubsidized long, deficit_subsidized long"),
    }
    return tables.__getitem__


def test_all_twenty_run(t):
    import inspect
    assert len(D.DASHBOARD) == 20
    for name, fn in D.DASHBOARD.items():
        kw = {"community": "alderton"} if "community" in inspect.signature(fn).parameters else {}
        fn(t, **kw).collect()


def test_default_community_key_absent_gives_no_rows(t):
    assert D.priority_groups(t).count() == 0          # default key is not in the fixture


def test_regional_overview_orders_and_drops_orphans(t):
    got = [r.community for r in D.regional_overview(t).collect()]
    assert got == ["Alderton", "Brookfield"]


def test_income_tiers_in_category_order_unknown_first(t):
    got = [r.income_tier for r in D.income_categories(t).collect()]
    assert got == ["unknown_tier", "very_low", "median", "high"]


def test_priority_groups_excludes_total(t):
    got = [r.priority_group for r in D.priority_groups(t, "alderton").collect()]
    assert got == ["youth", "seniors"]


def test_vacancy_not_null_and_tenure_filter(t):
    assert [(r.community, r.year) for r in D.vacancy_trends(t).collect()] == [("Alderton", 2023), ("Brookfield", 2024)]
    assert [r.tenure for r in D.starts_by_tenure(t, "alderton").collect()] == ["owner"]
    assert [r.income_band for r in D.income_distribution(t, "alderton").collect()] == ["under_20k", "over_100k"]


def test_dwelling_values_not_in_and_positive(t):
    assert [r.structure_type for r in D.dwelling_values(t, "alderton").collect()] == ["single"]


def test_deficit_order_and_filter(t):
    assert [(r.income_tier, r.household_size) for r in D.housing_deficit(t, "alderton").collect()] == [("very_low", 1), ("low", 2)]


def test_completeness_summary(t):
    got = [(r.table_name, r.community, r.rows) for r in D.completeness_summary(t).collect()]
    assert (D.PRIORITY_GROUPS, "Alderton", 3) in got
    assert (D.DEMOGRAPHICS, "Alderton", 1) in got
