"""Presentation frames on small made-up tables (FIXTURES.md F1, F2)."""

import datetime as dt

from lodestar.operators import present as P


WEEKS = 30
FIRST = dt.date(2023, 10, 4)


def _median(i):
    return 251_300 - 700 * i + 90 * i * i


def _f1(spark):
    """Thirty Wednesdays, a curved median, the 18th flagged."""
    rows = [(FIRST + dt.timedelta(days=7 * i), "all", _median(i), _median(i) + 13_777, 61 + (7 * i) % 12, i == 17,
             _median(i) - 9_100, _median(i) + 8_200) for i in range(WEEKS)]
    return spark.createDataFrame(rows, "dim_collected_date date, is_target_segment string, "
                                       "met_price_median long, met_price_avg long, met_listings_count long, "
                                       "is_price_median_anomaly boolean, met_price_median_lower_bound long, "
                                       "met_price_median_upper_bound long")


def _f2(spark):
    rows = [("p-31", "12 Quarry Lane", "Lakeside", "04101", 238_750, 191, 43.6601, -70.2550, True),
            ("p-32", "7 Ferry Street", "Lakeside", "04102", 1_015_000, 367, 43.6512, -70.2811, True),
            ("p-33", "88 Mill Row", "Lakeside", "04101", 189_900, 158, 43.6702, -70.2433, True)]
    return spark.createDataFrame(rows, "id string, info_street1 string, dim_city string, dim_zip string, "
                                       "met_price long, met_price_per_sqft long, info_latitude double, "
                                       "info_longitude double, is_target_segment boolean")


def test_trend_filter_segments_and_single_day(spark):
    t = _f1(spark)
    assert P.trend_filter(t, "2023-01-01", "2024-12-31", segment="true").count() == 0
    assert P.trend_filter(t, "2023-01-01", "2024-12-31", segment="ALL").count() == WEEKS
    assert P.trend_filter(t, "2023-10-11", "2023-10-31", segment="all").count() == 3
    assert P.trend_filter(t, "2023-10-18", segment="all").count() == 1


def test_kpis_on_mock(spark):
    from pyspark.sql import functions as F
    t = P.trend_filter(_f1(spark), "2023-01-01", "2024-12-31", segment="all").withColumn(
        "met_04_week_ma", F.lit(1.0))
    listings = P.recent_listings(_f2(spark), "2024-06-30")          # no listed date, no is_target column
    k = {r.kpi: (r.value, r.display) for r in P.kpi_summary(t, listings).collect()}
    assert k["latest_median"] == (306_690.0, "$307k")     # 251,300 - 700 * 29 + 90 * 841
    assert k["anomalies"][0] == 1.0 and k["listings"][0] == 3.0


def test_map_points_and_inventory(spark):
    l = _f2(spark).union(spark.createDataFrame(
        [("p-34", None, "Lakeside", "04101", None, None, None, -70.3, True)], _f2(spark).schema))
    pts = {r.id: r for r in P.map_points(l).collect()}
    assert set(pts) == {"p-31", "p-32", "p-33"}            # p-34 has no latitude
    assert pts["p-32"].price_formatted == "$1,015,000" and pts["p-31"].listed_date_str == "Unknown"
    c = P.map_centre(P.map_points(l)).first()
    assert abs(c.centre_lat - (43.6601 + 43.6512 + 43.6702) / 3) < 1e-9
    inv = P.inventory_by_ratio(l, "met_price_per_sqft", tie_break=["id"]).collect()
    assert [r.id for r in inv] == ["p-33", "p-31", "p-32", "p-34"]


def test_date_bounds_defaults_when_empty(spark):
    b = P.date_bounds(_f1(spark).limit(0)).first()
    assert (b.min_date, b.max_date) == (dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def test_latest_trend_row(spark):
    r = P.latest_trend_row(_f1(spark), cols=["dim_collected_date", "met_price_median"]).first()
    assert r.met_price_median == 306_690 and r.dim_collected_date == FIRST + dt.timedelta(days=7 * 29)


def test_recent_listings_target_and_unreadable_dates(spark):
    rows = [("a", "2024-06-20", True), ("b", "2024-06-30", False), ("c", "not a date", True),
            ("d", "2024-05-01", True), ("e", "2024-06-02", True)]
    df = spark.createDataFrame(rows, "id string, dim_listed_date string, is_target boolean")
    got = sorted(r.id for r in P.recent_listings(df, "2024-06-30").collect())
    assert got == ["a", "e"]                       # 28 days inclusive, target only, bad date dropped
    got_all = sorted(r.id for r in P.recent_listings(df, "2024-06-30", target_homes=False).collect())
    assert got_all == ["a", "b", "e"]


def test_band_series_and_points_on_mock(spark):
    from lodestar.plans.queries_models import band_series_df
    from pyspark.sql import functions as F
    t = _f1(spark)
    for m in ("met_price_avg", "met_price_per_sqft_median", "met_price_per_sqft_avg"):
        t = t.withColumns({m: F.lit(1.0), f"{m}_lower_bound": F.lit(0.0), f"{m}_upper_bound": F.lit(2.0)})
    for flag in ("is_price_avg_anomaly", "is_price_per_sqft_median_anomaly", "is_price_per_sqft_avg_anomaly"):
        t = t.withColumn(flag, F.lit(False))
    bands = band_series_df(t, ["Median Price"])
    assert bands.count() == WEEKS
    pts = bands.where("is_anomaly").collect()
    assert len(pts) == 1 and pts[0].value == 265_410 and pts[0].lower_bound == 256_310
    assert band_series_df(t).count() == 4 * WEEKS
