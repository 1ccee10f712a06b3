"""Operator properties: grid comps == brute force, series identities,
snapshot, reshaping, anomaly bands, calendar."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from lodestar.functions.geo import EARTH_RADIUS_M
from lodestar.operators import anomaly as A
from lodestar.operators import calendar as CAL
from lodestar.operators import series as S
from lodestar.operators.reshape import pivot_wide, unpivot_metrics
from lodestar.operators.snapshot import latest_per_key
from lodestar.operators.spatial import add_comps_ratio, neighbour_stats


def _hav(lon1, lat1, lon2, lat2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = (math.sin((p2 - p1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(h, 1.0)))


def _comps_fixture(seed=7):
    rnd = random.Random(seed)
    rows, key = [], 0
    for d in (dt.date(2024, 1, 7), dt.date(2024, 1, 14)):
        for _ in range(300):
            key += 1
            beds = rnd.choice([1.0, 2.0, 2.0, 2.0, None])          # one hot bedroom group
            lat = 44.05 + rnd.random() * 0.03
            lon = -121.33 + rnd.random() * 0.04
            if rnd.random() < 0.2:                                  # exact copies at one point
                lat, lon = 44.06, -121.31
            if rnd.random() < 0.03:
                lat = None
            price = None if rnd.random() < 0.05 else rnd.randrange(200000, 900000)
            rows.append((key, d, beds, lon, lat, price))
    # poles and the date line: the grid has no special cases
    rows += [(10001, dt.date(2024, 1, 7), 3.0, 179.9999, 10.0, 100), (10002, dt.date(2024, 1, 7), 3.0, -179.9999, 10.0, 300),
             (10003, dt.date(2024, 1, 7), 3.0, 0.0, 89.9999, 50), (10004, dt.date(2024, 1, 7), 3.0, 120.0, 89.9999, 150)]
    return rows


def _brute(rows, radius):
    out = {}
    for k, d, b, lon, lat, p in rows:
        if b is None or lat is None or lon is None:
            out[k] = (0, None)
            continue
        vals = [q for k2, d2, b2, lon2, lat2, q in rows
                if d2 == d and b2 == b and lat2 is not None and q is not None
                and _hav(lon, lat, lon2, lat2) <= radius]
        out[k] = (len(vals), (sum(vals) / len(vals)) if vals else None)
    return out


def test_grid_comps_equal_brute_force(spark):
    rows = _comps_fixture()
    df = spark.createDataFrame(rows, "k long, d date, beds double, lon double, lat double, price long")
    got = add_comps_ratio(df, keys=["d", "beds"], lon="lon", lat="lat", value="price", radius_m=1000.0,
                          keep_stats=True).collect()
    assert len(got) == len(rows)                      # no listing is lost
    want = _brute(rows, 1000.0)
    for r in got:
        n, avg = want[r.k]
        assert (r.comps_count or 0) == n, r
        if avg is None:
            assert r.comps_avg is None and r.met_price_vs_comps_ratio is None
        else:
            assert abs(r.comps_avg - avg) <= 1e-9 * avg
            if r.price is not None:
                assert abs(r.met_price_vs_comps_ratio - r.price / avg) < 1e-12 * max(1.0, r.price / avg)


def test_comps_against_reference_table(spark):
    rows = _comps_fixture(3)
    df = spark.createDataFrame(rows, "k long, d date, beds double, lon double, lat double, price long")
    new = df.where(F.col("k") % 5 == 0)
    got = {r.k: r.comps_count for r in add_comps_ratio(
        new, keys=["d", "beds"], lon="lon", lat="lat", value="price", radius_m=1000.0,
        reference=df, keep_stats=True).collect()}
    want = _brute(rows, 1000.0)
    assert got and all((got[k] or 0) == want[k][0] for k in got)


def test_neighbour_stats_poles_and_dateline(spark):
    rows = _comps_fixture()[-4:]
    df = spark.createDataFrame(rows, "k long, d date, beds double, lon double, lat double, price long")
    st = {(r.lon, r.lat): r.comps_count for r in neighbour_stats(
        df, keys=["d", "beds"], lon="lon", lat="lat", value="price", radius_m=1000.0).collect()}
    assert st[(179.9999, 10.0)] == 2 and st[(0.0, 89.9999)] == 2


def _weekly(spark, n=60, gaps=()):
    start = dt.date(2024, 1, 7)
    rows = []
    for i in range(n):
        if i in gaps:
            continue
        d = start + dt.timedelta(days=7 * i)
        for j in range(5):
            rows.append((f"id{j}", d, j % 2 == 0, 1000 * (i + 1) + j))
    return spark.createDataFrame(rows, "id string, d date, seg boolean, price long")


def test_grouping_sets_all_equals_parts_and_null_segment(spark):
    df = _weekly(spark, 10)
    df = df.union(spark.createDataFrame([("x", dt.date(2024, 1, 7), None, 5)], df.schema))
    ts = S.segment_series(df, "d", "seg", {"n": F.count("id")})
    got = {(r.d, r.is_target_segment): r.n for r in ts.collect()}
    for (d, seg), n in got.items():
        if seg == "all":
            assert n == sum(v for (d2, s2), v in got.items() if d2 == d and s2 != "all")
    assert (dt.date(2024, 1, 7), None) in got          # a genuine NULL segment is not 'all'


def test_mock_series_moving_average_closed_form(spark):
    # 52 weekly rows, median = 400000 + 1000 i + 5000 (i mod 4)
    rows = [(dt.date(2024, 1, 7) + dt.timedelta(days=7 * i), "all", 400000 + 1000 * i + 5000 * (i % 4))
            for i in range(52)]
    df = spark.createDataFrame(rows, "d date, seg string, m long")
    out = S.moving_averages(df, "m", "seg", "d", {"ma4": 4, "ma52": 52}).orderBy("d").collect()
    for i, r in enumerate(out):
        if i >= 3:
            assert r.ma4 == 400000 + 1000 * (i - 1.5) + 7500
    assert out[0].ma4 == 400000.0 and out[-1].m == 466000


def test_crossover_strict_and_first_row(spark):
    rows = [(1, 1.0, 2.0), (2, 3.0, 2.0), (3, 2.0, 2.0), (4, 1.0, 2.0), (5, 3.0, 2.0)]
    df = spark.createDataFrame([("s", *r) for r in rows], "p string, t int, f double, s double")
    out = S.crossover(df, "f", "s", "p", "t", down="dn", up="up").orderBy("t").collect()
    assert [(r.dn, r.up) for r in out] == [(False, False), (False, True), (False, False),
                                           (False, False), (False, True)]


def test_yoy_join_exact_shift(spark):
    rows = [("a", dt.date(2023, 12, 31), 1.0), ("a", dt.date(2024, 12, 29), 2.0), ("a", dt.date(2024, 12, 22), 3.0),
            ("a", None, 7.0)]
    df = spark.createDataFrame(rows, "seg string, d date, v double")
    got = {r.d: r.prior for r in S.yoy_join(df, "seg", "d", {"v": "prior"}).collect()}
    assert got[dt.date(2024, 12, 29)] == 1.0 and got[dt.date(2024, 12, 22)] is None
    assert got[None] is None


def test_latest_per_key_ties_repeats_and_nulls(spark):
    rows = [("a", dt.date(2024, 1, 1), 1, "x"), ("a", dt.date(2024, 1, 8), 1, "y"), ("a", dt.date(2024, 1, 8), 1, "y"),
            ("a", dt.date(2024, 1, 8), 1, "z"), ("b", None, 5, "u"), ("b", None, None, "v"), (None, None, None, None),
            (None, dt.date(2024, 1, 1), 2, "w"), ("c", None, None, None)]
    df = spark.createDataFrame(rows, "id string, d date, k long, v string")
    got = {r.id: tuple(r) for r in latest_per_key(df, "id", ["d", "k"]).collect()}
    assert len(got) == 4 and got["b"][3] == "u" and got[None][3] == "w" and got["c"] == ("c", None, None, None)
    assert got["a"][3] in ("y", "z")
    for n in (1, 3, 7):  # a tie falls the same way in any partitioning
        again = {r.id: tuple(r) for r in latest_per_key(df.repartition(n), "id", ["d", "k"]).collect()}
        assert again == got
    assert latest_per_key(df.limit(0), "id", ["d"]).collect() == []


def test_latest_per_key(spark):
    rows = [("a", dt.date(2024, 1, 1), 1), ("a", dt.date(2024, 2, 1), 2), ("a", dt.date(2024, 2, 1), 3),
            ("b", dt.date(2024, 1, 1), 4), (None, dt.date(2024, 1, 1), 5), (None, dt.date(2024, 3, 1), 6)]
    df = spark.createDataFrame(rows, "id string, d date, k long")
    got = {r.id: r.k for r in latest_per_key(df, "id", ["d", "k"]).collect()}
    assert got == {"a": 3, "b": 4, None: 6}


def test_unpivot_drops_nulls_and_pivot_roundtrip(spark):
    rows = [(dt.date(2024, 1, 7), "all", 1.0, None), (dt.date(2024, 1, 14), "all", 2.0, 5.0)]
    df = spark.createDataFrame(rows, "d date, seg string, m1 double, m2 double")
    long = unpivot_metrics(df, ["d", "seg"], ["m1", "m2"], name_col="n", value_col="v")
    assert long.count() == 3
    wide = pivot_wide(long, ["d", "seg"], "n", ["m1", "m2"], {"max": "v"})
    back = {(r.d, r.max_m1, r.max_m2) for r in wide.collect()}
    assert back == {(r[0], r[2], r[3]) for r in rows}


def _long_series(spark):
    rnd = random.Random(11)
    rows, y = [], 100.0
    for sid in ("a", "b", "c"):
        for i in range(80):
            y = y + rnd.gauss(0, 1) if sid != "c" else 50.0 + rnd.gauss(0, 2)
            v = y + (30.0 if i == 60 else 0.0)
            rows.append((sid, dt.date(2023, 1, 1) + dt.timedelta(days=7 * i), v))
    rows.append(("d", dt.date(2023, 1, 1), 5.0))                 # one-point series
    return spark.createDataFrame(rows, "sid string, d date, v double")


def test_anomaly_band_properties(spark):
    long = _long_series(spark)
    params = A.fit_series_models(long, ["sid"], "d", "v")
    p = {r.sid: r for r in params.collect()}
    assert set(p) == {"a", "b", "c", "d"} and p["c"].d == 0
    det = A.detect_anomalies(long, params, ["sid"], "d", "v", 0.95)
    rows = det.collect()
    assert len(rows) == long.count()
    for r in rows:
        if r.lower_bound is None:
            assert r.is_anomaly is False
            continue
        assert r.lower_bound <= r.upper_bound
        outside = r.v < r.lower_bound or r.v > r.upper_bound
        assert r.is_anomaly == outside
        if r.anomaly_probability is not None:
            assert 0.0 <= r.anomaly_probability <= 1.0
            assert (r.anomaly_probability > 0.95) == outside or abs(r.anomaly_probability - 0.95) < 1e-6
    first = {}
    for r in sorted(rows, key=lambda r: r.d):
        first.setdefault(r.sid, []).append(r)
    for sid, rs in first.items():
        assert all(x.lower_bound is None for x in rs[:p[sid].d])
    spike = [r for r in rows if r.sid == "a" and r.d == dt.date(2023, 1, 1) + dt.timedelta(days=7 * 60)]
    assert spike[0].is_anomaly


def test_holiday_calendar_known_dates(spark):
    df = spark.createDataFrame([(dt.date(2020, 3, 1),), (dt.date(2024, 3, 1),)], "d date")
    cal = {(r.year, r.holiday): r.holiday_date for r in CAL.holiday_calendar(df, "d").collect()}
    assert cal[(2024, "Thanksgiving Day")] == dt.date(2024, 11, 28)
    assert cal[(2024, "Memorial Day")] == dt.date(2024, 5, 27)
    assert cal[(2024, "Martin Luther King Jr. Day")] == dt.date(2024, 1, 15)
    assert cal[(2024, "Labor Day")] == dt.date(2024, 9, 2)
    assert cal[(2024, "Columbus Day")] == dt.date(2024, 10, 14)
    assert cal[(2024, "Washington's Birthday")] == dt.date(2024, 2, 19)
    assert (2020, "Juneteenth") not in cal and cal[(2021, "Juneteenth")] == dt.date(2021, 6, 19)
    assert len([k for k in cal if k[0] == 2024]) == 11


def test_regularise_series_fills_gaps(spark):
    df = _weekly(spark, 6, gaps=(2, 3)).groupBy("d").agg(F.count("*").alias("n")).withColumn("sid", F.lit("x"))
    out = CAL.regularise_series(df, ["sid"], "d", ["n"], fill={"n": 0}).orderBy("d").collect()
    assert [r.n for r in out] == [5, 5, 0, 0, 5, 5] and [r.is_filled for r in out][2:4] == [True, True]


def test_series_metamorphic_partitions(spark):
    df = _weekly(spark, 30).withColumn("half", F.col("price") / 2)
    spec = dict(counts={"n": "id"}, means={"avg": "price"}, medians={"m": "price", "h": "half"})
    a = S.grouped_metrics(df, ["d", "seg"], **spec).collect()
    b = S.grouped_metrics(df.repartition(13).orderBy(F.rand(3)), ["d", "seg"], **spec, tasks=1).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_two_level_metrics_equal_plain_ones(spark):
    rnd = random.Random(5)
    rows = [(i % 3, None if i % 7 == 0 else rnd.randint(0, 50), None if i % 5 == 0 else rnd.random()) for i in range(2000)]
    rows += [(9, None, None)]                                     # a group without any value
    df = spark.createDataFrame(rows, "g int, a long, b double").repartition(40)
    got = {r.g: r for r in S.grouped_metrics(df, ["g"], counts={"n": "a"}, means={"avg": "a"},
                                             medians={"ma": "a", "mb": "b"}, tasks=8).collect()}
    for g in (0, 1, 2):
        a = sorted(x[1] for x in rows if x[0] == g and x[1] is not None)
        b = sorted(x[2] for x in rows if x[0] == g and x[2] is not None)
        assert (got[g].n, got[g].avg) == (len(a), sum(a) / len(a))
        assert got[g].ma == a[(len(a) - 1) // 2] and got[g].mb == b[(len(b) - 1) // 2]
    assert tuple(got[9])[1:] == (0, None, None, None)


def test_big_group_median_stays_close(spark):
    df = spark.range(0, 400_000, 1, 16).selectExpr("1 AS g", "(id * 7919) % 400009 AS v")
    r = S.grouped_metrics(df, ["g"], medians={"m": "v"}, sketch=4096, tasks=4).first()
    below = df.where(F.col("v") <= r.m).count()
    assert abs(below / 400_000 - 0.5) < 0.005


import pytest  # noqa: E402


@pytest.mark.parametrize("radius", [250.0, 2500.0])
def test_grid_comps_other_radii(spark, radius):
    rows = _comps_fixture(seed=int(radius))
    df = spark.createDataFrame(rows, "k long, d date, beds double, lon double, lat double, price long")
    st = neighbour_stats(df, keys=["d", "beds"], lon="lon", lat="lat", value="price", radius_m=radius)
    got = {(r.d, r.beds, r.lon, r.lat): r.comps_count for r in st.collect()}
    want = _brute(rows, radius)
    for k, d, b, lon, lat, _ in rows:
        if b is not None and lat is not None:
            assert got[(d, b, lon, lat)] == want[k][0]


def test_build_series_fill_gaps_counts_weeks(spark):
    from lodestar.plans.chain import build_series
    rows = []
    start = dt.date(2024, 1, 7)
    for i in (0, 1, 2, 4, 5):                      # week 3 missing
        for j in range(3):
            rows.append((f"id{j}", start + dt.timedelta(days=7 * i), True, True, 100 * (i + 1), 2.0))
    facts = spark.createDataFrame(rows, "id string, dim_collected_date date, is_active boolean, "
                                        "is_target boolean, met_price long, met_price_per_sqft double")
    plain = {r.dim_collected_date: r for r in build_series(facts).where("is_target_segment = 'all'").collect()}
    filled = {r.dim_collected_date: r for r in build_series(facts, fill_gaps=True)
              .where("is_target_segment = 'all'").collect()}
    w5 = start + dt.timedelta(days=35)
    assert plain[w5].met_04_week_ma == (200 + 300 + 500 + 600) / 4      # 4 rows back
    assert filled[w5].met_04_week_ma == (300 + 500 + 600) / 3           # 4 calendar weeks back
    gap = filled[start + dt.timedelta(days=21)]
    assert gap.met_listings_count == 0 and gap.met_price_median is None
