"""Unit cases for the semantics that decide correctness."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from lodestar.functions import casts as C
from lodestar.functions import geo as G
from lodestar.functions.jsonish import json_scalar, pydict_to_json
from lodestar.functions.text import currency_text, date_text, split_trim, thousands_text
from lodestar.operators.features import add_fact_flags, add_fact_metrics, add_target_flag


def one(spark, df, col):
    return [r[col] for r in df.collect()]


def test_safe_casts(spark):
    df = spark.createDataFrame([("abc",), ("",), ("123.0",), ("2.5",), ("42",), (None,)], "s string")
    out = df.select(C.safe_cast("s", "bigint").alias("l"), C.safe_cast("s", "double").alias("d")).collect()
    assert [r.l for r in out] == [None, None, None, None, 42, None]
    assert [r.d for r in out] == [None, None, 123.0, 2.5, 42.0, None]


def test_parse_dates(spark):
    df = spark.createDataFrame([("20240624",), ("2024-06",), ("",), ("2024-06-24T00:00:00.000Z",)], "s string")
    out = df.select(C.parse_date("s").alias("a"), C.safe_date("s").alias("b")).collect()
    assert out[0].a == dt.date(2024, 6, 24) and out[1].a is None and out[2].a is None
    assert out[3].b == dt.date(2024, 6, 24)


def test_safe_ratio_zero_divisor(spark):
    df = spark.createDataFrame([(3, 0), (3, 2), (None, 2), (3, None)], "a long, b long")
    assert one(spark, df.select(C.safe_ratio("a", "b").alias("r")), "r") == [None, 1.5, None, None]


def test_pydict_compat_and_strict(spark):
    rows = [("{'name': \"O'Brien\", 'phone': None}",), ("{'new': True}",),
            ("{'a': 'None of it'}",), ("{'fee': 12, 'x': None}",), (None,), ("not a dict",)]
    df = spark.createDataFrame(rows, "s string")
    out = df.select(F.to_json(pydict_to_json("s", "compat")).alias("c"),
                    F.to_json(pydict_to_json("s", "strict")).alias("t")).collect()
    assert out[0].c is None and out[0].t == '{"name":"O\'Brien","phone":null}'
    assert out[1].c is None and out[1].t == '{"new":true}'
    assert out[2].c == '{"a":"null of it"}'          # the blind repair, as in the reference
    assert out[2].t == '{"a":"None of it"}'          # strict keeps the value
    assert out[3].c == out[3].t == '{"fee":12,"x":null}'
    assert out[4].c is None and out[4].t is None
    assert out[5].c is None and out[5].t is None


def test_json_scalar(spark):
    df = spark.createDataFrame([("{'name': 'Ann', 'phone': None, 'o': {'k': 1}}",)], "s string")
    r = df.select(json_scalar("s", "$.name").alias("n"), json_scalar("s", "$.phone").alias("p"),
                  json_scalar("s", "$.o").alias("o"), json_scalar("s", "$.missing").alias("m")).first()
    assert (r.n, r.p, r.o, r.m) == ("Ann", None, None, None)


def test_text_formats(spark):
    df = spark.createDataFrame([(450000, dt.date(2024, 3, 5), "a, b ,c")], "p long, d date, s string")
    r = df.select(currency_text("p").alias("c"), thousands_text("p").alias("k"), date_text("d").alias("t"),
                  split_trim("s").alias("parts"), currency_text(F.lit(None).cast("long")).alias("u")).first()
    assert (r.c, r.k, r.t, r.u) == ("$450,000", "$450k", "Mar 05, 2024", "Unknown")
    assert r.parts == ["a", "b", "c"]


AS_OF = "2024-06-30"


def _listing(**kw):
    base = dict(id="1", dim_created_date=dt.date(2024, 1, 1), dim_removed_date=None, met_year_built=2000,
                met_bathrooms=2.0, met_bedrooms=3.0, met_price=300000, met_square_feet=1500,
                dim_zip="97703", info_longitude=-121.33, info_latitude=44.061)
    base.update(kw)
    return Row(**base)


SCHEMA = ("id string, dim_created_date date, dim_removed_date date, met_year_built long, "
          "met_bathrooms double, met_bedrooms double, met_price long, met_square_feet long, "
          "dim_zip string, info_longitude double, info_latitude double")


def test_flags_stale_boundary_and_never_null(spark):
    as_of = dt.date(2024, 6, 30)
    rows = [_listing(id="90", dim_created_date=as_of - dt.timedelta(days=90)),
            _listing(id="91", dim_created_date=as_of - dt.timedelta(days=91)),
            _listing(id="rm", dim_created_date=as_of - dt.timedelta(days=200), dim_removed_date=as_of),
            _listing(id="nul", dim_created_date=None, met_year_built=None),
            _listing(id="new", met_year_built=2023)]
    df = add_fact_flags(spark.createDataFrame(rows, SCHEMA), AS_OF)
    got = {r.id: (r.is_active, r.is_stale, r.is_new_construction) for r in df.collect()}
    assert got["90"] == (True, False, False)
    assert got["91"] == (True, True, False)
    assert got["rm"] == (False, False, False)
    assert got["nul"] == (True, False, False)
    assert got["new"][2] is True


def test_target_flag_and_metrics(spark):
    rows = [_listing(id="in"), _listing(id="far", info_longitude=-121.0),
            _listing(id="zip", dim_zip="97701"), _listing(id="noloc", info_latitude=None),
            _listing(id="stale", dim_created_date=dt.date(2023, 1, 1)),
            _listing(id="bed0", met_bedrooms=0.0, met_square_feet=0)]
    df = add_target_flag(spark.createDataFrame(rows, SCHEMA), dt.date(2024, 1, 20), zip_value="97703",
                         centre_lon=-121.32954935564848, centre_lat=44.06101015041879)
    df = add_fact_metrics(df, "2024-01-20")
    got = {r.id: r for r in df.collect()}
    assert got["in"].is_target and not got["far"].is_target and not got["zip"].is_target
    assert got["noloc"].is_target is False and got["stale"].is_target is False
    assert got["bed0"].met_bath_to_bed_ratio is None and got["bed0"].met_price_per_sqft is None
    assert got["in"].met_home_age_years == 24 and got["in"].met_price_per_sqft == 200.0


def test_within_radius_edges(spark):
    # one degree of latitude is R * pi / 180 metres on the sphere
    m_per_deg = G.EARTH_RADIUS_M * 3.141592653589793 / 180
    rows = [(44.0 + 999.0 / m_per_deg,), (44.0 + 1001.0 / m_per_deg,), (None,)]
    df = spark.createDataFrame(rows, "lat double")
    r = one(spark, df.select(G.within_radius(F.lit(-121.0), F.lit(44.0), F.lit(-121.0), "lat", 1000.0)
                             .alias("w")), "w")
    assert r == [True, False, False]


def test_geo_point_validity(spark):
    df = spark.createDataFrame([(10.0, 20.0), (200.0, 20.0), (10.0, -91.0), (None, 1.0)], "lon double, lat double")
    pts = [r.p for r in df.select(G.geo_point("lon", "lat").alias("p")).collect()]
    assert pts[0].lon == 10.0 and pts[0].lat == 20.0 and pts[1:] == [None, None, None]


def test_pydict_strict_equals_literal_eval(spark):
    import ast
    import json
    samples = [{"a": "x, None}", "b": None}, {"name": "True story", "ok": True, "bad": False},
               {"n": [1, None, {"k": "None"}]}, {"q": "it's", "r": None}, {"s": 'say "hi"'},
               {"t": (1, 2)}, {"u": 1.5e-05, "v": -3}, {"w": "a\\nb"}, [None, True, "False"],
               {"x": "'quoted' None"}, {}]
    texts = [str(v) for v in samples]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.j for r in df.select(F.to_json(pydict_to_json("s", "strict")).alias("j")).collect()]
    for t, j in zip(texts, got):
        want = json.loads(json.dumps(ast.literal_eval(t)))
        assert j is not None and json.loads(j) == want, (t, j)


def test_pydict_strict_random_literals(spark):
    import ast
    import json
    import random
    rnd = random.Random(20241202)
    atoms = ["None", "True", "False", "it's", 'say "x"', "a\\b", "x, None}", "{'k': 1}", "[1]",
             "naïve", "tab\there", "", " ", "True story", "(1, 2)", "nan"]

    def gen(depth=0):
        r = rnd.random()
        if depth > 2 or r < 0.4:
            return rnd.choice([None, True, False, rnd.randint(-99, 99), rnd.random() * 100,
                               rnd.choice(atoms), rnd.choice(atoms) + rnd.choice(atoms)])
        if r < 0.7:
            return {rnd.choice(atoms) + str(i): gen(depth + 1) for i in range(rnd.randint(0, 3))}
        if r < 0.9:
            return [gen(depth + 1) for _ in range(rnd.randint(0, 3))]
        return tuple(gen(depth + 1) for _ in range(rnd.randint(1, 2)))

    texts = [str({"v": gen()}) if i % 2 else str([gen()]) for i in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.j for r in df.select("i", F.to_json(pydict_to_json("s", "strict")).alias("j")).collect()}
    for i, t in enumerate(texts):
        want = json.loads(json.dumps(ast.literal_eval(t)))
        assert got[i] is not None and json.loads(got[i]) == want, (t, got[i])
