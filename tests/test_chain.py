"""The whole chain: incremental fact layer (two loads) equals a one-shot
computation, including the spatial comps (S17)."""

from pyspark.sql import functions as F

from sf_paths import SF_SMALL
from lodestar.functions.casts import parse_date
from lodestar.operators.cleanse import BASE_SPEC, typed_projection
from lodestar.operators.spatial import add_comps_ratio
from lodestar.plans.chain import run_chain
from lodestar.plans.standins import AS_OF, TARGET_LAT, TARGET_LON, TARGET_ZIP, raw_listings
from lodestar.sources import csvio


def test_incremental_chain_facts_equal_one_shot(spark, scratch):
    raw = raw_listings(spark, SF_SMALL)
    raw_dir, wh = scratch("raw"), scratch("wh")
    early = F.coalesce(parse_date("collected_date") < F.lit("1998-06-01").cast("date"), F.lit(True))
    args = dict(target_zip=TARGET_ZIP, centre_lon=TARGET_LON, centre_lat=TARGET_LAT)
    csvio.write_snapshot(raw.where(early), f"{raw_dir}/load=1")
    run_chain(spark, raw_dir, wh, AS_OF, **args)
    csvio.write_snapshot(raw.where(~early).drop("hoa"), f"{raw_dir}/load=2")
    tables = run_chain(spark, raw_dir, wh, AS_OF, **args)
    # a run that stopped after the fact table: the latest table lags, the retry mends it
    import shutil
    shutil.rmtree(f"{wh}/latest".replace("file:", ""))
    tables = run_chain(spark, raw_dir, wh, AS_OF, **args)
    fact = tables["fact"]
    base = typed_projection(raw, BASE_SPEC)
    want = add_comps_ratio(base, keys=["dim_collected_date", "met_bedrooms"], lon="info_longitude",
                           lat="info_latitude", value="met_price", radius_m=1000.0)
    got = {r.mls_number: r.met_price_vs_comps_ratio for r in
           fact.select("mls_number", "met_price_vs_comps_ratio").collect()}
    exp = {r.mls_number: r.met_price_vs_comps_ratio for r in
           want.select("mls_number", "met_price_vs_comps_ratio").collect()}
    assert got == exp and len(got) == base.count()
    from lodestar.operators.snapshot import latest_per_key
    one_shot = latest_per_key(base, "id", ["dim_collected_date", "mls_number"])
    assert ({(r.id, r.mls_number) for r in tables["latest"].select("id", "mls_number").collect()}
            == {(r.id, r.mls_number) for r in one_shot.select("id", "mls_number").collect()})


ARGS = dict(target_zip=TARGET_ZIP, centre_lon=TARGET_LON, centre_lat=TARGET_LAT)


def _bag(df):
    cols = sorted(c for c in df.columns if c not in ("met_price_per_sqft_avg",) and "bound" not in c
                  and "probability" not in c)
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


def test_first_loads_without_active_or_dated_rows_hold_up_nothing(spark, scratch):
    """A base and facts without a single active or dated row, then a real load."""
    raw = raw_listings(spark, SF_SMALL).where(parse_date("collected_date") < F.lit("1995-10-01").cast("date"))
    raw_dir, wh = scratch("raw"), scratch("wh")
    undated = raw.limit(3).withColumn("collected_date", F.lit("not a date"))
    csvio.write_snapshot(undated, f"{raw_dir}/load=0")
    first = run_chain(spark, raw_dir, wh, AS_OF, **ARGS)
    assert first["fact"].count() == 3
    early = parse_date("collected_date") < F.lit("1995-03-01").cast("date")
    csvio.write_snapshot(raw.where(early).withColumn("removeddate", F.lit("1996-01-01")), f"{raw_dir}/load=1")
    second = run_chain(spark, raw_dir, wh, AS_OF, **ARGS)
    assert second["series"].where("dim_collected_date IS NOT NULL").count() == 0
    csvio.write_snapshot(raw.where(~early), f"{raw_dir}/load=2")
    last = run_chain(spark, raw_dir, wh, AS_OF, **ARGS)
    assert last["series"].count() > 20 and last["fact"].count() == 3 + raw.count()
    again = run_chain(spark, raw_dir, wh, AS_OF, **ARGS)
    assert again["fact"].count() == last["fact"].count() and _bag(again["series"]) == _bag(last["series"])


def test_chain_goes_on_after_a_death_at_any_write(spark, scratch, monkeypatch):
    from lodestar.sources import tables as T
    raw = raw_listings(spark, SF_SMALL).where(parse_date("collected_date") < F.lit("1995-06-01").cast("date"))
    raw_dir, wh, clean = scratch("raw"), scratch("wh"), scratch("clean")
    csvio.write_snapshot(raw, f"{raw_dir}/load=1")
    want = run_chain(spark, raw_dir, clean, AS_OF, **ARGS)
    real = T._write_load
    died = []
    for table in ("base", "fact", "series_base", "series", "anomalies", "latest"):
        def dying(df, path, partition_col, table=table):
            out = real(df, path, partition_col)  # the files are there, the manifest is not
            if path.endswith("/" + table):
                died.append(table)
                raise RuntimeError("died")
            return out
        monkeypatch.setattr(T, "_write_load", dying)
        try:
            run_chain(spark, raw_dir, wh, AS_OF, **ARGS)
        except RuntimeError:
            pass
    monkeypatch.setattr(T, "_write_load", real)
    got = run_chain(spark, raw_dir, wh, AS_OF, **ARGS)
    assert died == ["base", "fact", "series_base", "series", "anomalies", "latest"]
    for name in want:
        assert _bag(got[name]) == _bag(want[name])
    assert len(T.current_version(spark, f"{wh}/fact").loads) == 1
