"""Plan-shape tests: the scale properties the design relies on."""

import datetime as dt
import re

from pyspark.sql import functions as F

from lodestar.operators.series import segment_series
from lodestar.operators.snapshot import latest_per_key
from lodestar.operators.spatial import add_comps_ratio
from lodestar.plans.chain import build_series


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def _facts(spark, tmp_path):
    rows = [(f"id{i % 7}", dt.date(2024, 1, 7) + dt.timedelta(days=7 * (i % 30)), i % 2 == 0, True,
             1000 + i, 1.5 * i, float(i % 3), -121.3 + i * 1e-4, 44.05 + i * 1e-4) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, dim_collected_date date, is_target boolean, "
                                     "is_active boolean, met_price long, met_price_per_sqft double, "
                                     "met_bedrooms double, info_longitude double, info_latitude double")
    path = str(tmp_path / "facts")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_series_is_one_scan_no_self_join(spark, tmp_path):
    plan = _plan(build_series(_facts(spark, tmp_path)))
    assert len(re.findall(r"Scan parquet", plan)) == 1          # the 52-week prior is a window frame
    assert "Join" not in plan
    assert "Expand" in plan                                       # grouping sets in one pass


def test_latest_sorts_no_wide_rows(spark, tmp_path):
    plan = _plan(latest_per_key(_facts(spark, tmp_path), "id", ["dim_collected_date", "met_price"]))
    assert "partial_max" in plan and "Window" not in plan and "SortMergeJoin" not in plan
    wide = [line for line in plan.splitlines() if re.search(r"[ -]Sort \[", line)]
    assert all("__key" in line for line in wide)                  # narrow rows only
    assert re.search(r"(ShuffledHashJoin|BroadcastHashJoin) .*LeftSemi", plan)


def test_comps_has_equi_keys_and_no_cartesian(spark, tmp_path):
    df = add_comps_ratio(_facts(spark, tmp_path), keys=["dim_collected_date", "met_bedrooms"],
                         lon="info_longitude", lat="info_latitude", value="met_price", radius_m=1000.0)
    plan = _plan(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[[^\]]*cx", plan)


def test_grouping_sets_aggregate_partially(spark, tmp_path):
    ts = segment_series(_facts(spark, tmp_path), "dim_collected_date", "is_target",
                        {"n": F.count("id"), "m": F.percentile_approx("met_price", 0.5, 1000)})
    plan = _plan(ts)
    assert "Expand" in plan and len(re.findall(r"HashAggregate\(", plan)) >= 2


def test_no_task_merges_the_sketches_of_all_scan_tasks(spark):
    """A hot week over many scan tasks: its sketches meet in groups first."""
    from lodestar.operators.series import LISTING_COUNTS, LISTING_MEANS, LISTING_MEDIANS, listing_series, salted_partials
    facts = spark.range(0, 3000, 1, 300).selectExpr(
        "CAST(id AS STRING) AS id", "DATE'2024-01-01' AS dim_collected_date", "id % 2 = 0 AS is_target",
        "id AS met_price", "CAST(id AS DOUBLE) AS met_price_per_sqft")
    first = salted_partials(facts, ["dim_collected_date", "is_target"], counts=LISTING_COUNTS, means=LISTING_MEANS,
                            medians=LISTING_MEDIANS, tasks=20)
    salts = first.groupBy("is_target").count().collect()
    assert all(r["count"] == 15 for r in salts)                   # 300 tasks, 20 to a salt
    plan = _plan(listing_series(facts, "dim_collected_date", "is_target", tasks=20))
    scan_side = plan[plan.index("partial_kll_sketch_agg"):]
    assert "Expand" in plan and "Expand" not in scan_side         # facts are aggregated once, not per grouping set
    assert "__salt" in scan_side
