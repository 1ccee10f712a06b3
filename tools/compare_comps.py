"""Grid vs plain equi-join for the spatial comps, as the equality groups grow.

For each grouping of the stand-in listings (weekly, yearly, one group) it
counts, with Spark aggregations only:
  plain_pairs  - candidate pairs of the plain form: every pair of distinct
                 points sharing (group, bedrooms), i.e. sum of n_g^2;
  grid_pairs   - candidate pairs the 8-cell grid join produces before the
                 distance residual;
  true_pairs   - pairs within the radius (the work both must keep);
and times the grid operator.  Usage: python tools/compare_comps.py sf_dir
"""
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import functions as F  # noqa: E402

from lodestar.functions.geo import chord_limit_sq, unit_vector  # noqa: E402
from lodestar.operators.spatial import _CORNERS, neighbour_stats  # noqa: E402
from lodestar.plans.queries_series import fact_rows  # noqa: E402
from lodestar.session import local_session  # noqa: E402

sf = sys.argv[1]
spark = local_session(8)
facts = fact_rows(spark, sf)
groupings = {"weekly": F.col("dim_collected_date"),
             "yearly": F.trunc("dim_collected_date", "year"),
             "one_group": F.lit("2000-01-01").cast("date")}
limit = chord_limit_sq(1000.0)
edge = 2 * math.sqrt(limit)
out = {}
for name, g in groupings.items():
    df = facts.withColumn("grp", g)
    pts = df.groupBy("grp", "met_bedrooms", "info_longitude", "info_latitude").agg(F.count("met_price").alias("n"))
    x, y, z = unit_vector("info_longitude", "info_latitude")
    pts = pts.select("*", x.alias("x"), y.alias("y"), z.alias("z"))
    pts = pts.select("*", *[F.floor(F.col(a) / edge).alias(f"c{a}") for a in "xyz"],
                     *[F.when(F.col(a) / edge - F.floor(F.col(a) / edge) < 0.5, -1).otherwise(1).alias(f"h{a}") for a in "xyz"])
    plain = pts.groupBy("grp", "met_bedrooms").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
    corners = F.explode(F.array(*[F.array(F.lit(a), F.lit(b), F.lit(c)) for a, b, c in _CORNERS]))
    b = pts.select("grp", "met_bedrooms", "cx", "cy", "cz", "hx", "hy", "hz", corners.alias("o")).select(
        "grp", "met_bedrooms", *[(F.col(f"c{a}") + F.col("o")[i] * F.col(f"h{a}")).alias(f"c{a}") for i, a in enumerate("xyz")])
    cand = pts.groupBy("grp", "met_bedrooms", "cx", "cy", "cz").count().alias("p").join(
        b.groupBy("grp", "met_bedrooms", "cx", "cy", "cz").count().withColumnRenamed("count", "bc"),
        ["grp", "met_bedrooms", "cx", "cy", "cz"]).agg(F.sum(F.col("count") * F.col("bc"))).first()[0]
    t = time.time()
    st = neighbour_stats(df, keys=["grp", "met_bedrooms"], lon="info_longitude", lat="info_latitude",
                         value="met_price", radius_m=1000.0)
    true_pairs = st.agg(F.sum("comps_count")).first()[0]
    out[name] = {"plain_pairs": plain, "grid_pairs": cand, "true_pairs": true_pairs,
                 "grid_seconds": round(time.time() - t, 2)}
    print(name, out[name], flush=True)
print(json.dumps(out))
