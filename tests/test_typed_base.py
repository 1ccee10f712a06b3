"""The typed projection: nested values, and code the JVM can compile."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lodestar.operators.cleanse import Field, typed_projection
from lodestar.plans.queries_ingest import typed_base

SPEC = [Field("name", "Agent", "string", "json:$.name:lower"), Field("phone", "Agent", "string", "json:$.phone"),
        Field("history", "agent2", "variant", "pydict"), Field("lon", "lon", "double"), Field("rooms", "rooms", "double"),
        Field("point", ("lon", "lat"), "point", "point")]


def test_nested_values_and_casts(spark):
    rows = [("{'name': 'Ann', 'phone': None}", "{'a': 1}", "-121.5", "44.25", 3),
            ("{'name': {'a': 1}, 'phone': [1]}", "[", "x", "44.25", 4),
            ("{'name': '[A] {', 'phone': '{\"'}", None, None, "1", None),
            ("{'name': '{Open', 'phone': 7}", "'text'", "200", "1", 1),
            ("no record", "None", "1e1", "NaN", 2), (None, "1", "", " 5 ", 5)]
    df = spark.createDataFrame(rows, "agent string, agent2 string, lon string, lat string, rooms int")
    got = typed_projection(df, SPEC).withColumn("history", F.to_json("history")).collect()
    assert [(r.name, r.phone) for r in got] == [
        ("ann", None), (None, None), (None, None), ("{open", "7"), (None, None), (None, None)]
    assert [r.history for r in got] == ['{"a":1}', None, None, '"text"', "null", "1"]
    assert [(r.lon, r.rooms) for r in got] == [(-121.5, 3.0), (None, 4.0), (None, None), (200.0, 1.0), (10.0, 2.0), (None, 5.0)]
    assert [r.point and tuple(r.point) for r in got] == [(-121.5, 44.25), None, None, None, None, None]
    strict = typed_projection(df, SPEC[:3], "strict").collect()
    assert [(r.name, r.phone) for r in strict] == [
        ("ann", None), (None, None), ("[a] {", '{"'), ("{open", "7"), (None, None), (None, None)]


def test_no_method_too_long_for_the_compiler(spark, tmp_path):
    spark.sql("""SELECT id AS o_orderkey, id % 5 AS o_custkey, 'F' AS o_orderstatus, 1.5D * id AS o_totalprice,
        TIMESTAMP_NTZ '1998-01-05' AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(20)""").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.sql("SELECT id AS c_custkey, id AS c_nationkey, 'name' AS c_name FROM range(5)").write.parquet(
        f"{tmp_path}/customer.parquet")
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = typed_base(spark, str(tmp_path))._jdf.queryExecution()
        text = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000
