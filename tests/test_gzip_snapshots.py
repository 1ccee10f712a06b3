"""Gzipped snapshots are read as plain ones are."""

from lodestar.sources import csvio


def test_gzipped_snapshots_round_trip(spark, scratch):
    rows = [(str(i), f'line one\nsays "{i}", and\r\nmore' if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "a string, b string")
    path = scratch("gz")
    csvio.write_snapshot(df.repartition(3), f"{path}/d1", compression="gzip")
    csvio.write_snapshot(df.limit(5).select("a"), f"{path}/d2")
    names = list(csvio.snapshot_files(spark, path).values())
    assert sum(n.endswith(".csv.gz") for n in names) == 3 and len(names) > 3
    got = csvio.read_snapshots(spark, path)
    assert sorted(map(str, got.collect())) == sorted(map(str, [*df.collect(), *df.limit(5).selectExpr("a", "CAST(NULL AS STRING) AS b").collect()]))
