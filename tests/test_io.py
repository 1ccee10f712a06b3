"""Sources, sinks and incremental loads."""

import datetime as dt

from pyspark.sql import functions as F

from lodestar.sources import csvio
from lodestar.sources.paged import paged_source
from lodestar.sources.unions import flatten_nested, schema_union
from lodestar.streaming.incremental import after_mark, incremental_append, stream_incremental


def test_csv_roundtrip_header_drift_and_quotes(spark, scratch):
    base = scratch("csv")
    a = spark.createDataFrame([("1", "01234", 'say "hi"\nnext line', "x")], "id string, zip string, note string, extra string")
    b = spark.createDataFrame([("2", "00077", "plain")], "id string, zip string, note string")
    assert csvio.write_snapshot(a.select("zip", "note", "id", "extra"), f"{base}/20240101")
    assert csvio.write_snapshot(b.select("note", "id", "zip"), f"{base}/20240108")
    assert not csvio.write_snapshot(b.limit(0), f"{base}/20240115")
    got = {r.id: r for r in csvio.read_snapshots(spark, base).collect()}
    assert got["1"].note == 'say "hi"\nnext line' and got["1"].zip == "01234" and got["1"].extra == "x"
    assert got["2"].zip == "00077" and got["2"].extra is None


def test_schema_union_sorted_and_flatten(spark):
    a = spark.createDataFrame([(1, "x")], "b long, a string")
    c = spark.createDataFrame([(2, [1, 2])], "b long, arr array<long>")
    u = schema_union([a, c])
    assert u.columns == ["a", "arr", "b"] and u.count() == 2
    flat = flatten_nested(u).where("b = 2").first()
    assert flat.arr == "[1,2]"


def test_paged_source_pages_and_stops(spark):
    calls = []
    data = {"k1": [{"id": i, "key": "k1"} for i in range(7)], "k2": [{"id": 100, "key": "k2"}], "k3": []}

    def fetch(key, offset, limit):
        calls.append((key, offset))
        return data[key][offset:offset + limit]

    df = paged_source(spark, fetch, ["k1", "k2", "k3"], "id long, key string", key_column="key",
                      limit=3, name="paged_test")
    got = sorted((r.key, r.id) for r in df.collect())
    assert got == sorted([("k1", i) for i in range(7)] + [("k2", 100)])


def test_paged_source_strides_read_each_page_once(spark):
    sizes = {"k1": 0, "k2": 1, "k3": 6, "k4": 7, "k5": 20}

    def fetch(key, offset, limit):
        return [{"id": i, "key": key} for i in range(sizes[key])][offset:offset + limit]

    df = paged_source(spark, fetch, list(sizes), "id long, key string", limit=3, strides=4, name="paged_strides")
    assert df.rdd.getNumPartitions() == 20
    got = sorted((r.key, r.id) for r in df.collect())
    assert got == [(k, i) for k, n in sizes.items() for i in range(n)]


def _facts(spark):
    rows = [(i, dt.date(2024, 1, 7) + dt.timedelta(days=7 * (i % 6)), i * 10) for i in range(60)]
    return spark.createDataFrame(rows, "k long, d date, v long")


def test_incremental_k_slices_equal_full_load(spark, scratch):
    src = _facts(spark)
    path = scratch("inc")
    for cut in ("2024-01-14", "2024-01-28", "2024-02-11"):
        incremental_append(spark, src.where(F.col("d") <= F.lit(cut).cast("date")), path, "d")
    incremental_append(spark, src, path, "d")   # replay: nothing new
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "d", "v").collect())
    assert got == sorted(tuple(r) for r in src.collect())


def test_incremental_drops_late_and_null_and_empty_target(spark, scratch):
    src = _facts(spark)
    target = src.where("d < '2024-02-01'")
    late = spark.createDataFrame([(999, dt.date(2024, 1, 7), 1), (998, None, 1)], src.schema)
    new = after_mark(src.union(late), "d", target, "d")
    assert new.where("k >= 998").count() == 0
    assert after_mark(src, "d", target.limit(0), "d").count() == 0           # empty target loads nothing
    assert after_mark(src, "d", target, "d", lazy=True).count() == new.count()


def test_streaming_form_matches_batch(spark, scratch):
    src_dir, path, chk = scratch("src"), scratch("tgt"), scratch("chk")
    src = _facts(spark)
    src.where("d < '2024-01-28'").write.parquet(f"{src_dir}/part1")
    stream_incremental(spark, src_dir + "/*", src.schema, path, "d", chk)
    src.where("d >= '2024-01-28'").write.parquet(f"{src_dir}/part2")
    stream_incremental(spark, src_dir + "/*", src.schema, path, "d", chk)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "d", "v").collect())
    assert got == sorted(tuple(r) for r in src.collect())


def test_paged_source_key_filter_pushdown(spark):
    data = {"k1": [{"id": i, "key": "k1"} for i in range(4)], "k2": [{"id": 9, "key": "k2"}]}

    def fetch(key, offset, limit):
        return data[key][offset:offset + limit]

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = paged_source(spark, fetch, ["k1", "k2"], "id long, key string", key_column="key",
                          limit=2, name="paged_push").where(F.col("key") == "k1")
        assert sorted(r.id for r in df.collect()) == [0, 1, 2, 3]
        assert df.rdd.getNumPartitions() == 1          # the k2 partition was dropped at planning
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_paged_source_request_params(spark):
    data = [{"id": i, "key": "k", "kind": "house" if i % 2 else "flat"} for i in range(9)]

    def fetch(key, offset, limit, kind=None):
        rows = [r for r in data if kind is None or r["kind"] == kind]   # filtered by the "server"
        return rows[offset:offset + limit]

    df = paged_source(spark, fetch, ["k"], "id long, key string, kind string", limit=2,
                      name="paged_params", params={"kind": "house"})
    assert sorted(r.id for r in df.collect()) == [1, 3, 5, 7]


def test_read_snapshots_reads_every_folder(spark, scratch):
    """No path, dated above the root or in a key=value folder, hides a file."""
    base = scratch("20200101") + "/raw"
    for day, ids in (("20240101", "1"), ("undated", "2"), ("account=10000001", "3"), ("with space", "4")):
        spark.createDataFrame([(ids,)], "id string").coalesce(1).write.options(**csvio.WRITE_OPTIONS).csv(f"{base}/{day}")
    assert sorted(r.id for r in csvio.read_snapshots(spark, base).collect()) == ["1", "2", "3", "4"]


def test_strict_repair_is_linear_and_python_sees_hard_rows_only(spark):
    from pyspark.sql import functions as F
    from lodestar.functions.jsonish import strict_text
    long = "{" + ", ".join(f"'k{i}': None" for i in range(100_000)) + "}"
    df = spark.createDataFrame([(long,), ("{'a': True}",), (None,), ('{"it\'s": 1}',)], "s string")
    got = [r.j for r in df.select(strict_text(F.col("s")).alias("j")).collect()]
    assert got[0] == long.replace("'", '"').replace("None", "null")
    assert got[1:] == ['{"a": true}', None, '{"it\'s": 1}']
    plan = df.select(strict_text(F.col("s")).alias("j"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_literal_to_json(CASE WHEN" in plan


def _csv_cases():
    rng = __import__("random").Random(3)
    words = ["a", "", "plain", 'say "hi"', "two\nlines", "crlf\r\ninside", "\n", '"', '""', "x,y", "tail\n", "é漢", " pad "]
    return [(f"{i:05d}", *(rng.choice(words) for _ in range(3))) for i in range(400)]


def _as_csv(rows, header, end="\n"):
    def cell(v):
        return '"' + v.replace('"', '""') + '"' if any(c in v for c in '",\n\r') else v
    return header + end + "".join(",".join(map(cell, r)) + end for r in rows)


def test_one_file_is_read_by_many_tasks(spark, scratch):
    """Splits of a few hundred bytes fall inside quoted values, between the
    quotes of an escape, and inside records longer than a split."""
    import os
    rows = _csv_cases() + [("99999", "long " + 'quoted "text"\n' * 200, "", "z")]
    want = sorted(tuple(v or None for v in r) for r in rows)
    for end in ("\n", "\r\n"):
        base = scratch("csv").replace("file:", "")
        os.makedirs(base)
        with open(f"{base}/one.csv", "w", newline="", encoding="utf-8") as f:
            f.write(_as_csv(rows, "id,a,b,c", end))
        keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        try:
            for size in ("300", "1237", "100000000"):
                spark.conf.set("spark.sql.files.maxPartitionBytes", size)
                spark.conf.set("spark.sql.files.openCostInBytes", "1")
                df = csvio.read_snapshots(spark, base)
                got = sorted(tuple(r) for r in df.select("id", "a", "b", "c").collect())
                assert got == want, (end, size)
                tasks = csvio._lines(spark, [f"{base}/one.csv"]).rdd.getNumPartitions()
                assert tasks > 20 if size == "300" else tasks >= 1
        finally:
            for k, v in keep.items():
                spark.conf.set(k, v)


def test_csv_reader_agrees_with_sparks_own(spark, scratch):
    base = scratch("csv")
    a = spark.createDataFrame(_csv_cases(), "id string, a string, b string, c string")
    assert csvio.write_snapshot(a.repartition(3), f"{base}/1")
    mine = csvio.read_snapshots(spark, base)
    own = spark.read.options(**csvio.CSV_OPTIONS).csv(f"{base}/1")
    assert sorted(map(str, mine.collect())) == sorted(map(str, own.select(*mine.columns).collect()))


def test_empty_snapshot_leaves_the_last_one(spark, scratch):
    base = scratch("csv")
    one = spark.createDataFrame([("1", "x")], "id string, day string")
    assert csvio.write_snapshot(one, f"{base}/d") and not csvio.write_snapshot(one.limit(0), f"{base}/d")
    assert [r.id for r in csvio.read_snapshots(spark, base).collect()] == ["1"]
    assert csvio.write_snapshot(one, f"{base}/p", partition_col="day")
    two = spark.createDataFrame([("2", "y"), ("3", "x")], "id string, day string")
    assert csvio.write_snapshot(two, f"{base}/p", partition_col="day")
    assert sorted(r.id for r in csvio.read_snapshots(spark, f"{base}/p").collect()) == ["2", "3"]


def test_record_union_of_drifting_keys(spark):
    from lodestar.sources.unions import record_union
    rows = [(1, '{"b": 1, "a key": "x", "n": {"d": [1, {"e": null}]}}'), (2, '{"c`c": true, "b": null}'), (3, "[1]"), (4, None),
            (5, "broken {"), (6, "{}"), (7, '{"b": 1.5, "OBJECT<": "y", "q\\"": "z"}')]
    df = spark.createDataFrame(rows, "id long, r string")
    got = record_union(df, "r", keep=["id"])
    assert got.columns == sorted(["OBJECT<", "a key", "b", "c`c", "id", "n", 'q"'])
    by = {r["id"]: r.asDict() for r in got.collect()}
    assert by[1] == {"OBJECT<": "", "a key": "x", "b": "1", "c`c": "", "id": 1, "n": '{"d":[1,{"e":null}]}', 'q"': ""}
    assert by[2]["c`c"] == "true" and by[2]["b"] == "" and by[7]["b"] == "1.5" and by[7]["OBJECT<"] == "y"
    assert all(set(v for k, v in by[i].items() if k != "id") == {""} for i in (3, 4, 5, 6))
    nulls = {r["id"]: r for r in record_union(df, "r", keep=["id"], fill=None).collect()}
    assert nulls[4]["b"] is None and nulls[1]["b"] == "1"
    assert record_union(df.limit(0), "r", keep=["id"]).collect() == []
    import pytest
    with pytest.raises(ValueError, match="clash"):
        record_union(df.withColumnRenamed("id", "b"), "r", keep=["b"])


def test_paged_source_planned_from_counts(spark):
    sizes = {"k1": 0, "k2": 1, "k3": 6, "k4": 7, "k5": 20}
    df = paged_source(spark, lambda key, offset, limit: [{"id": i, "key": key} for i in range(sizes[key])][offset:offset + limit],
                      list(sizes), "id long, key string, gone double", limit=3, counts=sizes, pages_per_task=2, name="paged_counts")
    assert df.rdd.getNumPartitions() == 0 + 1 + 1 + 2 + 4
    got = sorted((r.key, r.id, r.gone) for r in df.collect())
    assert got == [(k, i, None) for k, n in sizes.items() for i in range(n)]
    none = paged_source(spark, lambda *a: [], [], "id long", counts={}, name="paged_none")
    assert none.collect() == []


def test_pages_laid_out_by_spark(spark, scratch):
    from lodestar.sources.paged import PageFiles, write_pages
    keys = ["a b", "c:d/e", "100%", None]
    rows = [(keys[i % 4] if i > 300 else "a b", (i * 7919) % 1009, f"v{i}") for i in range(1000)]
    src = spark.createDataFrame(rows, "key string, o long, v string")
    path = scratch("pages")
    counts = write_pages(src.repartition(5), path, "key", "o", limit=40)
    assert counts == {k: sum(r[0] == k for r in rows) for k in keys}
    fetch = PageFiles(path, 40)
    pages = [fetch("a b", off, 40) for off in range(0, counts["a b"], 40)]
    assert [p.num_rows for p in pages[:-1]] == [40] * (len(pages) - 1)
    order = [o for p in pages for o in p.column("o").to_pylist()]
    assert order == sorted(order) and fetch("a b", 100_000 * 40, 40) == []
    df = paged_source(spark, fetch, list(counts), "key string, o long, v string", limit=40, counts=counts, name="paged_files")
    assert sorted(map(str, df.collect())) == sorted(map(str, src.collect()))
