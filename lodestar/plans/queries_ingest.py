"""Registered queries: ingest, text, JSON, unions, files, paged source,
tables and incremental loads (A1-A17, B1-B7, H1-H6, H26, P1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import parse_date as parse_date_fn
from ..functions.casts import safe_cast as safe_cast_fn
from ..functions.jsonish import json_scalar, pydict_to_json
from ..functions.text import normalise_text as norm_fn
from ..functions.text import split_trim as split_trim_fn
from ..operators.cleanse import BASE_SPEC, typed_projection
from ..operators.snapshot import latest_per_key
from ..session import scratch_path
from ..sources import csvio, unions
from ..sources.paged import PageFiles, paged_source as paged_source_fn, write_pages
from ..sources.tables import read_table, rebuild_table
from ..streaming.incremental import after_mark, incremental_append as incremental_append_fn
from . import oracle as O
from .queries_series import fact_rows
from .registry import register
from .standins import AS_OF, raw_listings, raw_listings_sql, table

RAW = f"raw AS ({raw_listings_sql()})"


def _rep(x: str) -> str:
    return f"replace(replace({x}, '''', '\"'), 'None', 'null')"


def _jx(x: str, path: str) -> str:
    r = _rep(x)
    return f"CASE WHEN json_valid({r}) THEN json_extract_string({r}, '{path}') END"


def _jtext(x: str) -> str:
    r = _rep(x)
    return f"CASE WHEN json_valid({r}) THEN CAST(json({r}) AS VARCHAR) END"


# The base layer written out for the oracle, column by column, not read from the
# engine's own list.
_BASE_SQL = f"""
    TRY_CAST(id AS STRING) AS id,
    TRY_CAST(mlsnumber AS STRING) AS mls_number,
    CAST(try_strptime(collected_date, '%Y%m%d') AS DATE) AS dim_collected_date,
    TRY_CAST(createddate AS DATE) AS dim_created_date,
    TRY_CAST(lastseendate AS DATE) AS dim_last_seen_date,
    TRY_CAST(listeddate AS DATE) AS dim_listed_date,
    TRY_CAST(removeddate AS DATE) AS dim_removed_date,
    lower({_jx('builder', '$.development')}) AS dim_builder_development,
    lower({_jx('builder', '$.name')}) AS dim_builder_name,
    lower(city) AS dim_city,
    lower(county) AS dim_county,
    TRY_CAST(countyfips AS STRING) AS dim_fips_county,
    TRY_CAST(statefips AS STRING) AS dim_fips_state,
    lower({_jx('listingoffice', '$.name')}) AS dim_listing_office,
    lower(listingtype) AS dim_listing_type,
    lower(mlsname) AS dim_mls_name,
    lower(propertytype) AS dim_property_type,
    upper(state) AS dim_state,
    lower(status) AS dim_status,
    TRY_CAST(zipcode AS STRING) AS dim_zip,
    TRY_CAST(bathrooms AS DOUBLE) AS met_bathrooms,
    TRY_CAST(bedrooms AS DOUBLE) AS met_bedrooms,
    TRY_CAST(daysonmarket AS BIGINT) AS met_days_on_market,
    TRY_CAST(price AS BIGINT) AS met_price,
    TRY_CAST(squarefootage AS BIGINT) AS met_square_feet,
    TRY_CAST(yearbuilt AS BIGINT) AS met_year_built,
    lower({_jx('builder', '$.phone')}) AS dim_builder_phone,
    TRY_CAST(formattedaddress AS STRING) AS info_full_address,
    {_jtext('history')} AS info_history,
    {_jtext('hoa')} AS info_hoa,
    TRY_CAST(longitude AS DOUBLE) AS info_longitude,
    TRY_CAST(latitude AS DOUBLE) AS info_latitude,
    lower({_jx('listingagent', '$.name')}) AS info_listing_agent,
    lower({_jx('listingagent', '$.email')}) AS info_listing_agent_email,
    {_jx('listingagent', '$.phone')} AS info_listing_agent_phone,
    lower({_jx('listingagent', '$.website')}) AS info_listing_agent_website,
    lower({_jx('listingoffice', '$.email')}) AS info_listing_office_email,
    {_jx('listingoffice', '$.phone')} AS info_listing_office_phone,
    TRY_CAST(addressline1 AS STRING) AS info_street1,
    TRY_CAST(addressline2 AS STRING) AS info_street2"""
_POINT = """TRY_CAST(longitude AS DOUBLE) BETWEEN -180 AND 180 AND TRY_CAST(latitude AS DOUBLE) BETWEEN -90 AND 90"""
_POINT_SQL = f""",
    CASE WHEN {_POINT} THEN TRY_CAST(longitude AS DOUBLE) END AS info_home_lon,
    CASE WHEN {_POINT} THEN TRY_CAST(latitude AS DOUBLE) END AS info_home_lat"""


def base_df(spark, sf_dir):
    """Raw text records -> typed base layer."""
    return typed_projection(raw_listings(spark, sf_dir), BASE_SPEC)


@register("typed_base", O.with_(RAW, select=f"SELECT {_BASE_SQL}{_POINT_SQL}\n  FROM raw"))
def typed_base(spark, sf_dir):
    """41-column typed projection (JSON columns shown as text, the
    point column as its two coordinates)."""
    b = base_df(spark, sf_dir)
    return b.withColumns(
        {"info_history": F.to_json("info_history"), "info_hoa": F.to_json("info_hoa"),
         "info_home_lon": F.col("info_home_location")["lon"],
         "info_home_lat": F.col("info_home_location")["lat"]}).drop("info_home_location")


@register("safe_cast", O.with_(RAW, select="""
  SELECT mlsnumber, bedrooms, TRY_CAST(bedrooms AS DOUBLE) AS met_bedrooms, price,
         TRY_CAST(price AS BIGINT) AS met_price, TRY_CAST(bathrooms AS DOUBLE) AS met_bathrooms,
         TRY_CAST(createddate AS DATE) AS dim_created_date FROM raw"""))
def safe_cast(spark, sf_dir):
    """Bad numbers and dates become NULL, never an error."""
    r = raw_listings(spark, sf_dir)
    return r.select("mlsnumber", "bedrooms", safe_cast_fn("bedrooms", "double").alias("met_bedrooms"),
                    "price", safe_cast_fn("price", "bigint").alias("met_price"),
                    safe_cast_fn("bathrooms", "double").alias("met_bathrooms"),
                    safe_cast_fn("createddate", "date").alias("dim_created_date"))


@register("parse_date", O.with_(RAW, select="""
  SELECT mlsnumber, collected_date, CAST(try_strptime(collected_date, '%Y%m%d') AS DATE) AS dim_collected_date
  FROM raw"""))
def parse_date(spark, sf_dir):
    """H6: yyyyMMdd text to DATE; unreadable values are NULL."""
    r = raw_listings(spark, sf_dir)
    return r.select("mlsnumber", "collected_date",
                    parse_date_fn("collected_date").alias("dim_collected_date"))


@register("normalise_text", """
  SELECT c_custkey, lower(c_mktsegment) AS segment_lower, upper(c_name) AS name_upper FROM customer""")
def normalise_text(spark, sf_dir):
    """H1/H2: lower/upper case normalisation."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", norm_fn("c_mktsegment").alias("segment_lower"),
                    norm_fn("c_name", "upper").alias("name_upper"))


@register("split_trim", """
  SELECT p_partkey, CAST(i - 1 AS INTEGER) AS pos, trim(parts[i]) AS token FROM (
    SELECT p_partkey, parts, generate_subscripts(parts, 1) AS i FROM (
      SELECT p_partkey, string_split(replace(p_name, ' ', ' , '), ',') AS parts FROM part))""")
def split_trim(spark, sf_dir):
    """Split a delimited text, trim each part, one row per part."""
    p = table(spark, sf_dir, "part")
    parts = split_trim_fn(F.replace(F.col("p_name"), F.lit(" "), F.lit(" , ")), ",")
    return p.select("p_partkey", F.posexplode(parts).alias("pos", "token"))


@register("load_stamp", f"""
  SELECT o_orderkey, '{AS_OF.replace('-', '')}' AS collected_date,
         strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS order_day FROM orders""")
def load_stamp(spark, sf_dir):
    """Stamp the load date as yyyyMMdd text."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    o = unions.load_stamp(o, AS_OF)
    o = unions.load_stamp(o, F.col("o_orderdate").cast("date"), name="order_day")
    return o.select("o_orderkey", "collected_date", "order_day")


def _pyrepr_spark():
    """events.props rewritten as Python repr text, with a None row type and
    an apostrophe row type."""
    return (F.when(F.col("event_type") == "error", F.lit("{'k': None, 'src': 'e'}"))
            .when(F.col("event_type") == "click",
                  F.concat(F.lit("{'k': "), F.get_json_object("props", "$.k"), F.lit(", 'note': \"it's\"}")))
            .otherwise(F.replace(F.col("props"), F.lit('"'), F.lit("'"))))
_PYREPR_SQL = ("CASE WHEN event_type = 'error' THEN '{''k'': None, ''src'': ''e''}' "
               "WHEN event_type = 'click' THEN '{''k'': ' || json_extract_string(props, '$.k') || ', ''note'': \"it''s\"}' "
               "ELSE replace(props, '\"', '''') END")


@register("json_extract", f"""
  SELECT event_id, json_extract_string(props, '$.k') AS k_text,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         {_jx(f"({_PYREPR_SQL})", '$.k')} AS k_repr FROM events""")
def json_extract(spark, sf_dir):
    """H4: scalar at a JSON path, also from repaired Python-repr text."""
    e = table(spark, sf_dir, "events")
    k = json_scalar("props", "$.k", repair=None)
    return e.select("event_id", k.alias("k_text"), safe_cast_fn(k, "bigint").alias("k"),
                    json_scalar(_pyrepr_spark(), "$.k").alias("k_repr"))


@register("pydict_to_json", f"""
  SELECT event_id, raw_text, {_jtext('raw_text')} AS compat_json,
         CASE WHEN event_type = 'click'
              THEN '{{"k":' || json_extract_string(props, '$.k') || ',"note":"it''s"}}'
              ELSE {_jtext('raw_text')} END AS strict_json
  FROM (SELECT *, {_PYREPR_SQL} AS raw_text FROM events)""")
def pydict_to_json_q(spark, sf_dir):
    """Python-repr text to JSON; compat repeats the blind repair
    (an apostrophe voids it), strict parses the literal exactly."""
    e = table(spark, sf_dir, "events").select("event_id", _pyrepr_spark().alias("raw_text"))
    return e.select("event_id", "raw_text",
                    F.to_json(pydict_to_json("raw_text", "compat")).alias("compat_json"),
                    F.to_json(pydict_to_json("raw_text", "strict")).alias("strict_json"))


def _event_parts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return [e.where(F.col("event_type") == "view").select("event_id", "ts", "value"),
            e.where(F.col("event_type") == "click").select("event_id", "user_id", "props"),
            e.where(~F.col("event_type").isin("view", "click"))
             .select("event_id", "event_type", "value", "user_id")]


@register("schema_union", """
  SELECT event_id, event_type, props, ts, user_id, value FROM (
    SELECT event_id, ts, value FROM events WHERE event_type = 'view'
    UNION ALL BY NAME SELECT event_id, user_id, props FROM events WHERE event_type = 'click'
    UNION ALL BY NAME SELECT event_id, event_type, value, user_id FROM events
                      WHERE event_type NOT IN ('view', 'click'))""")
def schema_union(spark, sf_dir):
    """Union by name of record sets with different columns;
    columns sorted by name."""
    return unions.schema_union(_event_parts(spark, sf_dir))


_CENTS = "CAST(round(value * 100) AS BIGINT)"
# One JSON record an event; each kind of event has keys of its own, every 97th
# event none that can be read.
_DRIFTING = f"""CASE
  WHEN event_id % 97 = 0 THEN 'not a record'
  WHEN event_type = 'view' THEN '{{"id": ' || CAST(event_id AS STRING) || ', "value": ' || CAST({_CENTS} AS STRING) || ', "meta": {{"user": ' || CAST(user_id AS STRING) || '}}}}'
  WHEN event_type = 'click' THEN '{{"note": "a \\\\"b\\\\"", "props": ' || props || ', "tags": [1, ' || CAST(user_id AS STRING) || ']}}'
  ELSE '{{"kind": "' || event_type || '", "value": null, "id": ' || CAST(event_id AS STRING) || '}}' END"""


@register("record_union", f"""
  SELECT event_id,
    CASE WHEN r AND event_type <> 'click' THEN CAST(event_id AS STRING) ELSE '' END AS id,
    CASE WHEN r AND event_type NOT IN ('view', 'click') THEN event_type ELSE '' END AS kind,
    CASE WHEN r AND event_type = 'view' THEN '{{"user":' || CAST(user_id AS STRING) || '}}' ELSE '' END AS meta,
    CASE WHEN r AND event_type = 'click' THEN 'a "b"' ELSE '' END AS note,
    CASE WHEN r AND event_type = 'click' THEN replace(props, ' ', '') ELSE '' END AS props,
    CASE WHEN r AND event_type = 'click' THEN '[1,' || CAST(user_id AS STRING) || ']' ELSE '' END AS tags,
    CASE WHEN r AND event_type = 'view' THEN CAST({_CENTS} AS STRING) ELSE '' END AS value
  FROM (SELECT *, event_id % 97 <> 0 AS r FROM events)""")
def record_union(spark, sf_dir):
    """Records with drifting keys to the sorted union of their keys,
    absent ones filled, nested ones as JSON text."""
    e = table(spark, sf_dir, "events").selectExpr("event_id", _DRIFTING + " AS record")
    return unions.record_union(e, "record", keep=["event_id"])


@register("bag_union", """
  SELECT 'documents' AS src, doc_id AS item, text FROM documents
  UNION ALL SELECT 'benchmark' AS src, item_id AS item, text FROM benchmark""")
def bag_union(spark, sf_dir):
    """A3/G1: UNION ALL, duplicates kept."""
    d = table(spark, sf_dir, "documents").select(F.lit("documents").alias("src"),
                                                  F.col("doc_id").alias("item"), "text")
    b = table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("src"),
                                                  F.col("item_id").alias("item"), "text")
    return unions.bag_union([d, b])


@register("flatten_nested", """
  SELECT event_id, CAST(to_json({'type': event_type, 'user': user_id, 'ids': [event_id, user_id]}) AS VARCHAR) AS meta,
         CAST(to_json([event_type, CAST(user_id AS STRING)]) AS VARCHAR) AS tags, value FROM events""")
def flatten_nested(spark, sf_dir):
    """A5: nested columns to JSON text, one flat row per record."""
    e = table(spark, sf_dir, "events")
    nested = e.select(
        "event_id",
        F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"),
                 F.array("event_id", "user_id").alias("ids")).alias("meta"),
        F.array("event_type", F.col("user_id").cast("string")).alias("tags"), "value")
    return unions.flatten_nested(nested)


@register("csv_roundtrip", """
  SELECT doc_id, text, CASE WHEN lang = 'en' THEN lang END AS lang, source, n_chars FROM documents""")
def csv_roundtrip(spark, sf_dir):
    """Two daily CSV snapshots with different headers (the
    second lacks ``lang``), long texts with newlines and quotes, read back
    by header name."""
    d = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "csv")
    csvio.write_snapshot(d.where(F.col("lang") == "en").select("doc_id", "lang", "n_chars", "source", "text"),
                         f"{base}/20240101")
    csvio.write_snapshot(d.where(F.col("lang") != "en").select("text", "source", "n_chars", "doc_id"),
                         f"{base}/20240108")
    csvio.write_snapshot(d.limit(0), f"{base}/20240115")   # empty input: nothing is written
    back = csvio.read_snapshots(spark, base)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source",
                       F.col("n_chars").cast("bigint").alias("n_chars"))


_ORDER_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")


@register("paged_source", "SELECT * FROM orders")
def paged_source(spark, sf_dir):
    """A1-A3: pages of 500 orders a key, tasks planned as equal page ranges from
    the keys' counts, one Arrow batch a page."""
    return _paged_orders(spark, sf_dir, "paged_orders")


@register("paged_source_filtered", """SELECT * FROM orders
  WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')""")
def paged_source_filtered(spark, sf_dir):
    """A2: a fixed request filter applied where the pages are read, and a
    filter on the key column."""
    return _paged_orders(spark, sf_dir, "paged_orders_filtered", params={"o_orderstatus": "F"}) \
        .where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))


def _paged_orders(spark, sf_dir, name, params=None):
    """Orders laid out as pages by Spark, then read through the source."""
    orders = table(spark, sf_dir, "orders")
    for c, v in (params or {}).items():
        orders = orders.where(F.col(c) == F.lit(v))
    path = scratch_path(spark, name)
    counts = write_pages(orders, path, "o_orderpriority", "o_orderkey")
    return paged_source_fn(spark, PageFiles(path, params=params), sorted(counts), _ORDER_DDL,
                           key_column="o_orderpriority", name=name, params=params, counts=counts)


@register("table_rebuild", O.with_(*O.FACT_CHAIN, select="""
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY dim_collected_date DESC, listing_key DESC) AS rn
    FROM facts) WHERE rn = 1"""))
def table_rebuild(spark, sf_dir):
    """Full rebuild of a result table, run twice: the second run
    replaces the first."""
    latest = latest_per_key(fact_rows(spark, sf_dir), "id", ["dim_collected_date", "listing_key"])
    path = scratch_path(spark, "latest")
    rebuild_table(latest, path)
    return rebuild_table(latest, path, view="latest_listings")


_SPLIT = "1998-06-01"


@register("incremental_append", O.with_(*O.FACT_CHAIN, select="""
  SELECT listing_key, id, dim_collected_date, met_price, is_active, is_target FROM facts"""))
def incremental_append(spark, sf_dir):
    """A first load of the weeks before a split date and of rows
    without a date, then an incremental run over the whole source that appends
    only the weeks after the stored high-water mark, into date folders."""
    src = fact_rows(spark, sf_dir).select("listing_key", "id", "dim_collected_date", "met_price",
                                          "is_active", "is_target")
    path = scratch_path(spark, "facts")
    early = F.coalesce(F.col("dim_collected_date") < F.lit(_SPLIT).cast("date"), F.lit(True))
    incremental_append_fn(spark, src.where(early), path, "dim_collected_date")
    incremental_append_fn(spark, src, path, "dim_collected_date")
    return read_table(spark, path)


@register("high_water_filter", f"""
  SELECT * FROM orders WHERE o_orderdate > (
    SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '{_SPLIT}')""")
def high_water_filter(spark, sf_dir):
    """Rows strictly newer than the max date of a stored slice
    (lazy scalar subquery)."""
    o = table(spark, sf_dir, "orders")
    target = o.where(F.col("o_orderdate") < F.lit(_SPLIT).cast("timestamp_ntz"))
    return after_mark(o, "o_orderdate", target, "o_orderdate", lazy=True)


def _chain_sql() -> str:
    from .queries_models import _WIDE_COLS, _WIDE_ROUND, _round_sql
    base = f"listings AS (SELECT\n    {_BASE_SQL}\n  FROM raw)"
    long_ = O.LONG.replace("FROM series_r)", "FROM series)")
    wide = O.WIDE.replace("FROM series_r s", "FROM series s")
    rnd = dict(_WIDE_ROUND, met_price_per_sqft_avg=6)
    cols = [c for c in _WIDE_COLS if c != "met_price_per_sqft_avg"]
    return O.with_(RAW, base, O.FLAGS, O.TARGET, O.FACTS, O.ts_cte("is_target"), O.MA, O.YOY,
                   O.SERIES, long_, *O.M.FIT, *O.DETECT, O.PIVOT, wide,
                   select="SELECT " + _round_sql(rnd, cols) + " FROM wide")


@register("chain_run", _chain_sql())
def chain_run(spark, sf_dir):
    """The whole chain over stored tables, run after each of two raw
    loads (raw -> base -> fact -> series -> anomalies, latest).  Returns the
    anomalies table; the equality of the others with a one-shot run is a test."""
    from .chain import run_chain
    from .standins import TARGET_LAT, TARGET_LON, TARGET_ZIP
    raw_dir, wh = scratch_path(spark, "raw"), scratch_path(spark, "wh")
    raw = raw_listings(spark, sf_dir)
    early = F.coalesce(parse_date_fn("collected_date") < F.lit(_SPLIT).cast("date"), F.lit(True))
    csvio.write_snapshot(raw.where(early), f"{raw_dir}/19980531", compression="gzip")
    args = dict(target_zip=TARGET_ZIP, centre_lon=TARGET_LON, centre_lat=TARGET_LAT)
    run_chain(spark, raw_dir, wh, AS_OF, **args)
    csvio.write_snapshot(raw.where(~early).drop("hoa"), f"{raw_dir}/20010805", compression="gzip")
    from .queries_models import _WIDE_ROUND
    out = run_chain(spark, raw_dir, wh, AS_OF, **args)["anomalies"]
    rnd = dict(_WIDE_ROUND, met_price_per_sqft_avg=6)
    return out.withColumns({c: F.round(c, n) for c, n in rnd.items()})


@register("incremental_stream", """
  SELECT o_orderkey, o_custkey, o_totalprice, CAST(date_trunc('week', o_orderdate) AS DATE) AS dim_collected_date
  FROM orders""")
def incremental_stream(spark, sf_dir):
    """A14 in Structured Streaming form: the orders file as a file stream,
    each micro-batch appended by the same high-water-mark function
    (foreachBatch, availableNow), with its checkpoint in the shared folder."""
    from ..streaming.incremental import stream_incremental
    schema = table(spark, sf_dir, "orders").schema
    path, chk = scratch_path(spark, "stream_target"), scratch_path(spark, "stream_chk")

    def shape(s):
        return s.select("o_orderkey", "o_custkey", "o_totalprice",
                        F.date_trunc("week", "o_orderdate").cast("date").alias("dim_collected_date"))

    stream_incremental(spark, sf_dir, schema, path, "dim_collected_date", chk,
                       glob="orders.parquet", transform=shape)
    return read_table(spark, path)
