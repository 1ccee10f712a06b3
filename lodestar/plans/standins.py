"""Stand-in inputs built from the given test tables.

The test data has no listing table, so listings are derived from
``orders`` joined with ``customer``: an id is a customer (seen many times),
a row is an order.  Every column is a deterministic expression of the
source row, written so that the DuckDB oracle text computes the same bits.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values for the stand-in runs.
AS_OF = "2001-12-31"
RECENT_AS_OF = "2001-07-31"
TARGET_ZIP = "7"
# Reference point for the target flag: longitude, latitude.
TARGET_LON = -121.32954935564848
TARGET_LAT = 44.06101015041879
TARGET_RADIUS_M = 3000.0
COMPS_RADIUS_M = 1000.0
URGENT = "1-URGENT"


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given test table.  The tables are read-only, so the DataFrame (its
    file listing and footer-derived schema) is built once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _join_customers(o: DataFrame, c: DataFrame) -> DataFrame:
    """orders x customer.  The customer table grows with the data, so it is
    not broadcast: a sort-merge join keyed on the customer (spills instead
    of holding a hash table per partition), which also spreads the per-row
    work after the join over the shuffle partitions."""
    return o.join(c.hint("merge"), o.o_custkey == c.c_custkey, "inner")


@lru_cache(maxsize=64)
def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing-shaped rows, base-layer column names."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    k = F.col("o_orderkey")
    od = F.col("o_orderdate").cast("date")
    return _join_customers(o, c).select(
        F.col("o_custkey").cast("string").alias("id"),
        k.alias("listing_key"),
        F.date_trunc("week", F.col("o_orderdate")).cast("date").alias("dim_collected_date"),
        od.alias("dim_created_date"),
        od.alias("dim_listed_date"),
        F.when(F.col("o_orderstatus") == "F", od).alias("dim_removed_date"),
        F.lower(F.col("o_orderstatus")).alias("dim_status"),
        F.col("c_nationkey").cast("string").alias("dim_zip"),
        (F.col("o_orderpriority") == F.lit(URGENT)).alias("is_urgent"),
        (F.lit(1) + k % 3).cast("double").alias("met_bathrooms"),
        (k % 4).cast("double").alias("met_bedrooms"),
        F.round(F.col("o_totalprice")).cast("long").alias("met_price"),
        (F.lit(800) + k % 2400).alias("met_square_feet"),
        (F.lit(1950) + k % 52).alias("met_year_built"),
        (F.lit(44.0) + (k * 7919 % 10007).cast("double") / 10007 * 0.1).alias("info_latitude"),
        (F.lit(-121.4) + (k * 104729 % 10009).cast("double") / 10009 * 0.15).alias("info_longitude"),
        F.col("c_name").alias("info_street1"),
    )


def listings_sql() -> str:
    """The same stand-in as SQL text (DuckDB and Spark SQL both accept it)."""
    return f"""
    SELECT
      CAST(o.o_custkey AS STRING) AS id,
      o.o_orderkey AS listing_key,
      CAST(date_trunc('week', o.o_orderdate) AS DATE) AS dim_collected_date,
      CAST(o.o_orderdate AS DATE) AS dim_created_date,
      CAST(o.o_orderdate AS DATE) AS dim_listed_date,
      CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_orderdate AS DATE) END AS dim_removed_date,
      lower(o.o_orderstatus) AS dim_status,
      CAST(c.c_nationkey AS STRING) AS dim_zip,
      (o.o_orderpriority = '{URGENT}') AS is_urgent,
      CAST(1 + o.o_orderkey % 3 AS DOUBLE) AS met_bathrooms,
      CAST(o.o_orderkey % 4 AS DOUBLE) AS met_bedrooms,
      CAST(round(o.o_totalprice) AS BIGINT) AS met_price,
      800 + o.o_orderkey % 2400 AS met_square_feet,
      1950 + o.o_orderkey % 52 AS met_year_built,
      44.0 + CAST(o.o_orderkey * 7919 % 10007 AS DOUBLE) / 10007 * 0.1 AS info_latitude,
      -121.4 + CAST(o.o_orderkey * 104729 % 10009 AS DOUBLE) / 10009 * 0.15 AS info_longitude,
      c.c_name AS info_street1
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    """


def _s(c):
    return c.cast("string")


@lru_cache(maxsize=64)
def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed records as text (33 columns, lower-case names), with junk
    values and Python-repr nested fields whose keys are in sorted order."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name")
    k, nk = F.col("o_orderkey"), _s(F.col("c_nationkey"))
    day = F.col("o_orderdate").cast("date")
    created = _s(day)
    price_int = _s(F.round(F.col("o_totalprice")).cast("long"))
    week = F.date_trunc("week", F.col("o_orderdate")).cast("date")
    return _join_customers(o, c).select(
        _s(F.col("o_custkey")).alias("id"),
        F.concat(F.lit("MLS"), _s(k)).alias("mlsnumber"),
        F.when(k % 101 == 0, F.lit("2024-06")).otherwise(F.date_format(week, "yyyyMMdd")).alias("collected_date"),
        created.alias("createddate"),
        _s(F.date_add(day, 7)).alias("lastseendate"),
        created.alias("listeddate"),
        F.when(F.col("o_orderstatus") == "F", created).alias("removeddate"),
        F.concat(F.lit("{'development': 'Dev "), nk, F.lit("', 'name': 'Builder "), _s(k % 13),
                 F.lit("', 'phone': None}")).alias("builder"),
        F.concat(F.lit("City "), nk).alias("city"),
        F.concat(F.lit("County "), _s(F.col("o_custkey") % 5)).alias("county"),
        F.lpad(nk, 3, "0").alias("countyfips"),
        F.lit("041").alias("statefips"),
        F.concat(F.lit("{'email': 'OFFICE"), nk, F.lit("@EXAMPLE.COM', 'name': 'Office "), nk,
                 F.lit("', 'phone': '555-01"), F.lpad(nk, 2, "0"), F.lit("'}")).alias("listingoffice"),
        F.lit("Standard").alias("listingtype"),
        F.lit("MLS Central").alias("mlsname"),
        F.lit("Single Family").alias("propertytype"),
        F.lit("or").alias("state"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Inactive")).otherwise(F.lit("Active")).alias("status"),
        F.lpad(_s(F.col("o_custkey") % 1000), 5, "0").alias("zipcode"),
        F.when(k % 7 == 0, F.lit("2.5")).otherwise(_s(F.lit(1) + k % 3)).alias("bathrooms"),
        F.when(k % 53 == 0, F.lit("abc")).when(k % 59 == 0, F.lit("")).otherwise(_s(k % 4)).alias("bedrooms"),
        _s(k % 120).alias("daysonmarket"),
        F.when(k % 97 == 0, F.lit("n/a")).otherwise(price_int).alias("price"),
        _s(F.lit(800) + k % 2400).alias("squarefootage"),
        _s(F.lit(1950) + k % 52).alias("yearbuilt"),
        F.concat(F.col("c_name"), F.lit(", City "), nk).alias("formattedaddress"),
        F.concat(F.lit("{'"), created, F.lit("': {'event': 'Sale Listing', 'listingType': None, 'price': "),
                 price_int, F.lit("}}")).alias("history"),
        F.when(k % 3 != 0, F.concat(F.lit("{'fee': "), _s(k % 500), F.lit("}"))).alias("hoa"),
        F.concat(F.lit("-121."), F.lpad(_s(k * 104729 % 10009), 5, "0")).alias("longitude"),
        F.when(k % 211 != 0, F.concat(F.lit("44."), F.lpad(_s(k * 7919 % 10007), 5, "0"))).alias("latitude"),
        F.concat(F.lit("{'email': 'AGENT"), _s(k % 17), F.lit("@EXAMPLE.COM', 'name': 'Agent "), _s(k % 17),
                 F.lit("', 'phone': '555-02"), F.lpad(_s(k % 17), 2, "0"), F.lit("', 'website': None}")).alias("listingagent"),
        F.col("c_name").alias("addressline1"),
        F.when(k % 10 == 0, F.concat(F.lit("Unit "), _s(k % 7))).alias("addressline2"),
    )


def raw_listings_sql() -> str:
    k, nk = "o.o_orderkey", "CAST(c.c_nationkey AS STRING)"
    created = "CAST(CAST(o.o_orderdate AS DATE) AS STRING)"
    price_int = "CAST(CAST(round(o.o_totalprice) AS BIGINT) AS STRING)"
    return f"""
    SELECT
      CAST(o.o_custkey AS STRING) AS id,
      'MLS' || CAST({k} AS STRING) AS mlsnumber,
      CASE WHEN {k} % 101 = 0 THEN '2024-06' ELSE strftime(CAST(date_trunc('week', o.o_orderdate) AS DATE), '%Y%m%d') END AS collected_date,
      {created} AS createddate,
      CAST(CAST(o.o_orderdate AS DATE) + 7 AS STRING) AS lastseendate,
      {created} AS listeddate,
      CASE WHEN o.o_orderstatus = 'F' THEN {created} END AS removeddate,
      '{{''development'': ''Dev ' || {nk} || ''', ''name'': ''Builder ' || CAST({k} % 13 AS STRING) || ''', ''phone'': None}}' AS builder,
      'City ' || {nk} AS city,
      'County ' || CAST(o.o_custkey % 5 AS STRING) AS county,
      lpad({nk}, 3, '0') AS countyfips,
      '041' AS statefips,
      '{{''email'': ''OFFICE' || {nk} || '@EXAMPLE.COM'', ''name'': ''Office ' || {nk} || ''', ''phone'': ''555-01' || lpad({nk}, 2, '0') || '''}}' AS listingoffice,
      'Standard' AS listingtype,
      'MLS Central' AS mlsname,
      'Single Family' AS propertytype,
      'or' AS state,
      CASE WHEN o.o_orderstatus = 'F' THEN 'Inactive' ELSE 'Active' END AS status,
      lpad(CAST(o.o_custkey % 1000 AS STRING), 5, '0') AS zipcode,
      CASE WHEN {k} % 7 = 0 THEN '2.5' ELSE CAST(1 + {k} % 3 AS STRING) END AS bathrooms,
      CASE WHEN {k} % 53 = 0 THEN 'abc' WHEN {k} % 59 = 0 THEN '' ELSE CAST({k} % 4 AS STRING) END AS bedrooms,
      CAST({k} % 120 AS STRING) AS daysonmarket,
      CASE WHEN {k} % 97 = 0 THEN 'n/a' ELSE {price_int} END AS price,
      CAST(800 + {k} % 2400 AS STRING) AS squarefootage,
      CAST(1950 + {k} % 52 AS STRING) AS yearbuilt,
      c.c_name || ', City ' || {nk} AS formattedaddress,
      '{{''' || {created} || ''': {{''event'': ''Sale Listing'', ''listingType'': None, ''price'': ' || {price_int} || '}}}}' AS history,
      CASE WHEN {k} % 3 <> 0 THEN '{{''fee'': ' || CAST({k} % 500 AS STRING) || '}}' END AS hoa,
      '-121.' || lpad(CAST({k} * 104729 % 10009 AS STRING), 5, '0') AS longitude,
      CASE WHEN {k} % 211 <> 0 THEN '44.' || lpad(CAST({k} * 7919 % 10007 AS STRING), 5, '0') END AS latitude,
      '{{''email'': ''AGENT' || CAST({k} % 17 AS STRING) || '@EXAMPLE.COM'', ''name'': ''Agent ' || CAST({k} % 17 AS STRING) || ''', ''phone'': ''555-02' || lpad(CAST({k} % 17 AS STRING), 2, '0') || ''', ''website'': None}}' AS listingagent,
      c.c_name AS addressline1,
      CASE WHEN {k} % 10 = 0 THEN 'Unit ' || CAST({k} % 7 AS STRING) END AS addressline2
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    """
