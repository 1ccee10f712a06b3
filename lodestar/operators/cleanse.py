"""Spec-driven typed projection of raw text records.

A spec is a list of ``Field(target, source, type, how)``; every cast is a
safe cast, so a bad value is NULL and never fails the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import parse_date, safe_cast
from ..functions.geo import geo_point
from ..functions.jsonish import repaired_text, variant_scalar


@dataclass(frozen=True)
class Field:
    target: str
    source: str | tuple[str, str]
    type: str = "string"
    how: str | None = None      # lower | upper | yyyymmdd | json:<path>[:lower] | pydict | point


_PARSED = "__parsed"


def field_expr(f: Field, doubles: dict[str, Column], parsed: dict[str, Column]) -> Column:
    """One field, from the raw columns, those cast to double and those parsed."""
    def double(c):
        return doubles[c] if c in doubles else safe_cast(c, "double")

    how = f.how or ""
    if how == "point":
        return geo_point(*map(double, f.source))
    if how == "pydict":
        return parsed[f.source]
    if how.startswith("json:"):
        _, path, *lower = how.split(":")
        v = variant_scalar(parsed[f.source], path)
        return safe_cast(F.lower(v) if lower else v, f.type)
    src = F.col(f.source)
    if how == "yyyymmdd":
        return parse_date(src, "yyyyMMdd")
    if how == "lower":
        return safe_cast(F.lower(safe_cast(src, "string")), f.type)
    if how == "upper":
        return safe_cast(F.upper(safe_cast(src, "string")), f.type)
    return double(f.source) if f.type == "double" else safe_cast(src, f.type)


def typed_projection(df: DataFrame, spec: list[Field], json_repair: str = "compat") -> DataFrame:
    """Project raw columns (matched case-insensitively) to the typed spec.
    Each nested source column is repaired and parsed once; every path
    reads that parsed value.

    Nested texts are parsed, and texts cast to double, as an array each:
    Spark compiles a projection with ``transform`` in parts, one of so many
    columns without it to a single method too long for the JVM's compiler."""
    kinds = {c.lower(): t for c, t in df.dtypes}
    missing = {s for f in spec for s in (f.source if isinstance(f.source, tuple) else (f.source,))
               if s.lower() not in kinds}
    if missing:
        df = df.withColumns({m: F.lit(None).cast("string") for m in sorted(missing)})
    nested = sorted({f.source for f in spec if (f.how or "").startswith(("json:", "pydict"))})
    if nested:
        df = df.withColumn(_PARSED, F.transform(
            F.array(*[repaired_text(safe_cast(s, "string"), json_repair) for s in nested]), F.try_parse_json))
    texts = sorted({s for f in spec for s in (f.source if f.how == "point" else (f.source,))
                    if (f.how == "point" or f.how is None and f.type == "double")
                    and kinds.get(s.lower(), "string") == "string"})
    cast = F.transform(F.array(*texts), lambda x: safe_cast(x, "double"))
    doubles = {s: cast[i] for i, s in enumerate(texts)}
    parsed = {s: F.col(_PARSED)[i] for i, s in enumerate(nested)}
    return df.select(*[field_expr(f, doubles, parsed).alias(f.target) for f in spec])


def _j(path: str, lower: bool = True) -> str:
    return f"json:{path}" + (":lower" if lower else "")


# The listing base layer (41 columns), target <- raw source.
BASE_SPEC = [
    Field("id", "id"),
    Field("mls_number", "mlsnumber"),
    Field("dim_collected_date", "collected_date", "date", "yyyymmdd"),
    Field("dim_created_date", "createddate", "date"),
    Field("dim_last_seen_date", "lastseendate", "date"),
    Field("dim_listed_date", "listeddate", "date"),
    Field("dim_removed_date", "removeddate", "date"),
    Field("dim_builder_development", "builder", "string", _j("$.development")),
    Field("dim_builder_name", "builder", "string", _j("$.name")),
    Field("dim_city", "city", "string", "lower"),
    Field("dim_county", "county", "string", "lower"),
    Field("dim_fips_county", "countyfips"),
    Field("dim_fips_state", "statefips"),
    Field("dim_listing_office", "listingoffice", "string", _j("$.name")),
    Field("dim_listing_type", "listingtype", "string", "lower"),
    Field("dim_mls_name", "mlsname", "string", "lower"),
    Field("dim_property_type", "propertytype", "string", "lower"),
    Field("dim_state", "state", "string", "upper"),
    Field("dim_status", "status", "string", "lower"),
    Field("dim_zip", "zipcode"),
    Field("met_bathrooms", "bathrooms", "double"),
    Field("met_bedrooms", "bedrooms", "double"),
    Field("met_days_on_market", "daysonmarket", "bigint"),
    Field("met_price", "price", "bigint"),
    Field("met_square_feet", "squarefootage", "bigint"),
    Field("met_year_built", "yearbuilt", "bigint"),
    Field("dim_builder_phone", "builder", "string", _j("$.phone")),
    Field("info_full_address", "formattedaddress"),
    Field("info_history", "history", "variant", "pydict"),
    Field("info_hoa", "hoa", "variant", "pydict"),
    Field("info_longitude", "longitude", "double"),
    Field("info_latitude", "latitude", "double"),
    Field("info_home_location", ("longitude", "latitude"), "point", "point"),
    Field("info_listing_agent", "listingagent", "string", _j("$.name")),
    Field("info_listing_agent_email", "listingagent", "string", _j("$.email")),
    Field("info_listing_agent_phone", "listingagent", "string", _j("$.phone", False)),
    Field("info_listing_agent_website", "listingagent", "string", _j("$.website")),
    Field("info_listing_office_email", "listingoffice", "string", _j("$.email")),
    Field("info_listing_office_phone", "listingoffice", "string", _j("$.phone", False)),
    Field("info_street1", "addressline1"),
    Field("info_street2", "addressline2"),
]
