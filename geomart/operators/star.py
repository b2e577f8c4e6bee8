"""Star schema: dimensions, key lookups by joins, and inserts of missing members."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomart.functions.dates import date_from_key, date_parts
from geomart.functions.text import is_true_text, to_number, to_whole_number
from geomart.operators.columns import require_columns
from geomart.operators.keys import dense_key
from geomart.operators.mapping import CATEGORY_GROUPS
from geomart.operators.quality import broken_keys, check_foreign_key, check_unique
from geomart.operators.reshape import count_column
from geomart.operators.skew import first_per_key
from geomart.session import materialize, materialize_all

# The measures and dimension columns of the mart.
MEASURES = (
    "price",
    "service_fee",
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "review_rate_number",
    "availability_365",
)
HOST_COLUMNS = ("host_id", "host_name", "host_verification", "calculated_host_listings_count")
LOCATION_COLUMNS = ("neighbourhood_group", "neighbourhood", "lat", "long")
PROPERTY_COLUMNS = ("property_name", "instant_bookable_flag", "cancellation_policy", "room_type", "construction_year")
WRITTEN_DIMENSIONS = ("dim_host", "dim_property_location")
LOAD_ORDER = ("dim_host", "dim_property_location", "dim_property", "dim_date", "fact_publication")
#: Dimensions whose keys are given out in order.
DIMENSION_KEYS = {"dim_host": "host_key", "dim_property_location": "property_location_key", "dim_property": "property_key"}
PRIMARY_KEYS = {**DIMENSION_KEYS, "dim_date": "date_key"}
#: The dimension each key of a fact leads to.
FACT_KEYS = {
    "property_key": "dim_property",
    "host_key": "dim_host",
    "property_location_key": "dim_property_location",
    "last_review_date_key": "dim_date",
}


def verified_flag(c: Column) -> Column:
    """Truth of a flag or number, any non-empty text (``verified`` among them); NULL is false."""
    text = c.cast("string")
    true = F.when(F.typeof(c) == "string", text != "").otherwise(~text.isin("false", "0", "0.0"))
    return F.coalesce(true, F.lit(False))


def coordinate(c: Column, kind: T.DataType | None = None) -> Column:
    return to_number(c, kind).cast("decimal(10,7)")


def host_members(df: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per host, the first in ``order_by``; rows without a host id have no member."""
    hosts = require_columns(df, [*dict.fromkeys([*HOST_COLUMNS, *order_by])]).where(F.col("host_id").isNotNull())
    hosts = first_per_key(hosts, ["host_id"], order_by).select(*HOST_COLUMNS)
    return hosts.withColumn("host_verification", verified_flag(F.col("host_verification")))


def dim_host(df: DataFrame, order_by: list[str]) -> DataFrame:
    """The hosts with a dense key."""
    return dense_key(host_members(df, order_by), "host_key", ["host_id"]).select("host_key", *HOST_COLUMNS)


LOCATION_KEY = ["listing_neighbourhood_group", "listing_neighbourhood", "listing_lat", "listing_long"]


def location_members(df: DataFrame) -> DataFrame:
    """Distinct places of listings; coordinates as DECIMAL(10,7), rows without them left out."""
    rows = require_columns(df, LOCATION_COLUMNS).select(
        F.col("neighbourhood_group").alias("listing_neighbourhood_group"),
        F.col("neighbourhood").alias("listing_neighbourhood"),
        coordinate(F.col("lat"), df.schema["lat"].dataType).alias("listing_lat"),
        coordinate(F.col("long"), df.schema["long"].dataType).alias("listing_long"),
    )
    return rows.dropna(subset=["listing_lat", "listing_long"]).distinct()


def dim_location(df: DataFrame) -> DataFrame:
    """The places with a dense key."""
    return dense_key(location_members(df), "property_location_key", LOCATION_KEY).select("property_location_key", *LOCATION_KEY)


def property_members(df: DataFrame, *keys: str) -> DataFrame:
    """One row per publication, with the columns ``keys`` besides."""
    rows = require_columns(df.withColumnRenamed("name", "property_name"), [*keys, "publication_key", *PROPERTY_COLUMNS])
    return rows.withColumns(
        {
            "instant_bookable_flag": is_true_text(F.col("instant_bookable_flag")),
            "construction_year": to_whole_number(F.col("construction_year"), rows.schema["construction_year"].dataType),
        }
    )


def dim_property(df: DataFrame) -> DataFrame:
    """One row per publication, keyed 1..n in the order of the publication key."""
    return dense_key(property_members(df), "property_key", ["publication_key"]).select(
        "property_key", "publication_key", *PROPERTY_COLUMNS
    )


def dim_date(df: DataFrame, key: str = "last_review") -> DataFrame:
    """Distinct integer dates with their parts; numbers that are no dates are left out."""
    days = df.select(F.col(key).cast("int").alias("date_key")).distinct()
    days = days.withColumn("full_date", date_from_key(F.col("date_key"))).where(F.col("full_date").isNotNull())
    return days.withColumns(date_parts(F.col("full_date"))).orderBy("date_key")


@dataclass(frozen=True)
class Lookup:
    """How a fact finds its key in a dimension: fact expression per natural-key column."""

    dimension: DataFrame
    key: str
    natural: dict[str, Column]


def resolve_keys(fact: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Add each dimension's key by a left join on its natural key.

    A composite key may hold NULLs, which then match each other; a single NULL key has no member.
    Whether a dimension is broadcast and a hot member split is left to the planner, which knows the sizes.
    """
    natural = {f"__{look.key}_{n}": e for look in lookups for n, e in look.natural.items()}
    fact = fact.withColumns(natural)
    for look in lookups:
        own = {f"__{look.key}_{n}": f"__dim_{n}" for n in look.natural}
        dim = look.dimension.select(look.key, *[F.col(n).alias(f"__dim_{n}") for n in look.natural])
        if len(own) == 1:
            match = [F.col(a) == F.col(b) for a, b in own.items()]
        else:
            match = [F.col(a).eqNullSafe(F.col(b)) for a, b in own.items()]
        fact = fact.join(dim, match, "left").drop(*own.values())
    return fact.drop(*natural)


def fact_publication(df: DataFrame, host: DataFrame, location: DataFrame) -> DataFrame:
    """The facts of listings that already carry ``property_key``: publications and facts are one to one."""
    counts = [count_column(g) for g in CATEGORY_GROUPS]
    lookup = ["property_key", "host_id", "lat", "long", "neighbourhood_group", "neighbourhood", "last_review"]
    rows = require_columns(df, [*MEASURES, *counts, *lookup])
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    rows = rows.withColumns(
        {c: to_number(F.col(c), kinds[c]) for c in MEASURES} | {c: F.col(c).cast("int") for c in counts}
    )
    keyed = resolve_keys(
        rows,
        [
            Lookup(host, "host_key", {"host_id": F.col("host_id")}),
            Lookup(
                location,
                "property_location_key",
                {
                    "listing_neighbourhood_group": F.col("neighbourhood_group"),
                    "listing_neighbourhood": F.col("neighbourhood"),
                    "listing_lat": coordinate(F.col("lat"), kinds["lat"]),
                    "listing_long": coordinate(F.col("long"), kinds["long"]),
                },
            ),
        ],
    )
    return keyed.select(
        "property_key",
        "host_key",
        "property_location_key",
        F.col("last_review").cast("int").alias("last_review_date_key"),
        *MEASURES,
        *counts,
    )


def new_members(
    dim: DataFrame, incoming: DataFrame, natural: list[str], key: str, order_by: list[str | Column], top: int
) -> DataFrame:
    """The members of ``incoming`` that ``dim`` lacks, keyed from ``top + 1`` on.

    A natural key that is NULL in all its columns names no member; NULLs within a composite one match each other.
    Of ``dim`` only the natural key is read, and the smaller side of the join is up to the planner.
    """
    attributes = [c for c in dim.columns if c != key]
    named = F.lit(False)
    for c in natural:
        named = named | F.col(c).isNotNull()
    fresh = first_per_key(incoming.where(named), natural, order_by).select(*attributes)
    known = dim.select(*[F.col(c).alias(f"__known_{c}") for c in natural])
    fresh = fresh.join(known, [F.col(c).eqNullSafe(F.col(f"__known_{c}")) for c in natural], "left_anti")
    return dense_key(fresh, key, natural, start=top + 1).select(*dim.columns)


def upsert_dimension(
    dim: DataFrame, incoming: DataFrame, natural: list[str], key: str, order_by: list[str | Column]
) -> DataFrame:
    """``dim`` plus the members of ``incoming`` it lacks, keyed above the present maximum."""
    top = dim.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
    return dim.unionByName(new_members(dim, incoming, natural, key, order_by, top))


def build_star(df: DataFrame) -> dict[str, DataFrame]:
    """The five tables of the mart from the wide listings table.

    The listings are numbered once: the property dimension and the facts are two views of the
    numbered table. It and the two dimensions that the facts look up are written side by side.
    """
    ready = materialize_all(
        {
            "numbered": lambda: dense_key(df, "property_key", ["publication_key"]),
            "dim_host": lambda: dim_host(df, ["publication_key"]),
            "dim_property_location": lambda: dim_location(df),
        }
    )
    numbered = ready.pop("numbered")
    prop = property_members(numbered, "property_key")
    fact = fact_publication(numbered, ready["dim_host"], ready["dim_property_location"])
    return {**ready, "dim_property": prop, "dim_date": dim_date(df), "fact_publication": fact}


class LoadError(ValueError):
    """A batch that would break a key of the mart."""


def check_star(tables: Mapping[str, DataFrame]) -> None:
    """Refuse a star with a key that is missing, given twice, or without its member.

    Constraints between tables that aren't all there, or on columns that they don't have, are left out.
    """
    primary = {n: k for n, k in PRIMARY_KEYS.items() if n in tables and k in tables[n].columns}
    child = "fact_publication"
    foreign = [(child, c, n) for c, n in FACT_KEYS.items() if n in primary and child in tables and c in tables[child].columns]
    if not primary:
        return
    broken = broken_keys(tables, primary, foreign)
    found = [f"{r.constraint}: {r.n} rows, such as {r.example}" for r in broken.collect()]  # one row per constraint
    if found:
        raise LoadError("; ".join(sorted(found)))


def new_rows(batch: DataFrame, star: Mapping[str, DataFrame], top: Mapping[str, int]) -> dict[str, DataFrame]:
    """What the listings of ``batch`` add to each table of a star whose highest keys are ``top``.

    The rows are written to the scratch folder and checked there: a publication that is already loaded or comes
    twice, a fact without one of its keys, or a key without its member refuses the whole batch. Of
    the tables only natural keys and keys are read.
    """
    batch = materialize(batch, "batch")
    known = star["dim_property"].select("publication_key")
    again = check_unique(batch, ["publication_key"]).select("publication_key").unionByName(
        batch.join(known, "publication_key", "left_semi").select("publication_key")
    )
    if not again.isEmpty():
        raise LoadError(f"publication {again.first()[0]} is there already or comes twice")
    hosts, places, props = host_members(batch, ["publication_key"]), location_members(batch), property_members(batch)
    days = dim_date(batch).join(star["dim_date"].select("date_key"), "date_key", "left_anti")
    rows = materialize_all(
        {
            "dim_host": lambda: new_members(star["dim_host"], hosts, ["host_id"], "host_key", ["host_id"], top["dim_host"]),
            "dim_property_location": lambda: new_members(
                star["dim_property_location"],
                places,
                LOCATION_KEY,
                "property_location_key",
                LOCATION_KEY,
                top["dim_property_location"],
            ),
            "dim_property": lambda: new_members(
                star["dim_property"], props, ["publication_key"], "property_key", ["publication_key"], top["dim_property"]
            ),
            "dim_date": lambda: days.select(*star["dim_date"].columns),
        }
    )
    keyed = batch.join(rows["dim_property"].select("publication_key", "property_key"), "publication_key", "left")
    host, place = (star[n].unionByName(rows[n]) for n in ("dim_host", "dim_property_location"))
    fact = materialize(fact_publication(keyed, host, place), "fact_batch")
    # Keys that were found come from their dimension, so a missing one shows as NULL; only dates are taken as they are.
    empty = fact.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FACT_KEYS]).first()
    for c in FACT_KEYS:
        if empty[c]:
            raise LoadError(f"{empty[c]} facts without {c}")
    every_day = star["dim_date"].select("date_key").unionByName(rows["dim_date"].select("date_key"))
    if not check_foreign_key(fact, "last_review_date_key", every_day, "date_key").isEmpty():
        raise LoadError("facts whose last_review_date_key is not in dim_date")
    return {**rows, "fact_publication": fact}


def append_facts(batch: DataFrame, star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The star with the listings of ``batch`` added (see :func:`new_rows`); no table is written again."""
    top = {n: star[n].agg(F.coalesce(F.max(k), F.lit(0)).cast("long")).scalar() for n, k in DIMENSION_KEYS.items()}
    rows = new_rows(batch, star, top)
    return {n: star[n].unionByName(rows[n]) for n in LOAD_ORDER}
