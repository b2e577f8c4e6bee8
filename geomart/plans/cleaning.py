"""The cleaning recipes of the two tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.functions.dates import SENTINEL_DATE, parse_date
from geomart.functions.text import flag_from_map, flag_from_text, parse_currency, to_number
from geomart.operators import columns as C
from geomart.operators.keys import dense_key
from geomart.operators.mapping import category_map, fuzzy_standardize

# Column sets, canonical boroughs, default fills and the regions left out.
INTEGER_COLUMNS = (
    "construction_year",
    "minimum_nights",
    "number_of_reviews",
    "review_rate_number",
    "calculated_host_listings_count",
    "availability_365",
)
DOUBLE_COLUMNS = ("lat", "long", "reviews_per_month")
TEXT_COLUMNS = ("name", "host_name", "neighbourhood_group", "neighbourhood", "cancellation_policy", "room_type")
BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")
BOROUGH_CUTOFF = 80
UNUSED_COLUMNS = ("host_identity_verified", "instant_bookable", "country", "country_code", "license", "house_rules")
LOCATION = ("neighbourhood_group", "neighbourhood", "lat", "long")
FILLS = {
    "name": "no_name",
    "host_name": "unknown_host",
    "cancellation_policy": "moderate",
    "construction_year": 2012,
    "price": 624.0,
    "service_fee": 125.0,
    "minimum_nights": 3,
    "number_of_reviews": 0,
    "reviews_per_month": 0.0,
    "calculated_host_listings_count": 1,
    "availability_365": 96,
    "host_verification": False,
    "instant_bookable_flag": False,
}
FIRST_LISTING_KEY = 1
FIRST_HOST_KEY = 150000
FOREIGN_REGIONS = ("NJ", "CT", "PA")
UNUSED_PLACE_COLUMNS = (
    "price_tier",
    "tips_count",
    "popularity_score",
    "address",
    "category_main_id",
    "category_main_name",
    "all_categories",
    "rating",
    "region",
    "area_searched",
    "locality",
    "name",
)


def clean_listings(
    raw: DataFrame, order_by: Sequence[str] | None = None, scorer: str = "weighted", date_format: str = "M/d/yyyy"
) -> DataFrame:
    """Raw listings (all text) to the typed, filled table.

    With ``order_by`` (unique columns) the listing and host keys are replaced by positions
    in that order, given before any row is dropped; without it the keys of the source stay.
    """
    df = C.normalize_columns(raw)
    df = C.parse_integers(df, [c for c in INTEGER_COLUMNS if c in df.columns])
    df = df.withColumns({c: to_number(F.col(c)) for c in DOUBLE_COLUMNS})
    if order_by:
        df = dense_key(df.withColumn("__source_id", F.col(order_by[0])), "__key", ["__source_id", *order_by[1:]])
        df = df.withColumns(
            {
                "id": F.col("__key") + (FIRST_LISTING_KEY - 1),
                "host_id": F.col("__key") + (FIRST_HOST_KEY - 1),
            }
        ).drop("__key", "__source_id")
    else:
        df = df.withColumns({c: F.col(c).try_cast("long") for c in ("id", "host_id")})
    df = C.clean_text_columns(df, TEXT_COLUMNS)
    df = fuzzy_standardize(df, "neighbourhood_group", BOROUGHS, BOROUGH_CUTOFF, scorer)
    df = df.withColumns(
        {
            "last_review": parse_date(F.col("last_review"), date_format),
            "host_verification": flag_from_map(
                F.col("host_identity_verified"), {"verified": True, "unconfirmed": False}
            ),
            "instant_bookable_flag": flag_from_text(F.col("instant_bookable")),
            "price": parse_currency(F.col("price")),
            "service_fee": parse_currency(F.col("service_fee")),
        }
    )
    df = C.drop_nulls(C.drop_columns(df, UNUSED_COLUMNS), LOCATION)
    silent = (
        (F.coalesce("number_of_reviews", F.lit(0)) == 0)
        & F.col("last_review").isNull()
        & F.col("review_rate_number").isNull()
    )
    df = C.fill_constants(C.drop_where(df, silent), FILLS)
    df = df.withColumn("last_review", F.coalesce("last_review", F.lit(SENTINEL_DATE)))
    return C.drop_nulls(df, ["review_rate_number"])


def clean_places(
    raw: DataFrame,
    groups: Mapping[str, Sequence[str]],
    regions: Sequence[str] = FOREIGN_REGIONS,
    exclude: bool = True,
    order_by: Sequence[str] = ("fsq_id",),
) -> DataFrame:
    """Raw places to (fsq_id, latitude, longitude, category_group) with dense ids.

    ``exclude`` leaves out the listed regions, otherwise only they are kept. ``groups`` is
    the category list per group, in order of precedence.
    """
    df = C.keep_not_in(raw, "region", regions) if exclude else C.keep_in(raw, "region", regions)
    df = category_map(df, "category_main_name", "category_group", groups)
    df = df.withColumnRenamed("fsq_id", "__source_id")
    order = ["__source_id" if c == "fsq_id" else c for c in order_by]
    df = dense_key(df, "fsq_id", order)
    return C.drop_columns(df, [*UNUSED_PLACE_COLUMNS, "__source_id"])
