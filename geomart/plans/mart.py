"""The whole run: clean, check, find the nearest places, join the counts, build and load the star, publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomart.functions.dates import date_key
from geomart.operators.knn import with_nearby_counts
from geomart.operators.mapping import CATEGORY_GROUPS
from geomart.operators.quality import LISTINGS_SUITE, PLACES_SUITE, gate
from geomart.operators.star import WRITTEN_DIMENSIONS, build_star
from geomart.plans.cleaning import clean_listings, clean_places
from geomart.session import materialize
from geomart.sources.tables import load_star
from geomart.streaming.records import publish_folder


def wide_table(
    listings: DataFrame,
    places: DataFrame,
    k: int = 5,
    groups: Sequence[str] = CATEGORY_GROUPS,
    listing_id: str = "id",
    **at,
) -> DataFrame:
    """Listings with the number of their k nearest places per group.

    Both inputs must have rows: without places every listing gets zeros.
    """
    wide = with_nearby_counts(listings, places, k, groups, **at).withColumnRenamed(listing_id, "publication_key")
    if "last_review" in wide.columns:
        wide = wide.withColumn("last_review", date_key(F.col("last_review")))
    return wide


def run(
    raw_listings: DataFrame,
    raw_places: DataFrame,
    category_groups: Mapping[str, Sequence[str]],
    target,
    topic_folder: str | None = None,
    k: int = 5,
    listing_order: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """From raw tables to the loaded star; returns the tables. Empty input stops the run.

    The cleaned tables and the wide table are each written once, as checks, joins and the
    star read them again.
    """
    for name, df in (("listings", raw_listings), ("places", raw_places)):
        if df.isEmpty():
            raise ValueError(f"{name}: no rows")
    listings = gate(materialize(clean_listings(raw_listings, listing_order), "listings"), LISTINGS_SUITE)
    places = gate(materialize(clean_places(raw_places, category_groups), "places"), PLACES_SUITE)
    wide = materialize(wide_table(listings, places, k), "wide")
    tables = build_star(wide)
    load_star(tables, target, ready=WRITTEN_DIMENSIONS)
    if topic_folder:
        publish_folder(wide, topic_folder, "publication_key")
    return tables
