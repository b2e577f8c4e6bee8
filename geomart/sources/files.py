"""CSV tables and landed JSON pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, encoding: str = "ISO-8859-1", multiline: bool = False
) -> DataFrame:
    """CSV with a header and a declared schema; a line that does not fit is kept in ``_corrupt``.

    Quoted line breaks need ``multiline``, which reads each file in one task; without it a
    large file is split.
    """
    full = schema if CORRUPT in schema.names else T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).option("encoding", encoding).option("escape", '"').csv(path)


# The fields of a place reply, and below the flat table's names for them.
PLACE_REPLY = (
    "fsq_id string, name string,"
    " geocodes struct<main:struct<latitude:double,longitude:double>>,"
    " categories array<struct<id:bigint,name:string>>,"
    " location struct<formatted_address:string,locality:string,region:string>,"
    " price int, rating double, popularity double, stats struct<total_tips:int>"
)


def read_pages(spark: SparkSession, path: str, item: str = PLACE_REPLY, max_page: int | None = None) -> DataFrame:
    """All result pages below ``path`` as one row per result.

    A page is ``{"area": …, "page": n, "results": […]}``; all pages are read
    unless the caller sets ``max_page``.
    """
    pages = spark.read.schema(f"area string, page int, results array<struct<{item}>>").json(path)
    if max_page is not None:
        pages = pages.where(F.col("page") <= max_page)
    return pages.select("area", "page", F.explode("results").alias("place"))


def first_element(array: Column) -> Column:
    """First element of an array, NULL when it is empty or NULL."""
    return F.get(array, F.lit(0))


def flatten_places(replies: DataFrame, place: str = "place", area: str = "area") -> DataFrame:
    """Nested place replies to the flat table: scalar paths, first category, all categories as JSON."""
    p = F.col(place)
    return replies.select(
        p["fsq_id"].alias("fsq_id"),
        p["name"].alias("name"),
        p["geocodes"]["main"]["latitude"].alias("latitude"),
        p["geocodes"]["main"]["longitude"].alias("longitude"),
        first_element(p["categories"])["name"].alias("category_main_name"),
        first_element(p["categories"])["id"].alias("category_main_id"),
        F.to_json(F.coalesce(p["categories"], F.array().cast("array<struct<id:bigint,name:string>>"))).alias(
            "all_categories"
        ),
        p["location"]["formatted_address"].alias("address"),
        p["location"]["locality"].alias("locality"),
        p["location"]["region"].alias("region"),
        F.col(area).alias("area_searched"),
        p["price"].alias("price_tier"),
        p["rating"].alias("rating"),
        p["popularity"].alias("popularity_score"),
        p["stats"]["total_tips"].alias("tips_count"),
    )
