"""Registration, table access, and stand-in columns written once per engine.

The tables hold neither coordinates nor dirty values; both are derived from keys by the
same rule in Spark and in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomart.operators.mapping import CATEGORY_GROUPS, OTHER_GROUP

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def coords(key: str, lat_step: int, lon_step: int) -> tuple[Column, Column]:
    k = F.col(key)
    return (k * lat_step % 18000) / F.lit(100.0) - 90, (k * lon_step % 36000) / F.lit(100.0) - 180


def coords_sql(key: str, lat_step: int, lon_step: int) -> tuple[str, str]:
    return (
        f"(({key}*{lat_step} % 18000)/CAST(100 AS DOUBLE) - 90)",
        f"(({key}*{lon_step} % 36000)/CAST(100 AS DOUBLE) - 180)",
    )


CUSTOMER_AT = ("c_custkey", 37, 91)
SUPPLIER_AT = ("s_suppkey", 5347, 7193)
PART_AT = ("p_partkey", 5347, 7193)

GROUPS_BY_REST = (*CATEGORY_GROUPS, OTHER_GROUP)


def group_of(key: str) -> Column:
    return F.element_at(F.array(*[F.lit(g) for g in GROUPS_BY_REST]), (F.col(key) % 8 + 1).cast("int"))


def group_sql(key: str) -> str:
    return f"CASE {key} % 8 " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(GROUPS_BY_REST)) + " END"


def distance_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"round(2*6371*asin(sqrt(least(1.0, pow(sin((radians({lat2})-radians({lat1}))/2),2)"
        f" + cos(radians({lat1}))*cos(radians({lat2}))*pow(sin((radians({lon2})-radians({lon1}))/2),2)))),4)"
    )


def null_every(n: int, key: str, value: Column) -> Column:
    return F.when(F.col(key) % n != 0, value)


def null_every_sql(n: int, key: str, value: str) -> str:
    return f"CASE WHEN {key} % {n} <> 0 THEN {value} END"
