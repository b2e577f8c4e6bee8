"""Quality suites and constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from geomart.operators import quality as Q
from geomart.queries.base import null_every, null_every_sql, query, table

SUITE = Q.Suite(
    "customers",
    (
        Q.Expectation(Q.EXISTS, "c_acctbal"),
        Q.Expectation(Q.EXISTS, "c_phone"),
        Q.Expectation(Q.BETWEEN, "c_acctbal", 0, 9000),
        Q.Expectation(Q.NOT_NULL, "c_name"),
        Q.Expectation(Q.IN_SET, "c_mktsegment", value_set=("MACHINERY", "FURNITURE", "BUILDING", "AUTOMOBILE")),
    ),
)

_SEGMENTS = "('MACHINERY', 'FURNITURE', 'BUILDING', 'AUTOMOBILE')"
_rows = f"""(SELECT c_custkey, {null_every_sql(7, "c_custkey", "c_name")} AS c_name,
  {null_every_sql(5, "c_custkey", "c_acctbal")} AS c_acctbal, c_mktsegment FROM customer)"""
_bad_balance = "coalesce(c_acctbal < 0 OR c_acctbal > 9000, FALSE)"
_labels = f"""list_filter([CASE WHEN {_bad_balance} THEN 'expect_column_values_to_be_between:c_acctbal' END,
  CASE WHEN c_name IS NULL THEN 'expect_column_values_to_not_be_null:c_name' END,
  CASE WHEN c_mktsegment NOT IN {_SEGMENTS} THEN 'expect_column_values_to_be_in_set:c_mktsegment' END],
  lambda x: x IS NOT NULL)"""


def _customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        null_every(7, "c_custkey", F.col("c_name")).alias("c_name"),
        null_every(5, "c_custkey", F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment",
    )


def _check(position: int, kind: str, column: str, bad: str, base: str) -> str:
    return f"""SELECT CAST({position} AS INTEGER) AS position, '{kind}' AS expectation, '{column}' AS column_name,
      count(*) AS element_count, count(*) FILTER ({column} IS NULL) AS null_count, count(*) FILTER ({bad}) AS unexpected_count,
      round(count(*) FILTER ({bad}) * 100.0::DOUBLE / {base}, 6) AS unexpected_percent,
      count(*) FILTER ({bad}) = 0 AS success FROM {_rows}"""


def _presence(position: int, column: str, there: str) -> str:
    return f"""SELECT CAST({position} AS INTEGER), '{Q.EXISTS}', '{column}', CAST(-1 AS BIGINT), CAST(-1 AS BIGINT),
      CAST(-1 AS BIGINT), CAST(NULL AS DOUBLE), {there}"""


@query(
    "dq_suite",
    " UNION ALL ".join(
        [
            _check(2, Q.BETWEEN, "c_acctbal", _bad_balance, "count(c_acctbal)"),
            _check(3, Q.NOT_NULL, "c_name", "c_name IS NULL", "count(*)"),
            _check(4, Q.IN_SET, "c_mktsegment", f"c_mktsegment NOT IN {_SEGMENTS}", "count(c_mktsegment)"),
            _presence(0, "c_acctbal", "TRUE"),
            _presence(1, "c_phone", "FALSE"),
        ]
    ),
)
def dq_suite(spark, sf):
    suite = Q.Suite.from_json(SUITE.to_json())
    counts = ("element_count", "null_count", "unexpected_count")
    return Q.validate(_customers(spark, sf), suite).withColumns(
        {c: F.coalesce(c, F.lit(-1)) for c in counts} | {"unexpected_percent": F.round("unexpected_percent", 6)}
    )


@query(
    "dq_violations",
    f"""SELECT c_custkey, array_to_string(failed, '|') AS failed FROM (SELECT c_custkey, {_labels} AS failed FROM {_rows})
    WHERE len(failed) > 0""",
)
def dq_violations(spark, sf):
    return Q.violations(_customers(spark, sf), SUITE).select(
        "c_custkey", F.array_join("failed_checks", "|").alias("failed")
    )


@query(
    "dq_gate_split",
    f"""SELECT c_custkey, len(failed) = 0 AS good, array_to_string(failed, '|') AS failed
    FROM (SELECT c_custkey, {_labels} AS failed FROM {_rows})""",
)
def dq_gate_split(spark, sf):
    good, bad = Q.split(_customers(spark, sf), Q.Suite("rows", tuple(e for e in SUITE.expectations if e.column != "c_phone")))
    good = good.select("c_custkey", F.lit(True).alias("good"), F.lit("").alias("failed"))
    return good.unionByName(bad.select("c_custkey", F.lit(False).alias("good"), F.array_join("failed_checks", "|").alias("failed")))


@query(
    "check_unique",
    """SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
)
def check_unique(spark, sf):
    return Q.check_unique(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"])


@query(
    "check_foreign_key",
    """SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    GROUP BY 1""",
)
def check_foreign_key(spark, sf):
    known = table(spark, sf, "customer").where("c_acctbal > 0")
    return Q.check_foreign_key(table(spark, sf, "orders"), "o_custkey", known, "c_custkey")


@query(
    "dq_gate",
    f"""SELECT c_custkey FROM (SELECT c_custkey, {_labels} AS failed FROM {_rows}) WHERE len(failed) = 0
      AND (SELECT count(*) FROM {_rows}) > (SELECT count(*) FROM (SELECT {_labels} AS failed FROM {_rows}) WHERE len(failed) = 0)""",
)
def dq_gate(spark, sf):
    """The gate refuses the whole table, which has violations, and lets its good rows through."""
    customers = _customers(spark, sf)
    held = Q.Suite(SUITE.name, tuple(e for e in SUITE.expectations if e.column in customers.columns))
    good, _ = Q.split(customers, held)
    try:
        Q.gate(customers, held)
    except Q.QualityError:
        return Q.gate(good, held).select("c_custkey")
    return customers.select("c_custkey").limit(0)
