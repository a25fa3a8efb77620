"""Data-quality checks: not_null, unique, accepted_values, and the report over all of them."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Check(NamedTuple):
    """``kind`` is not_null, unique or accepted_values; ``values`` only for the last."""

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()


def _checks(table: str, not_null: str, unique: str = "", **accepted: tuple[str, ...]) -> list[Check]:
    return ([Check(table, c, "not_null") for c in not_null.split()]
            + [Check(table, c, "unique") for c in unique.split()]
            + [Check(table, c, "accepted_values", v) for c, v in accepted.items()])


BINARY = ("0", "1")

# The declared checks on raw tables, staged tables and the mart.
DECLARED: list[Check] = [
    *_checks("application_train", "SK_ID_CURR TARGET", "SK_ID_CURR", TARGET=BINARY),
    *_checks("bureau", "SK_ID_CURR SK_ID_BUREAU", "SK_ID_BUREAU"),
    *_checks("bureau_balance", "SK_ID_BUREAU"),
    *_checks("previous_application", "SK_ID_CURR SK_ID_PREV", "SK_ID_PREV"),
    *_checks("POS_CASH_balance", "SK_ID_CURR"),
    *_checks("installments_payments", "SK_ID_CURR"),
    *_checks("credit_card_balance", "SK_ID_CURR"),
    *_checks("stg_application_train", "loan_id target income_amount credit_amount age_years", "loan_id", target=BINARY),
    *_checks("stg_bureau", "bureau_id loan_id", "bureau_id"),
    *_checks("stg_bureau_balance", "bureau_id"),
    *_checks("stg_previous_application", "prev_application_id loan_id", "prev_application_id"),
    *_checks("stg_pos_cash_balance", "prev_application_id loan_id"),
    *_checks("stg_installments_payments", "prev_application_id loan_id"),
    *_checks("stg_credit_card_balance", "prev_application_id loan_id"),
    *_checks("mart_credit_features",
             "loan_id target income_amount credit_amount age_years age_group owns_car owns_realty", "loan_id",
             target=BINARY, age_group=("young", "adult", "senior"), owns_car=BINARY, owns_realty=BINARY),
]

COLUMNS = ["table_name", "column_name", "check_kind", "failures"]


def _items(number: int, check: Check) -> Column:
    """What a row says about a check, null for nothing: ``check`` and a ``value`` that is counted with its copies."""
    value = F.col(check.column).cast("string")
    says, counted = {
        "not_null": (value.isNull(), F.lit(None).cast("string")),
        "unique": (value.isNotNull(), value),
        "accepted_values": (~value.isin(*check.values), value),
    }[check.kind]
    return F.when(says, F.struct(F.lit(number).alias("check"), counted.alias("value")))


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check with its failures: NULL rows, values that occur more than once, or distinct values not accepted.

    NULL is neither repeated nor unaccepted. Every table is scanned once for all its
    checks; rows send on only their keys and what offends, combined map-side, and
    two exchanges serve all tables.
    """
    parts = []
    for name in dict.fromkeys(c.table for c in checks):
        items = F.array(*[_items(i, c) for i, c in enumerate(checks) if c.table == name])
        parts.append(tables[name].select(F.explode(F.filter(items, lambda x: x.isNotNull())).alias("x")).select("x.*"))
    copies = reduce(DataFrame.unionByName, parts).groupBy("check", "value").agg(F.count("*").alias("n"))
    found = copies.groupBy("check").agg(F.sum("n").alias("not_null"), F.count_if(F.col("n") > 1).alias("unique"),
                                        F.count("*").alias("accepted_values"))
    declared = copies.sparkSession.createDataFrame([(i, c.table, c.column, c.kind) for i, c in enumerate(checks)],
                                                   "check int, table_name string, column_name string, check_kind string")
    failures = F.coalesce(F.expr("CASE check_kind WHEN 'not_null' THEN not_null WHEN 'unique' THEN unique ELSE accepted_values END"),
                          F.lit(0).cast("long"))
    return declared.join(F.broadcast(found), "check", "left").withColumn("failures", failures).select(*COLUMNS)  # a row per check


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """NULL rows per column."""
    return run_checks({table: df}, [Check(table, c, "not_null") for c in columns])


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values that occur more than once."""
    return run_checks({table: df}, [Check(table, column, "unique")])


def accepted_values(df: DataFrame, table: str, allowed: dict[str, tuple[str, ...]]) -> DataFrame:
    """Distinct values outside the allowed ones."""
    return run_checks({table: df}, [Check(table, c, "accepted_values", ok) for c, ok in allowed.items()])


def quality_report(tables: dict[str, DataFrame], checks: list[Check] = DECLARED) -> DataFrame:
    """The run report: every declared check with its status."""
    return run_checks(tables, checks).withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
