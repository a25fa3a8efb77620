"""Stand-in raw tables: each raw table as a projection of the given test tables.

One text serves both engines: the Spark reader and the DuckDB checks format the
same expressions, differing only in the day-difference function. Every column
is cast to the declared raw type; columns without an expression are NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import RAW_TABLES

# Day zero of the stand-in calendar.
DAY_ZERO = "DATE '2001-08-02'"


def spark_days(column: str) -> str:
    return f"datediff({column}, {DAY_ZERO})"


def duckdb_days(column: str) -> str:
    return f"date_diff('day', {DAY_ZERO}, CAST({column} AS DATE))"


# Types of the given tables that are read; declared so that no schema job runs per read.
GIVEN = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


class Origin(NamedTuple):
    """Given table a stand-in is projected from, with an optional join and filter."""

    table: str
    join: tuple[str, str] | None = None
    where: str | None = None


# raw table -> (origin, {raw column: expression})
STANDINS: dict[str, tuple[Origin, dict[str, str]]] = {
    "application_train": (Origin("customer"), {
        "SK_ID_CURR": "c_custkey",
        "TARGET": "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END",
        "NAME_CONTRACT_TYPE": "CASE WHEN c_custkey % 10 = 0 THEN 'Revolving loans' ELSE 'Cash loans' END",
        "AMT_CREDIT": "CASE WHEN c_custkey % 97 = 0 THEN 0e0 ELSE 45000e0 + (c_custkey * 104729) % 900000 END",
        "AMT_ANNUITY": "CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE 1600e0 + (c_custkey * 6151) % 60000 END",
        "AMT_INCOME_TOTAL": "25000e0 + (c_custkey * 7919) % 200000",
        "AMT_GOODS_PRICE": "CASE WHEN c_custkey % 83 = 0 THEN NULL ELSE 40000e0 + (c_custkey * 99991) % 900000 END",
        "CODE_GENDER": "CASE WHEN c_custkey % 50 = 49 THEN 'XNA' WHEN c_custkey % 50 < 33 THEN 'F' ELSE 'M' END",
        "DAYS_BIRTH": "-(7500 + (c_custkey * 31) % 17700)",
        "DAYS_EMPLOYED": "CASE WHEN c_custkey % 6 = 0 THEN 365243 ELSE -((c_custkey * 17) % 12000) END",
        "NAME_INCOME_TYPE": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Working' WHEN 'BUILDING' THEN 'Pensioner' "
                            "WHEN 'FURNITURE' THEN 'Unemployed' WHEN 'HOUSEHOLD' THEN 'State servant' "
                            "ELSE 'Commercial associate' END",
        "OCCUPATION_TYPE": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('occ_', CAST(c_custkey % 18 AS STRING)) END",
        "NAME_EDUCATION_TYPE": "concat('edu_', CAST(c_custkey % 5 AS STRING))",
        "NAME_FAMILY_STATUS": "concat('fam_', CAST(c_nationkey % 5 AS STRING))",
        "EXT_SOURCE_1": "CASE WHEN c_custkey % 16 < 9 THEN NULL ELSE ((c_custkey * 37) % 1000) / 1e3 END",
        "EXT_SOURCE_2": "CASE WHEN c_custkey % 500 = 0 THEN NULL ELSE ((c_custkey * 53) % 1000) / 1e3 END",
        "EXT_SOURCE_3": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE ((c_custkey * 71) % 1000) / 1e3 END",
        "REGION_RATING_CLIENT_W_CITY": "1 + c_custkey % 3",
        "DAYS_ID_PUBLISH": "-((c_custkey * 13) % 6000)",
        "DAYS_REGISTRATION": "-1e0 * ((c_custkey * 19) % 15000)",
        "REG_CITY_NOT_WORK_CITY": "c_custkey % 2",
        "FLAG_DOCUMENT_3": "CASE WHEN c_custkey % 10 < 7 THEN 1 ELSE 0 END",
        "FLAG_MOBIL": "1",
        "FLAG_EMAIL": "c_custkey % 2",
        "FLAG_OWN_CAR": "CASE WHEN c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END",
        "FLAG_OWN_REALTY": "CASE WHEN c_custkey % 10 < 7 THEN 'Y' ELSE 'N' END",
        "CNT_CHILDREN": "c_custkey % 4",
        "CNT_FAM_MEMBERS": "CASE WHEN c_custkey % 71 = 0 THEN NULL ELSE 1e0 + c_custkey % 6 END",
        "OWN_CAR_AGE": "CASE WHEN c_custkey % 3 = 0 THEN 1e0 * (c_custkey % 25) ELSE NULL END",
        "ORGANIZATION_TYPE": "concat('org_', CAST(c_nationkey AS STRING))",
        "DAYS_LAST_PHONE_CHANGE": "-1e0 * ((c_custkey * 11) % 4000)",
        "OBS_30_CNT_SOCIAL_CIRCLE": "1e0 * (c_custkey % 7)",
        "DEF_30_CNT_SOCIAL_CIRCLE": "1e0 * (c_custkey % 3)",
        "OBS_60_CNT_SOCIAL_CIRCLE": "1e0 * (c_custkey % 6)",
        "DEF_60_CNT_SOCIAL_CIRCLE": "1e0 * (c_custkey % 2)",
        "AMT_REQ_CREDIT_BUREAU_HOUR": "1e0 * (c_custkey % 2)",
        "AMT_REQ_CREDIT_BUREAU_DAY": "1e0 * (c_custkey % 3)",
        "AMT_REQ_CREDIT_BUREAU_WEEK": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 1e0 * (c_custkey % 4) END",
        "AMT_REQ_CREDIT_BUREAU_MON": "1e0 * (c_custkey % 5)",
        "AMT_REQ_CREDIT_BUREAU_QRT": "1e0 * (c_custkey % 6)",
        "AMT_REQ_CREDIT_BUREAU_YEAR": "1e0 * (c_custkey % 9)",
    }),
    "bureau": (Origin("orders"), {
        "SK_ID_CURR": "o_custkey",
        "SK_ID_BUREAU": "o_orderkey",
        "CREDIT_ACTIVE": "CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END",
        "CREDIT_TYPE": "o_orderpriority",
        "CREDIT_CURRENCY": "'currency 1'",
        "DAYS_CREDIT": "{days(o_orderdate)}",
        "DAYS_CREDIT_ENDDATE": "1e0 * (o_orderkey % 900)",
        "DAYS_CREDIT_UPDATE": "-(o_orderkey % 300)",
        "CREDIT_DAY_OVERDUE": "CASE WHEN o_orderkey % 20 = 0 THEN o_orderkey % 90 ELSE 0 END",
        "AMT_CREDIT_SUM": "o_totalprice",
        "AMT_CREDIT_SUM_DEBT": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice / 2 END",
        "AMT_CREDIT_SUM_LIMIT": "0e0",
        "AMT_CREDIT_SUM_OVERDUE": "CASE WHEN o_orderkey % 20 = 0 THEN 100e0 ELSE 0e0 END",
        "AMT_CREDIT_MAX_OVERDUE": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 1e0 * (o_orderkey % 5000) END",
        "AMT_ANNUITY": "o_totalprice / 12",
        "CNT_CREDIT_PROLONG": "o_orderkey % 3",
    }),
    "bureau_balance": (Origin("lineitem"), {
        "SK_ID_BUREAU": "l_orderkey",
        "MONTHS_BALANCE": "-l_linenumber",
        "STATUS": "CASE WHEN l_quantity <= 20 THEN '0' WHEN l_quantity <= 25 THEN '1' WHEN l_quantity <= 28 THEN '2' "
                  "WHEN l_quantity <= 30 THEN '3' WHEN l_quantity <= 31 THEN '4' WHEN l_quantity <= 32 THEN '5' "
                  "WHEN l_quantity <= 42 THEN 'C' ELSE 'X' END",
    }),
    "previous_application": (Origin("orders"), {
        "SK_ID_PREV": "o_orderkey",
        "SK_ID_CURR": "o_custkey",
        "NAME_CONTRACT_STATUS": "CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Canceled' END",
        "AMT_CREDIT": "o_totalprice",
        "AMT_APPLICATION": "CASE WHEN o_orderkey % 11 = 0 THEN 0e0 "
                           "ELSE o_totalprice * (1e0 + (o_orderkey % 5) / 1e1) END",
        "AMT_ANNUITY": "o_totalprice / 12",
        "DAYS_DECISION": "{days(o_orderdate)}",
        "CNT_PAYMENT": "1e0 * (o_orderkey % 60)",
        "DAYS_FIRST_DRAWING": "CASE WHEN o_orderkey % 4 = 0 THEN 365243e0 ELSE -1e0 * (o_orderkey % 2900) END",
        "DAYS_FIRST_DUE": "CASE WHEN o_orderkey % 5 = 0 THEN 365243e0 ELSE -1e0 * (o_orderkey % 2801) END",
        "DAYS_LAST_DUE_1ST_VERSION": "CASE WHEN o_orderkey % 6 = 0 THEN 365243e0 ELSE -1e0 * (o_orderkey % 2702) END",
        "DAYS_LAST_DUE": "CASE WHEN o_orderkey % 7 = 0 THEN 365243e0 ELSE -1e0 * (o_orderkey % 2603) END",
        "DAYS_TERMINATION": "CASE WHEN o_orderkey % 8 = 0 THEN 365243e0 ELSE -1e0 * (o_orderkey % 2504) END",
    }),
    "installments_payments": (Origin("lineitem", join=("orders", "l_orderkey = o_orderkey")), {
        "SK_ID_PREV": "l_orderkey",
        "SK_ID_CURR": "o_custkey",
        "NUM_INSTALMENT_VERSION": "1e0",
        "NUM_INSTALMENT_NUMBER": "l_linenumber",
        "DAYS_INSTALMENT": "1e0 * {days(o_orderdate)}",
        "DAYS_ENTRY_PAYMENT": "CASE WHEN l_discount = 0 THEN NULL ELSE {days(o_orderdate)} + l_quantity * 2 - 60 END",
        "AMT_INSTALMENT": "CASE WHEN l_tax = 0 THEN 0e0 ELSE l_extendedprice END",
        "AMT_PAYMENT": "CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice * (1e0 - l_discount) END",
    }),
    "POS_CASH_balance": (Origin("events"), {
        "SK_ID_PREV": "event_id",
        "SK_ID_CURR": "user_id",
        "MONTHS_BALANCE": "-(event_id % 96)",
        "CNT_INSTALMENT": "12e0",
        "CNT_INSTALMENT_FUTURE": "1e0 * (event_id % 12)",
        "NAME_CONTRACT_STATUS": "CASE event_type WHEN 'view' THEN 'Active' WHEN 'click' THEN 'Active' "
                                "WHEN 'purchase' THEN 'Completed' ELSE 'Signed' END",
        "SK_DPD": "CASE WHEN event_id % 8 = 0 THEN event_id % 30 ELSE 0 END",
        "SK_DPD_DEF": "0",
    }),
    "credit_card_balance": (Origin("events"), {
        "SK_ID_PREV": "event_id",
        "SK_ID_CURR": "user_id",
        "MONTHS_BALANCE": "-(event_id % 96)",
        "AMT_BALANCE": "value",
        "AMT_CREDIT_LIMIT_ACTUAL": "100 * (event_id % 5)",
        "AMT_DRAWINGS_ATM_CURRENT": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE value / 4 END",
        "AMT_DRAWINGS_CURRENT": "CASE WHEN event_id % 6 = 0 THEN 0e0 ELSE value / 2 END",
        "AMT_PAYMENT_CURRENT": "value / 10",
        "SK_DPD": "CASE WHEN event_id % 7 = 0 THEN event_id % 40 ELSE 0 END",
    }),
}


def _varied(table: str, key: str) -> dict[str, str]:
    """Different values, some of them NULL, for every raw column that the table above leaves out."""
    made = {}
    for i, field in enumerate(RAW_TABLES[table].fields):
        if field.name not in STANDINS[table][1]:
            value = {"string": f"concat('{field.name.lower()}_', CAST({key} % {i + 2} AS STRING))",
                     "double": f"1e0 * (({key} * {i + 3}) % {97 + i})"}.get(
                         field.dataType.simpleString(), f"({key} * {i + 3}) % {89 + i}")
            made[field.name] = f"CASE WHEN {key} % {11 + i} = 0 THEN NULL ELSE {value} END"
    return made


for _table, _key in (("previous_application", "o_orderkey"), ("credit_card_balance", "event_id")):
    STANDINS[_table][1].update(_varied(_table, _key))


def _projection(table: str, days: Callable[[str], str]) -> list[str]:
    _, columns = STANDINS[table]
    items = []
    for field in RAW_TABLES[table].fields:
        text = columns.get(field.name, "NULL").replace("{days(o_orderdate)}", days("o_orderdate"))
        items.append(f"CAST({text} AS {field.dataType.simpleString().upper()}) AS {field.name}")
    return items


def standin_sql(table: str) -> str:
    """SELECT text of one stand-in table for DuckDB."""
    origin, _ = STANDINS[table]
    query = f"SELECT {', '.join(_projection(table, duckdb_days))} FROM {origin.table}"
    if origin.join:
        query += f" JOIN {origin.join[0]} ON {origin.join[1]}"
    if origin.where:
        query += f" WHERE {origin.where}"
    return query


def given_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_standin(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One raw table played by the parquet tables in ``folder``."""
    origin, _ = STANDINS[table]
    df = given_table(spark, folder, origin.table)
    if origin.join:
        df = df.join(given_table(spark, folder, origin.join[0]), F.expr(origin.join[1]))
    if origin.where:
        df = df.where(origin.where)
    return df.selectExpr(*_projection(table, spark_days))
