"""Column names and types of the raw tables.

The raw files are CSV; types are declared so that no inference pass is needed
and a column such as STATUS stays a string even when a file holds digits only.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def struct(spec: str) -> T.StructType:
    """Build a schema from lines of ``type: NAME NAME ...``."""
    fields = []
    for line in spec.strip().splitlines():
        kind, names = line.split(":")
        fields += [T.StructField(n, _TYPES[kind.strip()], True) for n in names.split()]
    return T.StructType(fields)


# Raw column names, in file order where the pipeline uses them.
APPLICATION = struct("""
    bigint: SK_ID_CURR
    int: TARGET
    string: NAME_CONTRACT_TYPE
    double: AMT_CREDIT AMT_ANNUITY AMT_INCOME_TOTAL AMT_GOODS_PRICE
    string: CODE_GENDER
    bigint: DAYS_BIRTH DAYS_EMPLOYED
    string: NAME_INCOME_TYPE OCCUPATION_TYPE NAME_EDUCATION_TYPE NAME_FAMILY_STATUS
    double: EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3
    bigint: REGION_RATING_CLIENT_W_CITY DAYS_ID_PUBLISH
    double: DAYS_REGISTRATION
    bigint: REG_CITY_NOT_WORK_CITY FLAG_DOCUMENT_3 FLAG_MOBIL FLAG_EMAIL
    string: FLAG_OWN_CAR FLAG_OWN_REALTY
    bigint: CNT_CHILDREN
    double: CNT_FAM_MEMBERS OWN_CAR_AGE
    string: ORGANIZATION_TYPE
    double: DAYS_LAST_PHONE_CHANGE
    double: OBS_30_CNT_SOCIAL_CIRCLE DEF_30_CNT_SOCIAL_CIRCLE OBS_60_CNT_SOCIAL_CIRCLE DEF_60_CNT_SOCIAL_CIRCLE
    double: AMT_REQ_CREDIT_BUREAU_HOUR AMT_REQ_CREDIT_BUREAU_DAY AMT_REQ_CREDIT_BUREAU_WEEK
    double: AMT_REQ_CREDIT_BUREAU_MON AMT_REQ_CREDIT_BUREAU_QRT AMT_REQ_CREDIT_BUREAU_YEAR
""")

BUREAU = struct("""
    bigint: SK_ID_CURR SK_ID_BUREAU
    string: CREDIT_ACTIVE CREDIT_CURRENCY
    bigint: DAYS_CREDIT CREDIT_DAY_OVERDUE
    double: DAYS_CREDIT_ENDDATE DAYS_ENDDATE_FACT AMT_CREDIT_MAX_OVERDUE
    bigint: CNT_CREDIT_PROLONG
    double: AMT_CREDIT_SUM AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_LIMIT AMT_CREDIT_SUM_OVERDUE
    string: CREDIT_TYPE
    bigint: DAYS_CREDIT_UPDATE
    double: AMT_ANNUITY
""")

BUREAU_BALANCE = struct("""
    bigint: SK_ID_BUREAU MONTHS_BALANCE
    string: STATUS
""")

PREVIOUS = struct("""
    bigint: SK_ID_PREV SK_ID_CURR
    string: NAME_CONTRACT_TYPE
    double: AMT_ANNUITY AMT_APPLICATION AMT_CREDIT AMT_DOWN_PAYMENT AMT_GOODS_PRICE
    string: FLAG_LAST_APPL_PER_CONTRACT
    bigint: NFLAG_LAST_APPL_IN_DAY
    string: NAME_CASH_LOAN_PURPOSE NAME_CONTRACT_STATUS
    bigint: DAYS_DECISION
    string: NAME_PAYMENT_TYPE NAME_CLIENT_TYPE NAME_GOODS_CATEGORY NAME_PORTFOLIO NAME_PRODUCT_TYPE
    string: CHANNEL_TYPE NAME_SELLER_INDUSTRY
    double: CNT_PAYMENT
    string: NAME_YIELD_GROUP PRODUCT_COMBINATION
    double: DAYS_FIRST_DRAWING DAYS_FIRST_DUE DAYS_LAST_DUE_1ST_VERSION DAYS_LAST_DUE DAYS_TERMINATION
""")

POS_CASH = struct("""
    bigint: SK_ID_PREV SK_ID_CURR MONTHS_BALANCE
    double: CNT_INSTALMENT CNT_INSTALMENT_FUTURE
    string: NAME_CONTRACT_STATUS
    bigint: SK_DPD SK_DPD_DEF
""")

INSTALLMENTS = struct("""
    bigint: SK_ID_PREV SK_ID_CURR
    double: NUM_INSTALMENT_VERSION
    bigint: NUM_INSTALMENT_NUMBER
    double: DAYS_INSTALMENT DAYS_ENTRY_PAYMENT AMT_INSTALMENT AMT_PAYMENT
""")

CREDIT_CARD = struct("""
    bigint: SK_ID_PREV SK_ID_CURR MONTHS_BALANCE
    double: AMT_BALANCE
    bigint: AMT_CREDIT_LIMIT_ACTUAL
    double: AMT_DRAWINGS_ATM_CURRENT AMT_DRAWINGS_CURRENT AMT_DRAWINGS_OTHER_CURRENT AMT_DRAWINGS_POS_CURRENT
    double: AMT_INST_MIN_REGULARITY AMT_PAYMENT_CURRENT AMT_PAYMENT_TOTAL_CURRENT
    double: AMT_RECEIVABLE_PRINCIPAL AMT_RECIVABLE AMT_TOTAL_RECEIVABLE
    double: CNT_DRAWINGS_ATM_CURRENT CNT_DRAWINGS_CURRENT CNT_DRAWINGS_OTHER_CURRENT CNT_DRAWINGS_POS_CURRENT
    double: CNT_INSTALMENT_MATURE_CUM
    string: NAME_CONTRACT_STATUS
    bigint: SK_DPD SK_DPD_DEF
""")

COLUMN_DICTIONARY = struct("string: Table Row Description")

RAW_TABLES: dict[str, T.StructType] = {
    "application_train": APPLICATION,
    "bureau": BUREAU,
    "bureau_balance": BUREAU_BALANCE,
    "previous_application": PREVIOUS,
    "POS_CASH_balance": POS_CASH,
    "installments_payments": INSTALLMENTS,
    "credit_card_balance": CREDIT_CARD,
}
