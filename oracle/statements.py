"""One DuckDB statement per registered query, over the given parquet tables.

Written independently of the Spark operators: plain joins, filters and windows
instead of their one-pass forms. ``PARTS`` are named subqueries; a statement
lists them by name and gets those it needs, with their own needs, in front.
"""

from __future__ import annotations

import re

from creditloom.operators import staging
from creditloom.operators.scoring import REQUEST_SCHEMA
from creditloom.plans.mart import MART_COLUMNS
from creditloom.sources.schemas import APPLICATION, RAW_TABLES
from creditloom.sources.standins import standin_sql


def _rename(names: dict[str, str]) -> str:
    return ", ".join(f"{raw} AS {name}" for raw, name in names.items())


PARTS: dict[str, str] = {f"raw_{t.lower()}": standin_sql(t) for t in RAW_TABLES}

PARTS |= {
    "stg_application": f"""
        SELECT {_rename(staging.APPLICATION_NAMES)},
          CASE WHEN CODE_GENDER <> 'XNA' THEN CODE_GENDER END AS gender_clean,
          CAST(DAYS_BIRTH / -365.25 AS INTEGER) AS age_years,
          CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS days_employed,
          CAST(coalesce(FLAG_OWN_CAR = 'Y', false) AS INTEGER) AS owns_car,
          CAST(coalesce(FLAG_OWN_REALTY = 'Y', false) AS INTEGER) AS owns_realty
        FROM raw_application_train""",
    "stg_bureau": f"SELECT {_rename(staging.BUREAU_NAMES)} FROM raw_bureau",
    "stg_bureau_balance": f"SELECT {_rename(staging.BUREAU_BALANCE_NAMES)} FROM raw_bureau_balance",
    "stg_previous": f"""
        SELECT {_rename(staging.PREVIOUS_NAMES)},
          CASE WHEN DAYS_FIRST_DRAWING <> 365243 THEN DAYS_FIRST_DRAWING END AS days_first_drawing,
          CASE WHEN DAYS_FIRST_DUE <> 365243 THEN DAYS_FIRST_DUE END AS days_first_due,
          CASE WHEN DAYS_LAST_DUE_1ST_VERSION <> 365243 THEN DAYS_LAST_DUE_1ST_VERSION END AS days_last_due_first,
          CASE WHEN DAYS_LAST_DUE <> 365243 THEN DAYS_LAST_DUE END AS days_last_due,
          CASE WHEN DAYS_TERMINATION <> 365243 THEN DAYS_TERMINATION END AS days_termination
        FROM raw_previous_application""",
    "stg_installments": f"SELECT {_rename(staging.INSTALLMENT_NAMES)} FROM raw_installments_payments",
    "stg_pos": f"SELECT {_rename(staging.POS_NAMES)} FROM raw_pos_cash_balance",
    "stg_credit_card": f"SELECT {_rename(staging.CARD_NAMES)} FROM raw_credit_card_balance",

    "app_features": """
        SELECT * EXCLUDE (gender),
          round(income_amount / nullif(credit_amount, 0), 4) AS ratio_income_credit,
          round(annuity_amount / nullif(income_amount, 0), 4) AS ratio_annuity_income,
          round(credit_amount / nullif(annuity_amount, 0), 4) AS credit_to_annuity_ratio,
          round(credit_amount / nullif(goods_price, 0), 4) AS credit_to_goods_ratio,
          round(income_amount / nullif(cnt_fam_members, 0), 4) AS income_per_family_member,
          round(income_amount / (1 + cnt_children), 4) AS income_per_child,
          round((ifnull(ext_source_1, 0) + ext_source_2 + ifnull(ext_source_3, 0))
            / list_count([ext_source_1, ext_source_2, ext_source_3]), 4) AS ext_source_mean,
          CAST(ext_source_1 IS NOT NULL AS INTEGER) AS ext_source_1_available,
          round(ifnull(ext_source_1, 0) * ext_source_2, 4) AS ext_source_1_x_2,
          round(ext_source_2 * ifnull(ext_source_3, 0), 4) AS ext_source_2_x_3,
          round(ifnull(ext_source_1, 0) * ext_source_2 * ifnull(ext_source_3, 0), 4) AS ext_source_1_x_2_x_3,
          CAST(days_employed IS NOT NULL AS INTEGER) AS is_employed,
          round(days_employed / -365.25, 1) AS years_employed,
          if(age_years < 30, 'young', if(age_years <= 50, 'adult', 'senior')) AS age_group,
          CAST(income_type = 'Pensioner' AS INTEGER) AS is_pensioner,
          CAST(income_type = 'Working' AS INTEGER) AS is_working,
          CAST(income_type = 'Unemployed' AS INTEGER) AS is_unemployed,
          round(days_employed / nullif(days_birth, 0), 4) AS employed_to_birth_ratio,
          round(days_last_phone_change / nullif(days_birth, 0), 4) AS phone_to_birth_ratio,
          round(def_30_social_circle / nullif(obs_30_social_circle, 0), 4) AS def_30_social_ratio,
          round(def_60_social_circle / nullif(obs_60_social_circle, 0), 4) AS def_60_social_ratio,
          ifnull(req_bureau_day, 0) + ifnull(req_bureau_week, 0) + ifnull(req_bureau_mon, 0) AS req_bureau_recent
        FROM stg_application""",

    "bureau_types": "SELECT loan_id, count(DISTINCT credit_type) AS loan_types_bureau FROM stg_bureau GROUP BY loan_id",
    "agg_bureau": """
        SELECT b.*, t.loan_types_bureau FROM (
          SELECT loan_id,
            count(*) AS bureau_credit_count,
            count(*) FILTER (credit_active = 'Active') AS bureau_active_count,
            count(*) FILTER (credit_active = 'Closed') AS bureau_closed_count,
            sum(credit_sum_debt) AS bureau_debt_total,
            avg(credit_sum) AS bureau_credit_avg,
            ifnull(sum(credit_sum), 0) AS bureau_credit_sum_total,
            max(credit_max_overdue) AS bureau_overdue_max,
            max(credit_day_overdue) AS bureau_day_overdue_max,
            min(days_credit) AS bureau_oldest_credit,
            max(days_credit) AS bureau_most_recent_credit,
            ifnull(sum(credit_sum_debt) / nullif(sum(credit_sum), 0), 0) AS debt_credit_ratio,
            ifnull(sum(credit_sum_overdue) / nullif(sum(credit_sum_debt), 0), 0) AS overdue_debt_ratio
          FROM stg_bureau GROUP BY loan_id) b
        JOIN bureau_types t USING (loan_id)""",
    "agg_bureau_balance": """
        SELECT loan_id,
          CAST(count(*) AS BIGINT) AS bb_total_months,
          CAST(count(*) FILTER (status BETWEEN '1' AND '5') AS BIGINT) AS bb_bad_months,
          CAST(count(*) FILTER (status IN ('4', '5')) AS BIGINT) AS bb_severe_months,
          max(CAST(status = '5' AS INTEGER)) AS bb_had_severe_overdue,
          round(count(*) FILTER (status BETWEEN '1' AND '5') / count(*), 4) AS bb_bad_months_ratio
        FROM stg_bureau_balance JOIN stg_bureau USING (bureau_id)
        GROUP BY loan_id""",
    "agg_previous": """
        SELECT loan_id,
          count(*) AS prev_application_count,
          count(*) FILTER (contract_status = 'Approved') AS prev_approved_count,
          count(*) FILTER (contract_status = 'Refused') AS prev_refused_count,
          count(*) FILTER (contract_status = 'Canceled') AS prev_canceled_count,
          round(count(*) FILTER (contract_status = 'Refused') / count(*), 4) AS prev_refused_ratio,
          avg(credit_amount) AS prev_credit_avg,
          avg(application_amount) AS prev_application_avg,
          ifnull(sum(credit_amount), 0) AS prev_app_credit_sum,
          round(avg(credit_amount / nullif(application_amount, 0)), 4) AS prev_credit_ratio,
          min(days_decision) AS prev_oldest_decision,
          max(days_decision) AS prev_most_recent_decision
        FROM stg_previous GROUP BY loan_id""",
    "agg_installments": """
        SELECT loan_id,
          count(*) AS inst_total_count,
          count(*) FILTER (days_entry_payment > days_instalment) AS inst_late_count,
          round(count(*) FILTER (days_entry_payment > days_instalment) / count(*), 4) AS inst_late_ratio,
          round(avg(days_entry_payment - days_instalment), 2) AS inst_late_avg,
          round(avg(payment_amount / nullif(instalment_amount, 0)), 4) AS inst_payment_ratio,
          max(days_entry_payment - days_instalment) AS inst_late_max,
          ifnull(avg(payment_amount), 0) AS instpay_payment_avg,
          ifnull(sum(payment_amount), 0) AS instpay_payment_sum
        FROM stg_installments GROUP BY loan_id""",
    "agg_pos": """
        SELECT loan_id,
          count(*) AS pos_total_months,
          count(*) FILTER (days_past_due > 0) AS pos_late_months,
          round(count(*) FILTER (days_past_due > 0) / count(*), 4) AS pos_late_ratio,
          max(days_past_due) AS pos_dpd_max,
          avg(days_past_due) AS pos_dpd_avg,
          count(*) FILTER (contract_status = 'Active') AS pos_active_count
        FROM stg_pos GROUP BY loan_id""",
    "agg_credit_card": """
        SELECT loan_id,
          count(*) AS cc_total_months,
          count(*) FILTER (days_past_due > 0) AS cc_late_months,
          round(count(*) FILTER (days_past_due > 0) / count(*), 4) AS cc_late_ratio,
          max(days_past_due) AS cc_dpd_max,
          round(avg(balance / nullif(credit_limit, 0)), 4) AS cc_utilization_avg,
          round(avg(drawings_atm / nullif(drawings_total, 0)), 4) AS cc_atm_ratio,
          round(avg(payment_current / nullif(balance, 0)), 4) AS cc_payment_ratio
        FROM stg_credit_card GROUP BY loan_id""",

    "payments": """
        SELECT loan_id, days_instalment, days_entry_payment - days_instalment AS late,
          payment_amount / nullif(instalment_amount, 0) AS paid
        FROM stg_installments WHERE days_instalment IS NOT NULL""",
    "payments_all": """
        SELECT loan_id, sum(CAST(ifnull(late > 0, false) AS INTEGER)) / count(*) AS r FROM payments GROUP BY loan_id""",
    **{f"payments_{days}": f"""
        SELECT loan_id, sum(CAST(ifnull(late > 0, false) AS INTEGER)) / count(*) AS r,
          sum(CAST(ifnull(late > 30, false) AS INTEGER)) / count(*) AS r30,
          avg(paid) AS paid, max(late) AS worst, count(*) AS n
        FROM payments WHERE days_instalment >= -{days} GROUP BY loan_id""" for days in (90, 180, 365)},
    "inst_windowed": """
        SELECT a.loan_id,
          w3.r AS inst_late_ratio_3m, w3.r30 AS inst_dpd30_ratio_3m, round(w3.paid, 9) AS inst_payment_ratio_3m,
          w3.worst AS inst_late_max_3m, w3.n AS inst_count_3m,
          w6.r AS inst_late_ratio_6m, w6.r30 AS inst_dpd30_ratio_6m, round(w6.paid, 9) AS inst_payment_ratio_6m,
          w12.r AS inst_late_ratio_12m, w12.r30 AS inst_dpd30_ratio_12m, round(w12.paid, 9) AS inst_payment_ratio_12m,
          w3.r / nullif(a.r, 0) AS inst_late_trend_3m_vs_all, w6.r / nullif(a.r, 0) AS inst_late_trend_6m_vs_all
        FROM payments_all a LEFT JOIN payments_90 w3 USING (loan_id) LEFT JOIN payments_180 w6 USING (loan_id)
        LEFT JOIN payments_365 w12 USING (loan_id)""",

    "prev_latest": """
        SELECT * FROM stg_previous
        QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY days_decision DESC NULLS LAST, prev_application_id DESC) = 1""",
    "prev_approved": """
        SELECT loan_id, avg(credit_amount) AS credit_avg, max(credit_amount) AS credit_max,
          avg(annuity_amount) AS annuity_avg, avg(credit_amount / nullif(application_amount, 0)) AS granted
        FROM stg_previous WHERE contract_status = 'Approved' GROUP BY loan_id""",
    "prev_refused": """
        SELECT loan_id, avg(credit_amount) AS credit_avg, max(credit_amount) AS credit_max, max(days_decision) AS newest
        FROM stg_previous WHERE contract_status = 'Refused' GROUP BY loan_id""",
    "prev_windowed": """
        SELECT l.loan_id,
          round(a.credit_avg, 6) AS prev_approved_credit_avg, a.credit_max AS prev_approved_credit_max,
          round(a.annuity_avg, 6) AS prev_approved_annuity_avg, round(a.granted, 9) AS prev_approved_credit_ratio,
          round(r.credit_avg, 6) AS prev_refused_credit_avg, r.credit_max AS prev_refused_credit_max,
          r.newest AS prev_refused_most_recent,
          l.credit_amount AS prev_last_credit, l.application_amount AS prev_last_application,
          l.annuity_amount AS prev_last_annuity, l.days_decision AS prev_last_days_decision,
          l.payment_count AS prev_last_payment_count,
          CAST(ifnull(l.contract_status = 'Refused', false) AS INTEGER) AS prev_last_was_refused
        FROM prev_latest l LEFT JOIN prev_approved a USING (loan_id) LEFT JOIN prev_refused r USING (loan_id)""",

    "mart": f"""
        SELECT {', '.join({'debt_credit_ratio': 'ifnull(debt_credit_ratio, 0) AS debt_credit_ratio',
                           'overdue_debt_ratio': 'ifnull(overdue_debt_ratio, 0) AS overdue_debt_ratio',
                           'loan_types_bureau': 'ifnull(loan_types_bureau, 0) AS loan_types_bureau'}.get(c, c)
                          for c in MART_COLUMNS)}
        FROM app_features LEFT JOIN agg_bureau USING (loan_id) LEFT JOIN agg_bureau_balance USING (loan_id)
        LEFT JOIN agg_previous USING (loan_id) LEFT JOIN agg_installments USING (loan_id)
        LEFT JOIN agg_pos USING (loan_id) LEFT JOIN agg_credit_card USING (loan_id)""",

    "ranked": """
        SELECT loan_id, target, row_number() OVER w AS place, count(*) OVER (PARTITION BY target) AS n,
          ntile(5) OVER w - 1 AS fold
        FROM stg_application WINDOW w AS (PARTITION BY target ORDER BY md5('42|' || loan_id), loan_id)""",
    "split": """
        SELECT loan_id, target, CASE WHEN place <= ceil(n * 0.2) THEN 'test'
          WHEN place <= ceil(n * 0.2) + ceil(n * 0.1) THEN 'val' ELSE 'train' END AS split
        FROM ranked""",

    "scored": """
        SELECT loan_id, target, gender_clean, ((loan_id * 7919) % 1000) / 1e3 AS score FROM stg_application""",
    "audited": "SELECT * FROM scored WHERE gender_clean IN ('F', 'M')",
    "score_counts": """
        SELECT score, count(*) FILTER (target = 1) AS pos, count(*) FILTER (target = 0) AS neg
        FROM scored GROUP BY score""",
    "curve": """
        SELECT score, pos, neg, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp,
          sum(pos) OVER () AS p, sum(neg) OVER () AS n,
          row_number() OVER down AS i, count(*) OVER () AS points,
          lead(pos) OVER down AS next_pos, lead(neg) OVER down AS next_neg
        FROM score_counts WINDOW down AS (ORDER BY score DESC)""",
    "sweep": """
        SELECT i / 100 AS threshold,
          ifnull(2 * tp / nullif(tp + fp + p, 0), 0) AS f1, ifnull(tp / nullif(tp + fp, 0), 0) AS precision,
          ifnull(tp / nullif(p, 0), 0) AS recall,
          ifnull(tp / nullif(p, 0), 0) + ifnull((n - fp) / nullif(n, 0), 0) - 1 AS youden_j
        FROM (
          SELECT i, count(*) FILTER (target = 1 AND score >= i / 100) AS tp,
            count(*) FILTER (target = 0 AND score >= i / 100) AS fp,
            count(*) FILTER (target = 1) AS p, count(*) FILTER (target = 0) AS n
          FROM scored, range(1, 99) t(i) GROUP BY i)""",
    "group_rates": """
        SELECT gender_clean, count(*) AS n_rows,
          count(*) FILTER (score >= 0.3) / count(*) AS selection_rate,
          ifnull(count(*) FILTER (target = 0 AND score >= 0.3) / nullif(count(*) FILTER (target = 0), 0), 0)
            AS false_positive_rate,
          ifnull(count(*) FILTER (target = 1 AND score < 0.3) / nullif(count(*) FILTER (target = 1), 0), 0)
            AS false_negative_rate
        FROM audited GROUP BY gender_clean""",
    "group_auc": """
        SELECT gender_clean, n_rows, won / nullif(pairs, 0) AS auc FROM (
          SELECT gender_clean, count(*) AS n_rows, sum(target) * (count(*) - sum(target)) AS pairs,
            sum(target * place) - sum(target) * (sum(target) + 1) / 2 AS won
          FROM (
            SELECT gender_clean, target, avg(i) OVER (PARTITION BY gender_clean, score) AS place FROM (
              SELECT gender_clean, target, score, row_number() OVER (PARTITION BY gender_clean ORDER BY score) AS i
              FROM (SELECT gender_clean, target, score FROM audited
                    UNION ALL SELECT 'all', target, score FROM audited)))
          GROUP BY gender_clean)
        WHERE n_rows >= 10""",
}

AUC_OF = """
        SELECT count(*) AS n_rows,
          (sum(target * place) - sum(target) * (sum(target) + 1) / 2) / (sum(target) * (count(*) - sum(target))) AS auc
        FROM (SELECT target, avg(i) OVER (PARTITION BY score) AS place
              FROM (SELECT target, score, row_number() OVER (ORDER BY score) AS i FROM {rows}))"""


def confusion(rows: str, threshold: str) -> str:
    return f"""
        SELECT *, round((tp + tn) / total, 4) AS accuracy, round(1 - (tp + tn) / total, 4) AS error_rate,
          round(tp / (tp + fn), 4) AS recall, round(fp / (fp + tn), 4) AS fpr, round(fn / (fn + tp), 4) AS fnr
        FROM (SELECT count(*) FILTER (target = 0 AND score < {threshold}) AS tn,
                count(*) FILTER (target = 0 AND score >= {threshold}) AS fp,
                count(*) FILTER (target = 1 AND score < {threshold}) AS fn,
                count(*) FILTER (target = 1 AND score >= {threshold}) AS tp, count(*) AS total FROM {rows})"""


def statement(final: str) -> str:
    """``final`` with the named subqueries it needs in front."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                visit(PARTS[name])
                needed[name] = None

    visit(final)
    parts = ", ".join(f"{n} AS ({PARTS[n]})" for n in needed)
    return f"WITH {parts} {final}" if parts else final


def raw_facts(aggregate: str) -> str:
    """Rows ``column_name, <aggregate>`` over the raw application columns."""
    return " UNION ALL ".join(
        f"SELECT '{f.name}' AS column_name, {aggregate.format(c=f.name)} FROM raw_application_train"
        for f in APPLICATION.fields)


NUMERIC = [f.name for f in APPLICATION.fields if f.dataType.simpleString() != "string"]
TEXT = [f.name for f in APPLICATION.fields if f.dataType.simpleString() == "string"]
REQUEST_TYPES = {f.name: f.dataType.simpleString() for f in REQUEST_SCHEMA.fields}
