"""The statement of every registered query that SQL can express."""

from __future__ import annotations

from itertools import combinations

from creditloom.operators.profiling import ALREADY_USED, KEY_FEATURES
from creditloom.operators.quality import DECLARED
from creditloom.operators.scoring import DEFAULTS, REQUIRED
from creditloom.operators.staging import APPLICATION_NAMES
from creditloom.plans import catalog
from creditloom.sources.schemas import APPLICATION, RAW_TABLES

from .statements import AUC_OF, NUMERIC, PARTS, REQUEST_TYPES, TEXT, confusion, raw_facts, statement


def _rounded(source: str, digits: dict[str, int]) -> str:
    items = ", ".join(f"round({c}, {d}) AS {c}" for c, d in digits.items())
    return f"SELECT * REPLACE ({items}) FROM {source}"


MART = _rounded("mart", catalog.MART_DIGITS)

# Tables under their names in the declared checks.
CHECKED = {t: f"raw_{t.lower()}" for t in RAW_TABLES} | {v: f"stg_{k}" for k, v in catalog.CHECKED_AS.items()} | {
    "mart_credit_features": "mart"}


def _check(kind: str) -> str:
    parts = []
    for c in DECLARED:
        if c.kind != kind:
            continue
        rows = CHECKED[c.table]
        if kind == "not_null":
            failures = f"(SELECT count(*) FROM {rows} WHERE {c.column} IS NULL)"
        elif kind == "unique":
            failures = (f"(SELECT count(*) FROM (SELECT {c.column} FROM {rows} WHERE {c.column} IS NOT NULL "
                        f"GROUP BY {c.column} HAVING count(*) > 1))")
        else:
            allowed = ", ".join(f"'{v}'" for v in c.values)
            failures = (f"(SELECT count(DISTINCT {c.column}) FROM {rows} "
                        f"WHERE CAST({c.column} AS VARCHAR) NOT IN ({allowed}))")
        parts.append(f"SELECT '{c.table}' AS table_name, '{c.column}' AS column_name, '{kind}' AS check_kind, "
                     f"{failures} AS failures")
    return " UNION ALL ".join(parts)


ALL_CHECKS = " UNION ALL ".join(_check(k) for k in ("not_null", "unique", "accepted_values"))

TRAIN = "SELECT a.*, s.split FROM stg_application a JOIN split s USING (loan_id)"


def _encoded(col: str) -> str:
    return f"""SELECT loan_id, round(ifnull(encoded, prior), 9) AS {col} FROM stg_application
        CROSS JOIN (SELECT avg(target) AS prior FROM labelled WHERE split = 'train')
        LEFT JOIN (
          SELECT {col} AS category, (SELECT avg(target) FROM labelled WHERE split = 'train') * (1 - w) + m * w AS encoded
          FROM (SELECT {col}, avg(target) AS m, 1 / (1 + exp(-(count(*) - 20) / 10)) AS w
                FROM labelled WHERE split = 'train' GROUP BY {col}))
        ON category IS NOT DISTINCT FROM {col}"""


PARTS["labelled"] = TRAIN
for _col in catalog.encoders.TARGET_ENCODED:
    PARTS[f"encoded_{_col}"] = _encoded(_col)
PARTS["contributions"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(ifnull(abs(({c} - m) * {w!r}), 0)), 9) AS mean_abs_contribution "
    f"FROM (SELECT {c}, (SELECT avg({c}) FROM app_features) AS m FROM app_features)"
    for c, w in catalog.COEFFICIENTS.items())

# Sweep on validation rows, then all sections on test rows at the best threshold.
PARTS["val_rows"] = "SELECT scored.* FROM scored JOIN split USING (loan_id) WHERE split = 'val'"
PARTS["test_rows"] = "SELECT scored.* FROM scored JOIN split USING (loan_id) WHERE split = 'test'"
PARTS["val_sweep"] = PARTS["sweep"].replace("FROM scored", "FROM val_rows")
PARTS["chosen"] = "SELECT threshold, f1 FROM val_sweep ORDER BY f1 DESC, threshold LIMIT 1"
PARTS["test_confusion"] = confusion("test_rows", "(SELECT threshold FROM chosen)")
PARTS["test_audited"] = "SELECT * FROM test_rows WHERE gender_clean IN ('F', 'M')"
PARTS["test_rates"] = PARTS["group_rates"].replace("0.3", "(SELECT threshold FROM chosen)").replace(
    "FROM audited", "FROM test_audited")
PARTS["test_group_auc"] = PARTS["group_auc"].replace("FROM audited", "FROM test_audited")
PARTS["test_auc"] = AUC_OF.format(rows="test_rows")
RATES = ("selection_rate", "false_positive_rate", "false_negative_rate")


def _gap(rates: str, aucs: str) -> str:
    long = " UNION ALL ".join(f"SELECT gender_clean, '{r}' AS metric, {r} AS value FROM {rates}" for r in RATES)
    long += f" UNION ALL SELECT gender_clean, 'auc', auc FROM {aucs} WHERE gender_clean <> 'all'"
    return f"""SELECT metric, round(max(value) - min(value), 9) AS gap,
        CASE WHEN max(value) > min(value) THEN arg_max(gender_clean, value) END AS higher_group
        FROM ({long}) GROUP BY metric"""


PARTS["test_gaps"] = _gap("test_rates", "test_group_auc")


def _classes(counts: str) -> str:
    """Precision p, recall r, F1 f and support s per class and on average, from confusion counts."""
    return f"""WITH c AS ({counts}), k AS (
          SELECT '0' AS label, ifnull(tn / nullif(tn + fn, 0), 0) AS p, ifnull(tn / nullif(tn + fp, 0), 0) AS r,
            ifnull(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f, tn + fp AS s FROM c
          UNION ALL SELECT '1', ifnull(tp / nullif(tp + fp, 0), 0), ifnull(tp / nullif(tp + fn, 0), 0),
            ifnull(2 * tp / nullif(2 * tp + fn + fp, 0), 0), tp + fn FROM c)
        SELECT * FROM k UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM k
          UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM k
          UNION ALL SELECT 'accuracy', (tn + tp) / total, (tn + tp) / total, (tn + tp) / total, total FROM c"""


PARTS["test_classes"] = _classes("SELECT * FROM test_confusion")


def _report() -> str:
    def one(section: str, measure: str, value: str, source: str, subject: str = "CAST(NULL AS VARCHAR)") -> str:
        return (f"SELECT '{section}' AS section, {subject} AS subject, '{measure}' AS measure, "
                f"round(CAST({value} AS DOUBLE), 9) AS value FROM {source}")

    rows = [one("threshold", m, m, "chosen") for m in ("threshold", "f1")]
    rows.append(one("metrics", "auc", "auc", "test_auc"))
    rows += [one("metrics", m, m, "test_confusion")
             for m in ("tn", "fp", "fn", "tp", "accuracy", "error_rate", "recall", "fpr", "fnr")]
    rows += [one("classes", m, m[0], "test_classes", "label") for m in ("precision", "recall", "f1", "support")]
    rows += [one("fairness", r, r, "test_rates", "gender_clean") for r in RATES]
    rows.append(one("fairness", "auc", "auc", "test_group_auc", "gender_clean"))
    rows.append(one("fairness_gap", "gap", "gap", "test_gaps", "metric"))
    rows.append(one("importance", "mean_abs_contribution", "mean_abs_contribution", "contributions", "feature"))
    return " UNION ALL ".join(rows)


FOLLOWS = {
    "is_working": "CASE WHEN income_type IS NOT NULL THEN CAST(income_type = 'Working' AS INTEGER) ELSE 0 END",
    "is_pensioner": "CASE WHEN income_type IS NOT NULL THEN CAST(income_type = 'Pensioner' AS INTEGER) ELSE 0 END",
    "is_unemployed": "CASE WHEN income_type IS NOT NULL THEN CAST(income_type = 'Unemployed' AS INTEGER) ELSE 0 END",
    "is_employed": "CAST(days_employed IS NOT NULL AS INTEGER)",
    "years_employed": "round(days_employed / -365.25, 1)",
    "ext_source_1_available": "CAST(ext_source_1 IS NOT NULL AS INTEGER)",
    "def_30_social_ratio": "ifnull(round(def_30_social_circle / nullif(obs_30_social_circle, 0), 4), 0.0)",
    "def_60_social_ratio": "ifnull(round(def_60_social_circle / nullif(obs_60_social_circle, 0), 4), 0.0)",
    "req_bureau_recent": "ifnull(req_bureau_day, 0) + ifnull(req_bureau_week, 0) + ifnull(req_bureau_mon, 0)",
}


def _request(name: str, required: bool = False) -> str:
    staged = set(APPLICATION_NAMES.values()) | {"gender_clean", "age_years", "days_employed", "owns_car", "owns_realty"}
    kind = REQUEST_TYPES[name].upper()
    value = f"CAST({name if name in staged else 'NULL'} AS {kind})"
    default = DEFAULTS[name]
    if default is not None:
        value = f"ifnull({value}, {default!r})"
    if name == "age_group":
        value = "CASE WHEN age_years < 30 THEN 'young' WHEN age_years <= 50 THEN 'adult' WHEN age_years > 50 THEN 'senior' END"
    if name in FOLLOWS:
        value = f"CAST({FOLLOWS[name]} AS {kind})"
    return f"{value} AS {name}"


_missing = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in REQUIRED)
PARTS["requests"] = f"""
    SELECT loan_id AS request_id, {', '.join(_request(n) for n in DEFAULTS)},
      'missing: ' || nullif(concat_ws(', ', {_missing}), '') AS error
    FROM stg_application"""

PARTS["with_score"] = "SELECT * FROM scored WHERE loan_id % 13 <> 0"
PARTS["sweep_with_score"] = PARTS["sweep"].replace("FROM scored", "FROM with_score")
_asked = _missing.replace("income_amount IS NULL", "(income_amount IS NULL OR request_id % 11 = 0)")
PARTS["answered"] = f"""
    SELECT request_id, coalesce('missing: ' || nullif(concat_ws(', ', {_asked}), ''),
             CASE WHEN request_id % 7 = 0 THEN 'unknown age_group: old' END) AS error,
      1 / (1 + exp(-(1 - 2.5e0 * ifnull(mean_source, 0.5e0) + 0.05e0 * ifnull(pace, 0e0)
        - 0.4e0 * CASE age_group WHEN 'young' THEN 0 WHEN 'adult' THEN 1 ELSE 2 END))) AS score
    FROM (SELECT *, round(credit_amount / nullif(annuity_amount, 0), 4) AS pace,
            round((ifnull(ext_source_1, 0) + ext_source_2 + ifnull(ext_source_3, 0))
              / list_count([ext_source_1, ext_source_2, ext_source_3]), 4) AS mean_source FROM requests)"""

CORR = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, abs(corr({c}, TARGET)) AS raw, avg(CAST({c} IS NULL AS INTEGER)) AS missing_rate "
    f"FROM raw_application_train" for c in NUMERIC if c != "TARGET")
MATRIX = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS raw FROM raw_application_train"
    for a in KEY_FEATURES for b in KEY_FEATURES)
REDUNDANCY = "SELECT unnest([" + ", ".join(
    f"{{'a': '{min(a, b)}', 'b': '{max(a, b)}', 'n': CAST(regr_count({a}, {b}) AS BIGINT), 'raw': abs(corr({a}, {b}))}}"
    for a, b in combinations(NUMERIC, 2)) + "], recursive := true) FROM raw_application_train"
SPREAD = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(max(r) - min(r), 9) AS spread, count(*) AS n_categories FROM "
    f"(SELECT avg(TARGET) AS r FROM raw_application_train WHERE {c} IS NOT NULL GROUP BY {c})" for c in TEXT)
MISSING = raw_facts("avg(CAST({c} IS NULL AS INTEGER)) AS missing_rate")
TYPES = [f.dataType.simpleString() for f in APPLICATION.fields]
MEASURES = dict.fromkeys(["f1", "precision", "recall", "youden_j"], 9)

FINAL: dict[str, str] = {
    "scan_tables": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(sum({s.fieldNames()[0]}) AS BIGINT) AS key_sum "
        f"FROM raw_{t.lower()}" for t, s in RAW_TABLES.items()),
    **{f"stg_{k}": f"SELECT * FROM stg_{k}" for k in catalog.STAGED},
    "app_features": "SELECT * FROM app_features",
    "agg_bureau": _rounded("agg_bureau", catalog.BUREAU_DIGITS),
    "distinct_types": "SELECT * FROM bureau_types",
    "agg_bureau_balance": "SELECT * FROM agg_bureau_balance",
    "any_severe": "SELECT loan_id, bb_had_severe_overdue FROM agg_bureau_balance",
    "agg_previous": _rounded("agg_previous", catalog.PREVIOUS_DIGITS),
    "agg_installments": _rounded("agg_installments", catalog.INSTALLMENT_DIGITS),
    "agg_pos": "SELECT * FROM agg_pos",
    "agg_credit_card": "SELECT * FROM agg_credit_card",
    "inst_windowed": "SELECT * FROM inst_windowed",
    "prev_windowed": "SELECT * FROM prev_windowed",
    "full_outer_combine": "SELECT * FROM prev_windowed",
    "latest_per_key": "SELECT * FROM prev_latest",
    "mart_features": MART,
    "mart_ordered": f"{MART} ORDER BY loan_id",
    "mart_bucketed": MART,
    "mart_roundtrip": MART,
    "dq_not_null": _check("not_null"),
    "dq_unique": _check("unique"),
    "dq_accepted_values": _check("accepted_values"),
    "dq_report": f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({ALL_CHECKS})",
    "split_assign": "SELECT loan_id, target, split FROM split",
    "split_sizes": "SELECT split, count(*) AS n_rows, round(avg(target), 9) AS target_rate FROM split GROUP BY split",
    "fold_assign": "SELECT loan_id, target, CAST(fold AS INTEGER) AS fold FROM ranked",
    "ordinal_encode": "SELECT loan_id, CASE age_group WHEN 'young' THEN 0e0 WHEN 'adult' THEN 1e0 WHEN 'senior' THEN 2e0 "
                      "END AS age_group FROM app_features",
    "ordered_target_stats": " UNION ALL ".join(
        f"SELECT loan_id, '{c}' AS column_name, round((ifnull(sum(target) OVER w, 0) + (SELECT avg(target) FROM stg_application)) / "
        f"(count(*) OVER w + 1), 9) AS encoded FROM stg_application WINDOW w AS (PARTITION BY {c} ORDER BY md5('42|' || loan_id), "
        "loan_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in catalog.encoders.TARGET_ENCODED),
    "oof_folds": """
        SELECT loan_id, target, CAST(ntile(5) OVER (PARTITION BY target ORDER BY md5('42|' || loan_id), loan_id) - 1 AS INTEGER) AS fold
        FROM split WHERE split = 'train'""",
    "fold_auc_given": """
        SELECT * FROM (WITH g AS (SELECT loan_id, target, CAST(fold AS INTEGER) AS fold, (loan_id * 7919) % 1000 / 1e3 AS p1,
                                    (loan_id * 104729) % 17 / 17e0 AS p2 FROM ranked),
          l AS (SELECT 'p1' AS learner, fold, target, p1 AS p FROM g UNION ALL SELECT 'p2', fold, target, p2 FROM g),
          b AS (SELECT * FROM l UNION ALL SELECT learner, NULL, target, p FROM l),
          r AS (SELECT *, rank() OVER (PARTITION BY learner, fold ORDER BY p)
                  + (count(*) OVER (PARTITION BY learner, fold, p) - 1) / 2 AS place FROM b)
        SELECT learner, fold, count(*) AS n_rows, round((sum(place) FILTER (target = 1) - sum(target) * (sum(target) + 1) / 2)
          / (sum(target) * (count(*) - sum(target))), 12) AS auc FROM r GROUP BY learner, fold)""",
    "target_encode": "SELECT * FROM " + " JOIN ".join(
        f"encoded_{c}" + (" USING (loan_id)" if i else "") for i, c in enumerate(catalog.encoders.TARGET_ENCODED)),
    "fill_unknown": "SELECT * REPLACE (" + ", ".join(
        f"ifnull({c}, 'Unknown') AS {c}" for c in (
            "gender_clean", "contract_type", "income_type", "occupation_type", "education_type", "family_status",
            "organization_type", "age_group")) + ") FROM app_features",
    "impute_median": "SELECT loan_id, " + ", ".join(
        f"CAST(ifnull({c}, (SELECT median({c}) FROM labelled WHERE split = 'train')) AS DOUBLE) AS {c}"
        for c in catalog.IMPUTED) + " FROM labelled",
    "standardize": "SELECT loan_id, " + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM labelled WHERE split = 'train')) / "
        f"(SELECT CASE stddev_pop({c}) WHEN 0 THEN 1 ELSE stddev_pop({c}) END FROM labelled WHERE split = 'train'), 9) AS {c}"
        for c in catalog.SCALED) + " FROM labelled",
    "auc_overall": AUC_OF.format(rows="scored"),
    "threshold_sweep": _rounded("sweep", MEASURES),
    "best_threshold": f"SELECT * REPLACE ({', '.join(f'round({m}, 9) AS {m}' for m in MEASURES)}) FROM ("
                      "(SELECT *, 'best_f1' AS choice FROM sweep ORDER BY f1 DESC, threshold LIMIT 1) UNION ALL "
                      "(SELECT *, 'best_youden' FROM sweep ORDER BY youden_j DESC, threshold LIMIT 1) UNION ALL "
                      "(SELECT *, 'default' FROM sweep WHERE threshold = 0.5))",
    "class_report": f"SELECT label, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, CAST(s AS BIGINT) AS support "
                    f"FROM ({_classes(confusion('scored', '0.3'))})",
    "confusion_metrics": f"SELECT * EXCLUDE (total) FROM ({confusion('scored', '0.3')})",
    "roc_curve": """
        SELECT score AS threshold, fp / n AS fpr, tp / p AS tpr FROM curve
        WHERE i = 1 OR i = points OR next_pos <> pos OR next_neg <> neg
        UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0, 0""",
    "pr_curve": "SELECT score AS threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM curve "
                "UNION ALL SELECT NULL, 1, 0",
    "prevalence": "SELECT avg(target) AS prevalence FROM scored",
    "fairness_by_group": "SELECT * FROM group_rates",
    "fairness_gap": _gap("group_rates", "group_auc"),
    "auc_by_group": "SELECT * FROM group_auc",
    "importance_linear": "SELECT * FROM contributions",
    "evaluation_report": _report(),
    "shape_dtypes": "SELECT 'rows' AS fact, count(*) AS value FROM raw_application_train UNION ALL "
                    f"SELECT 'columns', {len(TYPES)} UNION ALL " + " UNION ALL ".join(
                        f"SELECT 'dtype {k}', {TYPES.count(k)}" for k in sorted(set(TYPES))),
    "value_counts": "SELECT TARGET, count(*) AS n_rows, count(*) / (SELECT count(*) FROM raw_application_train) AS share "
                    "FROM raw_application_train GROUP BY TARGET",
    "missing_rates": f"SELECT * FROM ({MISSING}) WHERE missing_rate > 0",
    "candidate_columns": f"SELECT * FROM ({MISSING}) WHERE missing_rate > 0 AND missing_rate < 0.2 AND column_name NOT IN ("
                         + ", ".join(f"'{c}'" for c in ALREADY_USED) + ")",
    "rate_by_group": "SELECT gender, round(avg(target), 4) AS rate, count(target) AS n_rows, "
                     "CAST(sum(target) AS BIGINT) AS n_positive FROM stg_application WHERE gender IS NOT NULL GROUP BY gender",
    "rate_by_age_bucket": """
        SELECT age_bucket, round(avg(target), 3) AS rate, count(target) AS n_rows, CAST(sum(target) AS BIGINT) AS n_positive
        FROM (SELECT target, CASE WHEN y > 0 AND y <= 25 THEN '<25' WHEN y > 25 AND y <= 35 THEN '25-35'
                WHEN y > 35 AND y <= 45 THEN '35-45' WHEN y > 45 AND y <= 55 THEN '45-55'
                WHEN y > 55 AND y <= 100 THEN '>55' END AS age_bucket
              FROM (SELECT target, -days_birth / 365 AS y FROM stg_application))
        WHERE age_bucket IS NOT NULL GROUP BY age_bucket""",
    "top_correlations": f"SELECT column_name, CASE WHEN NOT isnan(raw) THEN round(raw, 6) END AS abs_corr, missing_rate "
                        f"FROM ({CORR}) ORDER BY abs_corr DESC NULLS LAST, column_name LIMIT 20",
    "corr_matrix": f"SELECT a, b, CASE WHEN NOT isnan(raw) THEN round(raw, 2) END AS corr FROM ({MATRIX})",
    "column_redundancy": "SELECT a, b, n, abs_corr, ifnull(abs_corr >= 0.9, false) AS redundant FROM (SELECT a, b, n, "
                         f"CASE WHEN NOT isnan(raw) THEN round(raw, 6) END AS abs_corr FROM ({REDUNDANCY}))",
    "category_spread": SPREAD,
    "density_histogram": """
        SELECT * FROM (WITH k AS (SELECT TARGET, EXT_SOURCE_2 AS x FROM raw_application_train
                   WHERE EXT_SOURCE_2 IS NOT NULL AND EXT_SOURCE_3 IS NOT NULL),
          r AS (SELECT TARGET, min(x) AS lo, (max(x) - min(x)) / 50 AS w, count(*) AS n FROM k GROUP BY TARGET),
          bins AS (SELECT TARGET, CAST(b AS INTEGER) AS bin, lo + b * w AS edge,
                     CASE WHEN b < 49 THEN lo + (b + 1) * w END AS upper, w, n FROM r, range(50) t(b))
        SELECT b.TARGET, b.bin, round(any_value(edge), 9) AS bin_start, count(x) AS n_rows,
          round(count(x) / any_value(n * w), 9) AS density
        FROM bins b LEFT JOIN k ON k.TARGET = b.TARGET AND x >= edge AND (x < upper OR upper IS NULL)
        GROUP BY b.TARGET, b.bin)""",
    "rate_vs_average": "SELECT income_type, round(avg(target), 9) AS rate, avg(target) > 0.081 AS above_average "
                       "FROM stg_application WHERE income_type IN ('Working', 'Commercial associate', 'State servant', "
                       "'Pensioner') GROUP BY income_type",
    "dictionary_search": "SELECT * FROM part WHERE p_type = 'ECONOMY' AND regexp_matches(lower(p_name), 'ring|bolt') "
                         "AND p_brand IN ('Brand#2', 'Brand#4', 'Brand#17')",
    "score_requests": """
        SELECT request_id, CASE WHEN error IS NULL THEN round(score, 4) END AS default_probability, 0.3e0 AS threshold,
          CASE WHEN error IS NULL THEN CAST(score >= 0.3 AS INTEGER) END AS decision,
          CASE WHEN error IS NULL THEN CASE WHEN score >= 0.5 THEN 'high' WHEN score >= 0.3 THEN 'medium' ELSE 'low' END END
            AS risk_level, error FROM answered""",
    "confusion_partly_scored": f"SELECT * EXCLUDE (total) FROM ({confusion('with_score', '0.3')})",
    "sweep_partly_scored": _rounded("sweep_with_score", MEASURES),
    "auc_partly_scored": f"SELECT n_rows, round(auc, 12) AS auc FROM ({AUC_OF.format(rows='with_score')})",
    "score_defaults": "SELECT * FROM requests",
    "score_backfill": """
        SELECT * REPLACE (
          round(income_amount / nullif(credit_amount, 0), 4) AS ratio_income_credit,
          round(annuity_amount / nullif(income_amount, 0), 4) AS ratio_annuity_income,
          round(credit_amount / nullif(annuity_amount, 0), 4) AS credit_to_annuity_ratio,
          round(income_amount / nullif(cnt_fam_members, 0), 4) AS income_per_family_member,
          round(income_amount / (1 + cnt_children), 4) AS income_per_child,
          round((ifnull(ext_source_1, 0) + ext_source_2 + ifnull(ext_source_3, 0))
            / list_count([ext_source_1, ext_source_2, ext_source_3]), 4) AS ext_source_mean,
          round(ifnull(ext_source_1, 0) * ext_source_2, 4) AS ext_source_1_x_2,
          round(ext_source_2 * ifnull(ext_source_3, 0), 4) AS ext_source_2_x_3,
          round(ifnull(ext_source_1, 0) * ext_source_2 * ifnull(ext_source_3, 0), 4) AS ext_source_1_x_2_x_3)
        FROM requests""",
    "score_decision": "SELECT *, round(score, 4) AS default_probability, 0.3e0 AS threshold, "
                      "CAST(score >= 0.3 AS INTEGER) AS decision, CASE WHEN score >= 0.5 THEN 'high' "
                      "WHEN score >= 0.3 THEN 'medium' ELSE 'low' END AS risk_level FROM scored",
    "quick_ratios": "SELECT loan_id, ifnull(income_amount / nullif(credit_amount, 0), 0) AS ratio_income_credit, "
                    "ifnull(credit_amount / nullif(annuity_amount, 0), 0) AS credit_to_annuity_ratio, "
                    "ifnull(credit_amount / nullif(goods_price, 0), 0) AS credit_to_goods_ratio FROM stg_application",
}


def statements() -> dict[str, str]:
    return {name: statement(" ".join(final.split())) for name, final in FINAL.items()}
