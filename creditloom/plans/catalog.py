"""Registered queries: every operator over whole tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import duck_round
from ..operators import (application, balances, bureau, encoders, evaluation, importance, installments, learners,
                         previous, profiling, quality, scoring, splits, stacking, tuning)
from ..session import written
from ..sources.schemas import RAW_TABLES
from ..sources.standins import given_table, read_standin
from .mart import STAGED, bucketed_staging, credit_mart, mart_of_staged, ordered_mart, staged
from .report import evaluation_report

Query = Callable[[SparkSession, str], DataFrame]

# Decision threshold and coefficients used where a query needs a given model.
THRESHOLD = 0.3
COEFFICIENTS = {
    "ext_source_mean": -2.5, "credit_to_annuity_ratio": 0.05, "age_years": -0.02, "years_employed": -0.04,
    "ratio_annuity_income": 0.8, "cnt_children": 0.1,
}

# Names of staged tables as the declared checks use them.
CHECKED_AS = {
    "application": "stg_application_train", "bureau": "stg_bureau", "bureau_balance": "stg_bureau_balance",
    "previous": "stg_previous_application", "installments": "stg_installments_payments",
    "pos": "stg_pos_cash_balance", "credit_card": "stg_credit_card_balance",
}

# Digits to which order-dependent double sums and averages are compared.
BUREAU_DIGITS = {"bureau_debt_total": 6, "bureau_credit_avg": 6, "bureau_credit_sum_total": 6,
                 "debt_credit_ratio": 9, "overdue_debt_ratio": 9}
MART_DIGITS = {"bureau_debt_total": 6, "debt_credit_ratio": 9, "overdue_debt_ratio": 9}
PREVIOUS_DIGITS = {"prev_credit_avg": 6, "prev_application_avg": 6, "prev_app_credit_sum": 6}
INSTALLMENT_DIGITS = {"instpay_payment_avg": 6, "instpay_payment_sum": 6}
WINDOW_DIGITS = {f"inst_payment_ratio_{w}": 9 for w in ("3m", "6m", "12m")}
STATUS_DIGITS = {"prev_approved_credit_avg": 6, "prev_approved_annuity_avg": 6, "prev_approved_credit_ratio": 9,
                 "prev_refused_credit_avg": 6}


def settled(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round sums whose last bits depend on the order of addition."""
    return df.withColumns({c: F.expr(duck_round(c, d)) for c, d in digits.items()})


class Tables:
    """The stand-in tables below one folder, and the models fitted on them."""

    _open: dict[tuple[str, str], Tables] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Tables:
        """One object per session and folder, so that queries share the written mart and the folds."""
        key = (spark.sparkContext.applicationId, folder)
        return cls._open.setdefault(key, cls(spark, folder))

    def raw(self, name: str) -> DataFrame:
        return read_standin(self.spark, self.folder, name)

    def stg(self, name: str) -> DataFrame:
        return staged(self.raw, name)

    def mart(self) -> DataFrame:
        return credit_mart(self.raw)

    def features(self) -> DataFrame:
        return application.application_features(self.stg("application"))

    def scored(self) -> DataFrame:
        score = ((F.col("loan_id") * 7919) % 1000 / F.lit(1e3)).alias("score")
        return self.stg("application").select("loan_id", "target", "gender_clean", score)

    def part(self) -> DataFrame:
        return given_table(self.spark, self.folder, "part")

    def requests(self) -> DataFrame:
        return scoring.as_requests(self.stg("application"), "loan_id")

    @cached_property
    def mart_table(self) -> DataFrame:
        """The mart as a written table, for work that reads it more than once."""
        return written(self.mart(), "mart")

    @cached_property
    def split_mart(self) -> DataFrame:
        return splits.stratified_split(self.mart_table)

    def part_of_mart(self, split: str) -> DataFrame:
        return self.split_mart.where(F.col("split") == split).drop("split")

    @cached_property
    def bases(self) -> stacking.BaseModels:
        return stacking.fit_bases(self.part_of_mart("train"))

    @cached_property
    def oof(self) -> DataFrame:
        return written(stacking.out_of_fold(self.part_of_mart("train"), self.bases), "oof")

    @cached_property
    def stack(self) -> stacking.StackedScorer:
        return stacking.fit_stack(self.bases, self.oof)


def _scan_tables(t: Tables) -> DataFrame:
    """Rows and sum of the first key of every raw table."""
    parts = [t.raw(name).select(F.col(schema.fieldNames()[0]).alias("k")).agg(
        F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.sum("k").alias("key_sum"))
        for name, schema in RAW_TABLES.items()]
    return reduce(DataFrame.unionByName, parts)


def _checked_tables(t: Tables) -> dict[str, DataFrame]:
    raw = {name: t.raw(name) for name in RAW_TABLES}
    stg = {CHECKED_AS[name]: t.stg(name) for name in STAGED}
    return raw | stg | {"mart_credit_features": t.mart_table}


def _checks(t: Tables, kind: str) -> DataFrame:
    wanted = [c for c in quality.DECLARED if c.kind == kind]
    return quality.run_checks(_checked_tables(t), wanted)


def _split_columns(t: Tables) -> DataFrame:
    return splits.stratified_split(t.stg("application").select("loan_id", "target")).select("loan_id", "target", "split")


def _target_encode(t: Tables) -> DataFrame:
    table = splits.stratified_split(t.stg("application").select("loan_id", "target", *encoders.TARGET_ENCODED))
    encoder = encoders.fit_target_encoder(table.where("split = 'train'"))
    encoded = encoder.transform(table).select("loan_id", *encoders.TARGET_ENCODED)
    return settled(encoded, dict.fromkeys(encoders.TARGET_ENCODED, 9))


# Every number of the staged application.
NUMBERS = [
    "income_amount", "credit_amount", "annuity_amount", "goods_price", "age_years", "days_birth", "days_employed",
    "region_rating", "days_id_publish", "days_registration", "reg_city_not_work_city", "flag_document_3", "has_mobile",
    "has_email", "ext_source_1", "ext_source_2", "ext_source_3", "cnt_children", "cnt_fam_members", "own_car_age",
    "days_last_phone_change", "obs_30_social_circle", "def_30_social_circle", "obs_60_social_circle", "def_60_social_circle",
    "req_bureau_hour", "req_bureau_day", "req_bureau_week", "req_bureau_mon", "req_bureau_qrt", "req_bureau_year",
]
IMPUTED = SCALED = NUMBERS


def _impute_median(t: Tables) -> DataFrame:
    table = splits.stratified_split(t.stg("application").select("loan_id", "target", *IMPUTED))
    medians = encoders.fit_medians(table.where("split = 'train'"), IMPUTED)
    return encoders.impute_median(table, medians).select("loan_id", *IMPUTED)


def _standardize(t: Tables) -> DataFrame:
    table = splits.stratified_split(t.stg("application").select("loan_id", "target", *SCALED))
    scaler = encoders.fit_scaler(table.where("split = 'train'"), SCALED)
    return settled(encoders.standardize(table, scaler).select("loan_id", *SCALED), dict.fromkeys(SCALED, 9))


def _linear_importance(t: Tables) -> DataFrame:
    ranked = importance.linear_importance(t.features(), COEFFICIENTS)
    return settled(ranked, {"mean_abs_contribution": 9})


def _evaluation_report(t: Tables) -> DataFrame:
    report = evaluation_report(splits.stratified_split(t.scored()), _linear_importance(t))
    return settled(report, {"value": 9})


def _stack_report(t: Tables) -> DataFrame:
    """The whole chain on the scores of the fitted stack, with the contributions of its boosted learner."""
    scored = t.stack.score(t.split_mart.where("split <> 'train'"))
    return evaluation_report(scored, _importance_tree(t))


def _gaps(t: Tables) -> DataFrame:
    by_group = evaluation.fairness_by_group(t.scored(), THRESHOLD)
    return settled(evaluation.fairness_gap(by_group, evaluation.auc_by_group(t.scored())), {"gap": 9})


def _dictionary_search(t: Tables) -> DataFrame:
    return profiling.dictionary_search(t.part(), equals={"p_type": "ECONOMY"}, contains={"p_name": "RING|BOLT"},
                                       one_of={"p_brand": ["Brand#2", "Brand#4", "Brand#17"]})


def _partly_scored(t: Tables) -> DataFrame:
    """Scored rows of which a thirteenth has no score, as rejected requests have none."""
    return t.scored().withColumn("score", F.when(F.col("loan_id") % 13 != 0, F.col("score")))


def _score_requests(t: Tables) -> DataFrame:
    """Answers of a linear model to requests of which some lack the income and some have an age group that does not exist."""
    asked = t.requests().withColumns({
        "income_amount": F.when(F.col("request_id") % 11 != 0, F.col("income_amount")),
        "age_group": F.when(F.col("request_id") % 7 == 0, F.lit("old")).otherwise(F.col("age_group"))})

    def linear(rows: DataFrame) -> DataFrame:
        rows = encoders.ordinal_encode(rows)  # fails the job where an unknown group gets through
        logit = "1 - 2.5D * coalesce(ext_source_mean, 0.5D) + 0.05D * coalesce(credit_to_annuity_ratio, 0D) - 0.4D * age_group"
        return rows.withColumn("score", F.expr(f"1 / (1 + exp(-({logit})))"))

    return scoring.score_requests(asked, linear, THRESHOLD)


def _fit_report(t: Tables, scorer: learners.Scorer) -> DataFrame:
    """AUC of a model on the rows it was trained on and on the validation rows, which are scored once."""
    scored = scorer.score(t.split_mart.where(F.col("split").isin("train", "val"))).select("split", "target", "score")
    scored = written(scored, "scored")
    parts = [evaluation.auc(scored.where(F.col("split") == s)).withColumn("split", F.lit(s)) for s in ("train", "val")]
    return parts[0].unionByName(parts[1])


def _lr_baseline(t: Tables) -> DataFrame:
    return _fit_report(t, learners.fit_logistic(t.part_of_mart("train")))


def _gbt_model(t: Tables) -> DataFrame:
    model = learners.fit_boosted(t.part_of_mart("train"), t.part_of_mart("val"))
    return _fit_report(t, model).withColumn("n_trees", F.lit(model.trees()))


def _tree_cat_model(t: Tables) -> DataFrame:
    train, val = t.part_of_mart("train"), t.part_of_mart("val")
    model = learners.fit_categorical(train, val)
    return _fit_report(t, model).withColumn("n_trees", F.lit(model.trees()))


def _given_oof(t: Tables) -> DataFrame:
    """Two given scores in place of the learners', with the folds of the whole table."""
    folded = splits.stratified_folds(t.stg("application").select("loan_id", "target"))
    return folded.withColumns({"p1": F.expr("(loan_id * 7919) % 1000 / 1e3"), "p2": F.expr("(loan_id * 104729) % 17 / 17e0")})


def _stacking_meta(t: Tables) -> DataFrame:
    """Weights of the meta model next to the out-of-fold AUC of its two inputs."""
    regression = t.stack.meta.stages[-1]
    weights = zip(stacking.BASE, map(float, regression.coefficients))
    table = t.spark.createDataFrame([(n, w, float(regression.intercept)) for n, w in weights],
                                    "learner string, weight double, intercept double")
    return stacking.fold_aucs(t.oof).where("fold IS NULL").drop("fold").join(table, "learner")


def _stacking_score(t: Tables) -> DataFrame:
    return t.stack.predict(t.part_of_mart("test")).select("loan_id", "target", "score", "prediction")


def _tune_cv(t: Tables) -> DataFrame:
    return tuning.search(t.part_of_mart("train"))


def _importance_permutation(t: Tables) -> DataFrame:
    table = t.part_of_mart("test")
    return importance.permutation_importance(table, t.bases.full[1].score, learners.feature_columns(table))


def _importance_tree(t: Tables) -> DataFrame:
    """Contributions of the stack's boosted learner on the test rows."""
    return importance.tree_importance(t.part_of_mart("test"), t.bases.full[0])


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "scan_tables": _scan_tables,
    "stg_application": lambda t: t.stg("application"),
    "stg_bureau": lambda t: t.stg("bureau"),
    "stg_bureau_balance": lambda t: t.stg("bureau_balance"),
    "stg_previous": lambda t: t.stg("previous"),
    "stg_installments": lambda t: t.stg("installments"),
    "stg_pos": lambda t: t.stg("pos"),
    "stg_credit_card": lambda t: t.stg("credit_card"),

    "app_features": lambda t: t.features(),
    "agg_bureau": lambda t: settled(bureau.bureau_features(t.stg("bureau")), BUREAU_DIGITS),
    "distinct_types": lambda t: bureau.distinct_credit_types(t.stg("bureau")),
    "agg_bureau_balance": lambda t: bureau.bureau_balance_features(t.stg("bureau_balance"), t.stg("bureau")),
    "any_severe": lambda t: bureau.any_severe(t.stg("bureau_balance"), t.stg("bureau")),
    "agg_previous": lambda t: settled(previous.previous_features(t.stg("previous")), PREVIOUS_DIGITS),
    "agg_installments": lambda t: settled(installments.installments_features(t.stg("installments")), INSTALLMENT_DIGITS),
    "agg_pos": lambda t: balances.pos_features(t.stg("pos")),
    "agg_credit_card": lambda t: balances.card_features(t.stg("credit_card")),
    "inst_windowed": lambda t: settled(installments.installments_windowed(t.stg("installments")), WINDOW_DIGITS),
    "prev_windowed": lambda t: settled(previous.previous_windowed(t.stg("previous")), STATUS_DIGITS),
    "full_outer_combine": lambda t: settled(previous.full_outer_combine(t.stg("previous")), STATUS_DIGITS),
    "latest_per_key": lambda t: previous.latest_previous(t.stg("previous")),

    "mart_features": lambda t: settled(t.mart(), MART_DIGITS),
    "mart_ordered": lambda t: ordered_mart(settled(t.mart(), MART_DIGITS)),
    "mart_bucketed": lambda t: settled(mart_of_staged(bucketed_staging(t.spark, t.raw).__getitem__), MART_DIGITS),
    "mart_roundtrip": lambda t: settled(written(t.mart(), "mart"), MART_DIGITS),

    "dq_not_null": lambda t: _checks(t, "not_null"),
    "dq_unique": lambda t: _checks(t, "unique"),
    "dq_accepted_values": lambda t: _checks(t, "accepted_values"),
    "dq_report": lambda t: quality.quality_report(_checked_tables(t)),

    "split_assign": _split_columns,
    "split_sizes": lambda t: settled(splits.split_report(_split_columns(t)), {"target_rate": 9}),
    "fold_assign": lambda t: splits.stratified_folds(t.stg("application").select("loan_id", "target")),

    "ordinal_encode": lambda t: encoders.ordinal_encode(t.features().select("loan_id", "age_group")),
    "target_encode": _target_encode,
    "ordered_target_stats": lambda t: settled(encoders.ordered_target_stats(t.stg("application")), {"encoded": 9}),
    "fill_unknown": lambda t: encoders.fill_unknown(t.features()),
    "impute_median": _impute_median,
    "standardize": _standardize,

    "auc_overall": lambda t: evaluation.auc(t.scored()),
    "threshold_sweep": lambda t: settled(
        evaluation.threshold_sweep(t.scored()), dict.fromkeys(["f1", "precision", "recall", "youden_j"], 9)),
    "best_threshold": lambda t: settled(evaluation.best_thresholds(
        evaluation.threshold_sweep(t.scored())), dict.fromkeys(["f1", "precision", "recall", "youden_j"], 9)),
    "class_report": lambda t: settled(
        evaluation.class_report(t.scored(), THRESHOLD), dict.fromkeys(["precision", "recall", "f1"], 9)),
    "confusion_metrics": lambda t: evaluation.confusion_metrics(t.scored(), THRESHOLD),
    "roc_curve": lambda t: evaluation.roc_curve(t.scored()),
    "pr_curve": lambda t: evaluation.pr_curve(t.scored()),
    "prevalence": lambda t: evaluation.prevalence(t.scored()),
    "fairness_by_group": lambda t: evaluation.fairness_by_group(t.scored(), THRESHOLD),
    "fairness_gap": _gaps,
    "auc_by_group": lambda t: evaluation.auc_by_group(t.scored()),
    "importance_linear": _linear_importance,
    "evaluation_report": _evaluation_report,

    "shape_dtypes": lambda t: profiling.shape_dtypes(t.raw("application_train")),
    "value_counts": lambda t: profiling.value_counts(t.raw("application_train"), "TARGET"),
    "missing_rates": lambda t: profiling.missing_rates(t.raw("application_train")),
    "candidate_columns": lambda t: profiling.candidate_columns(t.raw("application_train")),
    "rate_by_group": lambda t: profiling.rate_by_group(t.stg("application"), ["gender"]),
    "rate_by_age_bucket": lambda t: profiling.rate_by_age_bucket(t.stg("application")),
    "top_correlations": lambda t: profiling.top_correlations(t.raw("application_train"), "TARGET"),
    "corr_matrix": lambda t: profiling.corr_matrix(t.raw("application_train"), profiling.KEY_FEATURES),
    "column_redundancy": lambda t: profiling.column_redundancy(t.raw("application_train")),
    "category_spread": lambda t: settled(
        profiling.category_spread(t.raw("application_train"), "TARGET"), {"spread": 9}),
    "density_histogram": lambda t: settled(profiling.density_histogram(
        t.raw("application_train"), "EXT_SOURCE_2", "TARGET", complete=["EXT_SOURCE_2", "EXT_SOURCE_3"]),
        {"bin_start": 9, "density": 9}),
    "rate_vs_average": lambda t: settled(profiling.rate_vs_average(
        t.stg("application"), "income_type",
        ["Working", "Commercial associate", "State servant", "Pensioner"]), {"rate": 9}),
    "dictionary_search": _dictionary_search,

    "score_defaults": lambda t: scoring.score_defaults(t.requests()),
    "score_backfill": lambda t: scoring.score_backfill(scoring.score_defaults(t.requests())),
    "score_requests": _score_requests,
    "confusion_partly_scored": lambda t: evaluation.confusion_metrics(_partly_scored(t), THRESHOLD),
    "sweep_partly_scored": lambda t: settled(
        evaluation.threshold_sweep(_partly_scored(t)), dict.fromkeys(["f1", "precision", "recall", "youden_j"], 9)),
    "auc_partly_scored": lambda t: settled(evaluation.auc(_partly_scored(t)), {"auc": 12}),
    "score_decision": lambda t: scoring.score_decision(t.scored(), THRESHOLD),
    "quick_ratios": lambda t: scoring.quick_ratios(t.stg("application")).select(
        "loan_id", "ratio_income_credit", "credit_to_annuity_ratio", "credit_to_goods_ratio"),

    "lr_baseline": _lr_baseline,
    "gbt_model": _gbt_model,
    "tree_cat_model": _tree_cat_model,
    "stacking_oof": lambda t: t.oof,
    "oof_folds": lambda t: t.oof.where("p1 BETWEEN 0 AND 1 AND p2 BETWEEN 0 AND 1").select("loan_id", "target", "fold"),
    "fold_auc_given": lambda t: settled(stacking.fold_aucs(_given_oof(t)), {"auc": 12}),
    "stacking_fold_auc": lambda t: stacking.fold_aucs(t.oof),
    "stacking_meta": _stacking_meta,
    "stacking_score": _stacking_score,
    "tune_cv": _tune_cv,
    "importance_permutation": _importance_permutation,
    "importance_tree": _importance_tree,
    "stack_report": _stack_report,
}


def registered() -> dict[str, Query]:
    """All queries as functions of a session and a folder of given tables."""
    def bound(build: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, folder: build(Tables.of(spark, folder))

    return {name: bound(build) for name, build in _QUERIES.items()}
