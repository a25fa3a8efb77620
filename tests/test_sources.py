import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from creditloom.operators import evaluation as ev
from creditloom.operators import profiling
from creditloom.operators.splits import stratified_split
from creditloom.plans.mart import credit_mart
from creditloom.sources import readers, writers
from creditloom.sources.schemas import RAW_TABLES


def only_file(folder, suffix):
    (path,) = Path(folder).glob(f"*.{suffix}")
    return path.read_text()


def test_csv_by_header_name(spark, tmp_path):
    path = tmp_path / "bureau_balance.csv"
    path.write_text("EXTRA,STATUS,SK_ID_BUREAU,MONTHS_BALANCE\nx,0,5,-1\ny,5,,-2\n")
    df = readers.read_raw_csv(spark, str(path), "bureau_balance")
    assert df.schema == RAW_TABLES["bureau_balance"]
    assert [tuple(r) for r in df.collect()] == [(5, -1, "0"), (None, -2, "5")]


def test_whole_csv_types_the_undeclared_columns(spark, tmp_path):
    path = tmp_path / "bureau_balance.csv"
    path.write_text("WHOLE,STATUS,GAPS,SK_ID_BUREAU,TEXT,EMPTY,MONTHS_BALANCE,SHARE.X\n1,0,1,5,a,,-1,0.5\n2,C,,6,2,,x7,1\n")
    df = readers.read_whole_csv(spark, str(path), "bureau_balance")
    assert df.dtypes == [("WHOLE", "bigint"), ("STATUS", "string"), ("GAPS", "double"), ("SK_ID_BUREAU", "bigint"),
                         ("TEXT", "string"), ("EMPTY", "double"), ("MONTHS_BALANCE", "bigint"), ("SHARE.X", "double")]
    assert [tuple(r) for r in df.collect()] == [(1, "0", 1.0, 5, "a", None, -1, 0.5), (2, "C", None, 6, "2", None, None, 1.0)]


def test_profiles_of_a_whole_csv_see_every_column(spark, tables, tmp_path):
    raw = tables.raw("application_train").withColumns({
        "APARTMENTS_AVG": F.expr("if(SK_ID_CURR % 4 = 0, NULL, SK_ID_CURR / 7e0)"), "WALLSMATERIAL_MODE": F.lit("Panel")})
    raw.write.option("header", True).csv(f"{tmp_path}/application_train.csv")
    df = readers.read_whole_csv(spark, f"{tmp_path}/application_train.csv", "application_train")
    assert df.dtypes == raw.dtypes and df.count() == raw.count()
    assert "APARTMENTS_AVG" in {r["column_name"] for r in profiling.missing_rates(df).collect()}
    assert "APARTMENTS_AVG" in {r["column_name"] for r in profiling.correlations_with(df, "TARGET").collect()}
    assert "WALLSMATERIAL_MODE" in {r["column_name"] for r in profiling.category_spread(df, "TARGET").collect()}


def test_values_that_fail_to_parse_are_counted(spark, tmp_path):
    path = tmp_path / "bureau_balance.csv"
    path.write_text("EXTRA,STATUS,SK_ID_BUREAU,MONTHS_BALANCE\nx,0,5,-1\ny,5,,oops\nz,1,7\nz,1,8.5,-3,9\n")
    found = readers.unparsed_values(spark, str(path), "bureau_balance").collect()
    assert {tuple(r) for r in found} == {("SK_ID_BUREAU", 3, 1), ("MONTHS_BALANCE", 3, 1), (readers.BROKEN_ROW, 4, 2)}


def test_csv_with_missing_column(spark, tmp_path):
    path = tmp_path / "bureau_balance.csv"
    path.write_text("SK_ID_BUREAU,STATUS\n1,0\n")
    with pytest.raises(ValueError, match="MONTHS_BALANCE"):
        readers.read_raw_csv(spark, str(path), "bureau_balance")


def test_mart_from_csv_equals_mart_from_stand_ins(spark, tables, tmp_path):
    for name in RAW_TABLES:
        tables.raw(name).write.option("header", True).csv(f"{tmp_path}/{name}.csv")
    from_csv = credit_mart(readers.csv_folder(spark, str(tmp_path)))
    mine, theirs = (m.select("loan_id", "age_years", "bb_bad_months", "prev_refused_count", "inst_late_max",
                             "pos_dpd_max", "ratio_income_credit") for m in (from_csv, tables.mart()))
    assert sorted(map(str, mine.collect())) == sorted(map(str, theirs.collect()))


def test_column_dictionary(spark, tmp_path):
    path = tmp_path / "dictionary.csv"
    path.write_bytes(',Table, Row ,Description\n1, bureau.csv ,DAYS,"café, ""day"""\n'.encode("latin-1"))
    row = readers.read_column_dictionary(spark, str(path)).first()
    assert row.asDict() == {"Table": "bureau.csv", "Row": "DAYS", "Description": 'café, "day"'}


def test_splits_are_read_by_folder(spark, tables, tmp_path):
    split = stratified_split(tables.scored())
    writers.write_splits(split, str(tmp_path))
    test = readers.read_splits(spark, str(tmp_path), "test")
    assert test.count() == split.where("split = 'test'").count() and "split" not in test.columns
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_report_files(spark, tables, tmp_path):
    scored = tables.scored()
    aucs, groups = ev.auc_by_group(scored), ev.fairness_by_group(scored, 0.3)
    writers.write_metrics(ev.confusion_metrics(scored, 0.3), ev.auc(scored), f"{tmp_path}/m", "demo", 0.3)
    metrics = json.loads(only_file(f"{tmp_path}/m", "json"))
    assert list(metrics) == ["model_name", "auc", "accuracy", "threshold", "recall", "fpr", "fnr", "confusion_matrix"]
    writers.write_fairness(groups, ev.fairness_gap(groups, aucs), aucs, f"{tmp_path}/f", "demo")
    fairness = json.loads(only_file(f"{tmp_path}/f", "json"))
    assert set(fairness["by_group"]["selection_rate"]) == {"F", "M"} == set(fairness["auc_by_gender"])
    assert set(fairness["difference"]) == {"selection_rate", "false_positive_rate", "false_negative_rate"}
    writers.write_threshold(ev.best_threshold(ev.threshold_sweep(scored)), f"{tmp_path}/t", "demo")
    assert set(json.loads(only_file(f"{tmp_path}/t", "json"))) == {"threshold", "model"}


def test_importance_csv_is_sorted(spark, rows, tmp_path):
    writers.write_importance(rows([("a", .1), ("b", .3)], "feature string, share double"), f"{tmp_path}/i")
    assert only_file(f"{tmp_path}/i", "csv").split() == ["feature,share", "b,0.3", "a,0.1"]


def test_register_view(spark, tables):
    writers.register_view(tables.stg("application"), "stg_application_view")
    assert spark.table("stg_application_view").agg(F.count("*")).first()[0] > 0
