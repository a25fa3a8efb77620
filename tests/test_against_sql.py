"""Every registered query with a statement gives the rows DuckDB gives."""

import pytest
from compare import FOLDER, differences

from creditloom.plans.catalog import registered
from oracle.queries import statements

QUERIES, STATEMENTS = registered(), statements()
MODEL_QUERIES = {"lr_baseline", "gbt_model", "tree_cat_model", "stacking_oof", "stacking_fold_auc", "stacking_meta",
                 "stacking_score", "tune_cv", "importance_permutation", "importance_tree", "stack_report"}


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_statement(name, spark, oracle):
    assert differences(QUERIES[name], STATEMENTS[name], spark, oracle, FOLDER) is None


def test_only_model_queries_have_no_statement():
    assert set(QUERIES) - set(STATEMENTS) == MODEL_QUERIES
    assert not set(STATEMENTS) - set(QUERIES)


@pytest.mark.parametrize("name", ["agg_bureau", "inst_windowed", "mart_features", "auc_by_group", "split_assign"])
def test_result_does_not_depend_on_partitioning(name, spark, oracle):
    """Many small scan partitions and shuffled joins instead of one partition and broadcasts.

    A mean of doubles depends on the order of addition in its last bits, so one
    that is rounded to four digits may step by one there.
    """
    changed = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0",
               "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "5"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        assert differences(QUERIES[name], STATEMENTS[name], spark, oracle, FOLDER, tolerance=1.01e-4) is None
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
