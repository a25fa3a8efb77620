import pytest
from pyspark.sql import functions as F

from creditloom.operators import encoders, profiling, quality


def test_checks_ignore_null(rows):
    df = rows([(1, "0"), (1, "2"), (None, None), (None, "2")], "k int, v string")
    checks = [quality.Check("t", "k", "unique"), quality.Check("t", "v", "accepted_values", ("0", "1")),
              quality.Check("t", "k", "not_null"), quality.Check("t", "v", "not_null")]
    got = {(r["column_name"], r["check_kind"]): r["failures"] for r in quality.run_checks({"t": df}, checks).collect()}
    assert got == {("k", "unique"): 1, ("v", "accepted_values"): 1, ("k", "not_null"): 2, ("v", "not_null"): 1}


def test_declared_checks():
    kinds = [c.kind for c in quality.DECLARED]
    assert (len(kinds), kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (47, 34, 7, 6)


@pytest.mark.parametrize("days, bucket", [(-9125, "<25"), (-9129, "25-35"), (-36500, ">55"), (-36501, None), (0, None)])
def test_age_buckets_are_right_closed(rows, days, bucket):
    assert rows([(days,)], "days_birth int").select(profiling.age_bucket("days_birth")).first()[0] == bucket


def test_correlation_with_gaps_and_constants(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("a"), F.when(F.col("id") < 40, F.col("id") % 7).cast("double").alias("b"),
        F.lit(3.0).alias("c"), (F.col("id") % 2).alias("y"))
    got = {r["column_name"]: r["abs_corr"] for r in profiling.correlations_with(df, "y").collect()}
    both = df.where("b IS NOT NULL").toPandas()
    assert got["c"] is None and got["b"] == pytest.approx(abs(both["b"].corr(both["y"])), abs=1e-6)
    cells = {(r["a"], r["b"]): r["corr"] for r in profiling.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(cells) == 9 and cells["a", "b"] == cells["b", "a"] and cells["a", "a"] == 1.0 and cells["c", "c"] is None


def test_histogram_covers_all_rows(spark):
    df = spark.range(1_000).select((F.col("id") % 2).alias("y"), (F.col("id") * 37 % 1000 / 1e3).alias("x"))
    got = profiling.density_histogram(df, "x", "y", bins=10).collect()
    assert sum(r["n_rows"] for r in got) == 1_000 and {r["bin"] for r in got} == set(range(10))
    constant = profiling.density_histogram(df.withColumn("x", F.lit(2.0)), "x", "y", bins=10).collect()
    assert sorted((r["bin"], r["n_rows"]) for r in constant) == sorted([(b, 500 * (b == 5)) for b in range(10)] * 2)


def test_ordinal_encoding_fails_on_unknown_values(rows):
    df = rows([("young",), ("senior",)], "age_group string")
    assert [r[0] for r in encoders.ordinal_encode(df).collect()] == [0.0, 2.0]
    with pytest.raises(Exception, match="unknown category in age_group: old"):
        encoders.ordinal_encode(rows([("old",)], "age_group string")).collect()


def test_unseen_categories_get_the_prior(rows):
    fit = rows([("a", 1), ("a", 0), ("b", 1), ("b", 1)], "k string, target int")
    encoder = encoders.fit_target_encoder(fit, cols=["k"])
    got = {r["k0"]: r["k"] for r in encoder.transform(
        rows([("a", "a"), ("z", "z"), (None, None)], "k string, k0 string")).collect()}
    assert got["z"] == got[None] == 0.75 and got["a"] < 0.75


def test_imputer_without_values(rows):
    df = rows([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    filled = encoders.impute_median(df, encoders.fit_medians(df, ["a", "b"])).collect()
    assert [tuple(r) for r in filled] == [(1.0, 0.0), (3.0, 0.0), (2.0, 0.0)]


def test_dictionary_search(rows):
    df = rows([("t1", "FLAG_A"), ("t1", "days"), ("t2", "flag_b")], "Table string, Row string")
    assert profiling.dictionary_search(df, contains={"Row": "flag"}).count() == 2
    assert profiling.dictionary_search(df, equals={"Table": "t1"}, one_of={"Row": ["days", "flag_b"]}).count() == 1
