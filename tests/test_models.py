import itertools
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import boosting, importance, learners, stacking, tuning
from creditloom.operators.boosting import HELD, LEARNED, Model, Settings
from creditloom.operators.evaluation import auc
from creditloom.plans import catalog

SMALL = Settings(rounds=2, depth=2, seed=1)


@pytest.fixture(scope="module")
def learnable(spark):
    """A mart-like table whose label follows the features."""
    noise = F.pmod(F.hash("id"), F.lit(100)) / 200
    return spark.range(1_500).select(
        F.col("id").alias("loan_id"), F.when((F.col("id") % 10) / 10 + noise > 0.7, 1).otherwise(0).alias("target"),
        F.when(F.col("id") % 2 == 0, "F").otherwise("M").alias("gender_clean"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 10).cast("double")).alias("income_amount"),
        F.pmod(F.hash(F.lit("u"), "id"), F.lit(7)).cast("double").alias("unrelated"),
        F.element_at(F.array(*map(F.lit, ["young", "adult", "senior"])), (F.col("id") % 3 + 1).cast("int")).alias("age_group"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("o"), F.col("id") % 10)).alias("occupation_type"))


@pytest.fixture(scope="module")
def parts(learnable):
    return learnable.where("loan_id % 7 > 0"), learnable.where("loan_id % 7 = 0")


def quality(scorer, rows):
    return auc(scorer.score(rows)).first()["auc"]


def test_sensitive_and_key_columns_are_not_features(learnable):
    assert learners.feature_columns(learnable) == ["income_amount", "unrelated", "age_group", "occupation_type"]


def test_logistic(spark, parts, tmp_path):
    train, val = parts
    scorer = learners.fit_logistic(train, max_iter=50)
    assert quality(scorer, val) > 0.8
    scorer.save(str(tmp_path))
    again = learners.Scorer.load(spark, str(tmp_path))
    assert sorted(map(str, again.score(val).collect())) == sorted(map(str, scorer.score(val).collect()))


def test_score_keeps_the_other_columns(parts):
    train, val = parts
    scored = learners.fit_boosted(train, val, SMALL).score(val)
    assert scored.columns == [*val.columns, "score"]
    assert sorted(map(str, scored.drop("score").collect())) == sorted(map(str, val.collect()))


def test_categorical_trees_take_unseen_and_missing_categories(parts):
    train, val = parts
    scorer = learners.fit_categorical(train, val, SMALL)
    odd = val.withColumn("occupation_type", F.when(F.col("loan_id") % 2 == 0, "never seen"))
    assert scorer.score(odd).where("score BETWEEN 0 AND 1").count() == val.count()
    assert quality(scorer, val) > 0.7


def test_tree_scorers_are_saved_and_unknown_ordered_values_fail(spark, parts, tmp_path):
    train, val = parts
    for name, fit in (("a", learners.fit_boosted), ("b", learners.fit_categorical)):
        scorer = fit(train, None, replace(SMALL, rounds=6, depth=4))
        scorer.save(str(tmp_path / name))
        again = learners.load_scorer(spark, str(tmp_path / name))
        assert sorted(map(str, again.score(val).collect())) == sorted(map(str, scorer.score(val).collect()))
    with pytest.raises(Exception, match="unknown category in age_group: old"):
        scorer.score(val.withColumn("age_group", F.lit("old"))).collect()


def test_stack(spark, parts, tmp_path):
    train, val = parts
    bases = stacking.fit_bases(train, 2, SMALL, SMALL)
    oof = stacking.out_of_fold(train, bases).cache()
    assert oof.count() == oof.select("loan_id").distinct().count() == train.count()
    assert stacking.fold_aucs(oof).where("fold IS NULL AND auc > 0.7").count() == 2
    stack = stacking.fit_stack(bases, oof)
    assert quality(stack, val) > 0.7
    predicted = stack.predict(val)
    assert predicted.where("prediction <> int(score >= 0.5)").count() == 0
    stack.save(str(tmp_path))
    again = stacking.StackedScorer.load(spark, str(tmp_path)).score(val)
    assert sorted(map(str, again.collect())) == sorted(map(str, predicted.drop("prediction").collect()))


def test_models_grown_together_are_those_grown_alone(parts):
    train, _ = parts
    table = train.withColumns({"role0": F.when(F.col("loan_id") % 4 > 0, LEARNED).otherwise(HELD),
                               "role1": F.when(F.col("loan_id") % 3 > 0, LEARNED).otherwise(HELD)})
    quantizer = learners.tree_quantizer(train, 64)
    features, encode = learners.encoded_features(quantizer)
    blocks = boosting.coded_blocks(table, quantizer, "target", "loan_id", ["role0", "role1"])
    settings = [Settings(rounds=12, depth=3, patience=4, row_share=0.8, feature_share=0.8), Settings(rounds=7, depth=5, leaves=6, l1=0.5, l2=2.0)]

    def model(role, s, encoded=True):
        return Model(role, s, features, encode) if encoded else Model(role, s, learners.category_features(quantizer))

    choices = [(r, s, e) for r in (0, 1) for s in settings for e in (True, False)]
    together = boosting.grow(blocks, quantizer, [model(*c) for c in choices])
    for choice, found in zip(choices[::3], together[::3]):
        [alone] = boosting.grow(blocks, quantizer, [model(*choice)])
        assert [t.facts() for t in alone.trees] == [t.facts() for t in found.trees] and alone.losses == found.losses


@pytest.mark.parametrize("carry", [3, 64])
def test_growing_on_equals_growing_at_once(parts, monkeypatch, carry):
    """Also over many blocks, whose sums are shuffled, and with margins written often."""
    train, _ = parts
    monkeypatch.setattr(boosting, "CARRY", carry)
    table = train.withColumn("role0", F.when(F.col("loan_id") % 4 > 0, LEARNED).otherwise(HELD))
    quantizer = learners.tree_quantizer(train, 64)
    features, encode = learners.encoded_features(quantizer)
    settings = Settings(rounds=9, depth=3, min_rows=5, row_share=0.7, row_every=2, feature_share=0.7, positive_weight=3)
    whole = boosting.coded_blocks(table, quantizer, "target", "loan_id", ["role0"])
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    many = boosting.coded_blocks(table, quantizer, "target", "loan_id", ["role0"])
    assert whole.count() == 1 and many.count() > 4
    [at_once] = boosting.grow(whole, quantizer, [Model(0, settings, features, encode)])
    [first] = boosting.grow(many, quantizer, [Model(0, replace(settings, rounds=4), features, encode)])
    assert len(first.trees) == 4
    [on] = boosting.grow(many, quantizer, [replace(first, settings=settings)])
    assert [t.facts() for t in on.trees] == [t.facts() for t in at_once.trees] and len(on.trees) == 9


def plain_best(x, y, weight, margin, s):
    """Gain of the best split of numbers, missing ones on either side, by trying them all."""
    p = 1 / (1 + np.exp(-margin))
    g, h = weight * (p - y), weight * p * (1 - p)

    def score(rows):
        reduced = max(abs(g[rows].sum()) - s.l1, 0.0)
        return reduced ** 2 / (h[rows].sum() + s.l2)

    best = 0.0
    for column in x.T:
        for cut in np.unique(column[~np.isnan(column)]):
            for missing_left in (True, False):
                left = (column <= cut) | (np.isnan(column) & missing_left)
                if min(left.sum(), (~left).sum()) >= s.min_rows:
                    best = max(best, score(left) + score(~left) - score(np.ones(len(y), bool)))
    return best


def test_splits_are_the_best_of_all(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(120, 3)), 1)
    x[rng.random(x.shape) < 0.15] = np.nan
    y = (np.nan_to_num(x[:, 0], nan=0.7) + rng.normal(size=120) > 0.3).astype(int)
    rows = [(i, int(t), *[None if np.isnan(v) else float(v) for v in r]) for i, (t, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "loan_id long, target int, a double, b double, c double").withColumn("role0", F.lit(LEARNED))
    quantizer = boosting.fit_quantizer(df, ["a", "b", "c"], [], bins=1000)
    blocks = boosting.coded_blocks(df, quantizer, "target", "loan_id", ["role0"])
    for settings in (Settings(rounds=1, depth=1, min_rows=7), Settings(rounds=1, depth=1, l1=1.5, l2=3.0, positive_weight=3)):
        [model] = boosting.grow(blocks, quantizer, [Model(0, settings)])
        weight = np.where(y == 1, settings.positive_weight, 1.0)
        rate = weight[y == 1].sum() / weight.sum()
        assert model.base == pytest.approx(math.log(rate / (1 - rate)), abs=1e-8)
        tree, margin = model.trees[0], np.full(120, model.base)
        codes = np.stack([np.where(np.isnan(c), 0, np.searchsorted(np.array(cuts), c) + 1)
                          for c, cuts in zip(x.T, quantizer.cuts.values())], 1)
        leaf = tree.leaves(codes)
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)

        def score(some):
            return max(abs(g[some].sum()) - settings.l1, 0.0) ** 2 / (h[some].sum() + settings.l2)

        gain = sum(score(leaf == n) for n in (1, 2)) - score(leaf > 0)
        assert gain == pytest.approx(plain_best(x, y, weight, margin, settings), abs=1e-4)
        for n in (1, 2):
            total = g[leaf == n].sum()
            value = -math.copysign(max(abs(total) - settings.l1, 0), total) / (h[leaf == n].sum() + settings.l2) * settings.rate
            assert tree.value[n] == pytest.approx(value, abs=1e-5) and tree.cover[n] == (leaf == n).sum()


def test_large_penalties_and_gains_stop_splits(parts):
    train, _ = parts
    assert learners.fit_boosted(train, None, replace(SMALL, l1=1e6)).model.trees[0].feature == [-1]
    assert learners.fit_boosted(train, None, replace(SMALL, min_gain=1e6)).model.trees[0].feature == [-1]
    budget = learners.fit_boosted(train, None, Settings(rounds=1, depth=6, leaves=5)).model.trees[0]
    assert sum(f < 0 for f in budget.feature) == 5


def test_search_prunes_below_the_median_and_changes_no_kept_trial(parts):
    train, _ = parts
    trials = tuning.draw_trials(6)
    assert trials == tuning.draw_trials(6) and len(tuning.draw_trials()) == 25
    shared = Settings(rounds=4, depth=3, patience=2, seed=1)
    whole = {r["trial"]: r for r in tuning.search(train, trials, 4, shared, startup=len(trials)).collect()}
    assert all(r["folds"] == 4 and not r["pruned"] for r in whole.values())
    ranked = tuning.search(train, trials, 4, shared, startup=1, warmup=1)
    rows = ranked.collect()
    kept = [r for r in rows if not r["pruned"]]
    assert 0 < len(kept) < 6 and rows[0]["mean_auc"] == max(r["mean_auc"] for r in kept) and rows[-1]["pruned"]
    for r in kept:
        assert r == whole[r["trial"]]
    assert all(2 <= r["folds"] < 4 and r["trial"] >= 1 for r in rows if r["pruned"])
    assert 0.5 < rows[0]["mean_auc"] <= 1
    assert tuning.fit_best(train, ranked, shared).trees() == max(1, int(rows[0]["mean_trees"] * 1.1))


def test_permutation_finds_the_used_feature(parts):
    train, val = parts
    scorer = learners.fit_logistic(train.select("loan_id", "target", "income_amount", "unrelated", "age_group"), 50)
    ranked = importance.permutation_importance(
        val.select("loan_id", "target", "income_amount", "unrelated", "age_group"), scorer.score,
        ["income_amount", "unrelated"]).collect()
    assert ranked[0]["feature"] == "income_amount" and ranked[0]["auc_drop"] > 0.1 > abs(ranked[1]["auc_drop"])


def plain_contributions(tree, row, n_features):
    """Shapley values by all subsets of the features that the tree uses."""
    used = sorted({f for f in tree.feature if f >= 0})

    def value(node, known):
        feature = tree.feature[node]
        if feature < 0:
            return tree.value[node]
        sides = (tree.left[node], tree.right[node])
        if feature in known:
            left = bool(tree.goes_left(np.array([node]), row[[feature]])[0])
            return value(sides[0] if left else sides[1], known)
        return sum(tree.cover[c] * value(c, known) for c in sides) / tree.cover[node]

    out = np.zeros(n_features)
    for f in used:
        others = [g for g in used if g != f]
        for size in range(len(others) + 1):
            for known in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(len(others) - size) / math.factorial(len(used))
                out[f] += weight * (value(0, {*known, f}) - value(0, set(known)))
    return out


def test_contributions_equal_all_subsets_and_add_up(parts):
    train, val = parts
    for scorer in (learners.fit_boosted(train, None, Settings(rounds=4, depth=3, min_rows=2, feature_share=0.9)),
                   learners.fit_categorical(train, None, Settings(rounds=4, depth=4))):
        model, names = scorer.model, scorer.quantizer.features
        [batch] = val.select(*dict.fromkeys(names)).limit(60).toArrow().combine_chunks().to_batches()
        codes = scorer.quantizer.codes(batch)
        found = importance.contributions(model, codes)
        assert np.abs(found.sum(1) + importance.expected_margin(model) - model.margins(codes)).max() < 1e-9
        for row, values in zip(codes[:12], found):
            assert np.abs(sum(plain_contributions(t, row, len(names)) for t in model.trees) - values).max() < 1e-9
        ranked = importance.tree_importance(val, scorer).collect()
        [batch] = val.select(*dict.fromkeys(names)).toArrow().combine_chunks().to_batches()
        means = np.abs(importance.contributions(model, scorer.quantizer.codes(batch))).mean(0)
        assert sorted(r["feature"] for r in ranked) == sorted({names[i] for i in model.features})
        assert all(r["mean_abs_contribution"] == pytest.approx(means[max(i for i in model.features if names[i] == r["feature"])]) for r in ranked)


def test_sample_is_fixed_by_the_key(learnable):
    one = importance.hash_sample(learnable, 100)
    other = importance.hash_sample(learnable.orderBy(F.desc("loan_id")).repartition(7), 100)
    assert {r["loan_id"] for r in one.collect()} == {r["loan_id"] for r in other.collect()} and one.count() == 100


def test_boosting_waits_for_gain(parts):
    train, val = parts
    settings = Settings(rounds=40, depth=3, rate=0.1, min_gain=0.5, patience=15)
    many = learners.fit_boosted(train, val, settings)
    one = learners.fit_boosted(train, val, replace(settings, rounds=1))
    assert many.trees() > 10 and one.trees() == 1
    assert quality(many, val) > quality(one, val)
    assert learners.fit_boosted(train, None, replace(settings, rounds=5)).trees() == 5


def test_registered_stack_and_search_run_the_published_settings(monkeypatch):
    seen = []
    monkeypatch.setattr(stacking, "stratified_folds", lambda train, k: k)
    monkeypatch.setattr(stacking, "fold_roles", lambda folded, k: None)
    monkeypatch.setattr(learners, "tree_quantizer", lambda train, bins: boosting.Quantizer({"x": []}, {}))
    monkeypatch.setattr(boosting, "coded_blocks", lambda *a: None)
    monkeypatch.setattr(boosting, "grow", lambda blocks, quantizer, models: seen.extend(m.settings for m in models) or models)
    stacking.fit_bases(None)
    assert seen == [learners.STACKED_BOOSTED] * 6 + [learners.STACKED_CATEGORICAL] * 6
    monkeypatch.setattr(tuning, "cross_validated", lambda train, trials, k, *a: seen.append((trials, k)) or (_ for _ in ()).throw(StopIteration))
    table = type("Table", (), {"part_of_mart": lambda self, split: split})()
    with pytest.raises(StopIteration):
        catalog._tune_cv(table)
    assert seen[-1] == ([replace(tuning.SHARED, **t) for t in tuning.draw_trials()], tuning.FOLDS)


def test_models_on_one_block_take_as_many_jobs_for_any_number_of_rounds(spark, parts):
    """A task that holds all rows of a model grows all its trees, so models wait neither for jobs nor for each other."""
    train, _ = parts
    table = train.withColumn("role0", F.when(F.col("loan_id") % 4 > 0, LEARNED).otherwise(HELD))
    quantizer = learners.tree_quantizer(train, 64)
    features, encode = learners.encoded_features(quantizer)
    blocks = boosting.coded_blocks(table, quantizer, "target", "loan_id", ["role0"])
    jobs = []
    for rounds in (2, 12):
        spark.sparkContext.setJobGroup(f"rounds {rounds}", "boosting")
        models = boosting.grow(blocks, quantizer, [Model(0, Settings(rounds=rounds, depth=3, seed=s), features, encode) for s in (1, 2)])
        assert [len(m.trees) for m in models] == [rounds, rounds]
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds {rounds}")))
    assert jobs[0] == jobs[1]


@pytest.mark.parametrize("heavy", [1.0, 1e12])
def test_sums_of_a_node_are_those_of_its_rows(heavy):
    """Also where Hessians leave no room for the number of rows, and over several chunks."""
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 7, (9000, 3)).astype(np.uint16)
    g, h = rng.integers(-99, 99, 9000).astype(float), np.rint(rng.integers(0, 99, 9000) * heavy)
    rows = np.flatnonzero(rng.random(9000) < 0.6)
    found = boosting._node_sums(codes, rows, g, h, np.array([0, 7, 14]), 21)
    for f, code in itertools.product(range(3), range(7)):
        here = rows[codes[rows, f] == code]
        assert found[:, 7 * f + code].tolist() == [g[here].sum(), h[here].sum(), len(here)]
    assert not boosting._node_sums(codes, rows[:0], g, h, np.array([0, 7, 14]), 21).any()


def test_models_on_many_blocks_are_tasks_of_their_own_and_equal_those_of_passes(spark, parts, monkeypatch):
    """Up to a bound of rows, however many blocks hold them, the number of jobs does not follow the rounds."""
    train, _ = parts
    table = train.withColumn("role0", F.when(F.col("loan_id") % 4 > 0, LEARNED).otherwise(HELD))
    quantizer = learners.tree_quantizer(train, 64)
    features, encode = learners.encoded_features(quantizer)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    blocks = boosting.coded_blocks(table, quantizer, "target", "loan_id", ["role0"])
    assert blocks.count() > 4
    settings = Settings(rounds=5, depth=3, row_share=0.8, feature_share=0.8, patience=3)

    def grown(name, rounds):
        spark.sparkContext.setJobGroup(name, "boosting")
        models = boosting.grow(blocks, quantizer, [Model(0, replace(settings, rounds=rounds, seed=s), features, encode) for s in (1, 2)])
        return [([t.facts() for t in m.trees], m.losses) for m in models], len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    found, jobs = grown("many blocks", 5)
    assert grown("many blocks, one round", 1)[1] == jobs
    monkeypatch.setattr(boosting, "WHOLE_ROWS", 0)
    passes, more = grown("passes", 5)
    assert passes == found and more > jobs


@pytest.mark.parametrize("bins", [64, 400])
def test_models_that_fill_the_cores_are_tasks_beyond_the_bound_for_a_few(spark, parts, monkeypatch, bins):
    """Whether a code takes one byte or two, they equal those of passes; the job that reads all blocks keeps its session's batches."""
    train = parts[0].withColumn("unrelated", F.col("loan_id") * F.lit(1.5))
    table = train.withColumn("role0", F.when(F.col("loan_id") % 4 > 0, LEARNED).otherwise(HELD))
    quantizer = learners.tree_quantizer(train, bins)
    assert (quantizer.sizes.max() > 256) == (bins > 256)
    features, encode = learners.encoded_features(quantizer)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 200)
    monkeypatch.setattr(boosting, "WHOLE_ROWS", 300)
    blocks = boosting.coded_blocks(table, quantizer, "target", "loan_id", ["role0"])
    seeds = range(max(2, math.ceil(spark.sparkContext.defaultParallelism / 2)))

    def grown(name, rounds):
        spark.sparkContext.setJobGroup(name, "boosting")
        settings = Settings(rounds=rounds, depth=3, patience=3)
        models = boosting.grow(blocks, quantizer, [Model(0, replace(settings, seed=s), features, encode) for s in seeds])
        return [([t.facts() for t in m.trees], m.losses) for m in models], len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    before = spark.conf.get(boosting.BATCH_ROWS, None)
    found, jobs = grown(f"filled {bins}", 3)
    assert grown(f"filled {bins}, one round", 1)[1] == jobs and spark.conf.get(boosting.BATCH_ROWS, None) == before
    monkeypatch.setattr(boosting, "SHARED_ROWS", 0)
    passes, more = grown(f"filled {bins}, passes", 3)
    assert passes == found and more > jobs


@pytest.mark.parametrize("heavy", [1.0, 1e12])
def test_sums_by_column_are_those_by_row(heavy):
    """Over joined columns, some of which are not chosen."""
    rng = np.random.default_rng(6)
    sizes, n = np.array([3, 255, 2, 7, 40, 5]), 40_000
    codes = np.asfortranarray((rng.random((n, 6)) * sizes).astype(np.uint16))
    g, h = rng.integers(-99, 99, n).astype(float), np.rint(rng.integers(0, 99, n) * heavy)
    rows, features = np.flatnonzero(rng.random(n) < 0.9), np.array([0, 1, 3, 4])
    offsets, width = boosting._offsets(sizes[features]), int(sizes[features].sum())
    joined = boosting._joined_columns(codes, sizes, np.arange(5))
    assert len(joined) < 5
    found = boosting._wide_sums(joined, rows, g, h, features, offsets, width)
    assert np.array_equal(found, boosting._node_sums(codes[:, features], rows, g, h, offsets, width))


def test_fit_report_scores_rows_once(parts):
    train, val = parts
    table = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    calls = []

    class Once:
        def score(self, df):
            calls.append(df)
            return df.withColumn("score", F.expr("loan_id % 101 / 101e0"))

    tables = type("Table", (), {"split_mart": table, "part_of_mart": lambda self, s: table.where(F.col("split") == s).drop("split")})()
    found = {r["split"]: (r["n_rows"], r["auc"]) for r in catalog._fit_report(tables, Once()).collect()}
    for name, part in (("train", train), ("val", val)):
        expected = auc(part.withColumn("score", F.expr("loan_id % 101 / 101e0"))).first()
        assert found[name] == (expected["n_rows"], expected["auc"])
    assert len(calls) == 1
