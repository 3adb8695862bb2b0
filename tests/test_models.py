"""Properties of the fitted families, the search and storage."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import evaluate, tune
from tabwright.operators.classify import Classifier, train_all, training_table
from tabwright.operators.kernel import Landmarks
from tabwright.operators.prep import PrepConfig, preprocess
from tabwright.operators.score import Scorer
from tabwright.plans.catalog import load
from tabwright.plans.modelling import DOC, vector_split
from tabwright.sources.shared import durable, fresh_path
from tabwright.streaming.score import read_stream, score_stream


@pytest.fixture(scope="module")
def docs(spark, sf):
    return preprocess(load(spark, sf, "doc_model"), DOC, ["id"])


@pytest.fixture(scope="module")
def vectors(spark, sf):
    return tuple(durable(df) for df in vector_split(spark, sf))


def accuracy(model, test):
    return evaluate.metrics(model.score(test)).first()["accuracy"]


@pytest.mark.parametrize("weight", [None, "balanced"])
def test_logistic_gradient_is_zero(docs, weight):
    model = Classifier.fit("Logistic Regression", docs.train, "label", "id", {"class_weight": weight})
    rows = docs.train.select(vector_to_array("features").alias("x"), "label").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows])
    w = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum())) if weight else np.ones(len(y))
    beta, b = model.model.coefficients.toArray(), model.model.intercept
    error = w * (1 / (1 + np.exp(-(x @ beta + b))) - y)
    assert np.abs(x.T @ error / len(y) + beta / len(y)).max() < 1e-3
    assert abs(error.mean()) < 1e-3


def test_tree_with_large_split_limit_is_a_single_leaf(vectors):
    train, test = vectors
    stump = Classifier.fit("Decision Tree", train, "label", "id", {"min_samples_split": 10_000})
    assert stump.score(test).select("prediction").distinct().count() == 1
    full = Classifier.fit("Decision Tree", train, "label", "id")
    ours = full.score(test).select("id", "prediction")
    full.model.setLeafCol("").setPredictionCol("p")
    theirs = full.model.transform(test).select("id", "p")
    assert ours.join(theirs, "id").where("prediction <> p").count() == 0


def test_svm_learns_embeddings(vectors):
    train, test = vectors
    best = max(evaluate.metrics(Classifier.fit("Naive Bayes", train, "label", "id").score(test)).first()["accuracy"], 0.1)
    model = Classifier.fit("Support Vector Machine", train, "label", "id", {"kernel": "linear"})
    assert accuracy(model, test) >= 0.5 * best
    scored = model.score(test)
    assert scored.where("probability is not null").count() == 0
    assert "probability" not in model.probability_columns(scored).columns


def rings(spark, n, classes):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(0)
    turns = rng.uniform(0, 2 * math.pi, n)
    rows = [(i, Vectors.dense([(1.0 + 2 * (i % classes)) * math.cos(t), (1.0 + 2 * (i % classes)) * math.sin(t)]), f"ring {i % classes}") for i, t in enumerate(turns)]
    return spark.createDataFrame(rows, ["id", "features", "label"])


def test_landmarks_keep_the_kernel_as_well_as_asked(spark):
    df = rings(spark, 300, 3)
    x = np.array([r["features"].toArray() for r in df.orderBy("id").collect()])
    exact = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    sizes = []
    for error in (0.2, 0.001):
        found = Landmarks.fit(df, "id", 0.5, error, 512)
        phi = np.array([r["features"].toArray() for r in found.mapped(df).orderBy("id").collect()])
        residual = np.maximum(1 - (phi * phi).sum(axis=1), 0)
        assert found.error <= error and abs(found.error - residual.mean()) < 1e-9
        gap = np.abs(exact - phi @ phi.T)
        assert (gap <= np.sqrt(np.outer(residual, residual)) + 1e-5).all() and gap.mean() <= found.error + 1e-6
        sizes.append(len(found.points))
    assert sizes[0] < sizes[1] < 300
    assert len(Landmarks.fit(df, "id", 0.5, 0.0, 40).points) == 40                      # the limit wins, and the error says so
    copies = df.unionByName(df.withColumn("id", F.col("id") + 1000)).where("id % 1000 < 5")
    assert len(Landmarks.fit(copies, "id", 0.5, 0.0, 512).points) == 5                  # copies add nothing


@pytest.mark.parametrize("weight", [None, "balanced"])
def test_pairs_of_classes_vote_and_come_back_from_storage(spark, weight):
    df = rings(spark, 400, 3)
    model = Classifier.fit("Support Vector Machine", df, "label", "id", {"gamma": "auto", "class_weight": weight})
    assert len(model.model.models) == 3 and model.state["kernel_error"] <= 0.01
    assert accuracy(model, df) > 0.95
    path = fresh_path(spark, "rings")
    model.save(spark, path)
    again = Classifier.load(spark, path).score(df).select("id", F.col("prediction").alias("p"))
    assert model.score(df).join(again, "id").where("prediction <> p or p is null").count() == 0


def test_machines_fitted_on_the_rows_that_hold_them_predict_all(spark, monkeypatch):
    from tabwright.operators import kernel

    df = rings(spark, 900, 3)
    monkeypatch.setattr(kernel, "WORKING_ROWS", 40)
    seen = []
    monkeypatch.setattr(kernel.LinearSVC, "fit", lambda self, part, fit=kernel.LinearSVC.fit: seen.append(part.count()) or fit(self, part))
    model = Classifier.fit("Support Vector Machine", df, "label", "id", {"gamma": "auto"})
    assert min(seen) < 300 and accuracy(model, df) > 0.95


def test_tied_votes_go_to_the_first_class(spark):
    from pyspark.ml.linalg import Vectors

    df = rings(spark, 90, 3)
    model = Classifier.fit("Support Vector Machine", df, "label", "id", {"kernel": "linear"})
    at = spark.createDataFrame([(0, Vectors.dense([0.0, 0.0]))], ["id", "features"])
    df, winner = model.model.winner(at)
    got = df.select("*", winner.alias("w")).first()
    counts = [0, 0, 0]
    for i, (a, b) in enumerate([(0, 1), (0, 2), (1, 2)]):
        counts[b if got[f"_vote{i}"] else a] += 1
    assert got["w"] == counts.index(max(counts))


def test_rbf_separates_rings(spark):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        angle, radius = rng.uniform(0, 2 * math.pi), 1.0 if i % 2 else 3.0
        rows.append((i, Vectors.dense([radius * math.cos(angle), radius * math.sin(angle)]), i % 2))
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    model = Classifier.fit("Support Vector Machine", df, "label", "id")
    assert accuracy(model, df) > 0.95


def test_bayes_matches_library(docs):
    from pyspark.ml.classification import NaiveBayes

    # smoothing of 1e-9 does not move predictions of well-spread numbers
    two = preprocess(load(docs.train.sparkSession, "/root/testdata/sf0.01", "doc_model"),
                     PrepConfig(target="label", feature_columns=["n_chars", "n_words"]), ["id"])
    ours = Classifier.fit("Naive Bayes", two.train, "label", "id").score(two.test)
    theirs = NaiveBayes(modelType="gaussian", smoothing=0.0).fit(
        two.train.withColumn("label", F.col("label").cast("double"))).setPredictionCol("p").transform(
        two.test.withColumn("label", F.col("label").cast("double")))
    assert ours.join(theirs.select("id", "p"), "id").where("prediction <> p").count() == 0


def plain_bayes(train, test, smoothing=1e-9):
    """Classes and shares by the usual formulas, dense."""
    x, y, t = (np.array(v, dtype=float) for v in (train[0], train[1], test))
    eps = smoothing * x.var(axis=0).max()
    logs = []
    for c in sorted(set(y)):
        m, v = x[y == c].mean(axis=0), x[y == c].var(axis=0) + eps
        logs.append(math.log((y == c).mean()) - 0.5 * np.log(2 * np.pi * v).sum() - ((t - m) ** 2 / (2 * v)).sum(axis=1))
    logs = np.stack(logs, axis=1)
    share = np.exp(logs - logs.max(axis=1, keepdims=True))
    return logs.argmax(axis=1), share / share.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("lookup_rows", [50_000, 0])
def test_bayes_of_dense_and_sparse_rows(spark, monkeypatch, lookup_rows):
    """Stored zeros, missing entries and dense rows are the same vector; hot slots are apart from the others in a long table."""
    from pyspark.ml.linalg import Vectors

    monkeypatch.setattr("tabwright.operators.lookup.SMALL_TABLE_ROWS", lookup_rows)
    rng = np.random.default_rng(3)
    x = np.where(rng.random((300, 40)) < 0.2, rng.normal(2, 1, (300, 40)), 0.0)
    x[:, 0], x[:, 1] = rng.normal(0, 1, 300), 0.0
    y = rng.integers(0, 3, 300)
    x[y == 2, 5] += 3

    def vector(i):
        if i % 3 == 0:
            return Vectors.dense(x[i])
        kept = np.flatnonzero(x[i] if i % 3 == 1 else np.ones(40))
        return Vectors.sparse(40, kept.tolist(), x[i][kept].tolist())

    df = spark.createDataFrame([(i, vector(i), int(y[i])) for i in range(300)], ["id", "features", "label"])
    train, test = df.where("id < 200"), df.where("id >= 200").withColumn("extra", F.lit("x"))
    model = Classifier.fit("Naive Bayes", train, "label", "id")
    won, shares = plain_bayes((x[:200], y[:200]), x[200:])
    got = {r["id"]: r for r in model.score(test).collect()}
    assert len(got) == 100 and all(r["extra"] == "x" for r in got.values())
    for i in range(100):
        assert got[200 + i]["prediction"] == won[i]
        assert got[200 + i]["probability"] == pytest.approx(shares[i].tolist(), abs=1e-6)


def test_bayes_of_constants_and_absent_classes(spark):
    from pyspark.ml.linalg import Vectors

    same = spark.createDataFrame([(i, Vectors.dense([1.0, 0.0]), i % 2) for i in range(10)], ["id", "features", "label"])
    model = Classifier.fit("Naive Bayes", same, "label", "id")
    assert {tuple(r["probability"]) for r in model.score(same).collect()} == {(0.5, 0.5)}
    zeros = spark.createDataFrame([(i, Vectors.sparse(5, {}), i % 3 // 2) for i in range(9)], ["id", "features", "label"])
    only = Classifier.fit("Naive Bayes", zeros, "label", "id").score(zeros).collect()
    assert {r["prediction"] for r in only} == {0} and only[0]["probability"] == pytest.approx([2 / 3, 1 / 3])
    found = tune.search("Naive Bayes", zeros, "label", "id", cv=3, refit=False)
    assert found.best_score == pytest.approx(2 / 3)


def test_bayes_search_equals_separate_fits(docs):
    found = tune.search("Naive Bayes", docs.train, "label", "id", cv=3, refit=False)
    from tabwright.operators.split import stratified_folds

    folded = durable(stratified_folds(docs.train, ["id"], "label", 3))
    for f in range(3):
        one = Classifier.fit("Naive Bayes", folded.where(f"fold <> {f}").drop("fold"), "label", "id", {"var_smoothing": 1e-8})
        alone = accuracy(one, folded.where(f"fold = {f}").drop("fold"))
        assert found.scores.where(f"candidate = 1 and fold = {f}").first()["score"] == pytest.approx(alone)


def test_metrics_match_library(docs):
    scored = Classifier.fit("K-Nearest Neighbors", docs.train, "label", "id").score(docs.test).select(
        F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"))
    ours = evaluate.metrics(scored).first()
    for name, metric in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"),
                         ("f1_score", "f1")):
        theirs = MulticlassClassificationEvaluator(metricName=metric).evaluate(scored)
        assert ours[name] == pytest.approx(theirs, abs=1e-12)


def test_train_all_records_failures_and_skips_known(docs):
    models, errors = train_all(docs.train, "label", "id", ["Naive Bayes", "No Such Model"])
    assert set(models) == {"Naive Bayes"} and set(errors) == {"No Such Model"}
    again, _ = train_all(docs.train, "label", "id", ["Naive Bayes"], known=models)
    assert again["Naive Bayes"] is models["Naive Bayes"]
    table = training_table(docs.train.sparkSession, models, errors)
    assert {r["status"] for r in table.collect()} == {"trained", "failed"}


def test_search_refits_the_winner(docs):
    found = tune.search("Naive Bayes", docs.train, "label", "id", cv=3)
    top = found.scores.groupBy("candidate").avg("score").agg(F.max("avg(score)")).first()[0]
    assert found.best_score == pytest.approx(top)
    assert found.best.params["var_smoothing"] == found.best_params["var_smoothing"]
    assert found.summary().count() == 1


def test_candidates_share_fits_and_failures_stay_apart(docs, monkeypatch):
    fits = []
    original = Classifier.fit.__func__

    def counting(cls, name, train, target, key, params=None):
        fits.append(params)
        if params.get("max_depth") == 2:
            raise RuntimeError("this depth fails")
        return original(cls, name, train, target, key, params)

    monkeypatch.setattr(Classifier, "fit", classmethod(counting))
    space = {"max_depth": [1, 2], "min_samples_split": [2, 20, 10_000]}
    found = tune.search("Decision Tree", docs.train, "label", "id", cv=2, space=space, refit=False)
    assert len(fits) == 2 + 3 * 2  # one fit a fold for all good candidates, every bad one tried by itself
    scores = {(r["candidate"], r["fold"]): r["score"] for r in found.scores.collect()}
    assert len(scores) == 12 and {c for (c, _), v in scores.items() if v is None} == {3, 4, 5} == set(found.errors)
    assert found.best_params["max_depth"] == 1 and "this depth fails" in found.errors[3]
    with pytest.raises(ValueError, match="could be scored"):
        tune.search("Decision Tree", docs.train, "label", "id", cv=2, space={"max_depth": [2]}, refit=False)


def test_a_shared_fit_equals_its_own(docs):
    base = Classifier.fit("Decision Tree", docs.train, "label", "id", {"max_depth": 5})
    for least in (2, 15, 60):
        own = Classifier.fit("Decision Tree", docs.train, "label", "id", {"max_depth": 5, "min_samples_split": least})
        shared = base.sharing(docs.train.sparkSession, {"min_samples_split": least})
        assert shared.score(docs.test).select("id", "prediction").exceptAll(own.score(docs.test).select("id", "prediction")).count() == 0
    with pytest.raises(ValueError):
        base.sharing(docs.train.sparkSession, {"max_depth": 3})


def test_predictions_are_timed_and_failures_recorded(docs):
    from tabwright.operators.classify import score_all

    good = Classifier.fit("Naive Bayes", docs.train, "label", "id")
    bad = Classifier("K-Nearest Neighbors", {"n_neighbors": 3, "weights": "uniform", "p": 2}, good.classes, "id")
    results, seconds = score_all({"good": good, "bad": bad}, docs.test)
    table = evaluate.compare_models({n: evaluate.metrics(r) if not isinstance(r, str) else r for n, r in results.items()}, seconds)
    rows = {r["model"]: r for r in table.collect()}
    assert rows["good"]["predict_seconds"] > 0 and rows["good"]["train_seconds"] > 0 and rows["good"]["error"] is None
    assert rows["bad"]["error"] and rows["bad"]["predict_seconds"] is None


def test_random_search_takes_the_whole_small_grid():
    assert len(tune.random_candidates(tune.SPACES["Naive Bayes"], 20)) == 3
    assert len({i for i, _ in tune.random_candidates(tune.SPACES["Decision Tree"], 20)}) == 20


def test_unknown_parameters_are_refused(docs):
    with pytest.raises(ValueError):
        Classifier.fit("Naive Bayes", docs.train, "label", "id", {"depth": 3})


def test_scaled_train_has_mean_zero_and_spread_one(docs):
    v = docs.train.select(vector_to_array("features").alias("v"))
    row = v.agg(F.avg(F.col("v")[0]).alias("m"), F.stddev_pop(F.col("v")[0]).alias("s")).first()
    assert row["m"] == pytest.approx(0, abs=1e-9) and row["s"] == pytest.approx(1, abs=1e-9)


def streamed(spark, scorer, df, schema):
    folder, out, state = (fresh_path(spark, n) for n in ("incoming", "scored", "state"))
    df.repartition(3).write.options(header=True).csv(folder)
    for _ in range(2):  # nothing new the second time
        query = score_stream(scorer, read_stream(spark, folder, schema), out, state)
        query.awaitTermination(120)
        assert query.exception() is None
    batch = scorer.score(df)
    result = spark.read.parquet(out).select(*batch.columns)
    assert result.count() == df.count()
    both = result.join(batch.select("id", F.struct(*batch.columns).alias("b")), "id")
    apart = [F.abs(F.col(c) - F.col(f"b.{c}")) > 1e-9 if c.startswith("proba_") else ~F.col(c).eqNullSafe(F.col(f"b.{c}")) for c in batch.columns]
    assert both.where(F.exists(F.array(*apart), lambda v: v)).count() == 0


@pytest.mark.parametrize("name", ["Naive Bayes", "K-Nearest Neighbors", "Decision Tree"])
def test_streamed_scores_equal_batch_scores(spark, sf, docs, name):
    df = load(spark, sf, "doc_model").select("id", "n_chars", "n_words", "lang")
    scorer = Scorer(docs.preparation, Classifier.fit(name, docs.train, "label", "id"))
    streamed(spark, scorer, df, {"id": "bigint", "n_chars": "bigint", "n_words": "bigint", "lang": "string"})


def test_a_stream_with_a_long_vocabulary(spark, sf):
    df = load(spark, sf, "doc_model").selectExpr("id", "label", "n_chars", "concat('v', id % 70) as word")
    ready = preprocess(df, PrepConfig(target="label", feature_columns=["n_chars", "word"]), ["id"])
    assert ready.preparation.sizes["word"] > 64 and "word" not in ready.preparation.inline
    scorer = Scorer(ready.preparation, Classifier.fit("Naive Bayes", ready.train, "label", "id"))
    streamed(spark, scorer, df.drop("label"), {"id": "bigint", "n_chars": "bigint", "word": "string"})


def test_a_finished_search_leaves_no_stage_behind(docs):
    from tabwright.sources import shared

    spark = docs.train.sparkSession
    before = list(shared._written)
    tune.search("Decision Tree", docs.train, "label", "id", space={"max_depth": [2], "min_samples_split": [4]}, refit=False)
    tune.search("Naive Bayes", docs.train, "label", "id", refit=False)
    assert shared._written == before
    with shared.temporary(spark) as keep:
        gone, stays = shared.durable(spark.range(3), "gone"), keep(spark.range(4), "stays")
        assert gone.count() == 3
    assert stays.count() == 4 and len(shared._written) == len(before) + 1
