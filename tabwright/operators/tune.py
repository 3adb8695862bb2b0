"""Grid and random search with stratified cross-validation."""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabwright.functions.exprs import col
from tabwright.operators.bayes import GaussianBayes
from tabwright.operators.classify import DEFAULTS, Classifier, fit_key, indexed
from tabwright.operators.evaluate import metrics
from tabwright.operators.neighbors import neighbours, vote_grid
from tabwright.operators.split import SEED, class_sizes, stratified_folds
from tabwright.sources.local import small_table
from tabwright.sources.shared import durable, temporary

# The search spaces.
SPACES = {
    "Logistic Regression": {"C": [0.1, 1.0, 10.0], "solver": ["lbfgs"], "class_weight": [None, "balanced"]},
    "K-Nearest Neighbors": {"n_neighbors": [3, 5, 7, 9, 11], "weights": ["uniform", "distance"], "p": [1, 2]},
    "Support Vector Machine": {"C": [0.1, 1.0, 10.0], "kernel": ["rbf", "linear"], "gamma": ["scale", "auto"],
                               "class_weight": [None, "balanced"]},
    "Decision Tree": {"max_depth": [None, 3, 5, 10], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
                      "criterion": ["gini", "entropy"]},
    "Naive Bayes": {"var_smoothing": [1e-9, 1e-8, 1e-7]},
}
SCORERS = {"accuracy": "accuracy", "f1_weighted": "f1_score", "precision_weighted": "precision",
           "recall_weighted": "recall"}


def grid(space: dict[str, list]) -> list[dict]:
    """All candidates; names in alphabetical order, the last one varying fastest."""
    names = sorted(space)
    return [dict(zip(names, values)) for values in product(*[space[n] for n in names])]


def random_candidates(space: dict[str, list], n_iter: int = 20, seed: int = SEED) -> list[tuple[int, dict]]:
    """n_iter different candidates of the grid in hash order; the whole grid if it is smaller."""
    def place(i: int) -> tuple:
        return hashlib.md5(f"{seed}|{i}".encode()).hexdigest()[:8], i

    everything = grid(space)
    return [(i, everything[i]) for i in sorted(range(len(everything)), key=place)[:n_iter]]


def text_of(params: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(params.items()))


@dataclass
class Search:
    """Fold scores of every candidate, and the winner refitted on all rows."""

    name: str
    method: str
    scoring: str
    folds: int
    candidates: list[tuple[int, dict]]
    scores: DataFrame            # candidate, params, fold, score
    best_params: dict
    best_score: float
    best: Classifier | None
    elapsed_seconds: float
    errors: dict[int, str] = field(default_factory=dict)  # by candidate: why it has folds without a score

    def summary(self) -> DataFrame:
        return small_table(
            self.scores.sparkSession,
            [(self.name, self.method, self.scoring, self.folds, text_of(self.best_params), self.best_score,
              self.elapsed_seconds)],
            "model string, method string, scoring string, cv_folds int, best_params string, best_score double, "
            "elapsed_seconds double")


def mean_scores(scores: DataFrame) -> DataFrame:
    """Per candidate; NULL if it failed on any fold."""
    whole = F.count("score") == F.count("*")
    return scores.groupBy("candidate", "params").agg(F.when(whole, F.avg("score")).alias("mean_score"))


def best_candidate(scores: DataFrame) -> DataFrame:
    """The candidate with the best mean score; the earlier one on ties. One row per candidate comes in."""
    order = F.struct(F.round("mean_score", 12), -F.col("candidate"))
    return mean_scores(scores).agg(
        F.max_by("candidate", order).alias("candidate"), F.max_by("params", order).alias("params"),
        F.max("mean_score").alias("best_score"))


def search(name: str, train: DataFrame, target: str, key: str, method: str = "grid", scoring: str = "accuracy",
           cv: int = 5, n_iter: int = 20, seed: int = SEED, space: dict | None = None, refit: bool = True,
           parallelism: int = 4) -> Search:
    """Cross-validate candidates on prepared training rows; folds do not refit the preparation.

    Candidates that differ only in what does not change the fit share it. A candidate that fails has no score, and its error is kept.
    """
    start = time.perf_counter()
    train = train.where(col(target).isNotNull())
    if scoring not in SCORERS:
        raise ValueError(f"scoring must be one of {', '.join(SCORERS)}")
    space = space or SPACES[name]
    candidates = list(enumerate(grid(space))) if method == "grid" else random_candidates(space, n_iter, seed)
    classes = list(class_sizes(train, target))
    measure, errors = SCORERS[scoring], {}
    with temporary(train.sparkSession):  # only the scores come out
        folded = durable(indexed(stratified_folds(train, [key], target, cv, seed), target, classes), "folds")
        if name == "Naive Bayes":
            predicted = _bayes_predictions(folded, candidates, len(classes), cv)
        elif name == "K-Nearest Neighbors":
            predicted = _neighbour_predictions(folded, candidates, len(classes), key)
        else:
            predicted = None
        if predicted is not None:
            rows = [(r["candidate"], r["fold"], r[measure]) for r in
                    metrics(predicted, "label", "winner", ["candidate", "fold"]).collect()]  # candidates x folds
        else:
            rows, errors = _fitted_scores(name, folded, target, key, candidates, cv, measure, parallelism)
    texts = {i: text_of(p) for i, p in candidates}
    scores = small_table(train.sparkSession, [(i, texts[i], f, s) for i, f, s in rows],
                         "candidate int, params string, fold int, score double")
    top = best_candidate(scores).first()
    if top["best_score"] is None:
        raise ValueError(f"no candidate of {name} could be scored: {next(iter(errors.values()), 'there are no rows')}")
    params = dict(candidates)[top["candidate"]]
    best = Classifier.fit(name, train, target, key, params) if refit else None
    return Search(name, method, scoring, cv, candidates, scores, params, top["best_score"], best,
                  time.perf_counter() - start, errors)


def search_families(names: list[str], train: DataFrame, target: str, key: str, **how) -> tuple[dict[str, Search], dict[str, str]]:
    """Search the chosen families one after the other: (searches, errors). A failure stops only its own family.

    `space` in `how` has a space per family.
    """
    spaces = how.pop("space", None) or {}
    found, errors = {}, {}
    for name in names:
        try:
            if name not in SPACES:
                raise KeyError(f"{name} is not one of {', '.join(SPACES)}")
            found[name] = search(name, train, target, key, space=spaces.get(name), **how)
        except Exception as e:  # recorded per family, as the caller shows it beside the others
            errors[name] = e.args[0] if isinstance(e, KeyError) else str(e)
    return found, errors


def search_table(spark: SparkSession, found: dict[str, Search], errors: dict[str, str]) -> DataFrame:
    """(model, status, best_params, best_score, candidates, failed_candidates, error), one row per family."""
    rows = [(n, "searched", text_of(s.best_params), s.best_score, len(s.candidates), len(s.errors), None) for n, s in found.items()]
    rows += [(n, "failed", None, None, None, None, e) for n, e in errors.items()]
    return small_table(spark, rows, "model string, status string, best_params string, best_score double, candidates int, failed_candidates int, error string")


def adopted(models: dict[str, Classifier], found: dict[str, Search]) -> dict[str, Classifier]:
    """The models with every refitted winner in the place of its family's."""
    return {**models, **{n: s.best for n, s in found.items() if s.best is not None}}


def _bayes_predictions(folded: DataFrame, candidates: list, n_classes: int, cv: int) -> DataFrame:
    """All smoothings and folds from one moments pass and one scoring pass.

    A fold's model is the merged moments of the other folds.
    """
    models = GaussianBayes.fit(folded, n_classes, "fold", cv)
    smoothings = [p["var_smoothing"] for _, p in candidates]
    scored = models.score(folded.select("fold", "label", "features"), smoothings, models.baselines(smoothings), F.col("fold"))
    places = F.array(*[F.lit(i) for i, _ in candidates])
    rows = scored.select("fold", F.col("label").cast("int").alias("label"), F.posexplode("outcome").alias("_at", "_v"))
    return rows.select("fold", "label", F.get(places, F.col("_at")).alias("candidate"), "_v.winner")


def _neighbour_predictions(folded: DataFrame, candidates: list, n_classes: int, key: str) -> DataFrame:
    """One neighbour pass per distance answers every k and weighting; a row's own fold is no neighbour."""
    out = None
    for p in sorted({c["p"] for _, c in candidates}):
        own = [(i, c) for i, c in candidates if c["p"] == p]
        most = max(c["n_neighbors"] for _, c in own)
        near = neighbours(folded, folded, key, most, p, group="fold")
        won = vote_grid(near, [(c["n_neighbors"], c["weights"]) for _, c in own], n_classes)
        places = F.array(*[F.lit(i) for i, _ in own])
        rows = folded.join(won, col(key) == F.col("query")).select(
            "fold", F.col("label").cast("int").alias("label"), F.get(places, F.col("setting")).alias("candidate"),
            "winner")
        out = rows if out is None else out.unionAll(rows)
    return out


def _fitted_scores(name: str, folded: DataFrame, target: str, key: str, candidates: list, cv: int, measure: str,
                   parallelism: int) -> tuple[list[tuple], dict[int, str]]:
    """Scores (candidate, fold, score) and errors by candidate. One fit for all candidates that share it; a few fits run side by side, each as
    ordinary Spark jobs."""
    plain = folded.drop("label") if target != "label" else folded
    shared: dict[tuple, list] = {}
    for i, params in candidates:
        shared.setdefault(fit_key(name, {**DEFAULTS[name], **params}), []).append((i, params))

    def run(task):
        members, fold = task
        out, fitted = [], None
        for i, params in members:
            try:
                if fitted is None:
                    fitted = Classifier.fit(name, plain.where(F.col("fold") != fold), target, key, params)
                scored = fitted.sharing(plain.sparkSession, params).score(plain.where(F.col("fold") == fold))
                out.append((i, fold, metrics(scored, target, "prediction").first()[measure], None))
            except Exception as e:  # this candidate has no score on this fold
                out.append((i, fold, None, str(e)))
        return out

    tasks = [(members, f) for members in shared.values() for f in range(cv)]
    with ThreadPool(parallelism) as pool:
        rows = [r for part in pool.map(run, tasks, chunksize=1) for r in part]
    return [r[:3] for r in rows], {r[0]: r[3] for r in reversed(rows) if r[3] is not None}
