"""Five classifier families behind one interface: fit, score, save, load.

Input has a row key, a `features` vector and a target; output adds `prediction` and, where the family has them,
class probabilities.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field, replace

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabwright.functions.exprs import col, row_hash
from tabwright.operators.bayes import GaussianBayes
from tabwright.operators.kernel import Landmarks, Pairs
from tabwright.operators.neighbors import neighbours, votes
from tabwright.operators.split import SEED, class_sizes
from tabwright.sources.local import small_table
from tabwright.sources.shared import durable, fresh_path

MAX_DEPTH = 30  # deepest tree the library grows; stands for "unlimited"

# Model names and their default parameters.
DEFAULTS = {
    "Logistic Regression": {"C": 1.0, "class_weight": None, "max_iter": 1000},
    "K-Nearest Neighbors": {"n_neighbors": 5, "weights": "uniform", "p": 2},
    "Support Vector Machine": {"C": 1.0, "kernel": "rbf", "gamma": "scale", "class_weight": None,
                               "max_iter": 100, "kernel_error": 0.01, "max_landmarks": 512},
    "Decision Tree": {"max_depth": None, "min_samples_split": 2, "min_samples_leaf": 1, "criterion": "gini",
                      "max_bins": 128},
    "Naive Bayes": {"var_smoothing": 1e-9},
}


def indexed(df: DataFrame, target: str, classes: list) -> DataFrame:
    """The target as a class index in `label`."""
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), col(target)) - 1
    return df.withColumn("label", place.cast("double"))


def class_weights(sizes: dict, balanced: str | None) -> Column:
    """Balanced weights n / (k * n_c) by class index, or 1."""
    if not balanced:
        return F.lit(1.0)
    n, k = sum(sizes.values()), len(sizes)
    return F.get(F.array(*[F.lit(n / (k * m)) for m in sizes.values()]), F.col("label").cast("int"))


def fit_key(name: str, params: dict) -> tuple:
    """What of the parameters changes the fit. A tree is grown in full and cut back to min_samples_split; a line has no kernel."""
    unused = {"min_samples_split"} if name == "Decision Tree" else set()
    if name == "Support Vector Machine" and params.get("kernel") == "linear":
        unused = {"gamma", "kernel_error", "max_landmarks"}
    return tuple(sorted((k, str(v)) for k, v in params.items() if k not in unused and k != "solver"))


@dataclass
class Classifier:
    """A fitted classifier of one family."""

    name: str
    params: dict
    classes: list
    key: str                     # row key column
    state: dict = field(default_factory=dict)
    model: object = None         # library model, or machines of all pairs of classes
    points: DataFrame | None = None  # training rows of the neighbour family, slots of naive Bayes
    landmarks: Landmarks | None = None  # of the machines with a kernel
    train_seconds: float = 0.0

    @classmethod
    def fit(cls, name: str, train: DataFrame, target: str, key: str, params: dict | None = None) -> Classifier:
        if name not in DEFAULTS:
            raise KeyError(f"Unsupported model: {name}")
        unknown = set(params or {}) - set(DEFAULTS[name]) - {"solver"}
        if unknown:
            raise ValueError(f"{name} has no parameters {sorted(unknown)}")
        start = time.perf_counter()
        sizes = class_sizes(train, target)
        self = cls(name, {**DEFAULTS[name], **(params or {})}, list(sizes), key)
        if len(sizes) < 2 and name in ("Logistic Regression", "Support Vector Machine"):
            raise ValueError("at least two classes are needed")
        rows = indexed(train.where(col(target).isNotNull()), target, self.classes).select(col(key), "features", "label")
        getattr(self, FAMILIES[name])(rows, sizes)
        self.train_seconds = time.perf_counter() - start
        return self

    # --- families

    def _fit_logistic(self, rows: DataFrame, sizes: dict) -> None:
        p, n = self.params, sum(sizes.values())
        weighted = rows.withColumn("weight", class_weights(sizes, p["class_weight"]))
        self.model = LogisticRegression(
            regParam=1.0 / (p["C"] * n), elasticNetParam=0.0, standardization=False, maxIter=p["max_iter"], tol=1e-8,
            weightCol="weight").fit(weighted)

    def _fit_neighbours(self, rows: DataFrame, sizes: dict) -> None:
        self.points = durable(rows, "points")

    def _fit_svm(self, rows: DataFrame, sizes: dict) -> None:
        p, n = self.params, sum(sizes.values())
        if p["kernel"] == "rbf":
            facts = rows.agg(Summarizer.metrics("mean", "variance").summary(F.col("features")).alias("s")).first()["s"]
            mean, var = facts["mean"].toArray(), facts["variance"].toArray() * (n - 1) / n
            total = float((var + mean ** 2).mean() - mean.mean() ** 2)
            gamma = (1.0 / (len(mean) * total) if total else 1.0) if p["gamma"] == "scale" else 1.0 / len(mean)
            self.landmarks = Landmarks.fit(rows, self.key, gamma, p["kernel_error"], p["max_landmarks"])
            self.state["kernel_error"] = self.landmarks.error
            rows = self.landmarks.mapped(rows)
        weighted = rows.withColumn("weight", class_weights(sizes, p["class_weight"]))
        weights = [n / len(sizes)] * len(sizes) if p["class_weight"] else list(sizes.values())
        # a folder per class, so that each pair of classes reads its own rows
        draw = (F.conv(row_hash([self.key], SEED + 1), 16, 10).cast("double") + 0.5) / float(1 << 32)
        mapped = durable(weighted.select("features", "weight", "label", draw.alias("draw")), "mapped", by=["label"])
        self.model = Pairs.fit(mapped, weights, list(sizes.values()), p["C"], p["max_iter"])

    def _fit_tree(self, rows: DataFrame, sizes: dict) -> None:
        p = self.params
        self.model = DecisionTreeClassifier(
            maxDepth=min(p["max_depth"] or MAX_DEPTH, MAX_DEPTH), impurity=p["criterion"], maxBins=p["max_bins"], seed=SEED,
            minInstancesPerNode=p["min_samples_leaf"]).fit(rows)
        # every node that splits has two rows, so up to that limit the library's own leaves are the result
        self.state["leaves"] = leaf_counts(rows.sparkSession, self.model, p["min_samples_split"]) if p["min_samples_split"] > 2 else None

    def sharing(self, spark: SparkSession, params: dict) -> Classifier:
        """This fit under other parameters that do not change it: the same `fit_key`."""
        if fit_key(self.name, {**self.params, **params}) != fit_key(self.name, self.params):
            raise ValueError(f"{self.name} has to be fitted anew for {params}")
        out = replace(self, params={**self.params, **params}, state=dict(self.state))
        if self.name == "Decision Tree":
            least = out.params["min_samples_split"]
            out.state["leaves"] = leaf_counts(spark, self.model, least) if least > 2 else None
        return out

    def _fit_bayes(self, rows: DataFrame, sizes: dict) -> None:
        fitted = GaussianBayes.fit(rows, len(self.classes), known=list(sizes.values()))
        self.points = fitted.table
        self.state = {k: getattr(fitted, k) for k in ("sizes", "width", "slots", "entries", "largest")}
        self.state["baselines"] = fitted.baselines([self.params["var_smoothing"]])

    # --- scoring

    def score(self, df: DataFrame) -> DataFrame:
        """`df` without `features`, with `prediction` and `probability` (NULL where the family has none)."""
        keep = [c for c in df.columns if c != "features"]
        if self.name == "K-Nearest Neighbors":
            k = self.params["n_neighbors"]
            near = neighbours(self.points, df, self.key, k, self.params["p"])
            won = votes(near, k, len(self.classes), self.params["weights"])
            out = df.select(*[col(c) for c in keep]).join(won.withColumnRenamed("query", self.key), self.key, "left")
            winner = F.col("winner")
        elif self.name == "Naive Bayes":
            facts = {k: v for k, v in self.state.items() if k != "baselines"}
            scored = GaussianBayes(self.points, **facts).score(df, [self.params["var_smoothing"]], self.state["baselines"])
            out = scored.withColumn("_s", F.get("outcome", F.lit(0)))
            out = out.withColumn("probability", F.col("_s.probability"))
            winner = F.col("_s.winner")
        elif self.name == "Decision Tree":
            model = self.model.copy()
            model.setLeafCol("_leaf").setPredictionCol("_p").setProbabilityCol("_probability").setRawPredictionCol("")
            out = model.transform(df)
            if self.state["leaves"] is None:
                out, winner = out.withColumn("probability", vector_to_array("_probability")), F.col("_p").cast("int")
            else:  # a leaf's number looks up the class counts of the node that it is collapsed into
                table = small_table(df.sparkSession, [(float(i), n) for i, n in enumerate(self.state["leaves"])], "_at double, _n array<double>")
                out = out.join(table, F.col("_at") == F.col("_leaf"), "left")
                total = F.aggregate("_n", F.lit(0.0), lambda a, v: a + v)
                out = out.withColumn("probability", F.transform("_n", lambda v: v / total))
                winner = F.array_position("_n", F.array_max("_n")) - 1
        elif self.name == "Support Vector Machine":
            out, winner = self.model.winner(self.landmarks.mapped(df) if self.landmarks else df)
            out = out.withColumn("probability", F.lit(None).cast("array<double>"))
        else:
            out = self.model.copy().setPredictionCol("_p").transform(df).withColumn("probability", vector_to_array("probability"))
            winner = F.col("_p").cast("int")
        named = F.get(F.array(*[F.lit(c) for c in self.classes]), winner.cast("int"))
        return out.withColumn("prediction", named).select(*[col(c) for c in keep], "prediction", "probability")

    def probability_columns(self, scored: DataFrame) -> DataFrame:
        """`proba_<class>` columns in place of the array, where the family has probabilities."""
        if self.name == "Support Vector Machine":
            return scored.drop("probability")
        return scored.withColumns({f"proba_{c}": F.get("probability", F.lit(i)) for i, c in enumerate(self.classes)}
                                  ).drop("probability")

    # --- storing

    def save(self, spark: SparkSession, path: str) -> None:
        """The description as one line of text, library models and training rows in their own folders."""
        facts = {"name": self.name, "params": self.params, "classes": self.classes, "key": self.key,
                 "state": self.state, "kind": type(self.model).__name__}
        small_table(spark, [(json.dumps(facts),)], "facts string").coalesce(1).write.mode("overwrite").text(
            f"{path}/facts")
        if self.landmarks is not None:
            self.landmarks.save(spark, f"{path}/landmarks")
        if self.name == "Support Vector Machine":
            self.model.save(f"{path}/model")
        elif self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")
        if self.points is not None:
            self.points.write.mode("overwrite").parquet(f"{path}/points")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Classifier:
        facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
        kind = facts.pop("kind")
        self = cls(**facts)
        readers = {k.__name__: k for k in (LogisticRegressionModel, DecisionTreeClassificationModel)}
        if kind in readers:
            self.model = readers[kind].load(f"{path}/model")
        if self.name in ("K-Nearest Neighbors", "Naive Bayes"):
            self.points = spark.read.parquet(f"{path}/points")
        if self.name == "Support Vector Machine":
            self.model = Pairs.load(f"{path}/model", len(self.classes))
            if self.params["kernel"] == "rbf":
                self.landmarks = Landmarks.load(spark, f"{path}/landmarks")
        return self


FAMILIES = {"Logistic Regression": "_fit_logistic", "K-Nearest Neighbors": "_fit_neighbours",
            "Support Vector Machine": "_fit_svm", "Decision Tree": "_fit_tree", "Naive Bayes": "_fit_bayes"}


def leaf_counts(spark: SparkSession, model: DecisionTreeClassificationModel, min_split: int) -> list[list[float]]:
    """Class counts by leaf number. Nodes below `min_split` rows act as leaves, so their leaves share their counts.

    Splits further down do not influence splits elsewhere, so the collapsed tree is the one that growing with the limit would
    give. The stored node table lists every node after its parent and leaves in their order; it is read in one job.
    """
    path = fresh_path(spark, "tree")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("id", "leftChild", "rightChild", "impurityStats").orderBy("id").toArrow()
    held: dict[int, list[float] | None] = {}
    leaves = []
    for node, left, right, counts in zip(*(c.to_pylist() for c in nodes.columns), strict=True):
        above = held.get(node)
        if left < 0:
            leaves.append(above or counts)
        else:
            held[left] = held[right] = above or (counts if sum(counts) < min_split else None)
    return leaves


def train_all(train: DataFrame, target: str, key: str, names: list[str] | None = None,
              params: dict[str, dict] | None = None, known: dict[str, Classifier] | None = None
              ) -> tuple[dict[str, Classifier], dict[str, str]]:
    """Fit the families not yet in `known`: (models, errors). A failure stops only its own family."""
    models, errors = dict(known or {}), {}
    for name in names or list(DEFAULTS):
        if name in models:
            continue
        try:
            models[name] = Classifier.fit(name, train, target, key, (params or {}).get(name))
        except Exception as e:  # recorded per family, as the caller shows it beside the others
            errors[name] = str(e)
    return models, errors


def score_all(models: dict[str, Classifier], test: DataFrame) -> tuple[dict[str, DataFrame | str], dict[str, dict[str, float]]]:
    """Stored predictions of every model, or the error that kept it from any, with the seconds training and prediction took."""
    results, seconds = {}, {}
    for name, model in models.items():
        start = time.perf_counter()
        try:
            results[name] = durable(model.score(test), "scored")
            seconds[name] = {"train_seconds": model.train_seconds, "predict_seconds": time.perf_counter() - start}
        except Exception as e:  # one model's failure leaves the others
            results[name] = str(e)
    return results, seconds


def training_table(spark: SparkSession, models: dict[str, Classifier], errors: dict[str, str]) -> DataFrame:
    rows = [(n, "trained", None, m.train_seconds) for n, m in models.items()]
    rows += [(n, "failed", e, None) for n, e in errors.items()]
    return small_table(spark, rows, "model string, status string, error string, train_seconds double")
