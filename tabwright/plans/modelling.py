"""Queries: classifiers, search, evaluation, scoring."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from tabwright.operators import evaluate, tune
from tabwright.operators.bayes import GaussianBayes
from tabwright.operators.classify import DEFAULTS, Classifier, train_all
from tabwright.operators.prep import PrepConfig, preprocess
from tabwright.operators.score import Scorer, scoring_columns
from tabwright.operators.split import SEED, train_test_split
from tabwright.plans.catalog import load, query, rounded
from tabwright.plans.preparation import PRIORITIES, fill_sql, folds_sql, onehot_sql, split_sql
from tabwright.sources import sinks
from tabwright.sources.local import small_table
from tabwright.sources.shared import durable, fresh_path

DOC = PrepConfig(target="label", feature_columns=["n_chars", "n_words", "lang"])


# --- inputs ---------------------------------------------------------------------------------------

def vectors(spark, sf) -> DataFrame:
    """Embeddings as feature vectors of all their numbers."""
    return load(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def vector_split(spark, sf) -> tuple[DataFrame, DataFrame]:
    train, test, _ = train_test_split(vectors(spark, sf), ["id"], "label")
    return train, test


def documents_prepared(spark, sf):
    return preprocess(load(spark, sf, "doc_model"), DOC, ["id"])


VECTORS = f"""
    vectors as (select vec_id as id, label, embedding from embeddings),
    {split_sql('vectors', 'label').strip()},
    cells as (select id, label, is_test, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as j
              from parted)"""

DOC_PREPARED = f"""
    {split_sql('doc_model', 'label').strip()},
    spread as (select avg(n_chars) as ac, stddev_pop(n_chars) as sc, avg(n_words) as aw, stddev_pop(n_words) as sw
               from parted where not is_test),
    langs as (select lang as l, row_number() over (order by lang) as k
              from (select distinct lang from parted where not is_test)),
    cells as (
      select id, label, is_test, (n_chars - ac) / sc as v, 0 as j from parted, spread
      union all select id, label, is_test, (n_words - aw) / sw, 1 from parted, spread
      union all select id, label, is_test, case when lang = l then 1.0::double else 0.0::double end, 1 + k
      from parted, langs)"""


def gnb_sql(smoothing: str = "1e-9") -> str:
    """CTEs from `cells` to `shares`: class shares of every test row."""
    return f"""
    eps as (select {smoothing} * max(s) as e from (select var_pop(v) as s from cells where not is_test group by j)),
    moments as (select label as c, j, avg(v) as m, var_pop(v) + (select e from eps) as s from cells where not is_test
                group by label, j),
    prior as (select label as c, ln(count(*) / sum(count(*)) over ()) as p
              from (select distinct id, label from cells where not is_test) group by label),
    logs as (select id, label, moments.c, any_value(p) + sum(-0.5 * ln(2 * pi() * s) - (v - m) * (v - m) / (2 * s)) as g
             from cells join moments on cells.j = moments.j join prior on prior.c = moments.c where is_test
             group by id, label, moments.c),
    shares as (select id, label, c, exp(g - max(g) over (partition by id))
                 / sum(exp(g)) over (partition by id) * exp(max(g) over (partition by id)) as share, g from logs)"""


GNB_WON = "select id, label, arg_max(c, (g, -c)) as prediction from shares group by id, label"


def gnb_shares() -> str:
    return """
    tops as (select id, max(g) as top from logs group by id),
    weights as (select logs.id, label, c, g, exp(g - top) as w from logs join tops on logs.id = tops.id),
    shares as (select *, w / sum(w) over (partition by id) as share from weights)"""


def gnb_full(smoothing: str = "1e-9") -> str:
    head = gnb_sql(smoothing)
    return head[:head.index("shares as")].rstrip().rstrip(",") + "," + gnb_shares()


def proba_sql(classes) -> str:
    return ", ".join(f"round(max(case when c = {c} then share end), 6) as proba_{c}" for c in classes)


def proba_columns(model: Classifier, scored: DataFrame) -> DataFrame:
    wide = model.probability_columns(scored)
    return rounded(wide, *[c for c in wide.columns if c.startswith("proba_")])


# --- naive Bayes ----------------------------------------------------------------------------------

@query("gnb_fit", f"""
    with {VECTORS.strip()}
    select label, cast(j - 1 as integer) as position, count(*) as n, round(avg(v), 6) as mean,
      round(var_pop(v), 6) as variance
    from cells where not is_test group by label, j""")
def gnb_fit(spark, sf):
    train, _ = vector_split(spark, sf)
    classes = [r["label"] for r in train.select("label").distinct().orderBy("label").collect()]
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")) - 1
    table = GaussianBayes.fit(train.withColumn("label", place), len(classes)).moments()
    named = F.get(F.array(*[F.lit(c) for c in classes]), F.col("class"))
    return rounded(table.select(named.alias("label"), F.col("slot").alias("position"), "n", "mean", "variance"), "mean", "variance")


@query("gnb_predict", f"""
    with {VECTORS.strip()}, {gnb_full().strip()}
    select id, label, arg_max(c, (g, -c)) as prediction, {proba_sql(range(10))} from shares group by id, label""")
def gnb_predict(spark, sf):
    train, test = vector_split(spark, sf)
    model = Classifier.fit("Naive Bayes", train, "label", "id")
    return proba_columns(model, model.score(test))


DOC_GNB = f"{DOC_PREPARED.strip()}, {gnb_full().strip()}"


@query("gnb_documents", f"""
    with {DOC_GNB}
    select id, label, arg_max(c, (g, -c)) as prediction, {proba_sql(range(2))} from shares group by id, label""")
def gnb_documents(spark, sf):
    p = documents_prepared(spark, sf)
    model = Classifier.fit("Naive Bayes", p.train, "label", "id")
    return proba_columns(model, model.score(p.test))


@query("gnb_wide", f"""
    with customers as (select c_custkey as id, c_nationkey % 3 as label, c_name, c_acctbal from customer),
    {split_sql('customers', 'label').strip()},
    spread as (select avg(c_acctbal) as a, stddev_pop(c_acctbal) as s from parted where not is_test),
    names as (select distinct c_name from parted where not is_test),
    cells as (
      select id, label, is_test, (c_acctbal - a) / s as v, '' as j from parted, spread
      union all select id, label, is_test, 1.0::double, c_name from parted where c_name in (select c_name from names)),
    width as (select count(*) + 1 as d from names),
    classes as (select label as c, count(*) as n from parted where not is_test group by label),
    own as (select label as c, j, count(*) as k, avg(v) as m, var_pop(v) as q from cells where not is_test group by label, j),
    slots as (select c, j, n, coalesce(k * m / n, 0) as m, coalesce((k * (q + (m - k * m / n) ** 2) + (n - k) * (k * m / n) ** 2) / n, 0) as q
              from (select distinct j from own) cross join classes left join own using (c, j)),
    overall as (select j, sum(n * m) / sum(n) as mean from slots group by j),
    eps as (select 1e-9 * max(s) as e from (select slots.j, sum(n * (q + (m - mean) ** 2)) / sum(n) as s from slots join overall on slots.j = overall.j group by slots.j)),
    zeros as (select c, any_value(ln(n / (select sum(n) from classes))) + sum(-0.5 * ln(2 * pi() * (q + e)) - m * m / (2 * (q + e))) as z from slots, eps group by c),
    logs as (select t.id, t.label, zeros.c, z + coalesce(sum(v * (2 * m - v) / (2 * (q + e))), 0) as g
             from parted t cross join zeros cross join eps left join cells on cells.id = t.id left join slots on slots.c = zeros.c and slots.j = cells.j
             where t.is_test group by t.id, t.label, zeros.c, z),
    {gnb_shares().strip()}
    select id, label, (select cast(d as bigint) from width) as n_features, arg_max(c, (g, -c)) as prediction from shares group by id, label""")
def gnb_wide(spark, sf):
    """A feature per customer name: as many as there are training rows."""
    rows = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 3).alias("label"), "c_name", "c_acctbal")
    p = preprocess(rows, PrepConfig(target="label", feature_columns=["c_acctbal", "c_name"]), ["id"])
    scored = Classifier.fit("Naive Bayes", p.train, "label", "id").score(p.test)
    return scored.select("id", "label", F.lit(p.preparation.width()).cast("bigint").alias("n_features"), "prediction")


# --- nearest neighbours ---------------------------------------------------------------------------

def near_sql(k: int, p: int) -> str:
    dist = "sum(abs(a.v - b.v))" if p == 1 else "sqrt(sum((a.v - b.v) * (a.v - b.v)))"
    return f"""
    dists as (select a.id as id, a.label as label, b.id as other, b.label as c, {dist} as dist
              from cells a join cells b on a.j = b.j where a.is_test and not b.is_test group by all),
    near as (select * from (select *, row_number() over (partition by id order by round(dist, 9), other) as rank
             from dists) where rank <= {k})"""


def vote_sql(weights: str) -> str:
    w = ("1.0" if weights == "uniform" else
         "case when min(round(dist, 9)) over (partition by id) = 0 "
         "then case when round(dist, 9) = 0 then 1.0 else 0.0 end else 1.0 / dist end")
    return f"""
    weighed as (select id, label, c, {w} as w from near),
    shares as (select id, label, c, sum(w) as g, sum(w) / sum(sum(w)) over (partition by id) as share
               from weighed group by id, label, c)"""


def _neighbour_query(spark, sf, **params):
    train, test = vector_split(spark, sf)
    model = Classifier.fit("K-Nearest Neighbors", train, "label", "id", params)
    return proba_columns(model, model.score(test))


def _neighbour_check(cells: str, classes, k: int = 5, p: int = 2, weights: str = "uniform") -> str:
    shares = ", ".join(f"coalesce(round(max(case when c = {c} then share end), 6), 0) as proba_{c}" for c in classes)
    return f"""
    with {cells.strip()}, {near_sql(k, p).strip()}, {vote_sql(weights).strip()}
    select id, label, arg_max(c, (round(g, 9), -c)) as prediction, {shares} from shares group by id, label"""


@query("knn_predict", _neighbour_check(VECTORS, range(10)))
def knn_predict(spark, sf):
    return _neighbour_query(spark, sf)


@query("knn_distance_weighted", _neighbour_check(VECTORS, range(10), 7, 2, "distance"))
def knn_distance_weighted(spark, sf):
    return _neighbour_query(spark, sf, n_neighbors=7, weights="distance")


@query("knn_manhattan", _neighbour_check(VECTORS, range(10), 5, 1))
def knn_manhattan(spark, sf):
    return _neighbour_query(spark, sf, p=1)


@query("knn_documents", _neighbour_check(DOC_PREPARED, range(2)))
def knn_documents(spark, sf):
    p = documents_prepared(spark, sf)
    model = Classifier.fit("K-Nearest Neighbors", p.train, "label", "id")
    return proba_columns(model, model.score(p.test))


# --- library families -----------------------------------------------------------------------------

def newton_sql(source: str, steps: int = 12) -> str:
    """CTEs p0 .. p<steps>: slope w and intercept b of a logistic regression of y on x, by Newton's method; the slope is held by w * w / 2."""
    out = ["p0 as (select 0.0::double as w, 0.0::double as b)"]
    for i in range(steps):
        out.append(f"""s{i} as (select any_value(w) as w, any_value(b) as b, sum((p - y) * x) + any_value(w) as gw, sum(p - y) as gb,
          sum(p * (1 - p) * x * x) + 1 as hww, sum(p * (1 - p) * x) as hwb, sum(p * (1 - p)) as hbb
          from (select x, y, w, b, 1 / (1 + exp(-(w * x + b))) as p from {source}, p{i}))""")
        out.append(f"""p{i + 1} as (select w - (hbb * gw - hwb * gb) / (hww * hbb - hwb * hwb) as w,
          b - (hww * gb - hwb * gw) / (hww * hbb - hwb * hwb) as b from s{i})""")
    return ",\n    ".join(out)


@query("logreg_predict", f"""
    with points as (select id, least(n_words, 400) / 100.0::double as x, label as y from doc_model),
    {newton_sql('points')}
    select id, case when w * x + b > 0 then 1 else 0 end as prediction, round(1 / (1 + exp(-(w * x + b))), 4) as proba_1 from points, p12""")
def logreg_predict(spark, sf):
    """Quality from the number of words: the optimum that Newton's method finds."""
    rows = load(spark, sf, "doc_model").select("id", "label", array_to_vector(F.array(F.least("n_words", F.lit(400)) / 100.0)).alias("features"))
    model = Classifier.fit("Logistic Regression", rows, "label", "id")
    scored = model.score(rows).select("id", "prediction", F.get("probability", F.lit(1)).alias("proba_1"))
    return rounded(scored, "proba_1", digits=4)


@query("svm_linear_predict", "select o_orderkey as id, (o_orderkey % 2)::integer as prediction from orders")
def svm_linear_predict(spark, sf):
    """Two classes with a wide gap between them, which the widest margin must part without an error."""
    rows = load(spark, sf, "orders").selectExpr("o_orderkey as id", "o_orderkey % 2 as label",
                                                "array(o_orderkey % 2 * 6 + o_custkey % 100 / 100D, o_custkey % 7 / 7D) as x")
    rows = rows.withColumn("features", array_to_vector("x")).drop("x")
    model = Classifier.fit("Support Vector Machine", rows, "label", "id", {"kernel": "linear"})
    return model.score(rows).select("id", "prediction")


@query("svm_rbf_predict", "select c_custkey as id, (c_custkey % 2)::integer as prediction from customer")
def svm_rbf_predict(spark, sf):
    """Two rings, one inside the other, which no line can part."""
    rows = load(spark, sf, "customer").selectExpr("c_custkey as id", "c_custkey % 2 as label", "1 + c_custkey % 2 * 3D as r", "c_custkey * 0.7D as t")
    rows = rows.select("id", "label", array_to_vector(F.array(F.col("r") * F.cos("t"), F.col("r") * F.sin("t"))).alias("features"))
    model = Classifier.fit("Support Vector Machine", rows, "label", "id")
    return model.score(rows).select("id", "prediction")


@query("svm_three_rings", "select c_custkey as id, (c_custkey % 3)::integer as prediction from customer")
def svm_three_rings(spark, sf):
    """Three rings around each other: no class can be parted from both others by a line, and each pair of classes votes."""
    rows = load(spark, sf, "customer").selectExpr("c_custkey as id", "c_custkey % 3 as label", "1 + c_custkey % 3 * 2D as r", "c_custkey * 0.7D as t")
    rows = rows.select("id", "label", array_to_vector(F.array(F.col("r") * F.cos("t"), F.col("r") * F.sin("t"))).alias("features"))
    model = Classifier.fit("Support Vector Machine", rows, "label", "id", {"gamma": "auto", "kernel_error": 0.001})
    return model.score(rows).select("id", "prediction")


@query("svm_modes", """
    with said as (select o_orderkey, o_orderpriority as label from orders)
    select o_orderkey as id, label as prediction from said""")
def svm_modes(spark, sf):
    """Five classes in five corners, parted by ten machines without a kernel."""
    rows = load(spark, sf, "orders").selectExpr("o_orderkey as id", "o_orderpriority as label", "cast(left(o_orderpriority, 1) as double) as p", "o_custkey % 50 / 100D as noise")
    rows = rows.select("id", "label", array_to_vector(F.array(10 * F.cos(F.col("p") * 1.2566) + F.col("noise"), 10 * F.sin(F.col("p") * 1.2566) - F.col("noise"))).alias("features"))
    return Classifier.fit("Support Vector Machine", rows, "label", "id", {"kernel": "linear"}).score(rows).select("id", "prediction")


TREE_LABEL = "case when l_quantity + l_orderkey % 17 > 40 then 'large' when l_quantity + l_orderkey % 23 > 24 then 'medium' else 'small' end"


@query("tree_predict", f"""
    with cells as (select l_quantity::double as q, {TREE_LABEL} as f, count(*)::double as n from lineitem group by all),
    cuts as (select distinct q as cut from cells where q < (select max(q) from cells)),
    sides as (select cut, q <= cut as low, f, sum(n) as n from cells, cuts group by all),
    sizes as (select cut, low, sum(n) as m, sum(n * n) as squares from sides group by all),
    best as (select arg_max(cut, (round(gain, 6), -cut)) as cut from (select cut, sum(squares / m) as gain from sizes group by cut)),
    leaves as (select low, f, n / sum(n) over (partition by low) as p from sides where cut = (select cut from best)),
    said as (select low, arg_max(f, p) as prediction, {", ".join(f"coalesce(round(max(p) filter (f = '{c}'), 6), 0) as proba_{c}" for c in ("large", "medium", "small"))} from leaves group by low)
    select quantity, prediction, proba_large, proba_medium, proba_small
    from (select distinct l_quantity::double as quantity from lineitem) d join said on (quantity <= (select cut from best)) = low""")
def tree_predict(spark, sf):
    """A tree of depth one takes the best of all cuts."""
    lines = load(spark, sf, "lineitem").select("l_orderkey", F.expr(TREE_LABEL).alias("label"), F.col("l_quantity").cast("double").alias("quantity"))
    rows = lines.withColumn("features", array_to_vector(F.array("quantity")))
    model = Classifier.fit("Decision Tree", rows, "label", "l_orderkey", {"max_depth": 1, "min_samples_split": 5})
    shares = {f"proba_{c}": F.get("probability", F.lit(i)) for i, c in enumerate(model.classes)}
    return rounded(model.score(rows).select("quantity", "prediction", *(v.alias(k) for k, v in shares.items())).distinct(), *shares)


@query("train_all", f"""
    with {split_sql('doc_model', 'label').strip()}
    select name as model, 'trained' as status, (select count(*) from parted where is_test) as n_scored,
      (select count(*) from parted where not is_test) as n_trained
    from (values ('Decision Tree'), ('K-Nearest Neighbors'), ('Logistic Regression'), ('Naive Bayes'), ('Support Vector Machine')) v(name)""")
def train_all_query(spark, sf):
    """All families on prepared documents, each scoring the test side."""
    p = documents_prepared(spark, sf)
    models, errors = train_all(p.train, "label", "id")
    n = p.train.count()
    rows = [(name, "trained", m.score(p.test).where("prediction is not null").count(), n) for name, m in models.items()]
    rows += [(name, "failed", 0, n) for name in errors]
    return small_table(spark, rows, "model string, status string, n_scored bigint, n_trained bigint")


@query("model_roundtrip", """
    select name as model, cast(0 as bigint) as changed, (select count(*) from doc_model) as n_rows
    from (values ('Decision Tree'), ('K-Nearest Neighbors'), ('Logistic Regression'), ('Naive Bayes'),
                 ('Support Vector Machine')) v(name)""")
def model_roundtrip(spark, sf):
    """Every family saved, loaded and applied to all documents: how many predictions changed."""
    df = load(spark, sf, "doc_model")
    p = preprocess(df, DOC, ["id"])
    out = None
    for name in sorted(DEFAULTS):
        scorer = Scorer(p.preparation, Classifier.fit(name, p.train, "label", "id"))
        path = fresh_path(spark, "model")
        scorer.save(spark, path)
        again = Scorer.load(spark, path)
        before, after = scorer.score(df), again.score(df).select("id", F.col("prediction").alias("after"))
        row = before.join(after, "id").agg(
            F.lit(name).alias("model"), F.count_if(~F.col("prediction").eqNullSafe(F.col("after"))).alias("changed"),
            F.count("*").alias("n_rows"))
        out = row if out is None else out.unionAll(row)
    return out


# --- search ---------------------------------------------------------------------------------------

def _product_sql(axes: dict[str, list]) -> str:
    """Every combination of the axes in grid order, as `params` text."""
    names = sorted(axes)
    froms = ", ".join(f"(values {', '.join(f'({i}, {_q(str(v))})' for i, v in enumerate(axes[n]))}) a{n}(i_{n}, {n})"
                      for n in names)
    text = " || ', ' || ".join(f"'{n}=' || {n}" for n in names)
    order = ", ".join(f"i_{n}" for n in names)
    return f"select cast(row_number() over (order by {order}) - 1 as integer) as candidate, {text} as params from {froms}"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("param_grid", "\nunion all\n".join(
    f"select '{m}' as model, candidate, params, (select count(*) from labels) as n_rows, "
    + ("round(1.0 / (cast(regexp_extract(params, 'C=([0-9.]+)', 1) as double) * (select count(*) from labels)), 9)"
       if "C" in space else "cast(null as double)") + f" as reg_param from ({_product_sql(space)})"
    for m, space in tune.SPACES.items()))
def param_grid(spark, sf):
    """All candidates, with the regularisation that C means for this many rows."""
    rows = [(m, i, tune.text_of(p), p.get("C")) for m, s in tune.SPACES.items() for i, p in enumerate(tune.grid(s))]
    n = load(spark, sf, "labels").agg(F.count("*").alias("n_rows"))
    table = small_table(spark, rows, "model string, candidate int, params string, C double")
    n_rows = n.first()["n_rows"]
    return table.select("model", "candidate", "params", F.lit(n_rows).cast("bigint").alias("n_rows"),
                        (F.round(1.0 / (F.col("C") * n_rows), 9)).alias("reg_param"))


@query("random_candidates", "\nunion all\n".join(
    f"""select * from (select '{m}' as model, candidate, params, (select count(*) from labels) as n_rows
    from ({_product_sql(space)}) order by substr(md5('{SEED}|' || candidate), 1, 8), candidate limit 20)"""
    for m, space in tune.SPACES.items()))
def random_candidates(spark, sf):
    rows = [(m, i, tune.text_of(p)) for m, s in tune.SPACES.items() for i, p in tune.random_candidates(s)]
    n_rows = load(spark, sf, "labels").count()
    return small_table(spark, rows, "model string, candidate int, params string").withColumn(
        "n_rows", F.lit(n_rows).cast("bigint"))


FOLDED = f"""
    vectors as (select vec_id as id, label, embedding from embeddings),
    {folds_sql('vectors', 'label', 5).strip()},
    flat as (select id, label, fold, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as j from folded)"""

GRID_GNB = f"""
    {FOLDED.strip()},
    f3 as (select unnest([0, 1, 2, 3, 4]) as f),
    tries as (select * from (values (0, 1e-9::double, 'var_smoothing=1e-09'), (1, 1e-8::double, 'var_smoothing=1e-08'),
              (2, 1e-7::double, 'var_smoothing=1e-07')) t(candidate, s, params)),
    eps as (select f, max(v2) as e from (select f, j, var_pop(v) as v2 from flat, f3 where fold <> f group by f, j)
            group by f),
    moments as (select f, label as c, j, avg(v) as m, var_pop(v) as v2 from flat, f3 where fold <> f
                group by f, label, j),
    prior as (select f, label as c, ln(count(*) / sum(count(*)) over (partition by f)) as p from folded, f3 where fold <> f
              group by f, label),
    logs as (select candidate, params, flat.fold, id, label, m.c, any_value(p)
               + sum(-0.5 * ln(2 * pi() * (v2 + s * e)) - (v - m) * (v - m) / (2 * (v2 + s * e))) as g
             from flat join moments m on flat.fold = m.f and flat.j = m.j join prior on prior.f = m.f and prior.c = m.c
               join eps on eps.f = m.f, tries
             group by all),
    won as (select candidate, params, fold, id, label, arg_max(c, (g, -c)) as prediction from logs group by all),
    scores as (select cast(candidate as integer) as candidate, params, fold,
                 avg(case when label = prediction then 1.0 else 0.0 end) as score from won group by all)"""


@query("grid_search_gnb", f"""
    with {GRID_GNB.strip()}
    select candidate, params, fold, round(score, 6) as score from scores""")
def grid_search_gnb(spark, sf):
    return rounded(tune.search("Naive Bayes", vectors(spark, sf), "label", "id", refit=False).scores, "score")


@query("best_candidate", f"""
    with {GRID_GNB.strip()},
    means as (select candidate, params, avg(score) as mean_score from scores group by all)
    select arg_max(candidate, (round(mean_score, 12), -candidate)) as candidate,
      arg_max(params, (round(mean_score, 12), -candidate)) as params, round(max(mean_score), 6) as best_score
    from means""")
def best_candidate(spark, sf):
    found = tune.search("Naive Bayes", vectors(spark, sf), "label", "id", refit=False)
    return rounded(tune.best_candidate(found.scores), "best_score")


@query("search_families", f"""
    with {GRID_GNB.strip()},
    means as (select candidate, params, avg(score) as mean_score from scores group by all)
    select 'Naive Bayes' as model, 'searched' as status, arg_max(params, (round(mean_score, 12), -candidate)) as best_params,
      round(max(mean_score), 6) as best_score, 3::integer as candidates, 0::integer as failed_candidates, true as adopted from means
    union all select 'No Such Model', 'failed', null, null, null, null, false""")
def search_families(spark, sf):
    """Two families asked for, one of which does not exist; the other's winner takes its model's place."""
    rows = vectors(spark, sf)
    found, errors = tune.search_families(["Naive Bayes", "No Such Model"], rows, "label", "id")
    models = tune.adopted({}, found)
    table = tune.search_table(spark, found, errors).drop("error").withColumn("adopted", F.col("model").isin(list(models)))
    return rounded(table, "best_score")


def _knn_scores(p: int) -> str:
    dist = "sum(abs(a.v - b.v))" if p == 1 else "sqrt(sum((a.v - b.v) * (a.v - b.v)))"
    return f"""
      select {p} as p, a.id as id, a.label as label, a.fold as fold, b.id as other, b.label as c, {dist} as dist
      from flat a join flat b on a.j = b.j where a.fold <> b.fold group by all"""


@query("grid_search_knn", f"""
    with {FOLDED.strip()},
    dists as ({_knn_scores(1)} union all {_knn_scores(2)}),
    near as (select *, row_number() over (partition by p, id order by round(dist, 9), other) as rank from dists),
    tries as (select * from ({_product_sql(tune.SPACES['K-Nearest Neighbors'])})),
    parsed as (select candidate, params, cast(regexp_extract(params, 'n_neighbors=([0-9]+)', 1) as integer) as k,
                 cast(regexp_extract(params, 'p=([0-9])', 1) as integer) as tp, params like '%distance%' as weighted
               from tries),
    votes as (select candidate, params, fold, id, label, c,
                sum(case when weighted then 1.0 / dist else 1.0 end) as g
              from near join parsed on tp = p and rank <= k group by all),
    won as (select candidate, params, fold, id, label, arg_max(c, (round(g, 9), -c)) as prediction from votes group by all)
    select candidate, params, fold, round(avg(case when label = prediction then 1.0 else 0.0 end), 6) as score
    from won group by all""")
def grid_search_knn(spark, sf):
    return rounded(tune.search("K-Nearest Neighbors", vectors(spark, sf), "label", "id", refit=False).scores,
                   "score")


def _tried(scores: DataFrame, found) -> DataFrame:
    """Candidates with their folds, how many scores are shares, and whether the winner has the best mean."""
    means = tune.mean_scores(scores)
    best = F.round(F.max("mean_score").over(Window.partitionBy(F.lit(0))), 12) == F.round(F.lit(found.best_score), 12)
    told = scores.groupBy("candidate", "params").agg(F.count_distinct("fold").alias("folds"), F.count_if(F.col("score").between(0, 1)).alias("shares"))
    return told.join(means.select("candidate", best.alias("best_is_best")), "candidate").withColumn("candidate", F.col("candidate").cast("int"))


@query("grid_search_logreg", f"""
    select candidate, params, 5::bigint as folds, 5::bigint as shares, (select count(*) > 0 from doc_model) as best_is_best
    from ({_product_sql(tune.SPACES['Logistic Regression'])})""")
def grid_search_logreg(spark, sf):
    p = documents_prepared(spark, sf)
    found = tune.search("Logistic Regression", p.train, "label", "id", scoring="f1_weighted")
    return _tried(found.scores, found)


@query("random_search_tree", f"""
    select candidate, params, 5::bigint as folds, 5::bigint as shares, (select count(*) > 0 from doc_model) as best_is_best
    from ({_product_sql(tune.SPACES['Decision Tree'])}) order by substr(md5('{SEED}|' || candidate), 1, 8), candidate limit 20""")
def random_search_tree(spark, sf):
    p = documents_prepared(spark, sf)
    found = tune.search("Decision Tree", p.train, "label", "id", "random")
    return _tried(found.scores, found)


# --- evaluation -----------------------------------------------------------------------------------

def scored_documents(spark, sf):
    """Test predictions of naive Bayes and nearest neighbours on documents."""
    p = documents_prepared(spark, sf)
    return {n: durable(Classifier.fit(n, p.train, "label", "id").score(p.test), "scored")
            for n in ("Naive Bayes", "K-Nearest Neighbors")}


def metrics_sql(won: str) -> str:
    return f"""
    select sum(hit) / sum(actual) as accuracy, sum(actual * coalesce(hit / nullif(said, 0), 0)) / sum(actual) as precision,
      sum(actual * coalesce(hit / nullif(actual, 0), 0)) / sum(actual) as recall,
      sum(actual * coalesce(2.0 * hit / nullif(said + actual, 0), 0)) / sum(actual) as f1_score
    from (select c, sum(case when label = c then 1 else 0 end)::double as actual,
            sum(case when prediction = c then 1 else 0 end)::double as said,
            sum(case when label = c and prediction = c then 1 else 0 end)::double as hit
          from {won}, (select unnest([0, 1]) as c) group by c)"""


EVAL_CTES = f"""
    {DOC_GNB},
    bayes as ({GNB_WON}),
    {near_sql(5, 2).strip()},
    counted as (select id, label, c, count(*) as g from near group by id, label, c),
    knn as (select id, label, arg_max(c, (g, -c)) as prediction from counted group by id, label)"""

_rounded_metrics = ", ".join(f"round({m}, 6) as {m}" for m in evaluate.METRICS)


@query("metrics", f"with {EVAL_CTES.strip()} select {_rounded_metrics} from ({metrics_sql('bayes')})")
def metrics(spark, sf):
    return rounded(evaluate.metrics(scored_documents(spark, sf)["Naive Bayes"]), *evaluate.METRICS)


COMPARISON = f"""
    with {EVAL_CTES.strip()}, compared as (
      select 'Naive Bayes' as model, cast(null as varchar) as error, {_rounded_metrics} from ({metrics_sql('bayes')})
      union all
      select 'K-Nearest Neighbors', null, {_rounded_metrics} from ({metrics_sql('knn')})
      union all select 'Broken', 'could not be fitted', null, null, null, null)"""


def compared(spark, sf):
    results = {n: evaluate.metrics(s) for n, s in scored_documents(spark, sf).items()}
    return evaluate.compare_models({**results, "Broken": "could not be fitted"})


@query("comparison", f"{COMPARISON.strip()} select * from compared")
def comparison(spark, sf):
    return rounded(compared(spark, sf), *evaluate.METRICS)


RANKED = """select *, cast(row_number() over (order by f1_score desc nulls last, model) as integer) as rank
    from compared"""


@query("ranking", f"{COMPARISON.strip()} {RANKED}")
def ranking(spark, sf):
    return rounded(evaluate.rank_models(compared(spark, sf), "f1_score"), *evaluate.METRICS)


@query("best_model", f"{COMPARISON.strip()} select arg_min(model, rank) as best_model from ({RANKED})")
def best_model(spark, sf):
    return evaluate.best_model(evaluate.rank_models(compared(spark, sf), "f1_score"))


@query("confusion_matrix", f"""
    with {EVAL_CTES.strip()}
    select cast(label as varchar) as label, cast(prediction as varchar) as prediction, count(*) as count
    from knn group by 1, 2""")
def confusion_matrix(spark, sf):
    return evaluate.confusion(scored_documents(spark, sf)["K-Nearest Neighbors"])


@query("roc_auc", """
    with pairs as (select toxic, n_chars from doc_model),
    ranks as (select toxic, rank() over (order by n_chars) + (count(*) over (partition by n_chars) - 1) / 2.0 as r from pairs)
    select round((sum(case when toxic = 1 then r end) - sum(toxic) * (sum(toxic) + 1) / 2.0)
        / (sum(toxic) * (count(*) - sum(toxic))), 6) as auc,
      (select count(distinct n_chars) from pairs) as n_thresholds
    from ranks""")
def roc_auc(spark, sf):
    return rounded(evaluate.roc_auc(load(spark, sf, "doc_model"), "toxic", "n_chars"), "auc")


@query("roc_curve", """
    with steps as (select n_chars as score, cast(sum(toxic) as bigint) as pos, cast(sum(1 - toxic) as bigint) as neg
                   from doc_model group by 1)
    select score, round(sum(pos) over w / sum(pos) over (), 6) as tpr, round(sum(neg) over w / sum(neg) over (), 6) as fpr
    from steps window w as (order by score desc)""")
def roc_curve(spark, sf):
    points = evaluate.roc_points(load(spark, sf, "doc_model"), "toxic", "n_chars")
    return rounded(points.select("score", "tpr", "fpr"), "tpr", "fpr")


# --- scoring new data -----------------------------------------------------------------------------

ORDERS = PrepConfig(target="target", feature_columns=["price", "spiky", "priority"])


def order_scorer(spark, sf) -> Scorer:
    p = preprocess(load(spark, sf, "dirty_orders"), ORDERS, ["id"])
    return Scorer(p.preparation, Classifier.fit("Naive Bayes", p.train, "target", "id"))


@query("scoring_frame", "select id, cast(null as double) as price, spiky, priority from score_new")
def scoring_frame(spark, sf):
    from tabwright.operators.score import scoring_frame as frame

    return frame(load(spark, sf, "score_new"), ORDERS.feature_columns, "target", ["price", "spiky"], ["id"])


@query("scoring_columns", """
    select 'price' as "column", 'missing' as status, cast(null as bigint) as non_null
    union all select 'spiky', 'found', count(spiky) from score_new
    union all select 'priority', 'found', count(priority) from score_new
    union all select 'extra_col', 'extra', count(extra_col) from score_new""")
def scoring_columns_query(spark, sf):
    return scoring_columns(load(spark, sf, "score_new"), ORDERS.feature_columns, "target", ["id"])


@query("required_columns", """
    select cast(i as integer) as position, name as "column" from (values (0, 'price'), (1, 'spiky'), (2, 'priority'))
      v(i, name) where exists (select 1 from orders)""")
def required_columns(spark, sf):
    scorer = order_scorer(spark, sf)
    return small_table(spark, list(enumerate(scorer.preparation.input_columns())), "position int, column string")


_order_mode = fill_sql("priority", "most_frequent", "(select * from parted where not is_test)")
ORDER_MODEL = f"""
    {split_sql('dirty_orders', 'target').strip()},
    means as (select avg(price) as mp, avg(spiky) as ms from parted where not is_test),
    fresh as (select id, null::double as price, spiky, priority from score_new),
    filled as (
      select id, target, false as is_test, coalesce(price, mp) as price, coalesce(spiky, ms) as spiky,
        coalesce(priority, {_order_mode}) as priority from parted, means where not is_test
      union all
      select id, null, true, coalesce(price, mp), coalesce(spiky, ms), coalesce(priority, {_order_mode}) from fresh, means),
    spread as (select avg(price) as ap, stddev_pop(price) as sp, avg(spiky) as as_, stddev_pop(spiky) as ss
               from filled where not is_test),
    slots as (select unnest([{', '.join(_q(v) for v in PRIORITIES)}]) as l, unnest(range(5)) as k),
    cells as (
      select id, target as label, is_test, (price - ap) / sp as v, 0 as j from filled, spread
      union all select id, target, is_test, (spiky - as_) / ss, 1 from filled, spread
      union all select id, target, is_test, case when priority = l then 1.0::double else 0.0::double end, 2 + k
      from filled, slots),
    eps as (select 1e-9 * max(s) as e from (select var_pop(v) as s from cells where not is_test group by j)),
    moments as (select label as c, j, avg(v) as m, var_pop(v) + (select e from eps) as s from cells where not is_test
                group by label, j),
    prior as (select target as c, ln(count(*) / sum(count(*)) over ()) as p from parted where not is_test group by 1),
    logs as (select id, moments.c, any_value(p) + sum(-0.5 * ln(2 * pi() * s) - (v - m) * (v - m) / (2 * s)) as g
             from cells join moments on cells.j = moments.j join prior on prior.c = moments.c where is_test
             group by id, moments.c),
    tops as (select id, max(g) as top from logs group by id),
    weights as (select logs.id, c, g, exp(g - top) as w from logs join tops on logs.id = tops.id),
    shares as (select *, w / sum(w) over (partition by id) as share from weights)"""
_order_probas = ", ".join(f"round(max(case when c = '{c}' then share end), 5) as \"proba_{c}\"" for c in "FOP")
SCORED = f"""with {ORDER_MODEL.strip()}
    select id, arg_max(c, g) as prediction, {_order_probas} from shares group by id"""


@query("score_batch", SCORED)
def score_batch(spark, sf):
    scored = order_scorer(spark, sf).score(load(spark, sf, "score_new"))
    return rounded(scored, "proba_F", "proba_O", "proba_P", digits=5)


@query("write_predictions", SCORED)
def write_predictions(spark, sf):
    """Scored rows written in row order and read back."""
    scored = order_scorer(spark, sf).score(load(spark, sf, "score_new"))
    path = sinks.write_predictions(rounded(scored, "proba_F", "proba_O", "proba_P", digits=5), ["id"])
    return spark.read.parquet(path)


@query("unseen_category", f"""
    with {split_sql('dirty_orders', 'target').strip()}
    select id, {onehot_sql(f"coalesce(priority, {_order_mode})", 'priority', PRIORITIES)} from score_new""")
def unseen_category(spark, sf):
    scorer = order_scorer(spark, sf)
    wide = scorer.preparation.to_columns(scorer.frame(load(spark, sf, "score_new"), ["id"]), ["id"])
    return wide.select("id", *[f"`priority_{v}`" for v in PRIORITIES])


_one = ORDER_MODEL.replace("select id, null::double as price, spiky, priority from score_new",
                           "select cast(0 as bigint) as id, 1e5::double as price, null::double as spiky, "
                           "'2-HIGH' as priority")


@query("score_one", f"""with {_one.strip()}
    select id, arg_max(c, g) as prediction, {_order_probas} from shares group by id""")
def score_one(spark, sf):
    """One sample typed in by hand, scored by the model of the whole table."""
    scored = order_scorer(spark, sf).score_one(spark, {"price": " 1e5 ", "spiky": "", "priority": "2-HIGH"})
    return rounded(scored, "proba_F", "proba_O", "proba_P", digits=5)
