"""Queries: imputation, encoding, scaling, capping, removal, splitting, the whole preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import prep, split
from tabwright.operators.prep import PrepConfig, Preparation
from tabwright.plans.catalog import load, query, rounded
from tabwright.sources import sinks
from tabwright.sources.local import small_table

CONFIG = PrepConfig(target="target", feature_columns=["price", "spiky", "custkey", "mostly_zero", "constant_num",
                                                      "all_null", "priority", "flag"])
PLAIN = PrepConfig(target="target", scaler="none")
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def fitted(df, numeric, categorical, **options):
    """Learn on the whole table and apply to it."""
    config = PrepConfig(target="target", **{"scaler": "none", **options})
    return Preparation.fit(df, config, numeric, categorical).to_columns(df, ["id"])


# --- SQL building blocks --------------------------------------------------------------------------

def fill_sql(column: str, strategy: str, rows: str) -> str:
    found = {
        "mean": f"avg({column})", "median": f"quantile_cont({column}, 0.5)",
        "most_frequent": None, "constant": "0.0",
    }[strategy]
    if strategy == "most_frequent":
        return (f"(select {column} from {rows} where {column} is not null group by {column} "
                f"order by count(*) desc, {column} limit 1)")
    return f"(select {found} from {rows})"


def hash_sql(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{seed}|' || {key}), 1, 8))::bigint"


def split_sql(source: str, target: str, key: str = "id", test_size: float = 0.2) -> str:
    """CTEs ending in `parted`: the source's rows with a target, and `is_test`."""
    return f"""
    known as (select *, {hash_sql(key)} as h from {source} where {target} is not null),
    sizes as (select {target} as c, count(*) as n from known group by 1),
    totals as (select sum(n) as n_all, cast(ceil({test_size} * sum(n)) as bigint) as n_test from sizes),
    base as (select c, n, n * n_test // n_all as q, n * n_test % n_all as rest, n_test from sizes, totals),
    quota as (select c, q + case when row_number() over (order by rest desc, c) <= n_test - (sum(q) over ())
                then 1 else 0 end as q from base),
    parted as (select known.*, row_number() over (partition by {target} order by h, {key}) <= q as is_test
               from known join quota on known.{target} = quota.c)"""


# --- one step at a time ---------------------------------------------------------------------------

@query("impute_mean", f"""
    select id, round(coalesce(price, {fill_sql('price', 'mean', 'dirty_orders')}), 4) as price,
      round(coalesce(custkey, {fill_sql('custkey', 'mean', 'dirty_orders')}), 4) as custkey from dirty_orders""")
def impute_mean(spark, sf):
    return rounded(fitted(load(spark, sf, "dirty_orders"), ["price", "custkey", "all_null"], []), "price", "custkey",
                   digits=4)


@query("impute_median", f"""
    select id, round(coalesce(price, {fill_sql('price', 'median', 'dirty_orders')}), 4) as price,
      round(coalesce(custkey, {fill_sql('custkey', 'median', 'dirty_orders')}), 4) as custkey from dirty_orders""")
def impute_median(spark, sf):
    return rounded(fitted(load(spark, sf, "dirty_orders"), ["price", "custkey"], [], numeric_imputer="median"),
                   "price", "custkey", digits=4)


@query("impute_mode_num", f"""
    select id, cast(coalesce(custkey, {fill_sql('custkey', 'most_frequent', 'dirty_orders')}) as double) as custkey,
      mostly_zero from dirty_orders""")
def impute_mode_num(spark, sf):
    return fitted(load(spark, sf, "dirty_orders"), ["custkey", "mostly_zero"], [], numeric_imputer="most_frequent")


def _ordinal(column: str, values: list[str]) -> str:
    return f"case {column} " + " ".join(f"when '{v}' then {i}" for i, v in enumerate(values)) + " else -1 end"


@query("impute_mode_cat", f"""
    select id, cast({_ordinal(f"coalesce(priority, {fill_sql('priority', 'most_frequent', 'dirty_orders')})",
                              PRIORITIES)} as double) as priority from dirty_orders""")
def impute_mode_cat(spark, sf):
    return fitted(load(spark, sf, "dirty_orders"), [], ["priority"], encoder="label")


@query("mode_ties", """
    select 'num_tie' as "column", cast(min(num_tie) as varchar) as mode from ties
    where num_tie in (select num_tie from ties group by 1 having count(*) = (
      select max(n) from (select count(*) as n from ties group by num_tie)))
    union all
    select 'str_tie', min(str_tie) from ties
    where str_tie in (select str_tie from ties group by 1 having count(*) = (
      select max(n) from (select count(*) as n from ties group by str_tie)))""")
def mode_ties(spark, sf):
    df = load(spark, sf, "ties")
    p = Preparation.fit(df, PrepConfig(target="id", numeric_imputer="most_frequent", scaler="none"), ["num_tie"],
                        ["str_tie"])
    return small_table(df.sparkSession, [(c, str(int(float(p.fills[c])))) for c in ("num_tie", "str_tie")],
                                           "column string, mode string")


@query("impute_constant", f"""
    select id, coalesce(price, -1) as price,
      cast({_ordinal("coalesce(priority, '0-none')", ['0-none', *PRIORITIES])} as double) as priority
    from dirty_orders""")
def impute_constant(spark, sf):
    return fitted(load(spark, sf, "dirty_orders"), ["price"], ["priority"], numeric_imputer="constant",
                  numeric_fill=-1.0, categorical_imputer="constant", categorical_fill="0-none", encoder="label")


def onehot_sql(column: str, name: str, values: list[str]) -> str:
    return ", ".join(f"cast(case when {column} = '{v}' then 1 else 0 end as double) as \"{name}_{v}\"" for v in values)


_priority = f"coalesce(priority, {fill_sql('priority', 'most_frequent', 'dirty_orders')})"


@query("onehot", f"""
    select id, {onehot_sql(_priority, 'priority', PRIORITIES)},
      {onehot_sql("cast(flag as varchar)", 'flag', ['false', 'true'])} from dirty_orders""")
def onehot(spark, sf):
    return fitted(load(spark, sf, "dirty_orders"), [], ["priority", "flag"])


@query("ordinal", """
    with v as (select c_name, dense_rank() over (order by c_name) - 1 as code from customer),
    w as (select c_custkey as id, c_name, c_mktsegment, c_nationkey from customer)
    select id, cast(code as double) as c_name,
      cast(dense_rank() over (order by c_mktsegment) - 1 as double) as c_mktsegment,
      cast(dense_rank() over (order by c_nationkey) - 1 as double) as c_nationkey
    from w join v on w.c_name = v.c_name""")
def ordinal(spark, sf):
    df = load(spark, sf, "customer").withColumnRenamed("c_custkey", "id")
    return fitted(df, [], ["c_name", "c_mktsegment", "c_nationkey"], encoder="label")


@query("scale_standard", """
    select id, round((price2 - avg(price2) over ()) / stddev_pop(price2) over (), 6) as price, 0.0::double as constant_num
    from (select id, coalesce(price, (select avg(price) from dirty_orders)) as price2 from dirty_orders)""")
def scale_standard(spark, sf):
    return rounded(fitted(load(spark, sf, "dirty_orders"), ["price", "constant_num"], [], scaler="standard"), "price")


@query("scale_minmax", """
    select id, round((spiky - min(spiky) over ()) / (max(spiky) over () - min(spiky) over ()), 6) as spiky,
      0.0::double as constant_num from dirty_orders""")
def scale_minmax(spark, sf):
    return rounded(fitted(load(spark, sf, "dirty_orders"), ["spiky", "constant_num"], [], scaler="minmax"), "spiky")


@query("scale_none", "select id, spiky, constant_num from dirty_orders")
def scale_none(spark, sf):
    return fitted(load(spark, sf, "dirty_orders"), ["spiky", "constant_num"], [])


@query("iqr_cap", """
    select id, round(least(greatest(spiky, s1 - 1.5 * (s3 - s1)), s3 + 1.5 * (s3 - s1)), 4) as spiky,
      least(greatest(mostly_zero, z1 - 1.5 * (z3 - z1)), z3 + 1.5 * (z3 - z1)) as mostly_zero
    from dirty_orders, (select quantile_cont(spiky, 0.25) as s1, quantile_cont(spiky, 0.75) as s3,
      quantile_cont(mostly_zero, 0.25) as z1, quantile_cont(mostly_zero, 0.75) as z3 from dirty_orders)""")
def iqr_cap(spark, sf):
    return rounded(fitted(load(spark, sf, "dirty_orders"), ["spiky", "mostly_zero"], [], outlier_handling="cap"),
                   "spiky", digits=4)


@query("iqr_remove", """
    select id, price, mostly_zero, removed from (
      select *, cast(sum(case when keep then 0 else 1 end) over () as bigint) as removed from (
        select id, price, mostly_zero,
          (price is null or (price >= p1 - 1.5 * (p3 - p1) and price <= p3 + 1.5 * (p3 - p1)))
          and (spiky is null or (spiky >= s1 - 1.5 * (s3 - s1) and spiky <= s3 + 1.5 * (s3 - s1)))
          and (mostly_zero is null or (mostly_zero >= z1 - 1.5 * (z3 - z1) and mostly_zero <= z3 + 1.5 * (z3 - z1)))
          as keep
        from dirty_orders, (select quantile_cont(price, 0.25) as p1, quantile_cont(price, 0.75) as p3,
          quantile_cont(spiky, 0.25) as s1, quantile_cont(spiky, 0.75) as s3,
          quantile_cont(mostly_zero, 0.25) as z1, quantile_cont(mostly_zero, 0.75) as z3 from dirty_orders)))
    where keep""")
def iqr_remove(spark, sf):
    kept, removed = prep.remove_outlier_rows(load(spark, sf, "dirty_orders"), ["price", "spiky", "mostly_zero"])
    return kept.select("id", "price", "mostly_zero", F.lit(removed).cast("bigint").alias("removed"))


# --- splitting ------------------------------------------------------------------------------------

def _sides(train, test, *columns):
    side = lambda df, name: df.select(*columns, F.lit(name).alias("split"))
    return side(train, "train").unionAll(side(test, "test"))


@query("split_stratified", f"""
    with {split_sql('dirty_orders', 'target').strip()}
    select id, target, case when is_test then 'test' else 'train' end as split from parted""")
def split_stratified(spark, sf):
    train, test, _ = split.train_test_split(load(spark, sf, "dirty_orders"), ["id"], "target")
    return _sides(train, test, "id", "target")


@query("split_many_classes", f"""
    with {split_sql('many_classes', 'target').strip()}
    select id, target, case when is_test then 'test' else 'train' end as split from parted""")
def split_many_classes(spark, sf):
    """A text target with 250 classes."""
    train, test, _ = split.train_test_split(load(spark, sf, "many_classes"), ["id"], "target")
    return _sides(train, test, "id", "target")


@query("split_lineitem", """
    select count(*) as n, ceil(0.25 * count(*))::bigint as n_test, true as whole from lineitem""")
def split_lineitem(spark, sf):
    """Two columns that are no key of the table: rows of one key are told apart, and the sides are exact and whole."""
    lines = load(spark, sf, "lineitem")
    train, test, _ = split.train_test_split(lines, ["l_orderkey", "l_shipdate"], "l_returnflag", 0.25, stratify=False)
    return train.select(F.lit(0).alias("t")).unionAll(test.select(F.lit(1).alias("t"))).agg(
        F.count("*").alias("n"), F.sum("t").alias("n_test")).withColumn("whole", F.lit(train.columns == lines.columns))


@query("split_plain", f"""
    select id, case when row_number() over (order by {hash_sql('id')}, id) <= ceil(0.25 * count(*) over ())
      then 'test' else 'train' end as split
    from dirty_orders where target is not null""")
def split_plain(spark, sf):
    train, test, _ = split.train_test_split(load(spark, sf, "dirty_orders"), ["id"], "target", 0.25, stratify=False)
    return _sides(train, test, "id")


def folds_sql(source: str, target: str, k: int, key: str = "id") -> str:
    """CTEs ending in `folded`: the source's rows with `fold`."""
    return f"""
    ranked as (select *, row_number() over (partition by {target} order by {hash_sql(key)}, {key}) as rn,
                 (select count(*) from {source} e where e.{target} < s.{target}) as earlier from {source} s),
    spread as (select {target} as c, (earlier + rn - 1) % {k} as fold,
                 row_number() over (partition by {target} order by (earlier + rn - 1) % {k}, rn) as place from ranked),
    folded as (select ranked.*, cast(spread.fold as integer) as fold from ranked
               join spread on ranked.{target} = spread.c and ranked.rn = spread.place)"""


@query("stratified_folds", f"""
    with {folds_sql('doc_model', 'label', 5).strip()}
    select id, label, fold from folded""")
def stratified_folds(spark, sf):
    return split.stratified_folds(load(spark, sf, "doc_model"), ["id"], "label", 5).select("id", "label", "fold")


# --- all of it ------------------------------------------------------------------------------------

SCALED = ["price", "spiky", "custkey", "mostly_zero"]


def prepared_sql(where: str, handled: str = "none") -> str:
    """CTEs and a select: features of CONFIG learned on the training side."""
    stats = ", ".join(f"avg({c}) as m_{c}" for c in SCALED)
    filled = ", ".join(f"coalesce({c}, m_{c}) as {c}" for c in SCALED)
    spread = ", ".join(f"avg({c}) as a_{c}, stddev_pop({c}) as s_{c}" for c in SCALED)
    scaled = ", ".join(f"round(({c} - a_{c}) / s_{c}, 6) as {c}" for c in SCALED)
    mode = fill_sql("priority", "most_frequent", "(select * from parted where not is_test)")
    return f"""
    means as (select {stats} from parted where not is_test),
    filled as (select id, target, is_test, {filled}, coalesce(priority, {mode}) as priority, flag from parted, means),
    spread as (select {spread} from filled where not is_test)
    select id, target, case when is_test then 'test' else 'train' end as split, {scaled}, 0.0::double as constant_num,
      {onehot_sql('priority', 'priority', PRIORITIES)},
      {onehot_sql('cast(flag as varchar)', 'flag', ['false', 'true'])}
    from filled, spread {where}"""


PREP_ALL = f"with {split_sql('dirty_orders', 'target').strip()}, {prepared_sql('').strip()}"


def prepared_columns(spark, sf):
    """Named feature columns of all rows with a target, marked by side."""
    marked, numeric, categorical, _, _ = prep.split_raw(load(spark, sf, "dirty_orders"), CONFIG, ["id"])
    p = Preparation.fit(marked.where(~F.col("is_test")), CONFIG, numeric, categorical)
    return rounded(p.to_columns(marked, ["id", "target", "is_test"]), *SCALED)


def side(flag):
    return F.when(flag, "test").otherwise("train").alias("split")


@query("prep_all", PREP_ALL)
def prep_all(spark, sf):
    return prepared_columns(spark, sf).withColumn("split", side(F.col("is_test"))).drop("is_test")


@query("prep_export", PREP_ALL)
def prep_export(spark, sf):
    """Both sides written partitioned by split, and read back in row order."""
    path = sinks.write_prepared(prepared_columns(spark, sf), "is_test")
    return sinks.read_prepared(spark, path, ["id"])


@query("feature_names", f"""
    select cast(i as bigint) as position, name from (values {', '.join(
        f"({i}, '{n}')" for i, n in enumerate(
            [*SCALED, 'constant_num', *[f'priority_{v}' for v in PRIORITIES], 'flag_false', 'flag_true']))}) v(i, name)
    where exists (select 1 from orders)""")
def feature_names(spark, sf):
    df = load(spark, sf, "dirty_orders")
    marked, numeric, categorical, _, _ = prep.split_raw(df, CONFIG, ["id"])
    return Preparation.fit(marked.where(~F.col("is_test")), CONFIG, numeric, categorical).feature_names(spark)


@query("prep_vector", f"""
    with {split_sql('dirty_orders', 'target').strip()},
    wide as ({('with dummy as (select 1), ' + prepared_sql('').strip())})
    select id, split, round({' + '.join(f'{c} * {i + 1}' for i, c in enumerate(SCALED))}, 6) as numeric_part,
      {' + '.join(f'"priority_{v}" * {i + 6}' for i, v in enumerate(PRIORITIES))}
      + flag_false * 11 + flag_true * 12 as category_part, cast(12 as integer) as width
    from wide""")
def prep_vector(spark, sf):
    """The feature vector of both sides, folded into position-weighted sums."""
    from pyspark.ml.functions import vector_to_array

    p = prep.preprocess(load(spark, sf, "dirty_orders"), CONFIG, ["id"])
    both = p.train.withColumn("split", F.lit("train")).unionByName(p.test.withColumn("split", F.lit("test")))
    v = both.withColumn("v", vector_to_array("features"))
    weighted = lambda lo, hi: sum((F.round(F.col("v")[i], 6) * (i + 1) for i in range(lo, hi)), F.lit(0.0))
    return rounded(v.select("id", "split", weighted(0, 4).alias("numeric_part"), weighted(5, 12).alias("category_part"),
                            F.size("v").alias("width")), "numeric_part")
