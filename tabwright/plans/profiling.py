"""Queries: missing values, correlations, outliers, distributions, the full profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import profile
from tabwright.plans.catalog import load, query, rounded, union_of
from tabwright.plans.tables import DIRTY

MISSING = union_of(
    "select '{c}' as \"column\", count(*) - count({c}) as missing_count, "
    "round(100.0 * (count(*) - count({c})) / count(*), 6) as missing_percent from dirty_orders", DIRTY)


@query("missing_table", MISSING)
def missing_table(spark, sf):
    return rounded(profile.missing_values(load(spark, sf, "dirty_orders")), "missing_percent")


@query("missing_nan", union_of(
    "select '{c}' as \"column\", count(*) - count({v}) as missing_count, "
    "round(100.0 * (count(*) - count({v})) / count(*), 6) as missing_percent from nan_events",
    ["id", "event_type", "value"],
    v={"id": "id", "event_type": "event_type", "value": "case when not isnan(value) then value end"}))
def missing_nan(spark, sf):
    return rounded(profile.missing_values(load(spark, sf, "nan_events")), "missing_percent")


@query("missing_total", f"select cast(sum(missing_count) as bigint) as total_missing from ({MISSING})")
def missing_total(spark, sf):
    return profile.missing_total(load(spark, sf, "dirty_orders"))


@query("high_missing", f"select * from ({MISSING}) where missing_percent >= 14")
def high_missing(spark, sf):
    return rounded(profile.high_missing(load(spark, sf, "dirty_orders"), 14.0), "missing_percent")


_bits = " || ".join(f"case when {c} is null then '1' else '0' end" for c in DIRTY)


@query("missing_patterns", f"select {_bits} as pattern, count(*) as count from dirty_orders group by 1")
def missing_patterns(spark, sf):
    return profile.missing_patterns(load(spark, sf, "dirty_orders"))


# --- correlations ---------------------------------------------------------------------------------

MEASURES = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def pairs(columns):
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]


def corr_sql(source: str, columns: list[str]) -> str:
    return "\nunion all\n".join(f"""
        select '{a}' as col_a, '{b}' as col_b, round(covar_pop({a}, {b}) / nullif(
          stddev_pop(case when {b} is not null then {a} end) * stddev_pop(case when {a} is not null then {b} end), 0), 6)
          as corr from {source}""" for a, b in pairs(columns))


@query("corr_pearson", corr_sql("lineitem", MEASURES))
def corr_pearson(spark, sf):
    return rounded(profile.correlations(load(spark, sf, "lineitem").select(*MEASURES)), "corr")


@query("corr_many_columns", corr_sql("wide_orders", [f"m{k}" for k in range(1, 33)]))
def corr_many_columns(spark, sf):
    """No column is left out unless a limit is asked for."""
    return rounded(profile.correlations(load(spark, sf, "wide_orders").drop("id")), "corr")


GAPPY = ["price", "spiky", "custkey", "constant_num", "mostly_zero"]


@query("corr_pearson_gaps", corr_sql("dirty_orders", GAPPY))
def corr_pearson_gaps(spark, sf):
    return rounded(profile.correlations(load(spark, sf, "dirty_orders").select(*GAPPY)), "corr")


def spearman_sql(source: str, columns: list[str]) -> str:
    return "\nunion all\n".join(f"""
        select '{a}' as col_a, '{b}' as col_b,
          round(covar_pop(ra, rb) / nullif(stddev_pop(ra) * stddev_pop(rb), 0), 6) as corr
        from (select rank() over (order by {a}) + (count(*) over (partition by {a}) - 1) / 2.0 as ra,
                rank() over (order by {b}) + (count(*) over (partition by {b}) - 1) / 2.0 as rb
              from {source} where {a} is not null and {b} is not null)""" for a, b in pairs(columns))


@query("corr_spearman", spearman_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def corr_spearman(spark, sf):
    return rounded(profile.spearman(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]),
                   "corr")


@query("corr_spearman_gaps", spearman_sql("dirty_orders", ["price", "spiky", "custkey"]))
def corr_spearman_gaps(spark, sf):
    return rounded(profile.spearman(load(spark, sf, "dirty_orders"), ["price", "spiky", "custkey"]), "corr")


@query("corr_kendall", "\nunion all\n".join(f"""
    select '{a}' as col_a, '{b}' as col_b, round(sum(sign(p.{a} - q.{a}) * sign(p.{b} - q.{b})) / nullif(sqrt(
      cast(sum(case when p.{a} <> q.{a} then 1 else 0 end) as double)
      * sum(case when p.{b} <> q.{b} then 1 else 0 end)), 0), 6) as corr
    from part p, part q""" for a, b in pairs(["p_partkey", "p_size", "p_retailprice"])))
def corr_kendall(spark, sf):
    return rounded(profile.correlations(load(spark, sf, "part"), "kendall"), "corr")


# --- outliers -------------------------------------------------------------------------------------

def iqr_sql(source: str, columns: list[str]) -> str:
    rows = union_of(
        "select '{c}' as \"column\", 'iqr' as method, count({c}) as non_null_count, "
        "count(case when hi > lo and ({c} < lo or {c} > hi) then 1 end) as outlier_count "
        "from " + source + ", (select q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from "
        "(select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from " + source + "))", columns)
    return f"""select *, round(coalesce(100.0 * outlier_count / nullif(non_null_count, 0), 0), 6) as outlier_percent
        from ({rows})"""


@query("outliers_iqr", iqr_sql("events", ["event_id", "user_id", "value"]))
def outliers_iqr(spark, sf):
    df = load(spark, sf, "events").select("event_id", "user_id", "value")
    return rounded(profile.outliers(df), "outlier_percent")


DIRTY_NUMERIC = ["id", "price", "spiky", "custkey", "all_null", "constant_num", "mostly_zero"]


@query("outliers_iqr_gaps", iqr_sql("dirty_orders", DIRTY_NUMERIC))
def outliers_iqr_gaps(spark, sf):
    return rounded(profile.outliers(load(spark, sf, "dirty_orders")), "outlier_percent")


@query("outliers_zscore", """
    select 'n_chars' as "column", 'zscore' as method, count(n_chars) as non_null_count,
      count(case when abs((n_chars - m) / s) > 3 then 1 end) as outlier_count,
      round(100.0 * count(case when abs((n_chars - m) / s) > 3 then 1 end) / count(n_chars), 6) as outlier_percent
    from documents, (select avg(n_chars) as m, stddev_pop(n_chars) as s from documents)""")
def outliers_zscore(spark, sf):
    return rounded(profile.outliers(load(spark, sf, "documents").select("n_chars"), "zscore"), "outlier_percent")


@query("outliers_zscore_inf", """
    select c as "column", 'zscore' as method, n as non_null_count, o as outlier_count, round(100.0 * o / n, 6) as outlier_percent
    from (select 'value' as c, count(*) as n, 0::bigint as o from events union all
          select 'plain', count(*), count(case when abs((value - m) / s) > 2 then 1 end)
          from events, (select avg(value) as m, stddev_pop(value) as s from events))""")
def outliers_zscore_inf(spark, sf):
    """Infinite values leave a column without a spread, hence without outliers."""
    found = profile.outliers(load(spark, sf, "inf_events").drop("id"), "zscore", zscore_threshold=2.0)
    return rounded(found, "outlier_percent")


# --- distributions --------------------------------------------------------------------------------

def histogram_sql(source: str, columns: list[str], bins: int) -> str:
    return "\nunion all\n".join(f"""
        select '{c}' as "column", cast(b as integer) as bin, round(lo + w * b, 6) as lower,
          round(lo + w * (b + 1), 6) as upper, coalesce(n, 0) as count
        from (select lo, (hi - lo) / {bins} as w from (
                select case when min({c}) < max({c}) then min({c}) else min({c}) - 0.5 end as lo,
                  case when min({c}) < max({c}) then max({c}) else max({c}) + 0.5 end as hi from {source})),
             (select unnest(range({bins})) as b)
        left join (select least(floor(({c} - lo2) / (hi2 - lo2) * {bins}), {bins - 1}) as k, count(*) as n
              from {source}, (select case when min({c}) < max({c}) then min({c}) else min({c}) - 0.5 end as lo2,
                  case when min({c}) < max({c}) then max({c}) else max({c}) + 0.5 end as hi2 from {source})
              where {c} is not null group by 1) on k = b""" for c in columns)


@query("histogram", histogram_sql("dirty_orders", ["spiky", "constant_num", "mostly_zero"], 30))
def histogram(spark, sf):
    df = load(spark, sf, "dirty_orders")
    return rounded(profile.histogram(df, ["spiky", "constant_num", "mostly_zero"]), "lower", "upper")


def stats_sql(source: str, columns: list[str]) -> str:
    return union_of(
        "select '{c}' as \"column\", count({c}) as n, round(avg({c}), 4) as mean, round(stddev_pop({c}), 4) as std, "
        "cast(min({c}) as double) as min, cast(max({c}) as double) as max from " + source, columns)


@query("numeric_stats", stats_sql("dirty_orders", DIRTY_NUMERIC))
def numeric_stats(spark, sf):
    return rounded(profile.numeric_stats(load(spark, sf, "dirty_orders")), "mean", "std", digits=4)


CATEGORIES = ["p_name", "p_brand", "p_type", "p_size"]


def counts_sql(source: str, columns: list[str]) -> str:
    return union_of(
        "select '{c}' as \"column\", coalesce(cast({c} as varchar), 'nan') as value, count(*) as count, "
        "(select count(*) from " + source + ") as n from " + source + " group by 2", columns)


def top_counts_sql(source: str, columns: list[str], top: int = 50) -> str:
    return f"""select * from (select *, cast(row_number() over (partition by "column" order by count desc, value)
        as integer) as rank from ({counts_sql(source, columns)})) where rank <= {top}"""


@query("value_counts_top", top_counts_sql("part", CATEGORIES))
def value_counts_top(spark, sf):
    return profile.category_counts(load(spark, sf, "part"), CATEGORIES)


@query("value_counts_all", counts_sql("dirty_orders", ["priority", "flag", "target", "skewed_target"]))
def value_counts_all(spark, sf):
    return profile.category_counts(load(spark, sf, "dirty_orders"), ["priority", "flag", "target", "skewed_target"],
                                   top=None)


@query("box_stats", union_of("""
    select '{c}' as "column", min({c}) as min, round(any_value(q1), 4) as q1, round(any_value(q2), 4) as median,
      round(any_value(q3), 4) as q3, max({c}) as max,
      min(case when {c} >= q1 - 1.5 * (q3 - q1) then {c} end) as whisker_low,
      max(case when {c} <= q3 + 1.5 * (q3 - q1) then {c} end) as whisker_high
    from dirty_orders, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as q2,
                          quantile_cont({c}, 0.75) as q3 from dirty_orders)""", ["price", "spiky", "mostly_zero"]))
def box_stats(spark, sf):
    return rounded(profile.box_stats(load(spark, sf, "dirty_orders"), ["price", "spiky", "mostly_zero"]),
                   "q1", "median", "q3", digits=4)


@query("column_summary", union_of("""
    select '{c}' as "column", count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
      cast(min({c}) as double) as min, round(quantile_cont({c}, 0.25), 4) as q1,
      round(quantile_cont({c}, 0.5), 4) as median, round(quantile_cont({c}, 0.75), 4) as q3,
      cast(max({c}) as double) as max
    from lineitem""", MEASURES))
def column_summary(spark, sf):
    return rounded(profile.column_summary(load(spark, sf, "lineitem"), MEASURES), "mean", "std", "q1", "median", "q3",
                   digits=4)


@query("kde", """
    with s as (select count(value) as n, min(value) as lo, max(value) as hi,
                 stddev_samp(value) * power(count(value), -0.2) as h from events),
    bins as (select (least(floor((value - lo) / (hi - lo) * 200), 199) + 0.5) * (hi - lo) / 200 + lo as c,
               count(*) as k from events, s group by 1),
    grid as (select lo + (hi - lo) * i / 49 as x from s, (select unnest(range(50)) as i))
    select round(x, 6) as x,
      round(sum(k * exp(-((x - c) / h) * ((x - c) / h) / 2) / (n * h * 2.5066282746310002)), 6) as density
    from grid, bins, s group by x""")
def kde(spark, sf):
    return rounded(profile.kde(load(spark, sf, "events"), "value"), "x", "density")


# --- the whole profile in long form ---------------------------------------------------------------

_declared = {"priority": "categorical", "flag": "categorical", "price": "numeric", "spiky": "numeric",
             "custkey": "numeric", "constant_num": "numeric", "mostly_zero": "numeric"}
_measured = ["price", "spiky", "custkey", "constant_num", "mostly_zero"]
_profiled = _measured + ["priority", "flag", "target"]


@query("profile_all", f"""
    with base as (select {', '.join(_profiled)} from dirty_orders),
    missing as ({MISSING}),
    outlying as ({iqr_sql('dirty_orders', _measured)}),
    paired as ({corr_sql('dirty_orders', _measured)}),
    stats as ({stats_sql('dirty_orders', _measured)}),
    hist as ({histogram_sql('dirty_orders', _measured, 10)}),
    cats as ({top_counts_sql('dirty_orders', ['priority', 'flag'])})
    select 'missing' as section, "column" as item, 'percent' as measure, missing_percent as value
    from missing where "column" in ({', '.join(repr(c) for c in _profiled)})
    union all select 'outliers', "column", 'count', cast(outlier_count as double) from outlying
    union all select 'correlation', col_a, col_b, corr from paired
    union all select 'stats', "column", 'mean', mean from stats
    union all select 'histogram', "column", cast(bin as varchar), cast(count as double) from hist
    union all select 'categories', "column", value, cast(count as double) from cats""")
def profile_all(spark, sf):
    df = load(spark, sf, "dirty_orders").select(*_profiled)
    p = profile.profile(df, "target", _declared, bins=10)
    parts = [
        rounded(p["missing"], "missing_percent").select(
            F.lit("missing").alias("section"), F.col("column").alias("item"), F.lit("percent").alias("measure"),
            F.col("missing_percent").alias("value")),
        p["outliers"].select(F.lit("outliers"), "column", F.lit("count"), F.col("outlier_count").cast("double")),
        rounded(p["correlations"], "corr").select(F.lit("correlation"), "col_a", "col_b", "corr"),
        rounded(p["numeric_stats"], "mean", digits=4).select(F.lit("stats"), "column", F.lit("mean"), "mean"),
        p["histograms"].select(F.lit("histogram"), "column", F.col("bin").cast("string"),
                               F.col("count").cast("double")),
        p["category_counts"].select(F.lit("categories"), "column", "value", F.col("count").cast("double")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out
