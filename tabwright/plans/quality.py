"""Queries: data-quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import profile, quality
from tabwright.plans.catalog import load, query, rounded, union_of
from tabwright.plans.profiling import MISSING
from tabwright.plans.tables import DIRTY, NUMBER_SQL

TYPED = ["id", "num_text", "mixed_text", "date_text", "code_text", "code_int", "tricky", "word"]


def fractions_sql(source: str, columns: list[str], text: set[str]) -> str:
    number = {c: NUMBER_SQL.format(f"cast({c} as varchar)") for c in columns}
    date = {c: (f"(regexp_matches(trim({c}), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') and "
                f"try_strptime(trim({c}), '%Y-%m-%d') is not null)") if c in text else "false" for c in columns}
    return union_of(
        "select '{c}' as \"column\", count({c}) as non_null, "
        "count(case when {number} then 1 end) / nullif(count({c}), 0) as nf, "
        "count(case when {date} then 1 end) / nullif(count({c}), 0) as dtf from " + source, columns,
        number=number, date=date)


_typed_text = {c for c in TYPED if c not in ("id", "code_int")}


@query("convertible_fraction", f"""
    select "column", round(coalesce(nf, 0), 6) as convertible
    from ({fractions_sql('typed_strings', TYPED, _typed_text)})""")
def convertible_fraction(spark, sf):
    return rounded(profile.convertible_fractions(load(spark, sf, "typed_strings")), "convertible")


def mismatch_sql(source: str, columns: list[str], text: set[str], number: set[str], declared: dict[str, str],
                 threshold: str) -> str:
    kinds = " ".join(f"when '{c}' then '{t}'" for c, t in declared.items())
    numbers = ", ".join(f"'{c}'" for c in sorted(number))
    return f"""
    select * from (
      select "column", declared_type, issue_type, round(nf, 6) as numeric_fraction, round(dtf, 6) as datetime_fraction,
        round(case issue_type when 'declared_numeric_mixed_types' then 1 - nf
              when 'datetime_like_strings' then dtf else nf end, 6) as confidence
      from (select *, case
          when declared_type = 'numeric' and not isnum and nf >= {threshold} then 'declared_numeric_string_values'
          when declared_type = 'numeric' and not isnum then 'declared_numeric_mixed_types'
          when declared_type = 'categorical' and isnum and nf >= {threshold} then 'categorical_as_numeric_dtype'
          when declared_type = 'categorical' and nf >= {threshold} then 'categorical_looks_numeric'
          when declared_type = 'unknown' and nf >= {threshold} and not isnum then 'numeric_like_strings'
          when declared_type = 'unknown' and dtf >= {threshold} then 'datetime_like_strings' end as issue_type
        from (select *, case "column" {kinds} else 'unknown' end as declared_type, "column" in ({numbers}) as isnum
              from ({fractions_sql(source, columns, text)}) where non_null > 0)))
    where issue_type is not null"""


DECLARED = {"num_text": "numeric", "mixed_text": "numeric", "code_text": "categorical", "code_int": "categorical"}


@query("type_mismatch", mismatch_sql("typed_strings", TYPED, _typed_text, {"id", "code_int"}, DECLARED, "0.9"))
def type_mismatch(spark, sf):
    return rounded(quality.type_mismatch(load(spark, sf, "typed_strings"), DECLARED), "numeric_fraction",
                   "datetime_fraction", "confidence")


@query("type_mismatch_open", mismatch_sql("typed_strings", TYPED, _typed_text, {"id", "code_int"}, {"word": "unknown"},
                                          "0.9"))
def type_mismatch_open(spark, sf):
    return rounded(quality.type_mismatch(load(spark, sf, "typed_strings")), "numeric_fraction", "datetime_fraction",
                   "confidence")


def imbalance_sql(source: str, target: str) -> str:
    return f"""
    select missing_target_count, round(lo, 6) as min_class_proportion, round(hi, 6) as max_class_proportion,
      round(lo / hi, 6) as imbalance_ratio, lo < 0.2 or lo / hi < 0.5 as is_imbalanced, '' as reason
    from (select min(n) / sum(n) as lo, max(n) / sum(n) as hi,
            (select count(*) - count({target}) from {source}) as missing_target_count
          from (select count(*) as n from {source} where {target} is not null group by {target}))"""


@query("imbalance_flag", f"select 'quality' as target, * from ({imbalance_sql('labels', 'quality')}) "
                         f"union all select 'target', * from ({imbalance_sql('dirty_orders', 'target')})")
def imbalance_flag(spark, sf):
    parts = [quality.imbalance(load(spark, sf, t), c).withColumn("target", F.lit(c))
             for t, c in (("labels", "quality"), ("dirty_orders", "target"))]
    return rounded(parts[0].unionByName(parts[1]), "min_class_proportion", "max_class_proportion", "imbalance_ratio")


@query("imbalance_distribution", """
    select skewed_target as class, count(*) as count, round(count(*) / sum(count(*)) over (), 6) as proportion
    from dirty_orders where skewed_target is not null group by 1""")
def imbalance_distribution(spark, sf):
    return rounded(quality.imbalance_distribution(load(spark, sf, "dirty_orders"), "skewed_target"), "proportion")


def cardinality_sql(source: str, columns: list[str], threshold: str) -> str:
    return f"""
    select "column", count(distinct v) as unique_values, round(100.0 * count(distinct v) / sum(k), 6) as unique_percent,
      arg_min(shown, (-k, shown)) as top_value, max(k) as top_count, round(100.0 * max(k) / sum(k), 6) as top_percent,
      arg_min(shown, (k, shown)) as bottom_value, min(k) as bottom_count,
      round(100.0 * min(k) / sum(k), 6) as bottom_percent,
      array_to_string(list_slice(list_sort(list(v) filter (where v is not null)), 1, 5), ', ') as sample_values
    from ({union_of("select '{c}' as \"column\", cast({c} as varchar) as v, coalesce(cast({c} as varchar), 'nan') as shown, "
                    "count(*) as k from " + source + " group by 2, 3", columns)})
    group by 1 having count(distinct v) > {threshold}"""


@query("high_cardinality", cardinality_sql("part", ["p_name", "p_brand", "p_type"], "50"))
def high_cardinality(spark, sf):
    return rounded(quality.high_cardinality(load(spark, sf, "part")), "unique_percent", "top_percent",
                   "bottom_percent")


@query("high_cardinality_names", cardinality_sql("customer", ["c_name", "c_mktsegment"], "50"))
def high_cardinality_names(spark, sf):
    return rounded(quality.high_cardinality(load(spark, sf, "customer")), "unique_percent", "top_percent",
                   "bottom_percent")


_dirty_text = {"priority", "target", "skewed_target"}
_fractions = fractions_sql("dirty_orders", DIRTY, _dirty_text).replace("cast(flag as varchar)", "'no'")
THRESHOLDS = f"""
    rates as (select missing_count / (select count(*) from dirty_orders) as rate from ({MISSING})),
    props as (select count(*) / sum(count(*)) over () as p from dirty_orders group by skewed_target),
    uniq as (select (select count(distinct priority) from dirty_orders) / count(*) as u from dirty_orders
             union all select (select count(distinct target) from dirty_orders) / count(*) from dirty_orders),
    conv as (select coalesce(nf, 0) as f from ({_fractions})),
    est as (
      select 'min_class_proportion' as name, round_even(least(greatest(quantile_cont(p, 0.05),
        2 / (select count(*) from dirty_orders)), 0.4), 3) as value from props
      union all select 'imbalance_ratio', round_even(greatest(least(0.8 * min(p) / max(p), 0.9), 0.1), 2) from props
      union all select 'missingness_threshold_pct',
        round_even(100 * least(quantile_cont(rate, 0.75), avg(rate) + stddev_samp(rate)), 1) from rates
      union all select 'high_cardinality_threshold', cast(greatest(2, trunc(least(quantile_cont(u, 0.9), 0.95)
        * (select count(*) from dirty_orders))) as double) from uniq
      union all select 'datatype_mismatch_threshold', round_even(greatest(quantile_cont(f, 0.1), 0.8), 2) from conv)"""


@query("estimated_thresholds", f"with {THRESHOLDS.strip()} select * from est")
def estimated_thresholds(spark, sf):
    return quality.thresholds_table(load(spark, sf, "dirty_orders"), "skewed_target")


def _t(name: str) -> str:
    return f"(select value from est where name = '{name}')"


@query("issues_all", f"""
    with {THRESHOLDS.strip()},
    bal as (select min(n) / max(n) as ratio, min(n) / sum(n) as lo from
            (select count(*) as n from dirty_orders where skewed_target is not null group by skewed_target))
    select 'class_imbalance' as issue, 'skewed_target' as subject, 'imbalance_ratio' as detail, round(ratio, 6) as value
    from bal where lo < {_t('min_class_proportion')} or ratio < {_t('imbalance_ratio')}
    union all
    select 'high_cardinality', "column", top_value, cast(unique_values as double)
    from ({cardinality_sql('dirty_orders', ['priority', 'target'], _t('high_cardinality_threshold'))})
    union all
    select 'datatype_mismatch', "column", issue_type, confidence
    from ({mismatch_sql('dirty_orders', [c for c in DIRTY if c != 'skewed_target'], _dirty_text,
                        set(DIRTY) - _dirty_text, {}, _t('datatype_mismatch_threshold'))
           .replace('case "column"  else', 'case when false then null else')
           .replace('cast(flag as varchar)', "'no'")})
    union all
    select 'high_missingness', "column", 'missing_percent', missing_percent
    from ({MISSING}) where missing_percent >= {_t('missingness_threshold_pct')}""")
def issues_all(spark, sf):
    return rounded(quality.issues(load(spark, sf, "dirty_orders"), "skewed_target"), "value")


@query("hash_sample", """
    select event_id, value from events
    order by ('0x' || substr(md5('42|' || event_id), 1, 8))::bigint, event_id limit 5000""")
def hash_sample(spark, sf):
    return quality.hash_sample(load(spark, sf, "events").select("event_id", "value"), ["event_id"])


@query("schema_check", """
    select 'l_comment' as "column", 'missing' as status, 'string' as expected, cast(null as varchar) as actual,
      cast(null as bigint) as non_null
    union all select 'l_quantity', 'type_mismatch', 'bigint', 'double', count(l_quantity) from lineitem
    union all select 'l_tax', 'unexpected', null, 'double', count(l_tax) from lineitem""")
def schema_check(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_tax")
    return quality.schema_violations(df, {"l_orderkey": "bigint", "l_quantity": "bigint", "l_comment": "string"})


@query("range_check", """
    select 'l_quantity' as "column", count(case when l_quantity < 5 then 1 end) as below,
      count(case when l_quantity > 45 then 1 end) as above, count(l_quantity) as total from lineitem
    union all
    select 'l_discount', 0, count(case when l_discount > 0.09 then 1 end), count(l_discount) from lineitem""")
def range_check(spark, sf):
    return quality.range_violations(load(spark, sf, "lineitem"),
                                    {"l_quantity": (5.0, 45.0), "l_discount": (None, 0.09)})


@query("clean_columns", 'select p_partkey as part_key, p_name as part_name, p_brand as part_name_1 from part')
def clean_columns(spark, sf):
    df = load(spark, sf, "part").select(F.col("p_partkey").alias("part key"), F.col("p_name").alias("part-name"),
                                        F.col("p_brand").alias("part name"))
    return quality.clean_column_names(df)
