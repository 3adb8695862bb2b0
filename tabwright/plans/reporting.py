"""Queries: report sections, figure data, the stored bundle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import evaluate, profile, quality, report
from tabwright.operators.prep import PrepConfig
from tabwright.plans.catalog import load, query
from tabwright.plans.modelling import COMPARISON, RANKED, compared
from tabwright.plans.profiling import corr_sql, histogram_sql, iqr_sql, stats_sql, top_counts_sql
from tabwright.plans.quality import imbalance_sql
from tabwright.sources import sinks

COLUMNS = ["n_chars", "n_words", "lang", "source", "label"]
MEASURES = ["n_chars", "n_words"]
DECLARED = {"n_chars": "numeric", "n_words": "numeric", "lang": "categorical", "source": "categorical"}


def document_profile(spark, sf):
    df = load(spark, sf, "doc_model").select(*COLUMNS)
    return profile.profile(df, "label", DECLARED, bins=10)


def ranked(spark, sf):
    return evaluate.rank_models(compared(spark, sf), "f1_score")


_missing = "\nunion all\n".join(
    f"select '{c}' as \"column\", count(*) - count({c}) as missing_count, "
    f"100.0 * (count(*) - count({c})) / count(*) as missing_percent from doc_model" for c in COLUMNS)
_order = "row_number() over (order by"


def _cells(source: str, number: int, name: str, item: str, measure: str, value: str, text: str = "null") -> str:
    value = f"round(cast({value} as double), 4)" if value != "null" else "null::double"
    text = "null::varchar" if text == "null" else text
    return (f"select {number} as section, '{name}' as name, cast(pos as integer) as position, {item} as item, "
            f"'{measure}' as measure, {value} as value, {text} as text from {source}")


@query("report_sections", f"""
    {COMPARISON.strip()}, ranked as ({RANKED}),
    missing as (select *, {_order} missing_percent desc, missing_count desc, "column") as pos from ({_missing})),
    outlying as (select *, {_order} outlier_count desc, outlier_percent desc, "column") as pos
                 from ({iqr_sql('doc_model', MEASURES)})),
    stats as (select *, case "column" when 'n_chars' then 1 else 2 end as pos from ({stats_sql('doc_model', MEASURES)})),
    lead as (select arg_min(model, rank) as best_model, 1 as pos from ranked),
    ordered as (select *, rank as pos from ranked)
    {_cells('missing', 2, 'missing_values', '"column"', 'missing_count', 'missing_count')}
    union all {_cells('missing', 2, 'missing_values', '"column"', 'missing_percent', 'missing_percent')}
    union all {_cells('outlying', 3, 'outliers', '"column"', 'outlier_count', 'outlier_count')}
    union all {_cells('outlying', 3, 'outliers', '"column"', 'outlier_percent', 'outlier_percent')}
    union all select 4, 'correlations', 1, 'matrix', 'columns', 2.0, null
    union all {_cells('stats', 5, 'distributions', '"column"', 'mean', 'mean')}
    union all {_cells('stats', 5, 'distributions', '"column"', 'std', 'std')}
    union all {_cells('lead', 6, 'best_model', "'f1_score'", 'best_model', 'null', 'best_model')}
    union all {' union all '.join(_cells('ordered', 7, 'comparison', 'model', m, m) for m in evaluate.METRICS)}""")
def report_sections(spark, sf):
    return report.report_sections(document_profile(spark, sf), ranked(spark, sf), "f1_score")


@query("report_overview", f"""
    {COMPARISON.strip()}, ranked as ({RANKED}),
    facts as (select count(*) as n, 1 as pos from doc_model),
    bal as (select * from ({imbalance_sql('doc_model', 'label')}) where is_imbalanced),
    lead as (select arg_min(model, rank) as best_model, 1 as pos from ranked),
    steps as (select * from (values (1, 'numeric_imputer', 'mean'), (2, 'outliers', 'none'), (3, 'scaler', 'standard'),
      (4, 'categorical_imputer', 'most_frequent'), (5, 'encoder', 'onehot'), (6, 'test_size', '0.2')) t(pos, step, choice))
    {_cells('facts', 1, 'overview', "'dataset'", 'rows', 'n')}
    union all {_cells('facts', 1, 'overview', "'dataset'", 'columns', '5')}
    union all {_cells('(select *, 1 as pos from bal)', 2, 'issues', "'label'", 'finding', 'imbalance_ratio',
                      "'class_imbalance: imbalance_ratio'")}
    union all {_cells('steps', 3, 'preparation', 'step', 'choice', 'null', 'choice')}
    union all {_cells('lead', 4, 'recommendation', "'model'", 'use', 'null', 'best_model')}""")
def report_overview(spark, sf):
    df = load(spark, sf, "doc_model").select(*COLUMNS)
    limits = {"min_class_proportion": 0.2, "imbalance_ratio": 0.5, "missingness_threshold_pct": 20.0,
              "high_cardinality_threshold": 50, "datatype_mismatch_threshold": 0.9}
    found = quality.issues(df, "label", DECLARED, limits)
    return report.overview_sections(df, found, PrepConfig(target="label"), ranked(spark, sf))


FIGURES = f"""
    select 'missingness' as figure, "column" as x, missing_percent as y from ({_missing})
    union all select 'outliers', "column", outlier_percent from ({iqr_sql('doc_model', MEASURES)})
    union all select 'correlations', col_a || ' / ' || col_b, corr from ({corr_sql('doc_model', MEASURES)})
    union all select 'hist_' || "column", cast(bin as varchar), count::double from ({histogram_sql('doc_model', MEASURES, 10)})
    union all select 'centre_' || "column", cast(bin as varchar), round((lower + upper) / 2, 4)
    from ({histogram_sql('doc_model', MEASURES, 10)})
    union all select 'bar_' || "column", value, count::double from ({top_counts_sql('doc_model', ['lang', 'source'])})"""


def figures(spark, sf):
    df = report.figure_data(document_profile(spark, sf))
    digits = F.when(F.col("figure").startswith("centre_"), F.round("y", 4)).otherwise(F.round("y", 6))
    return df.withColumn("y", digits)


@query("figure_data", f"select figure, x, round(y, 6) as y from ({FIGURES})")
def figure_data(spark, sf):
    return figures(spark, sf)


@query("report_bundle", f"""
    with fig as ({FIGURES}), missing as ({_missing})
    select 'figures' as "table", count(*) as n_rows from fig
    union all select 'missing', count(*) from missing
    union all select 'outliers', count(*) from ({iqr_sql('doc_model', MEASURES)})
    union all select 'correlations', 1
    union all select 'category_counts', count(*) from ({top_counts_sql('doc_model', ['lang', 'source'])})""")
def report_bundle(spark, sf):
    """Report tables written to one folder and read back."""
    p = document_profile(spark, sf)
    tables = {"figures": report.figure_data(p), **{k: p[k] for k in ("missing", "outliers", "correlations",
                                                                     "category_counts")}}
    path = sinks.write_report(tables, spark)
    return sinks.table_sizes(sinks.read_report(spark, path, list(tables)))
