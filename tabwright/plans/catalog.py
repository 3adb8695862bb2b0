"""Registration of queries, table access and the derived views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Derived views: the same SQL text in Spark and in the checking engine.
VIEWS = {
    "dirty_orders": """
        select o_orderkey as id,
          case when o_orderkey % 10 = 3 then null else o_totalprice end as price,
          case when o_orderkey % 500 = 0 then o_totalprice * 20 else o_totalprice end as spiky,
          case when o_orderkey % 7 = 0 then null else o_orderpriority end as priority,
          case when o_orderkey % 4 <> 1 then null else o_custkey end as custkey,
          cast(null as double) as all_null, cast(7 as double) as constant_num,
          cast(case when o_orderkey % 20 = 0 then 1 else 0 end as double) as mostly_zero,
          (o_orderkey % 2 = 0) as flag,
          case when o_orderkey % 100 = 99 then null else o_orderstatus end as target,
          case when o_orderkey % 50 = 0 then 'rare' when o_orderkey % 3 = 0 then 'mid' else 'common' end
            as skewed_target
        from orders""",
    "typed_strings": """
        select event_id as id,
          case when event_id % 20 = 0 then 'n/a' else cast(value as string) end as num_text,
          case when event_id % 3 = 0 then 'x' else cast(value as string) end as mixed_text,
          concat('2024-01-', lpad(cast(event_id % 28 + 1 as string), 2, '0')) as date_text,
          cast(event_id % 4 as string) as code_text, event_id % 4 as code_int,
          case event_id % 6 when 0 then '1d' when 1 then '1_000' when 2 then 'nan' when 3 then ''
                            when 4 then ' 1e3 ' else 'inf' end as tricky,
          event_type as word
        from events""",
    "nan_events": """
        select event_id as id, event_type,
          case when event_id % 25 = 0 then cast('NaN' as double)
               when event_id % 40 = 1 then null else value end as value
        from events""",
    "inf_events": """
        select event_id as id, case when event_id % 997 = 0 then cast('Infinity' as double) else value end as value,
          value as plain
        from events""",
    "many_classes": """
        select o_orderkey as id, concat('c', cast(o_custkey % 250 as string)) as target from orders""",
    "wide_orders": "select o_orderkey as id, " + ", ".join(
        f"cast((o_orderkey * {k} + o_custkey) % {89 + k} as double) as m{k}" for k in range(1, 33)) + " from orders",
    "ties": """
        select n_nationkey as id, n_regionkey as num_tie, cast(n_regionkey as string) as str_tie from nation""",
    "doc_model": """
        select d.doc_id as id, l.quality as label, l.toxic, d.n_chars,
          cast(length(d.text) - length(replace(d.text, ' ', '')) + 1 as bigint) as n_words, d.lang, d.source
        from documents d join labels l on d.doc_id = l.doc_id""",
    "score_new": """
        select o_orderkey as id, o_totalprice as spiky,
          case when o_orderkey % 5 = 0 then 'NEVER_SEEN' else o_orderpriority end as priority,
          o_orderstatus as target, o_custkey as extra_col
        from orders""",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, or a derived view of it."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    used = {t: load(spark, sf_dir, t) for t in TABLES if f"from {t}" in sql or f"join {t}" in sql}
    for t in used:
        sql = sql.replace(f"from {t}", f"from {{{t}}}").replace(f"join {t}", f"join {{{t}}}")
    return spark.sql(sql, **used)


def with_views(sql: str) -> str:
    """Put the derived views that a check names in front of it as common table expressions."""
    used = [f"{name} as ({body})" for name, body in VIEWS.items() if name in sql]
    if not used:
        return sql
    sql = sql.strip()
    head = "with " + ",\n".join(used)
    return f"{head},\n{sql[5:]}" if sql.lower().startswith("with ") else f"{head}\n{sql}"


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn
    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round result columns, so that both engines agree on the last digits."""
    from tabwright.functions.exprs import col, tidy

    return df.withColumns({c: tidy(col(c), digits) for c in columns})


def union_of(template: str, columns: list[str], **by_column: dict) -> str:
    """The SQL template once per column; {c} is the column, {i} its position."""
    return "\nunion all\n".join(
        template.format(c=c, i=i, **{k: v[c] for k, v in by_column.items()}) for i, c in enumerate(columns))
