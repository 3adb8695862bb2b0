"""Queries: table metadata, projections, value maps, column types, targets."""

from __future__ import annotations

from tabwright.operators import coltypes, table
from tabwright.plans.catalog import load, query, rounded, union_of

ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderpriority": "string"}
ORDER_COLUMNS = list(ORDER_TYPES)
LINE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax"]


def orders(spark, sf):
    return load(spark, sf, "orders").select(*ORDER_COLUMNS)


_values = ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(ORDER_TYPES.items()))


@query("shape_info", f"""
    select (select count(*) from orders) as n_rows, cast(5 as bigint) as n_columns, v.*
    from (values {_values}) v(position, "column", dtype)""")
def shape_info(spark, sf):
    return table.dataset_info(orders(spark, sf))


@query("preview_head", f"select {', '.join(ORDER_COLUMNS)} from orders order by o_orderkey limit 5")
def preview_head(spark, sf):
    return table.preview(orders(spark, sf), ["o_orderkey"])


@query("preview_tail", f"select {', '.join(ORDER_COLUMNS)} from orders order by o_orderkey desc limit 5")
def preview_tail(spark, sf):
    return table.preview(orders(spark, sf), ["o_orderkey"], tail=True)


@query("feature_subset", "select l_quantity, l_extendedprice, l_linestatus from lineitem")
def feature_subset(spark, sf):
    return table.features_of(load(spark, sf, "lineitem"), "l_returnflag",
                             ["l_quantity", "l_extendedprice", "l_linestatus"])


@query("target_dropped", "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders")
def target_dropped(spark, sf):
    return table.features_of(orders(spark, sf), "o_orderstatus")


@query("numeric_columns", f"select {', '.join(LINE_NUMERIC)} from lineitem")
def numeric_columns(spark, sf):
    df = load(spark, sf, "lineitem")
    return df.select(*table.numeric_columns(df))


@query("non_numeric_columns", "select c_name, c_mktsegment from customer")
def non_numeric_columns(spark, sf):
    df = load(spark, sf, "customer")
    return df.select(*table.non_numeric_columns(df))


@query("capped_columns", "select l_orderkey, l_partkey, l_suppkey from lineitem")
def capped_columns(spark, sf):
    df = load(spark, sf, "lineitem")
    return df.select(*table.capped(table.numeric_columns(df), 3, "Preview")[0])


@query("realigned_target", """
    select f.o_orderkey, f.o_totalprice, l.o_orderstatus
    from orders f left join orders l on f.o_orderkey = l.o_orderkey""")
def realigned_target(spark, sf):
    df = orders(spark, sf)
    return table.realign(df.select("o_orderkey", "o_totalprice"), df.select("o_orderkey", "o_orderstatus"),
                         ["o_orderkey"])


@query("value_remap", """
    select o_orderkey,
      case o_orderpriority when '1-URGENT' then 'high' when '2-HIGH' then 'high' when '5-LOW' then 'low'
        else o_orderpriority end as o_orderpriority,
      o_totalprice
    from orders""")
def value_remap(spark, sf):
    maps = {"o_orderpriority": {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "low"}, "o_totalprice": {"1": "2"}}
    types = {"o_orderpriority": "categorical", "o_totalprice": "numeric"}
    return table.remap_values(load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"),
                              maps, types)


@query("distinct_categories", "select distinct p_brand as value from part order by 1 limit 50")
def distinct_categories(spark, sf):
    return table.distinct_categories(load(spark, sf, "part"), "p_brand", 50)


NUMBER_SQL = (r"regexp_matches(trim({0}, e' \t\n\r\f\x0b'), "
              r"'^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$', 'i')")


@query("coerce_values", f"""
    select id, case when {NUMBER_SQL.format('tricky')} then try_cast(trim(tricky) as double) end as tricky,
      nullif(trim(word), '') as word
    from typed_strings""")
def coerce_values(spark, sf):
    return table.coerce_columns(load(spark, sf, "typed_strings").select("id", "tricky", "word"), ["tricky"], ["word"])


@query("fingerprint", """
    with t as (select cast(o_orderkey as varchar) as a, cast(o_custkey as varchar) as b, o_orderstatus as c, o_orderpriority as d from orders),
    d as (select md5(concat_ws(',', coalesce(length(a) || ':' || a, '-'), coalesce(length(b) || ':' || b, '-'),
                               coalesce(length(c) || ':' || c, '-'), coalesce(length(d) || ':' || d, '-'))) as m from t)
    select count(*) as n_rows, bit_xor(('0x' || substr(m, 1, 8))::bigint) as xor_hash,
      cast(sum(('0x' || substr(m, 9, 8))::bigint) as varchar) as sum_hash,
      'o_orderkey:bigint, o_custkey:bigint, o_orderstatus:string, o_orderpriority:string' as schema
    from d""")
def fingerprint(spark, sf):
    return table.fingerprint(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                              "o_orderpriority"))


# --- column types ---------------------------------------------------------------------------------

LINE_COLUMNS = LINE_NUMERIC + ["l_returnflag", "l_linestatus"]
_line_kind = {c: "num" if c in LINE_NUMERIC else "text" for c in LINE_COLUMNS}
_line_whole = {c: f"bool_and({c} = round({c}))" if c in LINE_NUMERIC else "false" for c in LINE_COLUMNS}
LINE_FACTS = union_of(
    "select '{c}' as \"column\", {i} as position, count(distinct {c}) as n_unique, count(*) as n_rows, "
    "'{kind}' as kind, {whole} as whole from lineitem", LINE_COLUMNS, kind=_line_kind, whole=_line_whole)


def lines(spark, sf):
    return load(spark, sf, "lineitem").select(*LINE_COLUMNS)


@query("types_upload", f"""
    select "column", position, n_unique,
      case when kind = 'num' and n_unique > 5 and n_unique / n_rows > 0.005 then 'numeric' else 'categorical' end as type
    from ({LINE_FACTS})""")
def types_upload(spark, sf):
    return coltypes.upload_types(lines(spark, sf))


@query("types_upload_decided", f"""
    select "column", position, case when kind = 'num' and (n_unique <= 5 or 0.005 * n_rows > 5) then n_unique end as n_unique,
      case when kind = 'num' and n_unique > 5 and n_unique / n_rows > 0.005 then 'numeric' else 'categorical' end as type
    from ({LINE_FACTS})""")
def types_upload_decided(spark, sf):
    """Types with distinct values counted only as far as they decide."""
    return coltypes.upload_types(lines(spark, sf), counts=False)


_profile_rule = """case when kind = 'num' and not (whole and (n_unique <= 20 or n_unique / n_rows <= 0.10))
    then 'numeric' else 'categorical' end"""


@query("types_profile", f"""
    select "column", position, n_unique, {_profile_rule} as type
    from ({LINE_FACTS}) where "column" <> 'l_linestatus'""")
def types_profile(spark, sf):
    return coltypes.profile_types(lines(spark, sf).select(*LINE_NUMERIC, "l_returnflag", "l_linestatus"),
                                  "l_linestatus")


@query("types_dtype", union_of(
    "select '{c}' as \"column\", {i} as position, count({c}) as non_null, '{t}' as type from lineitem",
    LINE_COLUMNS, t={c: "numeric" if c in LINE_NUMERIC else "categorical" for c in LINE_COLUMNS}))
def types_dtype(spark, sf):
    df = lines(spark, sf)
    return coltypes.types_table(df, coltypes.dtype_types(df))


DECLARED = {"l_linenumber": "categorical", "l_quantity": "numeric", "l_returnflag": "categorical"}
_declared_order = (list(c for c in LINE_COLUMNS if c in DECLARED) + [c for c in LINE_COLUMNS if c not in DECLARED])


@query("types_declared_dtype", union_of(
    "select '{c}' as \"column\", {i} as position, count({c}) as non_null, '{t}' as type from lineitem",
    _declared_order,
    t={c: DECLARED.get(c, "numeric" if c in LINE_NUMERIC else "categorical") for c in LINE_COLUMNS}))
def types_declared_dtype(spark, sf):
    df = lines(spark, sf)
    return coltypes.types_table(df, coltypes.resolve_types(df, DECLARED))


_profile_order = [c for c in _declared_order if c != "l_linestatus"]
_declared_at = " ".join(f"when '{c}' then {i}" for i, c in enumerate(_profile_order))
_declared_type = " ".join(f"when '{c}' then '{t}'" for c, t in DECLARED.items())


@query("types_declared_profile", f"""
    select "column", case "column" {_declared_at} end as position, n_rows as non_null,
      case "column" {_declared_type} else {_profile_rule} end as type
    from ({LINE_FACTS}) where "column" <> 'l_linestatus'""")
def types_declared_profile(spark, sf):
    df = lines(spark, sf)
    return coltypes.types_table(df, coltypes.resolve_profile_types(df, DECLARED, "l_linestatus"))


# --- classification targets -----------------------------------------------------------------------

DIRTY = ["id", "price", "spiky", "priority", "custkey", "all_null", "constant_num", "mostly_zero", "flag", "target",
         "skewed_target"]
_dirty_kind = {"id": "int", "price": "float", "spiky": "float", "priority": "text", "custkey": "int",
               "all_null": "float", "constant_num": "float", "mostly_zero": "float", "flag": "bool", "target": "text",
               "skewed_target": "text"}
_dirty_near = {c: f"coalesce(bool_and(abs({c} - round_even({c}, 0)) <= 1e-8 + 1e-5 * abs(round_even({c}, 0))), false)"
               if k == "float" else "false" for c, k in _dirty_kind.items()}
DIRTY_FACTS = union_of(
    "select '{c}' as \"column\", {i} as position, '{kind}' as kind, count(distinct {c}) as n_unique, "
    "count(*) as n_rows, {near} as near from dirty_orders", DIRTY, kind=_dirty_kind, near=_dirty_near)
_candidate = """n_unique >= 2 and (kind in ('bool', 'text') or (kind = 'int' and n_unique <= 200)
    or (kind = 'float' and n_unique <= 200 and near))"""


@query("target_candidates", f'select "column", position, kind, n_unique from ({DIRTY_FACTS}) where {_candidate}')
def target_candidates(spark, sf):
    return coltypes.target_candidates(load(spark, sf, "dirty_orders"))


@query("target_candidates_decided", f"""
    select "column", position, kind, case when n_unique <= 200 then n_unique end as n_unique from ({DIRTY_FACTS}) where {_candidate}""")
def target_candidates_decided(spark, sf):
    """Candidates with classes counted up to the most that are allowed."""
    return coltypes.target_candidates(load(spark, sf, "dirty_orders"), counts=False)


@query("integer_like", union_of(
    "select '{c}' as \"column\", count({c}) as non_null, {near} as near_whole from dirty_orders",
    [c for c in DIRTY if _dirty_kind[c] == "float"], near=_dirty_near))
def integer_like(spark, sf):
    return coltypes.integer_like(load(spark, sf, "dirty_orders"))


@query("target_validation", """
    select 'p_name' as target, count(distinct p_name) >= 2 as ok, '' as errors,
      case when count(distinct p_name) > 50 then 'p_name has ' || count(distinct p_name)
        || ' classes over ' || count(*) || ' rows.' else '' end as warnings,
      count(distinct p_name) as n_classes
    from part
    union all
    select 'p_retailprice', false,
      'p_retailprice has ' || count(distinct p_retailprice) || ' distinct numbers or fractions, which are no classes.', '',
      count(distinct p_retailprice)
    from part
    union all
    select 'constant_num', false, 'constant_num has ' || count(distinct constant_num) || ' distinct values; two are needed.', '',
      count(distinct constant_num)
    from dirty_orders""")
def target_validation(spark, sf):
    part = load(spark, sf, "part")
    return (coltypes.validate_target(part, "p_name").unionAll(coltypes.validate_target(part, "p_retailprice"))
            .unionAll(coltypes.validate_target(load(spark, sf, "dirty_orders"), "constant_num")))


_distribution = """
    select target as class, count(*) as count, round(count(*) / sum(count(*)) over (), 6) as proportion
    from dirty_orders {where} group by target"""


@query("class_distribution", _distribution.format(where=""))
def class_distribution(spark, sf):
    return rounded(coltypes.class_distribution(load(spark, sf, "dirty_orders"), "target"), "proportion")


@query("class_proportions", _distribution.format(where="where target is not null"))
def class_proportions(spark, sf):
    return rounded(coltypes.class_distribution(load(spark, sf, "dirty_orders"), "target", dropna=True), "proportion")
