"""Queries: CSV files written from the test tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabwright.plans.catalog import load, query
from tabwright.sources.csv import read_csv, read_scoring_csv
from tabwright.sources.shared import fresh_path


def write_lines(df: DataFrame, header: str, encoding: str = "UTF-8") -> str:
    """Lines of text as CSV files, each with the header line.

    The CSV writer puts the header, which is the column's name here, on top of every file; quoting is off.
    """
    path = fresh_path(df.sparkSession, "csv")
    lines = df.select(F.col(df.columns[0]).alias(header))
    lines.write.options(header=True, sep="\x01", quote="", escape="\x02", encoding=encoding, emptyValue="",
                        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def write_table(df: DataFrame) -> str:
    path = fresh_path(df.sparkSession, "csv")
    df.write.options(header=True, escape='"', quoteAll=False).csv(path)
    return path


@query("csv_roundtrip", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def csv_roundtrip(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return read_csv(spark, write_table(df)).rows


@query("csv_text_cells", "select page_id, url, html from pages")
def csv_text_cells(spark, sf):
    """Cells with quotes, separators and line breaks survive."""
    df = load(spark, sf, "pages").select("page_id", "url", "html")
    return read_csv(spark, write_table(df)).rows


@query("csv_multiline", """
    select o_orderkey as key, o_orderstatus || chr(10) || '"' || o_orderpriority || '", ' || o_custkey || chr(10) || chr(10) || 'end' as note,
      o_totalprice as price from orders""")
def csv_multiline(spark, sf):
    """Cells that span lines, with quotes, separators and empty lines in them."""
    note = F.expr("""concat(o_orderstatus, '\n"', o_orderpriority, '", ', o_custkey, '\n\nend')""")
    df = load(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), note.alias("note"), F.col("o_totalprice").alias("price"))
    return read_csv(spark, write_table(df)).rows


@query("csv_null_tokens", """
    select event_id as id, case when event_id % 5 = 0 then null else user_id end as num,
      case when event_id % 7 = 0 then null else event_type end as word
    from events""")
def csv_null_tokens(spark, sf):
    token = F.element_at(F.array(*[F.lit(t) for t in ("NA", "null", "", "NaN", "n/a")]), F.expr("int(event_id % 5 + 1)"))
    lines = load(spark, sf, "events").select(F.concat_ws(
        ",", "event_id", F.expr("case when event_id % 5 = 0 then 'NA' else string(user_id) end"),
        F.when(F.expr("event_id % 7 = 0"), token).otherwise(F.col("event_type"))).alias("line"))
    return read_csv(spark, write_lines(lines, "id,num,word")).rows


@query("csv_bad_rows", """
    select o_orderkey as key, case when o_orderkey % 11 = 0 then null else o_orderstatus end as status,
      (select count(*) from orders where o_orderkey % 10 = 7) as skipped
    from orders where o_orderkey % 10 <> 7""")
def csv_bad_rows(spark, sf):
    """Long rows are skipped and counted, short rows padded."""
    lines = load(spark, sf, "orders").select(F.expr("""
        case when o_orderkey % 10 = 7 then concat(o_orderkey, ',', o_orderstatus, ',too,long')
             when o_orderkey % 11 = 0 then string(o_orderkey)
             else concat(o_orderkey, ',', o_orderstatus) end""").alias("line"))
    table = read_csv(spark, write_lines(lines, "key,status"))
    skipped = int(table.warnings[-1].split()[0]) if table.warnings else 0
    return table.rows.withColumn("skipped", F.lit(skipped).cast("bigint"))


@query("csv_long_integers", """
    select o_orderkey as key, 1234567890123456789 + o_orderkey as big, o_custkey * 1e20 as beyond from orders""")
def csv_long_integers(spark, sf):
    """Whole numbers of nineteen digits keep every digit; longer ones are doubles."""
    lines = load(spark, sf, "orders").select(F.expr(
        "concat(o_orderkey, ',', 1234567890123456789 + o_orderkey, ',', o_custkey, '00000000000000000000')").alias("line"))
    return read_csv(spark, write_lines(lines, "key,big,beyond")).rows


@query("csv_scoring_bad_rows", """
    select count(*) filter (o_orderkey % 10 = 7) || ' rows to score have more cells than the header has names.' as error,
      count(*) as source_rows from orders""")
def csv_scoring_bad_rows(spark, sf):
    """A file to score with rows that are too long is refused, and says how many."""
    orders = load(spark, sf, "orders")
    lines = orders.select(F.expr("concat(o_orderkey, ',', o_orderstatus, if(o_orderkey % 10 = 7, ',more', ''))").alias("line"))
    try:
        read_scoring_csv(spark, write_lines(lines, "id,status"), {"id": "bigint"})
        error = ""
    except ValueError as e:
        error = str(e)
    return orders.agg(F.lit(error).alias("error"), F.count("*").alias("source_rows"))


@query("csv_encoding", """
    select c_custkey as key, c_mktsegment || ' é ü' as segment, true as latin from customer""")
def csv_encoding(spark, sf):
    """Latin-1 bytes are recognised and decoded."""
    lines = load(spark, sf, "customer").select(F.concat("c_custkey", F.lit(","), "c_mktsegment", F.lit(" é ü")))
    table = read_csv(spark, write_lines(lines, "key,segment", "ISO-8859-1"))
    return table.rows.withColumn("latin", F.lit(any("latin-1" in w for w in table.warnings)))


@query("csv_guard", "select 'The input has a header line and no rows.' as error, count(*) as source_rows from nation")
def csv_guard(spark, sf):
    """A file with a header and no rows is refused."""
    df = load(spark, sf, "nation").select("n_nationkey", "n_name")
    try:
        read_csv(spark, write_table(df.where(F.col("n_nationkey") < F.lit(-1)).coalesce(1)))
        error = ""
    except ValueError as e:
        error = str(e)
    return df.agg(F.lit(error).alias("error"), F.count("*").alias("source_rows"))


@query("csv_scoring", """
    select o_orderkey as id, o_totalprice as spiky, o_orderpriority as priority, cast(o_custkey as varchar) as extra
    from orders""")
def csv_scoring(spark, sf):
    """Scoring input read in the training table's types; unknown columns stay text."""
    df = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("spiky"),
                                          F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("extra"))
    return read_scoring_csv(spark, write_table(df), {"id": "bigint", "spiky": "double", "priority": "string"})
