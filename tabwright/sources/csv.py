"""CSV reader: tolerant of long rows, other encodings and textual nulls."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tabwright.functions.exprs import BLANKS, NUMBER_TEXT, col
from tabwright.sources import spanning
from tabwright.sources.shared import durable

OVERFLOW = "_overflow"
# Texts that stand for a missing cell.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
               "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
WHOLE_TEXT = r"^[+-]?\d+$"
SPANS = r"""(^|[,;|\t])\s*"[^"]*("{2}[^"]*)*$"""
TRUE_FALSE = ["True", "TRUE", "true", "False", "FALSE", "false"]


class CsvError(ValueError):
    """The file has no usable rows."""


@dataclass
class CsvTable:
    rows: DataFrame
    warnings: list[str] = field(default_factory=list)


def text_facts(spark: SparkSession, path: str) -> tuple[bool, bool]:
    """(cells span lines, bytes are UTF-8), from one splittable pass over the raw lines.

    A quoted cell that spans lines begins as a cell does, after a separator or line start, and leaves an odd number of quotes on its first line.
    Every file of a folder must have the header line of the first; one without it is an error, since its cells would land in wrong columns.
    """
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path)
    first = lines.first()
    head = F.col("value") == F.lit(first[0] if first else "")
    files = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.bool_or((quotes % 2 == 1) & F.col("value").rlike(SPANS)).alias("span"), F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_or(head).alias("head"))
    row = files.agg(F.bool_or("span").alias("span"), F.bool_and("utf8").alias("utf8"),
                    F.min(F.when(~F.col("head"), F.col("file"))).alias("other")).first()
    if row["other"] is not None:
        raise CsvError(f"{row['other']} does not have the header line of the other files.")
    return bool(row["span"]), row["utf8"] is not False


def _options(separator: str, encoding: str, multi_line: bool) -> dict:
    return {"sep": separator, "quote": '"', "escape": '"', "encoding": encoding, "multiLine": multi_line,
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "mode": "PERMISSIVE"}


def header(spark: SparkSession, path: str, options: dict) -> list[str]:
    """Column names from the first line; a repeated or empty name gets a number."""
    lines = spark.read.options(**options, header=False).csv(path).limit(1).collect()
    if not lines:
        raise CsvError("The input has no header line.")
    names: list[str] = []
    for i, raw in enumerate(lines[0]):
        base = raw if raw else f"Unnamed: {i}"
        name, n = base, 0
        while name in names:
            n += 1
            name = f"{base}.{n}"
        names.append(name)
    return names


def read_csv(spark: SparkSession, path: str, separator: str = ",", multi_line: bool | None = None,
             encoding: str | None = None, schema: dict[str, str] | None = None) -> CsvTable:
    """Read a CSV file or folder with a header line.

    Rows with too many cells are skipped and counted, short ones padded. Bytes that are not UTF-8 make the
    whole input read as Latin-1. One pass over the raw lines finds the encoding and whether quoted cells span lines;
    state both to save it. Where they do, records are found in all byte ranges at once (`spanning`), at the price of two more passes;
    only an encoding other than UTF-8, ASCII and Latin-1 then makes every file one task. One pass over the cells counts rows and
    finds the types that `schema` (column to type) does not give.
    """
    warnings: list[str] = []
    if multi_line is None or encoding is None:
        span, utf8 = text_facts(spark, path)
        multi_line = span if multi_line is None else multi_line
        if encoding is None:
            encoding = "UTF-8" if utf8 else "ISO-8859-1"
            if not utf8:
                warnings.append("The bytes are not UTF-8; they are read as latin-1.")
    options = _options(separator, encoding, multi_line)
    names = header(spark, path, options)
    rows = _null_tokens(_raw(spark, path, names, options), names)
    good = col(OVERFLOW).isNull()
    open_names = [n for n in names if n not in (schema or {})]
    checks = []
    for i, n in enumerate(open_names):
        text = F.when(good, F.btrim(col(n), F.lit(BLANKS)))
        checks += [F.bool_and(F.when(text.isNotNull(), text.rlike(WHOLE_TEXT) & text.try_cast("bigint").isNotNull())).alias(f"whole{i}"), F.bool_and(text.rlike(NUMBER_TEXT)).alias(f"number{i}"),
                   F.bool_and(text.isin(TRUE_FALSE)).alias(f"truth{i}")]
    found = rows.agg(F.count_if(~good).alias("long"), F.count_if(good).alias("rows"), *checks).first()
    if found["long"]:
        warnings.append(f"{found['long']} rows have more cells than the header has names and are left out.")
    if not found["rows"]:
        raise CsvError("The input has a header line and no rows.")
    kinds = dict(schema or {})
    for i, n in enumerate(open_names):
        # a column without any value has no verdict and stays text
        kinds[n] = ("bigint" if found[f"whole{i}"] else "double" if found[f"number{i}"]
                    else "boolean" if found[f"truth{i}"] else "string")
    return CsvTable(rows.where(good).select(*[_typed(n, kinds[n]) for n in names]), warnings)


def read_scoring_csv(spark: SparkSession, path: str, schema: dict[str, str], separator: str = ",") -> DataFrame:
    """Rows to score, in the types of the training table; columns it does not know stay text.

    Scores must belong to whole rows, so a file with longer rows than its header, or with bytes that are not UTF-8, is refused.
    """
    span, utf8 = text_facts(spark, path)
    if not utf8:
        raise CsvError("The file to score is not valid UTF-8.")
    options = _options(separator, "UTF-8", span)
    names = header(spark, path, options)
    rows = _null_tokens(_raw(spark, path, names, options), names)
    long = rows.where(col(OVERFLOW).isNotNull()).count()
    if long:
        raise CsvError(f"{long} rows to score have more cells than the header has names.")
    return rows.select(*[_typed(n, schema.get(n, "string")) for n in names])


def _raw(spark: SparkSession, path: str, names: list[str], options: dict) -> DataFrame:
    """All cells as text, and one more column that only rows with too many cells fill."""
    if options["multiLine"] and options["encoding"].upper() in spanning.ENCODINGS:
        fields = ", ".join(f"c{i} string" for i in range(len(names) + 1))
        # stored, since the types and every use of the rows would cut all lines into records again
        records = durable(spanning.records(spark, path, options["sep"], options["encoding"]), "records")
        cells = records.select(F.from_csv("record", fields, {k: str(v) for k, v in options.items() if k != "encoding"}).alias("r"))
        return cells.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate([*names, OVERFLOW])])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, OVERFLOW]])
    return spark.read.options(**options, header=True).schema(schema).csv(path)


def _null_tokens(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.when(~col(n).isin(NULL_TOKENS), col(n)).alias(n) for n in names], col(OVERFLOW))


def _typed(name: str, kind: str) -> Column:
    text = col(name) if kind == "string" else F.btrim(col(name), F.lit(BLANKS))
    return text.try_cast(kind).alias(name)
