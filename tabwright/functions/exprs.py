"""Column expressions. Everything here is JVM-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What counts as a number or a date in text.
NUMBER_TEXT = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"
DATE_FORMATS = {
    r"^\d{4}-\d{2}-\d{2}$": "yyyy-MM-dd",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$": "yyyy-MM-dd HH:mm:ss",
    r"^\d{2}/\d{2}/\d{4}$": "MM/dd/yyyy",
}
BLANKS = " \t\n\r\f\v"


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def is_fractional(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def is_tabular(dt: T.DataType) -> bool:
    """False for nested types, which no operator accepts."""
    return not isinstance(dt, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL are one concept: missing."""
    return df.select([
        F.when(~F.isnan(col(f.name)), col(f.name)).alias(f.name) if is_fractional(f.dataType) else col(f.name)
        for f in df.schema
    ])


def stripped(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(BLANKS))


def text_to_number(c: Column) -> Column:
    """The number a text cell holds, or NULL."""
    text = stripped(c)
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def is_date_text(c: Column) -> Column:
    text = stripped(c)
    hits = [text.rlike(p) & F.try_to_timestamp(text, F.lit(f)).isNotNull() for p, f in DATE_FORMATS.items()]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def coerce_value(c: Column, numeric: bool) -> Column:
    """Trimmed value; blank is missing, and so is text in a numeric field."""
    text = F.nullif(stripped(c), F.lit(""))
    return text_to_number(text) if numeric else text


def near_integer(c: Column) -> Column:
    """Closeness to the nearest integer: tolerance 1e-8 + 1e-5 * |nearest|."""
    nearest = F.rint(c)
    return F.abs(c - nearest) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(nearest)


def row_hash(ids: list[str], seed: int) -> Column:
    """Eight hex digits of an md5 over seed and row key: the same for a row under any plan."""
    key = F.concat_ws("|", F.lit(str(seed)), *[col(i).cast("string") for i in ids])
    return F.substring(F.md5(key), 1, 8)


def tidy(c: Column, digits: int = 6) -> Column:
    """Rounded, without negative zero."""
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def rows_from_structs(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One row per struct for every input row."""
    return df.select(F.inline(F.array(*structs)))
