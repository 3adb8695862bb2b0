"""Shape, projections, value maps and fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabwright.functions.exprs import col, coerce_value, is_numeric, is_tabular


def tabular(df: DataFrame) -> DataFrame:
    """Refuse nested columns, which none of the operators accepts."""
    nested = [f.name for f in df.schema if not is_tabular(f.dataType)]
    if nested:
        raise TypeError("nested columns must be expanded or dropped first: " + ", ".join(nested))
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not is_numeric(f.dataType)]


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def dataset_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, with the table's shape."""
    return shape(df).select("n_rows", "n_columns", F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("dtype"))
        for i, f in enumerate(df.schema)
    ])))


def preview(df: DataFrame, order: list[str], n: int = 5, tail: bool = False) -> DataFrame:
    """First or last n rows by the row key; none when n is not positive."""
    keys = [col(c).desc() if tail else col(c).asc() for c in order]
    return df.orderBy(*keys).limit(max(n, 0))


def require(df: DataFrame, wanted: list[str], what: str) -> None:
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise KeyError(f"{what}: no {', '.join(missing)} among {', '.join(df.columns)}")


def features_of(df: DataFrame, target: str, wanted: list[str] | None = None) -> DataFrame:
    """The feature side of a table: everything but the target, or the wanted columns."""
    require(df, [target], "Target column")
    features = df.drop(target)
    if wanted:
        require(features, wanted, "Selected feature columns")
        features = features.select(*[col(c) for c in wanted])
    return features


def capped(columns: list[str], limit: int | None, what: str) -> tuple[list[str], list[str]]:
    """The first `limit` columns, and a warning when that leaves some out."""
    if limit and limit > 0 and len(columns) > limit:
        return columns[:limit], [f"{what}: {len(columns)} columns, using the first {limit}."]
    return columns, []


def remap_values(df: DataFrame, maps: dict[str, dict[str, str]], types: dict[str, str]) -> DataFrame:
    """Replace listed values of categorical columns; other values pass through as text."""
    changed = {}
    for name, mapping in maps.items():
        if not mapping or name not in df.columns or (types and types.get(name) != "categorical"):
            continue
        text = col(name).cast("string")
        table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
        changed[name] = F.coalesce(F.element_at(table, text), text)
    return df.withColumns(changed) if changed else df


def distinct_categories(df: DataFrame, column: str, n: int = 50) -> DataFrame:
    """The first n distinct non-null values as text."""
    value = col(column).cast("string").alias("value")
    return df.select(value).where("value is not null").distinct().orderBy("value").limit(n)


def coerce_columns(df: DataFrame, numeric: list[str], text: list[str]) -> DataFrame:
    return df.withColumns({**{c: coerce_value(col(c), True) for c in numeric},
                           **{c: coerce_value(col(c), False) for c in text}})


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free signature of every row, cell for cell with its length, and the schema."""
    text = lambda c: col(c).cast("string")
    cells = [F.coalesce(F.concat(F.char_length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in df.columns]
    digest = F.md5(F.concat_ws(",", *cells))
    words = [F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") for at in (1, 9)]
    hashed = df.select(words[0].alias("w0"), words[1].alias("w1"))
    return hashed.agg(
        F.count("*").alias("n_rows"), F.coalesce(F.bit_xor("w0"), F.lit(0)).alias("xor_hash"),
        F.coalesce(F.sum(F.col("w1").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum_hash"),
    ).withColumn("schema", F.lit(", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema)))


def realign(features: DataFrame, labels: DataFrame, ids: list[str]) -> DataFrame:
    """Labels back beside their features, one to one by row key."""
    return features.join(labels, ids, "left")
