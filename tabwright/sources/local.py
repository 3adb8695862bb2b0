"""Small driver-side tables: bounds, grids, names."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A table from a few rows. It enters the plan as a local relation, so the planner knows its size."""
    schema = T.StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = pa.table([pa.array(list(v), type=f.type) for v, f in zip(columns, to_arrow_schema(schema))],
                     schema=to_arrow_schema(schema))
    return spark.createDataFrame(arrow, schema)
