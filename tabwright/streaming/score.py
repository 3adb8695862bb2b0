"""Score CSV files as they arrive.

Every micro-batch is scored like any other table, joins with stored rows and long vocabularies included, and replaces its own folder, so
that a batch that is repeated after a failure leaves its rows once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tabwright.operators.score import Scorer
from tabwright.sources.shared import temporary


def read_stream(spark: SparkSession, folder: str, schema: dict[str, str], separator: str = ",") -> DataFrame:
    """New CSV files of a folder, all with the given columns."""
    fields = T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in schema.items()))
    return spark.readStream.schema(fields).options(header=True, sep=separator, escape='"').csv(folder)


def score_stream(scorer: Scorer, stream: DataFrame, path: str, checkpoint: str, keep: list[str] | None = None) -> StreamingQuery:
    """Predictions of every micro-batch as parquet under path/batch=<number>, each input row once."""
    def write(batch: DataFrame, number: int) -> None:
        with temporary(batch.sparkSession):  # what scoring stores on its way goes with the batch
            scorer.score(batch, keep).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
