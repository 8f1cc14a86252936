"""A landing folder as a stream: each micro-batch of new report rows is reconciled and published."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def reconcile_arrivals(spark: SparkSession, landing: str, schema: StructType | str, plan: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Run plan over each batch of new Parquet files and write it to out/batch=<id>.

    A batch that is run again after a failure writes the same folder anew, so results appear once. The
    stream ends when it has read what is there; start it again for later arrivals.
    """

    def publish(rows: DataFrame, batch: int) -> None:
        plan(rows).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    return rows.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
