"""A folder of delta files as a stream into the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from thicket.sources.files import DELTA_COLUMNS, POSITION, delta_rows
from thicket.sources.store import Store


def stream_deltas(spark: SparkSession, folder: str, store: Store, checkpoint: str, columns: list[str] = DELTA_COLUMNS) -> StreamingQuery:
    """Apply all files that are there, each once, then stop. columns is the header of the files.

    No watermark: late rows are never dropped; redelivered ones are upserted again. A batch that
    is retried after a failure is skipped if the store's state says that it is in.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = spark.readStream.schema(schema).options(sep="\t", header=True, quote="", enforceSchema=True).csv(folder)
    rows = rows.select("*", F.col("_metadata.file_path").alias(POSITION[0]), F.col("_metadata.file_block_start").alias(POSITION[1]))

    def apply(batch: DataFrame, number: int) -> None:
        own = store.on(batch.sparkSession)  # rows are counted in the session that runs them
        if own.state().get("batch", -1) < number:
            own.apply(delta_rows(batch.withColumn(POSITION[2], F.monotonically_increasing_id())), batch=number)

    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
