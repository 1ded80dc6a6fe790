"""Landing files -> history table, batch by batch.

The checkpoint remembers which files were taken, in place of a processed flag
on every landing row. Each micro-batch is merged under the stream's id and its batch
number, so a batch repeated after a failure is not applied twice, and batches of
other streams, of a new checkpoint or applied by hand all count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from histflow.functions.scalar import as_instant
from histflow.operators.history import latest_per_key
from histflow.sources.store import HistoryTable


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_apply(
    stream: DataFrame,
    table: HistoryTable,
    prepare: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    order_by: Sequence[str] = (),
    as_of=None,
) -> StreamingQuery:
    """Merge each micro-batch into the table; ends when the landing is drained.

    ``prepare`` turns landing rows into source rows. With ``order_by`` only the
    latest row of a key in a batch is merged, otherwise two are an error.
    """

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        source = prepare(batch)
        if order_by:
            source = latest_per_key(source, table.history.keys, order_by)
        # The id is part of the checkpoint: a new checkpoint is a new stream.
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.apply(source, as_instant(as_of), origin=stream_id or checkpoint, batch=batch_id)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(apply_batch)
        .start()
    )
