"""Landing as files arrive: every micro-batch is one upsert, so late rows update theirs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming import DataStreamWriter

from ratestrata.sources.landing import PartitionBy, land


def land_stream(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    schema: T.StructType,
    checkpoint: str,
    partition: PartitionBy | None = None,
    order_by: str = "_extracted_at",
) -> DataStreamWriter:
    """A writer that upserts `stream`, already in landing form, into the table at `path`.

    The checkpoint is the stream's name. A batch that Spark repeats, because the driver died between its landing and
    the checkpoint, is skipped: the table's pointer names the last batch of every stream. So rows with a NULL in the key, which equal nothing, are
    there once as well.
    """

    def merge(batch: DataFrame, number: int) -> None:
        land(batch.sparkSession, path, batch, keys, schema, partition, order_by, (checkpoint, number))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
