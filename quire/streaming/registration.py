"""A streaming front door to registration: each micro-batch adds the documents that are new.

The store has no streams of its own; arriving files are registered by checksum, so a batch that is replayed
after a failure writes nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from quire.operators.registration import register


def register_stream(incoming: DataFrame, table: str, order: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Starts the query that appends new documents of ``incoming`` (a stream) to the parquet folder ``table``.

    ``incoming`` has the table's columns, among them checksum_sha256; ``order`` decides between equal checksums.
    """

    def write(batch: DataFrame, _: int) -> None:
        existing = batch.sparkSession.read.schema(batch.schema).parquet(table)
        fresh = register(batch, existing, order).select(*batch.columns)
        fresh.write.mode("append").parquet(table)

    stream = incoming.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream).start()
