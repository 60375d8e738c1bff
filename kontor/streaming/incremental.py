"""Insert-only-new loading of a stream, one micro-batch after the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kontor.plans.warehouse import Warehouse


def load_stream(
    stream: DataFrame, warehouse: Warehouse, table: str, checkpoint: str, keys: Sequence[str] | None = None
) -> StreamingQuery:
    """Load what the stream has now into ``table``, then stop.

    Each micro-batch is compared with the table as it is then, so a batch that
    is run again after a failure adds nothing twice.  ``checkpoint`` is a
    shared folder.
    """

    def load(batch: DataFrame, _: int) -> None:
        warehouse.load(table, batch, keys)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
