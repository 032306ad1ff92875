"""Monthly status loads as a stream into the versioned status history.

Each micro-batch holds the status of loans at one or several months and is applied in one
pass, against the open versions. The number of the micro-batch is published together with the
history it leads to, so a micro-batch that is replayed (after a driver lost between publishing
and committing) is recognised and left alone. A row that contradicts a month the history has
passed stops the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lendscope.operators.status_history import StatusHistory
from lendscope.sources.catalog import Run

KEY = "sk_id_prev"


def apply_load(batch: DataFrame, root: str, table: str, batch_id: int | None = None) -> None:
    """Apply one micro-batch and publish the result; nothing if it was applied before."""
    run = Run(batch.sparkSession, root)
    entry = run.entry(table)
    if batch_id is not None and entry is not None and entry.note is not None and int(entry.note) >= batch_id:
        return
    if batch.isEmpty():
        return
    note = None if batch_id is None else str(batch_id)
    StatusHistory(run, table, KEY).apply(batch, note=note, stop_on_refused=True)
    run.commit()


def follow_status(
    loads: DataFrame, root: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Work off every load that has arrived (one row per loan and month), then stop.

    Set `maxFilesPerTrigger` on the source to bound a micro-batch of a long backlog. Numbers
    of micro-batches belong to a checkpoint: keep one checkpoint for each table.
    """
    return (
        loads.writeStream.foreachBatch(
            lambda batch, batch_id: apply_load(batch, root, table, batch_id)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
