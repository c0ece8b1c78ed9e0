"""Change streams that end in a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from dayblotter.fixed_values import POLL_INTERVAL
from dayblotter.operators.reshape import incidents_from_feed
from dayblotter.sinks.keyed import KeyedTable
from dayblotter.sources.feed import UPDATED, PagedFeed


def stream_upserts(
    changes: DataFrame, table: KeyedTable, checkpoint: str, interval: str | None = POLL_INTERVAL
) -> StreamingQuery:
    """Upsert every micro-batch. A batch replayed after a failure changes nothing more.

    With `interval` None the stream takes all that is there and ends, for outside schedulers. No
    watermark: a correction to an old incident is an ordinary row with a new change time.
    """
    table.create()
    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, _: table.upsert(batch)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def take_changes(feed: PagedFeed, table: KeyedTable, checkpoint: str, since: str | None = None) -> int:
    """Upsert all there is now, in batches of `feed.batch_rows`, and end; the number of batches.

    The newest change time is fixed before the first. A stream that takes what is there ends after one
    batch of a source that bounds its batches, so it is begun again until there is nothing left.
    """
    until, batches = feed.bounds(UPDATED)[1], 0
    while until:
        query = stream_upserts(incidents_from_feed(feed.changes(since, until)), table, checkpoint, interval=None)
        query.awaitTermination()
        taken = sum(1 for progress in query.recentProgress if progress.numInputRows)
        if not taken:
            break
        batches += taken
    return batches
