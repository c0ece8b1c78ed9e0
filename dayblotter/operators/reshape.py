"""From the feed as it arrives to the declared incident table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dayblotter.fixed_values import FEED_DROPPED, FEED_RENAMED
from dayblotter.functions.columns import conform, flatten_structs, quoted
from dayblotter.schemas import INCIDENTS


def reshape_feed(raw: DataFrame) -> DataFrame:
    """Flatten, drop what is not kept, rename. Values stay text; absent columns are no error."""
    flat = flatten_structs(raw)
    kept = [name for name in flat.columns if name not in FEED_DROPPED]
    return flat.select(*[quoted(name) for name in kept]).withColumnsRenamed(FEED_RENAMED)


def incidents_from_feed(raw: DataFrame) -> DataFrame:
    """Reshaped and cast to the declared schema, absent columns as NULL."""
    return conform(reshape_feed(raw), INCIDENTS)
