"""Lookups over streams of points: containment is a stateless join, nearest borders run batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from limes.operators.lookup import nearest, point_lookup


def lookup_stream(points: DataFrame, edges: DataFrame, cell: float, sink: Callable[[DataFrame, int], None], checkpoint: str, most: float | None = None) -> StreamingQuery:
    """Every micro-batch of ``pid, px, py`` is looked up and handed to ``sink``; with ``most`` also nearest borders of points without hit.

    Border cells aggregate crossings per point, so batches are looked up as a whole and need no state between them.
    """

    def handle(batch: DataFrame, epoch: int) -> None:
        hits = point_lookup(batch, edges, cell).withColumn("distance", F.lit(None).cast("double"))
        if most is not None:
            open_ = batch.join(hits.select("pid"), "pid", "left_anti")
            hits = hits.unionByName(nearest(open_, edges, most).select("pid", "feature_id", "level", "distance"))
        sink(hits, epoch)

    return points.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
