"""Streams of entities into the knowledge base (an extension): each micro-batch is one upsert, in the order of ord."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import KnowledgeBase


def upsert_stream(entities: DataFrame, base: KnowledgeBase, checkpoint: str, clock: Callable[[int], str], **trigger) -> StreamingQuery:
    """Starts the stream. A batch that is delivered again merges into what it has saved, which changes no field but last_updated."""

    def write(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            base.persist(batch, clock(epoch))

    stream = entities.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"availableNow": True})).start()
