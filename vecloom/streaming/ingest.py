"""Adding paragraphs to a store as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from vecloom.operators.embed import Embedder, embed_texts
from vecloom.operators.store import VectorTable, counted_ids, one_per_id


def add_stream(
    paragraphs: DataFrame,
    store: VectorTable,
    make: Callable[[], Embedder],
    checkpoint: str,
    *,
    order: str | None = None,
) -> StreamingQuery:
    """Embed each micro-batch of a paragraph stream and add it to the store.

    A batch is known by the stream's checkpoint folder and the micro-batch's number. A
    micro-batch that is run again after a failure replaces its own rows and no others;
    other streams, and batches added before or meanwhile, keep theirs. ``order`` ranks
    repeats of an id within one micro-batch; they are settled before anything is embedded, and
    texts are moved for it only if some id does repeat. The ids that this takes stay on the
    executors' disks, dealt by id, until they are compared with those of the store's batches.
    """

    def add(rows: DataFrame, epoch: int) -> None:
        ids = counted_ids(rows).persist(StorageLevel.DISK_ONLY)
        try:
            rows = one_per_id(rows, order, ids)
            vectors = embed_texts(rows, make, keep=("paragraph_id", "article_id", "article_title"))
            store.add_batch(vectors, writer=checkpoint, epoch=epoch, ids=ids)
        finally:
            ids.unpersist()

    return (
        paragraphs.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
