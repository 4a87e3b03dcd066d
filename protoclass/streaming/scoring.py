"""Classify documents as they arrive, against a fitted (or loaded) model.

Structured Streaming delivers micro-batches of rows in the ``documents``
schema; each batch goes through the same batch operators (routing,
de-duplication inside the batch, term counts, skew-safe weighting against
the model's term table, sparse cosine, assignment). Every batch's
predictions are written to ``<output>/batch_id=<n>`` with overwrite, so a
batch that is replayed after a failure replaces its own output and the sink
stays exactly-once.

The model is fixed: documents are weighted with the model's document
frequencies and corpus size; terms the model has never seen carry no weight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import CentroidModel, classify_documents


def classify_stream(model: CentroidModel, stream: DataFrame, output: str, checkpoint: str,
                    trigger: dict | None = None) -> StreamingQuery:
    """Start a query that classifies ``stream`` (streaming DataFrame in the
    ``documents`` schema) batch by batch into Parquet under ``output``.

    ``checkpoint``: the query's progress folder (on shared storage on a
    cluster). ``trigger``: e.g. ``{"availableNow": True}`` or
    ``{"processingTime": "1 minute"}``.
    """
    base = output.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        preds, kept = classify_documents(model, batch)
        try:
            preds.write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}")
        finally:
            for df in kept:
                df.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
