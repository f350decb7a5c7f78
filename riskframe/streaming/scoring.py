"""Stateless scoring of a stream.

Every fitted stage here is a projection, so ``transform`` applies unchanged
to a streaming DataFrame; there is no state, watermark or window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def score_stream(models: list, stream: DataFrame) -> DataFrame:
    """Apply fitted transformers in order to a streaming DataFrame."""
    out = stream
    for m in models:
        out = m.transform(out)
    return out


def run_to_files(stream_df: DataFrame, path: str, checkpoint: str, batches: int | None = None) -> DataFrame:
    """Score everything available into Parquet files and read them back.

    The sink logs the files of every batch under the batch's number, and only logged files
    are read. So a stream that was stopped, or whose driver was lost, goes on from its
    checkpoint when it is started again with the same folders: a batch that was under way
    is written anew and counts once, and files that came in the meantime are taken too.
    ``batches``: stop after so many batches at least."""
    q = (stream_df.writeStream.format("parquet").option("path", path).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    if batches is not None:
        while q.isActive and len(q.recentProgress) < batches:
            q.awaitTermination(0.05)
        q.stop()
        if q.exception() is not None:
            raise q.exception()
    else:
        q.awaitTermination()
    return stream_df.sparkSession.read.schema(stream_df.schema).parquet(path)
