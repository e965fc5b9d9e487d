"""Previews for people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: how many rows a preview has.
PREVIEW_ROWS = 20


def show_each(**frames: DataFrame) -> None:
    """Print the first rows of each frame under its name. Each is a small top-n job."""
    for name, frame in frames.items():
        print(f"{name}:")
        frame.show(PREVIEW_ROWS, truncate=False)


def console_stream(stream: DataFrame, checkpoint: str, every: str) -> StreamingQuery:
    """Print the first rows of each micro-batch until stopped."""
    writer = stream.writeStream.format("console").outputMode("append")
    writer = writer.option("numRows", PREVIEW_ROWS).option("truncate", False)
    return (
        writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    )
