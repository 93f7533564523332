"""Streaming form of the ratings source.

The training job itself is batch (the reference has no stream source, window
or state).  New ``user::item`` files landing in a folder are parsed with the
same rules as ``read_ratings`` and appended to an interactions table that a
later ``fit`` reads; the file source tracks which files it has seen in its
checkpoint, so restarts neither skip nor repeat files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.ratings import SEPARATOR, to_interactions


def ratings_stream(spark: SparkSession, folder: str, strict: bool = True,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (user_id, item_id) from ``user::item[::...]`` text files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(folder)
    parts = F.split(F.col("value"), SEPARATOR)
    behaviour = lines.select(F.get(parts, 0).alias("user_id"), F.get(parts, 1).alias("item_id"),
                             F.col("value").alias("_line"))
    return to_interactions(behaviour, strict=strict)


def append_interactions(stream: DataFrame, table_path: str, checkpoint: str,
                        once: bool = True):
    """Append the stream to a parquet interactions table; returns the query."""
    writer = (stream.writeStream.format("parquet").option("path", table_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()
