"""Rule filters and movers on streams. Progress lives in the checkpoint, so a restart goes on where
the last committed batch ended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import rules


def line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """(value): lines of files as they appear in a folder."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def filter_stream(messages: DataFrame, rule: str, **options) -> DataFrame:
    """The rule on each message: stateless, so append mode."""
    return rules.execute_json(rule, messages, **options)


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start(df: DataFrame, path: str, checkpoint: str, every: str | None = None, format: str = "parquet") -> StreamingQuery:
    """Write a stream to files. Without `every` it takes what is there and ends."""
    return _trigger(df.writeStream.format(format).outputMode("append").option("path", path).option("checkpointLocation", checkpoint), every).start()


def move(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Each batch to write(batch, number): at least once; the number lets a sink skip what it has."""
    return _trigger(df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), every).start()


def progress(query: StreamingQuery) -> dict[str, int]:
    """Rows read so far, and batches."""
    done = query.recentProgress
    return {"rows": sum(p["numInputRows"] for p in done), "batches": len(done)}
