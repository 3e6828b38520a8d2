"""Message logs: options of Spark's kafka source and sink. The connector is a package of its own."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OLDEST, NEWEST, THROW = "earliest", "latest", "throw"


def source_options(brokers: str, topic: str, partitions: list[int] | None = None, start: str = NEWEST, out_of_range: str = THROW, per_trigger: int | None = None) -> dict[str, str]:
    """start: where to begin without a checkpoint. out_of_range: fail, or go on with what is left."""
    out = {"kafka.bootstrap.servers": brokers, "startingOffsets": start, "failOnDataLoss": str(out_of_range == THROW).lower()}
    out |= {"assign": json.dumps({topic: partitions})} if partitions is not None else {"subscribe": topic}
    return out | ({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {})


def sink_options(brokers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic, "kafka.compression.type": "snappy", "kafka.linger.ms": "10000", "kafka.batch.size": "100000"}


def values(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("value").cast("string").alias("value"))


def as_messages(df: DataFrame) -> DataFrame:
    """Rows as JSON values; no key, so the producer picks partitions."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
