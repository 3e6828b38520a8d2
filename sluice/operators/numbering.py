"""Row numbers without gaps, and sums over all rows before, without a task that sees all rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PART, ROW = "__part", "__row"


def work_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share; of this machine only in a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="sluice-work-")
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"


def placed(df: DataFrame, path: str) -> DataFrame:
    """df, written and read again, with its rows' places: __part (the partition) and __row (the number
    in it, from 0). Places are stored, so all that reads them agrees, also after a lost executor."""
    at = F.monotonically_increasing_id()  # the partition's number, then 33 bits for the row
    df.withColumns({PART: F.shiftright(at, 33), ROW: at.bitwiseAND((1 << 33) - 1)}).write.parquet(path)
    schema = df.schema.add(PART, "long").add(ROW, "long")
    return df.sparkSession.read.schema(schema).parquet(path)


def before(parts: DataFrame, part: str, amount: str) -> DataFrame:
    """(part, amount, before): a row for each part, with the sum over all lesser parts."""
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition of the data
    return parts.withColumn("before", F.coalesce(F.sum(amount).over(w), F.lit(0)))


def numbered(df: DataFrame, name: str = "n", start: int = 0, path: str | None = None) -> DataFrame:
    """df with whole numbers from start on, in the order of its partitions and of the rows in them.

    The rows are written once (to path, or a new shared folder) with their places; then counts by
    partition, which are few, are summed up. df with an order by orderBy() is numbered in that order.
    """
    rows = placed(df, path or work_folder(df.sparkSession))
    counts = before(rows.groupBy(PART).agg(F.count(F.lit(1)).alias("__count")), PART, "__count")
    return rows.join(counts.select(PART, "before"), PART).withColumn(name, F.lit(start) + F.col("before") + F.col(ROW)).drop(PART, ROW, "before")


def running_total(df: DataFrame, order: list[Column | str], amount: Column, name: str, parts: int | None = None) -> DataFrame:
    """df with the sum of amount over each row and all before it in the order, which must tell all
    rows apart. Rows are dealt by ranges of the order; each range is summed up on its own, then moved
    on by the sum of the ranges before."""
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    rows = placed(dealt.sortWithinPartitions(*order).withColumn("__amount", amount), work_folder(df.sparkSession))
    own = Window.partitionBy(PART).orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    sums = before(rows.groupBy(PART).agg(F.sum("__amount").alias("__sum")), PART, "__sum")
    out = rows.withColumn("__own", F.sum("__amount").over(own)).join(sums.select(PART, "before"), PART)
    return out.withColumn(name, F.col("__own") + F.col("before")).drop(PART, ROW, "before", "__own", "__amount")
