"""Helpers that several operators share: shared-folder tables and distributed row numbers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of helper columns, so that columns of the caller can't clash with them.
P = "__sl_"
#: Every character that `[\x20\x09-\x0D]` matches.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session (as in tests) gets a temporary folder; on a cluster that
    would be a folder of each machine's own, so it is an error.
    """
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_dir:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster has machines of its own
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        set_dir = "file://" + tempfile.mkdtemp(prefix="sluice-checkpoint-")
        spark.sparkContext.setCheckpointDir(set_dir)
    return set_dir.rstrip("/")


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """Jobs in this block hand texts to Python in batches of that size, not of 64 MB: each running
    task holds several copies of a batch outside the heap."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


#: Tables that each open scratch() has written.
_scratch: list[list[DataFrame]] = []


def new_folder(spark: SparkSession) -> str:
    """A name in the shared folder that nothing has yet."""
    return f"{shared_dir(spark)}/sluice-{uuid.uuid4().hex}"


def materialize(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors. keep: the
    table outlives the scratch() it is written in; discard() deletes it."""
    path = new_folder(df.sparkSession)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if _scratch and not keep:
        _scratch[-1].append(out)
    return out


@contextmanager
def scratch():
    """Tables that are materialized in this block are deleted at its end, but for those to keep."""
    _scratch.append([])
    try:
        yield
    finally:
        for table in _scratch.pop():
            discard(table)


def discard(df: DataFrame) -> None:
    """Delete the files behind a materialized table that nothing will read again."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        if "/sluice-" in name:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Hot keys that are broadcast, at most: a key with no more than a share 1 / HOT_KEYS of all rows isn't hot.
HOT_KEYS = 500_000
#: Rows of a hot key that one task gets, about, if they'd make more than SALTS tasks.
HOT_SHARE, SALTS = 1 << 20, 64


def hot_bound(rows: int, least: int) -> int:
    """Rows that a hot key has at least, so that there are fewer than HOT_KEYS of them."""
    return max(least, rows // HOT_KEYS)


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, by: str) -> DataFrame:
    """Inner join on key, where keys of hot have very many rows on the left and one on the right.

    hot: (key, n), n the rows on the left; of bounded size (hot_bound()). Rows of a hot key are dealt
    over SALTS tasks, or as many as HOT_SHARE rows each ask for, by the hash of column `by`; the row
    on the right goes to each of them.
    """
    salt, many = f"{P}salt", f"{P}salts"
    tasks = F.greatest(F.lit(SALTS), F.ceil(F.max("n") / HOT_SHARE)).cast("int")
    marked = F.broadcast(hot.groupBy(key).agg(tasks.alias(many)))
    dealt = left.join(marked, key, "left").withColumn(salt, F.when(F.col(many).isNotNull(), F.pmod(F.xxhash64(by), F.col(many))).otherwise(F.lit(0)).cast("int")).drop(many)
    copies = right.join(marked, key, "left").withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(many), F.lit(1)) - 1))).drop(many)
    return dealt.join(copies, [key, salt]).drop(salt)


def words_in(text):
    """Number of `[^\\x20\\x09-\\x0D]+` in a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ascii_lower(col):
    return F.translate(col, UPPER, LOWER)


SQUEEZED = f"{P}squeezed"


def squeezed_docs(docs: DataFrame, columns, text_col: str) -> DataFrame:
    """The columns of docs and __sl_squeezed, the text compressed for an exchange (null as empty)."""
    from functools import partial

    from .textnum import squeezed

    some = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(text_col).alias(SQUEEZED))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in some.schema[:-1])
    return some.mapInArrow(partial(squeezed, text=len(some.columns) - 1), f"{schema}, {SQUEEZED} binary")
