"""Tables: catalog, statements, and report storage that can be written again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import numbered


class ReportConflict(RuntimeError):
    """Another writer was faster."""


def catalog(spark: SparkSession) -> list[tuple[str, str]]:
    """(database, table) of all databases."""
    return [(d.name, t.name) for d in spark.catalog.listDatabases() for t in spark.catalog.listTables(d.name) if not t.isTemporary]


def columns(spark: SparkSession, table: str) -> list[str]:
    return spark.table(table).columns


def rows(spark: SparkSession, statement: str) -> Iterator:
    """Rows of a statement, one partition at a time on the driver."""
    return spark.sql(statement).toLocalIterator(prefetchPartitions=True)


def widened(df: DataFrame) -> DataFrame:
    """Whole numbers as long, other floating numbers as double; all other types stay."""
    kinds = {"tinyint": "long", "smallint": "long", "int": "long", "float": "double"}
    return df.select(*[F.col(f"`{f.name}`").cast(kinds[k]).alias(f.name) if (k := f.dataType.simpleString()) in kinds else F.col(f"`{f.name}`") for f in df.schema])


def save_report(df: DataFrame, path: str, tag: int, metric: str) -> None:
    """Write a report's rows (with a dt column), replacing those of the tag, metric and days that it
    brings and no others."""
    out = df.withColumns({"tag_id": F.lit(tag), "metric_name": F.lit(metric)})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tag_id", "metric_name", "dt").parquet(path)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the committed versions in a folder, ascending."""
    from .files import file_system

    fs, at = file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n[8:]) for n in names if n.startswith("version=") and n[8:].isdigit())


def _commit(spark: SparkSession, source, target) -> None:
    """Rename a folder, unless the new name exists: unlike FileSystem's, this rename never moves a
    folder into another."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    options = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration()).rename(source, target, options)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            raise ReportConflict(f"{target} is there already") from e
        raise


def replace_report(df: DataFrame, path: str, tag: int, metric: str, first: str, last: str, keep: int = 1) -> int:
    """Put a report's rows (with a dt column) in place of all that the tag and metric have from day
    first to day last, also on days that df has no rows for. Returns the number of the new version.

    A version holds all days of its tag and metric. It is written aside, with the days outside the
    range taken over from the version before; one rename then makes it the one that read_reports()
    sees. Whatever fails before leaves the old rows, whatever fails after leaves the new ones. The
    newest `keep` versions before it stay, for readers that have begun; older ones are deleted. Of two
    writers of one tag and metric, one fails and changes nothing.
    """
    from .files import file_system

    spark = df.sparkSession
    folder = f"{path}/tag_id={tag}/metric_name={metric}"
    have = _versions(spark, folder)
    new = df.filter(F.col("dt").between(first, last))
    if have:
        old = spark.read.option("basePath", f"{folder}/version={have[-1]}").schema(df.schema).parquet(f"{folder}/version={have[-1]}")
        new = new.unionByName(old.filter(~F.col("dt").between(first, last)))
    number = have[-1] + 1 if have else 1
    aside = f"{folder}/_writing-{uuid.uuid4().hex}"
    fs, at = file_system(spark, aside)
    _, target = file_system(spark, f"{folder}/version={number}")
    try:
        new.write.partitionBy("dt").parquet(aside)
        if not fs.exists(at):
            fs.mkdirs(at)
        _commit(spark, at, target)
    finally:
        fs.delete(at, True)
    for v in have[: len(have) - keep]:
        fs.delete(file_system(spark, f"{folder}/version={v}")[1], True)
    return number


def read_reports(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a store that replace_report() writes, with tag_id, metric_name and dt: of each tag
    and metric the newest version. schema: that of the reports, with dt."""
    from .files import file_system

    fs, at = file_system(spark, path)
    folders = [str(m.getPath()) for t in (fs.listStatus(at) if fs.exists(at) else []) for m in fs.listStatus(t.getPath())]
    newest = [f"{f}/version={v[-1]}" for f in folders if (v := _versions(spark, f))]
    full = f"{schema}, tag_id int, metric_name string, version int"
    if not newest:
        return spark.createDataFrame([], full).drop("version")
    return spark.read.option("basePath", path).schema(full).parquet(*newest).drop("version")


def find(df: DataFrame, key: str, ids: list) -> DataFrame:
    """Documents by their ids, given as a short list."""
    return df.filter(F.col(key).isin(ids))


def set_fields(df: DataFrame, which, fields: dict) -> DataFrame:
    """df with some fields of the documents that match set; which: a condition, null for no match."""
    return df.withColumns({c: F.when(which, v).otherwise(F.col(f"`{c}`")) if c in df.columns else F.when(which, v) for c, v in fields.items()})


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of old whose key isn't in new, and new; missing columns are null."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def remove_by(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return old.join(keys.select(key), key, "left_anti")


def next_ids(df: DataFrame, start: int, name: str = "id") -> DataFrame:
    """df with whole numbers from start on, without gaps."""
    return numbered(df, name, start)
