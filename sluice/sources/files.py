"""Text, CSV and JSON files; listings; export. Paths may be of any file system Spark knows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules
from ..operators.numbering import numbered, work_folder


class SourceError(ValueError):
    """Nothing to read."""


def read_lines(spark: SparkSession, *paths: str, recursive: bool = False) -> DataFrame:
    """(value): lines of files, folders or globs; empty names are skipped."""
    named = [p for p in paths if p]
    if not named:
        raise SourceError("no files")
    return spark.read.option("recursiveFileLookup", recursive).text(named)


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """CSV with a header; every cell is text. A row with another number of cells is an error."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"').option("enforceSchema", False)
    names = reader.option("inferSchema", False).csv(path).columns
    missing = [c for c in columns or () if c not in names]
    if missing:
        raise SourceError(f"missing columns {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    out = reader.option("nullValue", "\x00").option("emptyValue", "").schema(schema).csv(path)
    # A cell that is empty is empty text.
    out = out.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names])
    return out.select(*[F.col(f"`{c}`") for c in columns]) if columns else out


def rule_over_csv(spark: SparkSession, path: str | list[str], rule: str, mode: str = "table") -> DataFrame:
    parsed = rules.parse(rule)
    return rules.execute(parsed, read_csv(spark, path, list(parsed.columns)), mode)


def rule_over_json(spark: SparkSession, path: str | list[str], rule: str, **options) -> DataFrame:
    return rules.execute_json(rule, spark.read.text(path), **options)


def listing(spark: SparkSession, path: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """(path, length, modified) of files; contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def usage(files: DataFrame, depth: int) -> DataFrame:
    """(folder, bytes, files): sizes rolled up to the first `depth` parts of the path."""
    parts = F.split(F.regexp_replace("path", r"^[a-z]+:/*", "/"), "/")
    folder = F.array_join(F.slice(parts, 1, F.least(F.lit(depth + 1), F.size(parts) - 1)), "/")
    return files.groupBy(folder.alias("folder")).agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, md5) of whole files."""
    return spark.read.format("binaryFile").load(path).select("path", F.md5("content").alias("md5"))


#: Files that split_lines() writes by a task of their own; if there are more, tasks write several, of so many lines in all.
TASKS, TASK_LINES = 1000, 1 << 17


def split_lines(lines: DataFrame, path: str, every: int) -> None:
    """Write the lines, in the order of their partitions and of the rows in them, as files of `every`
    lines each; the last may have fewer. They are named part-00000, part-00001, ..., up to TASKS files;
    more are named by the task that writes them and their number there, in order. split_files() numbers both.

    Lines are numbered over all partitions (see numbering); those of one file go to one task. Tasks are
    fewer than files, as each reports to the driver. Null is an empty line. No lines, no files.
    """
    if every < 1:
        raise SourceError("files need a line at least")
    spark, column = lines.sparkSession, lines.columns[0]
    work = work_folder(spark)
    rows = numbered(lines.select(F.coalesce(F.col(f"`{column}`"), F.lit("")).alias("value")), "n", path=work)
    parts = -(-spark.read.parquet(work).count() // every)
    if parts:
        each = max(1, min(TASK_LINES // every, -(-parts // TASKS)))
        task = F.floor(F.col("n") / (every * each)).cast("int")
        rows = rows.repartitionById(-(-parts // each), task).sortWithinPartitions("n")
        rows.select("value").write.mode("overwrite").option("maxRecordsPerFile", every).text(path)
    else:
        remove(spark, path, recursive=True, force=True)
        make_dir(spark, path)
    remove(spark, work, recursive=True, force=True)


def _split_number(spark: SparkSession, path: str, name: Column) -> Column:
    """The number of a file of split_lines(), from its name. All tasks but the last write equally many."""
    own = lambda c: F.regexp_extract(c, r"-c(\d+)[^-/]*$", 1).cast("long")
    each = (listing(spark, path, glob="part-*").agg(F.max(own("path"))).first()[0] or 0) + 1
    return F.regexp_extract(name, r"part-(\d+)-[^/]*$", 1).cast("long") * each + own(name)


def split_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, length): number and bytes of each file that split_lines() has written."""
    return listing(spark, path, glob="part-*").select(_split_number(spark, path, F.col("path")).alias("file"), "length")


def split_parts(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): the lines that split_lines() has written, with the number of their file."""
    return spark.read.text(path).select(_split_number(spark, path, F.col("_metadata.file_name")).alias("file"), "value")


def fan_out(lines: DataFrame, *paths: str) -> None:
    """The same rows to several places; they are computed once."""
    kept = lines.persist()
    try:
        for p in paths:
            kept.write.mode("overwrite").text(p)
    finally:
        kept.unpersist()


def merge_files(spark: SparkSession, source: str, target: str, newline: bool = False) -> None:
    """Lines of a folder's files, in file order, as one file: for results that are small.
    newline: an empty line after each file."""
    at = F.col("_metadata.file_path").alias("f")
    rows = spark.read.text(source).select("value", at, F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    if newline:
        ends = spark.read.format("binaryFile").load(source).select(F.lit("").alias("value"), F.col("path").alias("f"), F.lit((1 << 63) - 1).alias("b"), F.lit(0).cast("long").alias("i"))
        rows = rows.unionByName(ends)
    rows.orderBy("f", "b", "i").select("value").coalesce(1).write.mode("overwrite").text(target)


def upload_source(spark: SparkSession, files: list[str], local_dir: str | None = None, store: list[str] | None = None, store_recursive: bool = False) -> DataFrame:
    """Lines of a user's files, a folder tree and files in a store, together."""
    parts = []
    if any(files):
        parts.append(read_lines(spark, *files))
    if local_dir:
        parts.append(read_lines(spark, local_dir, recursive=True))
    if store:
        parts.append(read_lines(spark, *store, recursive=store_recursive))
    if not parts:
        raise SourceError("no files")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def file_system(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) for mkdirs, rename, delete, permissions and the like."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def make_dir(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str, force: bool = False) -> bool:
    """Rename, or move into a folder that exists; force replaces a file."""
    fs, p = file_system(spark, source)
    _, t = file_system(spark, target)
    if force and fs.exists(t) and fs.getFileStatus(t).isFile():
        fs.delete(t, False)
    return fs.rename(p, t)


def remove(spark: SparkSession, path: str, recursive: bool = False, force: bool = False) -> bool:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        if force:
            return False
        raise SourceError(f"no file {path}")
    if fs.getFileStatus(p).isDirectory() and not recursive:
        raise SourceError(f"{path} is a folder")
    return fs.delete(p, recursive)


def touch(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        fs.create(p).close()


def set_mode(spark: SparkSession, path: str, mode: int) -> None:
    """Access rights, as 0o640."""
    fs, p = file_system(spark, path)
    fs.setPermission(p, spark.sparkContext._jvm.org.apache.hadoop.fs.permission.FsPermission(format(mode, "o")))


def set_owner(spark: SparkSession, path: str, owner: str | None = None, group: str | None = None) -> None:
    fs, p = file_system(spark, path)
    fs.setOwner(p, owner, group)


def set_times(spark: SparkSession, path: str, modified: int, accessed: int = -1) -> None:
    """Times in milliseconds since 1970; -1 leaves one as it is."""
    fs, p = file_system(spark, path)
    fs.setTimes(p, modified, accessed)


def status(spark: SparkSession, path: str) -> dict:
    """What the store says of one file or folder."""
    fs, p = file_system(spark, path)
    s = fs.getFileStatus(p)
    return {"length": s.getLen(), "folder": s.isDirectory(), "modified": s.getModificationTime(), "mode": int(s.getPermission().toOctal()), "owner": s.getOwner(), "group": s.getGroup(), "block": s.getBlockSize()}


def content_summary(spark: SparkSession, path: str) -> dict[str, int]:
    fs, p = file_system(spark, path)
    s = fs.getContentSummary(p)
    return {"bytes": s.getLength(), "replicated": s.getSpaceConsumed(), "files": s.getFileCount(), "folders": s.getDirectoryCount()}
