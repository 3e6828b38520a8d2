import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from sluice.functions import devices
from sluice.sources import tables

SCHEMA = "dt string, cnt long"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA).repartition(4)


def stored(spark, path):
    return sorted((r.tag_id, r.metric_name, r.dt, r.cnt) for r in tables.read_reports(spark, path, SCHEMA).collect())


def test_a_range_is_replaced_whole(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    assert stored(spark, path) == []
    tables.replace_report(rows(spark, *[(f"2024010{d}", d) for d in range(1, 8)]), path, 1, "click", "20240101", "20240107")
    tables.replace_report(rows(spark, ("20240103", 1)), path, 2, "click", "20240101", "20240107")
    tables.replace_report(rows(spark, ("20240103", 30), ("20240103", 31), ("20240109", 9)), path, 1, "click", "20240102", "20240105")
    want = [(1, "click", "20240101", 1), (1, "click", "20240103", 30), (1, "click", "20240103", 31), (1, "click", "20240106", 6), (1, "click", "20240107", 7), (2, "click", "20240103", 1)]
    assert stored(spark, path) == want
    tables.replace_report(rows(spark, ("20240101", 0)).filter("cnt > 0"), path, 2, "click", "20240101", "20240107")
    assert stored(spark, path) == want[:-1]
    for k in range(3):
        tables.replace_report(rows(spark, ("20240101", k)), path, 3, "x", "20240101", "20240101")
    assert sorted(p.name for p in (tmp_path / "s/tag_id=3/metric_name=x").iterdir()) == ["version=2", "version=3"]


def test_failures_leave_old_or_new(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/s"
    tables.replace_report(rows(spark, ("20240101", 1), ("20240102", 2)), path, 1, "m", "20240101", "20240131")
    before = stored(spark, path)
    bad = rows(spark, ("20240101", 7), ("20240102", 8), ("20240103", 9)).withColumn("cnt", F.when(F.col("cnt") == 9, F.raise_error(F.lit("a task fails")).cast("long")).otherwise(F.col("cnt")))
    with pytest.raises(Exception, match="a task fails"):
        tables.replace_report(bad, path, 1, "m", "20240101", "20240131")
    assert stored(spark, path) == before
    assert [p.name for p in (tmp_path / "s/tag_id=1/metric_name=m").iterdir()] == ["version=1"]
    new = rows(spark, ("20240101", 7))
    real = tables._commit
    monkeypatch.setattr(tables, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("the driver dies")))
    with pytest.raises(RuntimeError):
        tables.replace_report(new, path, 1, "m", "20240101", "20240131")
    assert stored(spark, path) == before

    def late(spark_, at, target):  # another writer commits first
        from sluice.sources.files import file_system

        file_system(spark_, str(target))[0].mkdirs(target)
        real(spark_, at, target)

    monkeypatch.setattr(tables, "_commit", late)
    with pytest.raises(tables.ReportConflict):
        tables.replace_report(new, path, 1, "m", "20240101", "20240131")
    monkeypatch.setattr(tables, "_commit", real)
    tables.replace_report(new, path, 1, "m", "20240101", "20240131")
    assert stored(spark, path) == [(1, "m", "20240101", 7)]


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    rows_ = spark.createDataFrame([("imei", "1"), ("", "2"), (None, "3"), ("idfa", "éé")], "typ string, did string").repartition(3).mapInPandas(seen, "typ string, did string")
    told = devices.export_to(rows_, 2, f"file://{tmp_path}/o")
    text = "".join(p.read_text() for p in (tmp_path / "o").glob("part-*"))
    assert told == {"total": 4, "lines": 2, "bytes": len(text.encode())} and reads.value == 4
    assert devices.export_to(rows_.filter("did = 'no'"), 2, f"file://{tmp_path}/p") == {"total": 0, "lines": 0, "bytes": 0}


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from sluice.functions import devices
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
def once(batches):
    for b in batches:
        yield b
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() != 1:
        raise ValueError("the first attempt fails after its last row")
rows = spark.range(0, 1000, 1, 4).selectExpr("'imei' as typ", "cast(id as string) as did").mapInPandas(once, "typ string, did string")
print("TOLD", devices.export_to(rows, 2, sys.argv[1]))
"""


def test_counts_with_tasks_that_are_tried_again(tmp_path):
    out = subprocess.run([sys.executable, "-c", RETRIED, f"file://{tmp_path}/o"], capture_output=True, text=True, timeout=300)
    size = sum(len(f"imei\t{i}\n") for i in range(1000))
    assert f"TOLD {{'total': 1000, 'lines': 1000, 'bytes': {size}}}" in out.stdout, out.stderr[-2000:]


def test_rights_times_and_names(spark, tmp_path):
    from datetime import datetime

    from sluice.functions import text
    from sluice.sources import files

    path = tmp_path / "f.txt"
    path.write_text("abc")
    files.set_mode(spark, str(path), 0o640)
    files.set_times(spark, str(path), 1_700_000_000_000)
    told = files.status(spark, str(path))
    assert path.stat().st_mode & 0o777 == 0o640 and told["mode"] == 640
    assert (told["length"], told["folder"], told["modified"]) == (3, False, 1_700_000_000_000)
    files.set_owner(spark, str(path), told["owner"], told["group"])
    names = text.unique_names(["/a/b.csv", "/a/b.txt", "/c/d"], datetime(2024, 1, 2, 3, 4, 5))
    assert names == ["/a/b20240102030405.txt", "/a/b20240102030405-2.txt", "/c/d20240102030405.txt"]
