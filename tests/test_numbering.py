import pytest
from pyspark.sql import functions as F

from sluice.operators import numbering
from sluice.sources import files, tables


@pytest.mark.parametrize("parts, n, every", [(4, 25, 7), (8, 25, 5), (3, 1, 7), (5, 40, 100), (4, 0, 3), (1, 6, 1)])
def test_split_is_exact_over_partitions(spark, tmp_path, parts, n, every):
    lines = spark.range(0, n, 1, parts).select(F.concat(F.lit("line "), F.col("id")).alias("value"))
    out = f"file://{tmp_path}/out"
    files.split_lines(lines, out, every)
    got = {}
    for f in sorted((tmp_path / "out").rglob("part-*")):
        got.setdefault(int(f.name[5:10]), []).append(f.read_text().splitlines())
    want = [f"line {i}" for i in range(n)]
    assert got == {k: [want[k * every : (k + 1) * every]] for k in range(-(-n // every))}
    if n:
        assert sorted((r.file, r.value) for r in files.split_parts(spark, out).collect()) == sorted((i // every, w) for i, w in enumerate(want))


def test_split_uneven_partitions_nulls_and_errors(spark, tmp_path):
    rows = [None if i % 5 == 0 else f"r{i}" for i in range(60)]
    lines = spark.sparkContext.parallelize([(i, v) for i, v in enumerate(rows)], 8).toDF("i int, v string")
    uneven = lines.repartitionByRange(8, "i").sortWithinPartitions("i").filter("i < 3 or i > 30")
    files.split_lines(uneven.select("v"), f"file://{tmp_path}/o", 4)
    kept = [v or "" for i, v in enumerate(rows) if i < 3 or i > 30]
    got = {int(f.name[5:10]): f.read_text().split("\n")[:-1] for f in (tmp_path / "o").rglob("part-*")}
    assert [x for k in sorted(got) for x in got[k]] == kept and all(len(got[k]) == 4 for k in sorted(got)[:-1])
    with pytest.raises(files.SourceError):
        files.split_lines(lines.select("v"), f"file://{tmp_path}/p", 0)


@pytest.mark.parametrize("n, every", [(100, 4), (97, 4), (9, 4), (100, 30), (41, 1)])
def test_many_files_take_few_tasks(spark, tmp_path, monkeypatch, n, every):
    """More files than tasks: each task reports to the driver, so there must not be one for each file."""
    monkeypatch.setattr(files, "TASKS", 5, raising=False)
    lines = spark.range(0, n, 1, 3).select(F.col("id").cast("string").alias("value"))
    out = f"file://{tmp_path}/out"
    files.split_lines(lines, out, every)
    names = sorted(f.name for f in (tmp_path / "out").glob("part-*"))
    assert len(names) == -(-n // every) and len({x[5:10] for x in names}) <= 5
    assert sorted((r.file, int(r.value)) for r in files.split_parts(spark, out).collect()) == [(i // every, i) for i in range(n)]
    sizes = [sum(len(str(i)) + 1 for i in range(k, min(n, k + every))) for k in range(0, n, every)]
    assert sorted(tuple(r) for r in files.split_files(spark, out).collect()) == list(enumerate(sizes))
    assert [int(x) for name in names for x in (tmp_path / "out" / name).read_text().split()] == list(range(n))


def test_numbers_on_eight_partitions(spark):
    df = spark.range(0, 1000, 1, 8).filter("id % 7 <> 0").filter("id < 300 or id > 700")
    got = [tuple(r) for r in tables.next_ids(df, 5, "n").orderBy("n").collect()]
    ids = [i for i in range(1000) if i % 7 and (i < 300 or i > 700)]
    assert got == [(i, 5 + k) for k, i in enumerate(ids)]
    assert tables.next_ids(df.filter("id < 0"), 5).count() == 0


def test_running_total(spark):
    df = spark.range(0, 500, 1, 8).select((F.col("id") * 37 % 500).alias("k"), (F.col("id") % 11).alias("v"))
    got = {r.k: r.total for r in numbering.running_total(df, ["k"], F.col("v"), "total", 8).collect()}
    values = dict((r.k, r.v) for r in df.collect())
    total = 0
    for k in sorted(values):
        total += values[k]
        assert got[k] == total


def test_no_task_sees_all_lines(spark, tmp_path):
    """The one exchange of lines is by file; nothing but counts goes to a single partition."""
    lines = spark.range(0, 1000, 1, 8).select(F.col("id").cast("string").alias("value"))
    plan = numbering.numbered(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1 and "HashAggregate" in plan


def test_merge_with_newlines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text(f"a{i}\nb{i}\n")
    files.merge_files(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", newline=True)
    assert next((tmp_path / "out").glob("part-*")).read_text() == "a0\nb0\n\na1\nb1\n\na2\nb2\n\n"


def test_work_folder_on_a_cluster(monkeypatch, spark):
    class Other:
        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

        class sparkContext:  # noqa: N801
            master = "local-cluster[2,1,1024]"

    with pytest.raises(RuntimeError):
        numbering.work_folder(Other)
