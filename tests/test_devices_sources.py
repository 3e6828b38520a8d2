import pytest
from pyspark.sql import functions as F

from sluice.functions import devices, geo, text
from sluice.operators import rows, sets
from sluice.sources import cells, files, messages, tables
from sluice.streaming import rules as streams


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_line_stats(spark):
    one = lambda *v, e=2: tuple(devices.line_stats(lines(spark, *v), e).first())
    assert one("idfa 478AA328-6844-4502-965E-3AAA78C12CD2") == (1, 0, 1)
    assert one("imei 12", "nope 123", "a b c", "single", "  ", None) == (4, 2, 2)
    assert one("anything", "", e=1) == (1, 0, 1)
    assert tuple(devices.line_stats(lines(spark).filter("false")).first()) == (0, 0, 0)


def test_normalise(spark):
    run = lambda sub, *v: sorted(r[0] for r in devices.normalise(lines(spark, *v), sub_type=sub).collect())
    idfa = "478AA328-6844-4502-965E-3AAA78C12CD2"
    assert run("idfa", idfa, idfa, "short") == [f"idfa\t{idfa}"]
    assert run("did", idfa, "0123456789abcdef", "xyz") == ["android-id\t0123456789abcdef", f"idfa\t{idfa}"]
    assert run("imei", "imei 12345678901234x", "imei 123456789012345", "new  v", "a b c") == ["a\tb\tc", "imei\t123456789012345", "new\tv"]
    assert sorted(r[0] for r in devices.normalise(lines(spark, "a b", "a b", "c"), 1).collect()) == ["a b", "c"]
    with pytest.raises(devices.DeviceError):
        devices.normalise(lines(spark, "a"), sub_type="nope")


def test_characters(spark):
    is_ = lambda f, s: spark.range(1).select(f(F.lit(s))).first()[0]
    assert is_(devices.is_idfa, "2589F89C-A93C-479A-B257_80B035D8C281") and not is_(devices.is_idfa, "2589&&")
    assert is_(devices.is_number, "") and not is_(devices.is_hex, "xyz") and is_(devices.is_cookie, "1" * 15)


def test_box():
    lo_x, hi_x, lo_y, hi_y = geo.box(39.9, 116.397128, 1000)
    assert lo_x < 116397128 < hi_x and lo_y < 39900000 < hi_y
    assert hi_y - 39900000 == int(1000 / 40008000.0 * 360 * 1e6)
    assert geo.longitude_span(1000) == pytest.approx(1000 / 6371000 * 57.29577951, rel=1e-6)


def test_text(spark):
    sizes = [r[0] for r in spark.createDataFrame([(1,), (1536,), (3 * 1024**2,)], "n long").select(text.human_bytes(F.col("n"))).collect()]
    assert sizes == ["1B", "1.5K", "3.0M"]
    assert text.replace_extension("a/b.txt", "csv") == "a/b.csv"


def test_csv_and_rules(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('advid,visitorid,price\n34828,1,300.0\n34828,,15\n1,3,7\n')
    got = files.rule_over_csv(spark, str(p), 'advid = "34828" | visitorid').collect()
    assert [r.visitorid for r in got] == ["1", ""]
    assert [r.visitorid for r in files.rule_over_csv(spark, str(p), "price > 20 | visitorid").collect()] == ["1"]
    with pytest.raises(files.SourceError):
        files.rule_over_csv(spark, str(p), "nope = 1 | visitorid")
    with pytest.raises(files.SourceError):
        files.read_lines(spark, "", "")


def test_files(spark, tmp_path):
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "a.txt").write_text("hi\nhello\n")
    (tmp_path / "d" / "e" / "b.txt").write_text("world\n")
    assert files.read_lines(spark, str(tmp_path / "d" / "a.txt"), "").count() == 2
    assert files.read_lines(spark, str(tmp_path / "d"), recursive=True).count() == 3
    assert files.read_lines(spark, str(tmp_path / "d" / "*.txt")).count() == 2
    tree = files.listing(spark, str(tmp_path / "d"))
    assert sorted(r.length for r in tree.collect()) == [6, 9]
    assert files.usage(tree, 40).agg(F.sum("bytes")).first()[0] == 15
    files.split_lines(lines(spark, "1", "2", "3").coalesce(1), str(tmp_path / "s"), 2)
    assert sorted(len(f.read_text().split()) for f in (tmp_path / "s").glob("part-*")) == [1, 2]
    files.fan_out(lines(spark, "1"), str(tmp_path / "x"), str(tmp_path / "y"))
    assert spark.read.text([str(tmp_path / "x"), str(tmp_path / "y")]).count() == 2
    assert files.upload_source(spark, [str(tmp_path / "d" / "a.txt")], str(tmp_path / "d")).count() == 5
    files.make_dir(spark, str(tmp_path / "n"))
    files.touch(spark, str(tmp_path / "n" / "t"))
    assert files.content_summary(spark, str(tmp_path / "n"))["files"] == 1
    with pytest.raises(files.SourceError):
        files.remove(spark, str(tmp_path / "n"))
    assert files.move(spark, str(tmp_path / "n" / "t"), str(tmp_path / "t2")) and files.remove(spark, str(tmp_path / "n"), recursive=True)
    assert not files.remove(spark, str(tmp_path / "gone"), force=True)
    files.merge_files(spark, str(tmp_path / "d"), str(tmp_path / "m"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "m")).collect()] == ["hi", "hello"]
    assert files.checksums(spark, str(tmp_path / "d" / "a.txt")).count() == 1


def test_report_store(spark, tmp_path):
    df = lambda *r: spark.createDataFrame(list(r), "dt string, cnt int")
    path = str(tmp_path / "store")
    tables.save_report(df(("20240101", 1), ("20240102", 2)), path, 7, "click")
    tables.save_report(df(("20240102", 5)), path, 7, "click")
    tables.save_report(df(("20240102", 9)), path, 8, "click")
    got = sorted((r.tag_id, r.cnt) for r in spark.read.parquet(path).collect())
    assert got == [(7, 1), (7, 5), (8, 9)]
    assert sorted(r.id for r in tables.next_ids(spark.range(10).repartition(3).drop("id").withColumn("x", F.lit(1)), 5).collect()) == list(range(5, 15))
    assert tables.widened(spark.sql("select cast(1 as tinyint) a, cast(2 as float) b, 'x' c")).dtypes == [("a", "bigint"), ("b", "double"), ("c", "string")]


def test_cells(spark):
    c = spark.createDataFrame([("a", "f", "q", "1", 1), ("a", "f", "q", "2", 2), ("b", "f", "q", "3", 1), ("c", "f", "z", "4", 1)], "row string, family string, qualifier string, value string, ts long")
    assert [r.value for r in cells.scan(c, "a", "c").collect()] == ["2", "3"]
    assert [r.row for r in cells.scan(c, "c", "a", reverse=True).collect()] == ["c", "b"]
    assert [r.row for r in cells.scan(c, limit=2).collect()] == ["a", "b"]
    assert cells.get(c, ["a"], since=1, until=2).first().value == "1"
    assert cells.exists(c, "b") and not cells.exists(c, "b", [("f", "z")])
    assert cells.delete(c, c.filter("row = 'a'")).count() == 2
    assert cells.newest(cells.delete(c, c.filter("row = 'a'"), False)).filter("row = 'a'").first().value == "1"
    more = spark.createDataFrame([("a", "f", "q", 10), ("n", "f", "q", 1)], "row string, family string, qualifier string, amount long")
    assert {r.row: r.value for r in cells.newest(cells.increment(c, more, 9)).collect()}["a"] == "12"
    assert cells.check_and_put(c, "a", "f", "q", "2", c.limit(1))[1] and not cells.check_and_put(c, "a", "f", "q", "1", c)[1]


def test_rows(spark):
    df = spark.range(10)
    assert [r.id for r in rows.tail(df, 2, ["id"]).collect()] == [8, 9]
    assert rows.page_and_count(df, ["-id"], 1, 1)[1] == 10
    assert rows.exists(df, F.col("id") == 3) and rows.scalar(df.agg(F.max("id"))) == 9
    assert list(rows.column_values(df))[:2] == [0, 1]
    assert rows.next_due(df.withColumn("at", F.col("id")), -1).count() == 0
    assert [r[0] for r in rows.map_lines(lines(spark, "ab", None), str.upper).collect()] == ["AB", None]
    a = lambda *x: F.array(*map(F.lit, x))
    one = spark.range(1).select(sets.has_any(a(1, 2), a(2, 3, 4)).alias("x"), sets.has_any(a(1, 2), a(2, 3, 4), True).alias("y"), sets.has_all(a(1, 2), a(2)).alias("z")).first()
    assert tuple(one) == (True, False, True)


def test_message_options():
    o = messages.source_options("h:1", "t", [0, 1], "earliest", "latest", 10)
    assert o["assign"] == '{"t": [0, 1]}' and o["failOnDataLoss"] == "false" and o["maxOffsetsPerTrigger"] == "10"
    assert "subscribe" in messages.source_options("h:1", "t")


def test_stream_restarts(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    lines(spark, '{"a":1,"b":"x"}', "broken", '{"a":2,"b":"y"}').write.text(src)
    go = lambda: streams.start(streams.filter_stream(streams.line_stream(spark, src, 1), "a >= 1 | b"), out, cp).awaitTermination()
    go()
    lines(spark, '{"a":3,"b":"z"}').write.mode("append").text(src)
    go()
    go()
    assert sorted(r.b for r in spark.read.parquet(out).collect()) == ["x", "y", "z"]
    seen = []
    q = streams.move(streams.line_stream(spark, src), lambda df, n: seen.append((n, df.count())), str(tmp_path / "cp2"))
    q.awaitTermination()
    assert sum(c for _, c in seen) == 4 and streams.progress(q)["rows"] == 4
