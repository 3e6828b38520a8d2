import pytest
from pyspark.sql import functions as F

from sluice import queries
from sluice.plans import audience, days, reports, sqltext


def test_days():
    assert days.day_list("20181212", "20181214") == ["20181214", "20181213", "20181212"]
    assert days.day_range("20181212,20181214") == ("20181212", "20181214", 3)
    assert days.day_range("20181212")[2] == 1
    assert days.last_days("20190101", "20190131") == ["20190131", "20190130", "20190129", "20190128", "20190127", "20190126", "20190125"]
    with pytest.raises(ValueError):
        days.day_range("20181214,20181212")


def test_ctas_and_names():
    assert sqltext.ctas("select * from dmp.stage_114", "dmpstage.461") == "CREATE TABLE IF NOT EXISTS dmpstage.461 as select * from dmp.stage_114"
    assert sqltext.ctas("CREATE TABLE x  AS\n select 1", "y") == "CREATE TABLE x AS select 1"
    assert sqltext.target_table("CREATE TABLE IF NOT EXISTS dmpstage.461_sid AS select 1") == "dmpstage.461_sid"
    assert sqltext.target_table("CREATE TABLE dmpstage.461_sid AS select 1") == "dmpstage.461_sid"
    assert sqltext.target_table("select 1") is None


def test_sql_checks(spark):
    assert sqltext.is_sql(spark, "select a from b where c > 1")
    assert not sqltext.is_sql(spark, "selec a frm b")
    assert sorted(sqltext.table_names(spark, "select * from db.a join b on a.x = b.x where y in (select y from c)")) == ["b", "c", "db.a"]
    for sql in ("drop TABLE x", "DROP /* hidden */ TABLE IF EXISTS x"):
        with pytest.raises(sqltext.SqlError):
            sqltext.check_safe(spark, sql)
    sqltext.check_safe(spark, "create TABLE x (a int)")
    sqltext.check_safe(spark, "select 'DROP TABLE x' as a")


@pytest.fixture(scope="module")
def builder(spark, small):
    return queries._builder(spark, small)


def test_audience_errors(builder):
    for bad in ({"op": "$and", "rules": []}, {"op": "$xor", "rules": []}, {"key": "tag", "op": "in", "value": []}, {"key": "tag", "op": "nin", "value": [1]}, {"key": "tag", "op": "in", "value": [99]}, {"key": "nope", "op": "=", "value": 1}, {"key": "clickCount", "op": "in", "value": [1]}, {"key": "x"}):
        with pytest.raises(audience.AudienceError):
            builder.build(bad)
    builder.tags[5] = {"key": "tag", "op": "in", "value": [6]}
    builder.tags[6] = {"key": "tag", "op": "in", "value": [5]}
    with pytest.raises(audience.AudienceError):
        builder.build({"key": "tag", "op": "in", "value": [5]})


def test_audience_shares_stages(builder):
    leaf = {"key": "campaign", "op": "in", "value": [1, 2]}
    first = builder.build(leaf)
    assert builder.build({"op": "$or", "rules": [leaf, leaf]}) is not first
    n = len(builder.stages)
    assert builder.build(leaf) is first and len(builder.stages) == n
    assert builder.build({"key": "tag", "op": "in", "value": [1]}) is builder.build(builder.tags[1])
    assert "<-" in builder.describe() and len(builder.sequence()) == len(builder.stages)


def test_stage_names_and_types(spark):
    a = audience.stage_name(1, [2, 1], 1, ("20240101", "20240102"), {"key": "campaign", "op": "in", "value": [1]})
    assert a == audience.stage_name(1, [1, 2], 1, ("20240101", "20240102"), {"key": "campaign", "op": "in", "value": [1]})
    assert audience.etype_of("PC") == 1 and audience.etype_of("mobile") == 2
    with pytest.raises(audience.AudienceError):
        audience.etype_of("tv")
    suppliers = spark.createDataFrame([(9990, 19990), (9991, 19991)], "id int, account_id int")
    assert audience.supplier_accounts([9990, 9991], suppliers) == [19990, 19991]
    with pytest.raises(audience.AudienceError):
        audience.supplier_accounts([1], suppliers)
    with pytest.raises(audience.AudienceError):
        audience.table_count(suppliers.filter("id = 0"))


def test_report_gates(spark, small):
    ctx = queries.context(spark, small)
    names = {(r.dimension, r.metric) for r in reports.applicable(ctx)}
    assert ("sex", "value") in names and ("mob_os", "value") not in names
    from dataclasses import replace

    bare = replace(ctx, suppliers={})
    assert {(r.dimension, r.metric) for r in reports.applicable(bare)} == {("sex", "value"), ("age", "value"), ("industry", "value"), ("hotsite", "visitors")} | {(d, m) for d, m in names if not reports.REPORTS[d, m].products}
    with pytest.raises(reports.ReportError):
        reports.build_report(ctx, "mob_os", "value")
    with pytest.raises(reports.ReportError):
        reports.build_report(ctx, "no", "value")
    with pytest.raises(reports.ReportError):
        reports.build_report(replace(ctx, geo=None), "region", "click")
    short = replace(ctx, first="20240110", last="20240111")
    both = reports.by_day(short, "summary", "impressions").collect()
    assert [r.day for r in both] == ["20240111", "20240110"]
    assert sum(r.cnt for r in both) == reports.build_report(short, "summary", "impressions").first().cnt


def test_merge_runs(spark):
    df = spark.createDataFrame([(["a", "a", "b", "a", "a"],), ([],), (["x"],)], "p array<string>")
    assert [r[0] for r in df.select(reports.merge_runs(F.col("p"))).collect()] == [["a", "b", "a"], [], ["x"]]
    assert spark.range(1).select(reports.domain_of(F.lit("http://www.a-b.com/x"))).first()[0] == "www.a"


def test_semi_join_and_pushdown(spark, small):
    plan = reports.build_report(queries.context(spark, small), "summary", "impressions")._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "PushedFilters" in plan
