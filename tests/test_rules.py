import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluice import rules
from sluice.functions import values

#: Rule texts and the SQL that they stand for.
GOLDEN = [
    ("a = (1 + (2 * 3))  | userId", "SELECT userId FROM table WHERE a = 1 + (2 * 3)"),
    ('(((adv="a" or d="2")) and c="d") | userId', 'SELECT userId FROM table WHERE (adv = "a" or d = "2") and c = "d"'),
    ('adv = "xxx" | count()>23 | userId', 'SELECT userId FROM table WHERE adv = "xxx" HAVING count(*) > 23'),
    ('adv="xxx" and create>10 | distinct(素材) | count() = 124 | userId', 'SELECT userId FROM table WHERE adv = "xxx" and create > 10 GROUP BY 素材, userId HAVING count(*) = 124'),
    ("distinct(userId)", "SELECT userId FROM table GROUP BY userId"),
    ('adv = "xxx" | distinct(userId)', 'SELECT userId FROM table WHERE adv = "xxx" GROUP BY userId'),
    ('url ~ "host/%" | distinct(userId)', 'SELECT userId FROM table WHERE url like "host/%" GROUP BY userId'),
    ('adv = "xxx" | userId,adv', 'SELECT userId, adv FROM table WHERE adv = "xxx"'),
    ('advid = "35635" | distinct(advid) | count() > 3 | visitorId', 'SELECT visitorId FROM table WHERE advid = "35635" GROUP BY advid, visitorId HAVING count(*) > 3'),
    ('advid = "123" | visitor.id', 'SELECT visitor.id FROM table WHERE advid = "123"'),
]


@pytest.mark.parametrize(("rule", "sql"), GOLDEN)
def test_sql_text(rule, sql):
    assert rules.to_sql("table", rule) == sql


@pytest.mark.parametrize("bad", ["a = 1.5 | b", "a = -1 | b", "a = 'x' | b", "a && b", "sum() > 1", "a = 1 | b = 2 | c = 3 | d = 4 | e", "(a = 1 | b", "a = 1\nand b = 2 | c", 'a = "open | b'])
def test_syntax_errors(bad):
    with pytest.raises(rules.RuleSyntaxError):
        rules.parse(bad)


def test_second_plain_filter_becomes_having_text():
    assert rules.to_sql("t", "a = 1 | b = 2 | c") == "SELECT c FROM t WHERE a = 1 HAVING b = 2"


def test_executable_sql_binds_left(spark):
    spark.createDataFrame([("1", "0", "0", "x"), ("1", "1", "1", "y")], "a string, b string, c string, n string").createOrReplaceTempView("t_bind")
    sql = rules.executable_sql("t_bind", 'a = "1" or b = "1" and c = "1" | n')
    assert [r.n for r in spark.sql(sql).collect()] == ["y"]


@pytest.fixture(scope="module")
def cells(spark):
    rows = [("300.0", "h"), ("15", "hello"), ("+5", "abc"), (" 5 ", ""), ("", None), (None, "NULL"), ("99999999999999999999", "a_c"), ("abc", "ab"), ("-7", "素材")]
    return spark.createDataFrame(rows, "price string, url string")


def model_compare(cell, op, value):
    """Plain Python model of a text cell against a literal."""
    import operator
    import re

    if cell is None:
        return False
    f = {"=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}[op]
    if isinstance(value, int):
        if re.fullmatch(r"[+-]?[0-9]+", cell) and -(2**63) <= int(cell) < 2**63:
            return f(int(cell), value)
        return f(cell.encode(), str(value).encode())
    return f(cell.encode(), value.encode())


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sampled_from(["=", "!=", "<", "<=", ">", ">="]), st.one_of(st.integers(0, 400), st.text("ab0159.+- ", max_size=4)))
def test_comparison_against_model(cells, op, value):
    from pyspark.sql import functions as F

    got = [r.m for r in cells.select(values.compare_text(F.col("price"), op, value).alias("m")).collect()]
    assert got == [model_compare(r.price, op, value) for r in cells.collect()]


@pytest.mark.parametrize(("pattern", "cell", "found"), [("h%", "akjhjkj", False), ("h", "hjkj", False), ("%h", "h", True), ("h%", "h", True), ("ab%bc", "abc", True), ("a_c", "abc", False), ("%a%", "a", False)])
def test_like(spark, pattern, cell, found):
    from pyspark.sql import functions as F

    assert spark.range(1).select(values.like(F.lit(cell), pattern).alias("m")).first().m is found


def test_execute_groups(spark):
    df = spark.createDataFrame([("a", "1", "2"), ("a", "1", "3.5"), ("b", "1", "x"), ("b", "0", "1"), ("c", "1", "9")], "k string, on string, v string")
    assert [r.k for r in rules.execute('on = "1" | distinct(k) | count() > 1', df).collect()] == ["a"]
    out = rules.execute("on = 1 | distinct(k) | sum(v) > 5", df, mode="table").orderBy("k").collect()
    assert [(r["k"], r["sum(v)"]) for r in out] == [("a", 5.5), ("c", 9.0)]
    assert sorted(r.k for r in rules.execute("distinct(k)", df).collect()) == ["a", "b", "c"]


def test_execute_errors(spark):
    df = spark.createDataFrame([("a", "1")], "k string, v string")
    for rule in ("v = 1 | count() > 1 | k", "x = 1 | k", "v = 1 | distinct(k) | nope(v) > 1", "v = 1"):
        with pytest.raises(rules.RuleRunError):
            rules.execute(rule, df)
    with pytest.raises(rules.RuleRunError):
        rules.execute("distinct(k)", df, strict=True)
    assert rules.execute('v = 1 | k = "a" | k', df).count() == 1


def test_json_keeps_kinds(spark):
    lines = ['{"p":300,"v":"1"}', '{"p":"300","v":"2"}', '{"p":300.5,"v":"3"}', '{"p":null,"v":"4"}', "broken", '{"v":"5"}', '{"p":true,"v":"6"}', '{"p":{"q":1},"v":"7"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    pick = lambda rule: [r.v for r in rules.execute_json(rule, df).collect()]
    assert pick("p = 300 | v") == ["1", "2"]
    assert pick('p > "20" | v') == ["1", "2", "3"]
    assert pick("p = true | v") == ["6"]
    assert pick("p.q = 1 | v") == ["7"]
    assert pick('p ~ "3%" | v') == ["2"]
    assert rules.execute_json('p = 300 and v = "1" | p', df, last_only=True).columns == ["v"]
