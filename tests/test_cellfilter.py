import pytest

from sluice.sources import cellfilter
from sluice.sources.cellfilter import FilterError, filtered

CELLS = [("r1", "f", "a", "1", 1), ("r1", "f", "a", "7", 2), ("r1", "g", "b", "x'y", 3), ("r2", "f", "a", "9", 1), ("r2", "f", "a", "2", 5), ("r2", "f", "ab", "Hello", 2), ("s1", "g", "c", "0", 4), ("s1", "f", "d", None, 4)]


@pytest.fixture(scope="module")
def cells(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('cells')}/c"
    spark.createDataFrame(CELLS, "row string, family string, qualifier string, value string, ts long").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def rows(test):
    return sorted((c for c in CELLS if test(*c)), key=str)


@pytest.mark.parametrize(
    "text, test",
    [
        ("PrefixFilter ('r')", lambda r, f, q, v, t: r[0] == "r"),
        ("PrefixFilter('r') AND QualifierFilter(=, 'binary:a') OR FamilyFilter(=,'binary:g')", lambda r, f, q, v, t: (r[0] == "r" and q == "a") or f == "g"),
        ("PrefixFilter('r') AND (QualifierFilter(=, 'binary:ab') OR FamilyFilter(=,'binary:g'))", lambda r, f, q, v, t: r[0] == "r" and (q == "ab" or f == "g")),
        ("ValueFilter(=, 'binary:x''y')", lambda r, f, q, v, t: v == "x'y"),
        ("ValueFilter(>=, 'binary:7')", lambda r, f, q, v, t: v is not None and v >= "7"),
        ("ValueFilter(=, 'substring:ELL')", lambda r, f, q, v, t: v == "Hello"),
        ("ValueFilter(=, 'regexstring:^[0-9]$')", lambda r, f, q, v, t: v is not None and v.isdigit()),
        ("QualifierFilter(=, 'binaryprefix:a')", lambda r, f, q, v, t: q[0] == "a"),
        ("ColumnPrefixFilter('ab') OR MultipleColumnPrefixFilter('c', 'd')", lambda r, f, q, v, t: q in ("ab", "c", "d")),
        ("ColumnRangeFilter('a', false, 'c', true)", lambda r, f, q, v, t: "a" < q <= "c"),
        ("TimestampsFilter(1, 4) AND InclusiveStopFilter('r2')", lambda r, f, q, v, t: t in (1, 4) and r <= "r2"),
        ("RowFilter(!=, 'binary:r1')", lambda r, f, q, v, t: r != "r1"),
        ("SKIP ValueFilter(!=, 'binary:0')", lambda r, f, q, v, t: r != "s1"),
        ("SKIP QualifierFilter(<, 'binary:b') AND ValueFilter(>, 'binary:2')", lambda r, f, q, v, t: r == "r2" and v > "2"),
        ("SingleColumnValueFilter('f', 'a', <, 'binary:5')", lambda r, f, q, v, t: r != "r1"),
        ("SingleColumnValueFilter('f', 'a', <, 'binary:5', true, true)", lambda r, f, q, v, t: r == "r2"),
        ("SingleColumnValueFilter('f', 'a', <, 'binary:5', true, false)", lambda r, f, q, v, t: r in ("r1", "r2")),
    ],
)
def test_filters(cells, text, test):
    assert sorted((tuple(r) for r in filtered(cells, text).collect()), key=str) == rows(test)


def test_keys_and_versions(cells):
    assert {r.value for r in filtered(cells, "KeyOnlyFilter()").collect()} == {""}
    assert sorted((r.row, r.value) for r in cellfilter.scan(cells, "QualifierFilter(=, 'binary:a')").collect()) == [("r1", "7"), ("r2", "2")]


@pytest.mark.parametrize("bad", ["", "PrefixFilter", "PrefixFilter('a'", "Nope('a')", "PrefixFilter('a') AND", "PrefixFilter('a') 'b'", "ValueFilter(=, 'x')", "ValueFilter(<, 'substring:x')", "PrefixFilter('a', 'b')", "ColumnRangeFilter('a', yes, 'b', true)", "$", "SKIP SKIP ValueFilter(=, 'binary:1')"])
def test_errors(cells, bad):
    with pytest.raises(FilterError):
        filtered(cells, bad)


def test_filters_reach_the_scan(cells):
    plan = filtered(cells, "PrefixFilter('r1') AND ValueFilter(>, 'binary:3')")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(row,r1)" in plan and "GreaterThan(value,3)" in plan and "Exchange" not in plan
