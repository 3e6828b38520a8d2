import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sluice import queries
from sluice.operators.ranges import ip_number, narrowest
from sluice.plans import reports


def test_ip_number(spark):
    ips = ["0.0.0.0", "255.255.255.255", "10.0.3.7", "256.1.1.1", "1.2.3", "a.b.c.d", "1.2.3.4.5", "", None, "1.2.3.4\n"]
    df = spark.createDataFrame([(x,) for x in ips], "ip string")
    assert [r[0] for r in df.select(ip_number(F.col("ip"))).collect()] == [0, 2**32 - 1, (10 << 24) + 775, *[None] * 7]


def test_narrowest_range(spark):
    """Nested, touching, overlapping and repeated ranges, gaps, one point, all points."""
    rng = random.Random(6)
    top = 2**32 - 1
    ranges = [(0, top, "all"), (5, 5, "one"), (top, top, "last"), (100, 199, "a"), (200, 299, "b"), (150, 249, "c"), (150, 249, "bb"), (7, 3, "empty"), (2**24 - 1, 2**24, "border"), (2**31, 2**31 + 2**16, "wide")]
    for i in range(60):
        a = rng.choice([rng.randrange(2**32), rng.randrange(1000), 2**31 + rng.randrange(2**17)])
        ranges.append((a, min(top, a + rng.choice([0, 3, 200, 2**9, 2**16, 2**16 - 1, 2**20, 2**25, 2**31])), f"r{i}"))
    points = [None, -1, 2**32, 0, 5, 6, 7, top, top - 1, 2**24, 2**24 - 1, 2**24 + 1, *range(95, 305, 7), *[rng.randrange(2**32) for _ in range(100)], *[2**31 + rng.randrange(2**17) for _ in range(50)]]
    points += points[:20]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "i int, p long").repartition(8)

    def model(p, ranges):
        held = [(b - a, -a, n) for a, b, n in ranges if p is not None and a <= p <= b]
        return min(held)[2] if held else None

    for some in (ranges, ranges[1:], []):
        table = spark.createDataFrame(some, "first long, last long, name string")
        out = narrowest(rows, "p", table)
        assert out.columns == ["i", "p", "name"]
        assert {r.i: r.name for r in out.collect()} == {i: model(p, some) for i, p in enumerate(points)}
    plan = narrowest(rows, "p", table)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def rows_made(df):
    """The most rows that a node of the plan, as it ran, gave on."""
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name, made = node.nodeName(), node.metrics().get("numOutputRows")
        most = max(most, made.get().value() if made.isDefined() else 0)
        todo += [node.executedPlan()] if name.startswith("AdaptiveSparkPlan") else [node.plan()] if "QueryStage" in name else []
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return most


@pytest.mark.parametrize("share", [1 << 16, 50, 7])
def test_overlapping_ranges_make_no_pairs(spark, monkeypatch, share):
    """Some thousand points in some thousand ranges each; many that begin or end together; many parts."""
    monkeypatch.setattr("sluice.operators.ranges.SHARE", share, raising=False)
    rng = random.Random(8)
    ranges = [(a := rng.choice([0, 500, rng.randrange(4000), 9000]), a + rng.choice([0, 1, 700, 60_000, rng.randrange(20_000)]), i) for i in range(900)]
    ranges += [(4000, 4000, 1000), (4000, 4000, 999), (-5, 2**33, 1001), (None, 5, 1002), (2**40, 2**41, 1003), (-9, -2, 1004)]
    points = [rng.randrange(30_000) for _ in range(900)] + [4000, 0, 2**32 - 1, 2**32, -1, None]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "i int, p long").repartition(5)
    table = spark.createDataFrame(ranges, "first long, last long, band int").repartition(3)
    out = narrowest(rows, "p", table)
    got = {r.i: r.band for r in out.collect()}
    held = lambda p: min(((b - a, -a, n) for a, b, n in ranges if a is not None and p is not None and 0 <= p < 2**32 and a <= p <= b), default=(None,))[-1]
    assert got == {i: held(p) for i, p in enumerate(points)}
    assert rows_made(out) < 4 * (len(points) + len(ranges))


DAILY = [("sex", "value"), ("sex", "impressions"), ("os", "visitors"), ("os", "click"), ("hobby", "value"), ("hobby", "click"), ("hotsite", "visitors"), ("keyword", "session"), ("page", "session"), ("page", "pageviews"), ("region", "session"), ("region", "visitors"), ("source", "visitors"), ("summary", "session"), ("summary", "visitors"), ("depth", "session"), ("depth", "visitors"), ("frequency", "visitors"), ("ad_summary", "click"), ("path", "topology"), ("path", "percent")]


@pytest.mark.parametrize("dimension, metric", DAILY)
def test_days_are_as_one_report_each(spark, small, dimension, metric):
    ctx = replace(queries.context(spark, small), first="20240109", last="20240111")
    out = reports.by_day(ctx, dimension, metric, total=True)
    own = [c for c in out.columns if c != "day"]
    got = sorted(((r["day"], *[r[c] for c in own]) for r in out.collect()), key=str)
    want = []
    for day in [*ctx.days, None]:
        one = reports.build_report(replace(ctx, first=day or ctx.first, last=day or ctx.last), dimension, metric)
        assert one.columns == own
        want += [(day, *r) for r in one.collect()]
    assert got == sorted(want, key=str) and got


def test_scans_do_not_grow_with_days(spark, small):
    def scans(first, last):
        ctx = replace(queries.context(spark, small), first=first, last=last)
        return reports.by_day(ctx, "region", "visitors", total=True)._jdf.queryExecution().executedPlan().toString().count("FileScan")

    assert scans("20240105", "20240105") == scans("20240101", "20240130")


def test_total_of_paths_is_one_broadcast_row(spark, small):
    plan = reports.build_report(queries.context(spark, small), "path", "percent")._jdf.queryExecution().executedPlan().toString()
    assert "Window [sum" not in plan and "BroadcastNestedLoopJoin" in plan
