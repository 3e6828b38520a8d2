import random

import pytest
from pyspark.sql import functions as F

from sluice import queries
from sluice.plans import audience, bitmaps, sqltext


@pytest.fixture(scope="module")
def builder(spark, small):
    return queries._builder(spark, small)


def test_numbers_are_dense_and_grow(spark, tmp_path):
    ids = spark.createDataFrame([(x,) for x in ["b", "a", None, "c", "a"] * 30 + [str(i) for i in range(200)]], "id string").repartition(8)
    first = bitmaps.number_ids(ids, f"file://{tmp_path}/n")
    assert sorted(r.n for r in first.collect()) == list(range(203)) and first.filter("id is null").count() == 0
    more = bitmaps.add_ids(spark.createDataFrame([("a",), ("new",), (None,)], "id string"), first, f"file://{tmp_path}/m")
    assert {(r.id, r.n) for r in first.collect()} | {("new", 203)} == {(r.id, r.n) for r in more.collect()}


def test_random_trees_equal_joins(spark, builder, small):
    rng = random.Random(3)
    numbers = queries._numbers(spark, small).persist()

    def some(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice([{"key": "campaign", "op": "in", "value": rng.sample(range(25), 3)}, {"key": "mediaDomain", "op": "=", "value": f"site{rng.randrange(5)}"}, {"key": "clickCount", "op": rng.choice(["<", ">="]), "value": rng.randint(1, 12)}, {"key": "exposeCount", "op": ">=", "value": rng.randint(1, 20)}, {"key": "tag", "op": "in", "value": [1, 2]}])
        return {"op": rng.choice(["$and", "$or"]), "rules": [some(depth - 1) for _ in range(rng.randint(1, 3))]}

    for _ in range(4):
        data = {"op": "$or", "rules": [some(2), some(2)]}
        bits = bitmaps.tree_bits(builder, data, numbers)
        got = sorted(r.id for r in bitmaps.members(bits, numbers).collect())
        assert got == sorted(r.id for r in builder.build(data).collect())
        assert bitmaps.size(bits).first().cnt == len(got)


def test_ten_leaves_in_one_exchange(spark, builder, small):
    """Each leaf has the exchange of its own count or distinct; the tree adds one for the numbers and one for the bits."""
    numbers = queries._numbers(spark, small)
    leaves = {x for x in (queries._TEN["rules"])[0]["rules"][0]}
    plan = bitmaps.tree_bits(builder, queries._TEN, numbers)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(__word") == 1 and "LeftSemi" not in plan and leaves


def test_merges(spark, tmp_path):
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "id string").repartition(3)
    a, b, c = frame("1", "2", "2", "3", None), frame("2", "3", "4"), frame("3", "9")
    numbers = bitmaps.number_ids(frame(*map(str, range(10))), f"file://{tmp_path}/n")
    ids = lambda op: sorted(r.id for r in bitmaps.members(bitmaps.merged_bits(op, [a, b, c], numbers), numbers).collect())
    assert (ids("$and"), ids("$or"), ids("$except")) == (["3"], ["1", "2", "3", "4", "9"], ["1"])
    with pytest.raises(Exception, match="without a number"):
        bitmaps.size(bitmaps.merged_bits("$or", [a, frame("77")], numbers)).collect()
    many = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("kind"), F.col("id").cast("string").alias("who"))
    many = many.union(many.filter("who < '5'").withColumn("kind", F.lit("low")))
    big = bitmaps.number_ids(many.select("who"), f"file://{tmp_path}/big")
    maps = bitmaps.bitmaps(many, "kind", "who", big).persist()
    assert maps.count() >= 9 and {r.kind: r.cnt for r in bitmaps.kept_size(maps, "kind").collect()} == {"even": 50_000, "odd": 50_000, "low": many.filter("kind = 'low'").count()}
    both = bitmaps.kept_size(bitmaps.combined(maps, "kind", ["even", "low"], "$and")).first().cnt
    assert both == many.filter("kind = 'low' and cast(who as long) % 2 = 0").count()
    assert bitmaps.kept_size(bitmaps.combined(maps, "kind", ["even", "odd"], "$or")).first().cnt == 100_000
    assert bitmaps.kept_size(bitmaps.combined(maps, "kind", ["even", "odd"], "$and")).first().cnt == 0


def test_errors_are_those_of_joins(builder, spark, small):
    for bad in ({"op": "$and", "rules": []}, {"key": "tag", "op": "in", "value": []}, {"key": "tag", "op": "nin", "value": [1]}, {"key": "nope", "op": "=", "value": 1}):
        with pytest.raises(audience.AudienceError):
            bitmaps.tree_bits(builder, bad, spark.createDataFrame([("1", 0)], "id string, n long"))


@pytest.mark.parametrize(
    "sql, names",
    [
        ("select * from db.a join b on a.x = b.x where y in (select y from c)", ["db.a", "b", "c"]),
        ("with t as (select * from x), u as (select * from t join y using (k)) select * from u, z", ["x", "y", "z"]),
        ("with a as (select * from a) select * from a", ["a"]),
        ("with recursive r as (select 1 as n union all select n + 1 from r where n < 3) select * from r, s", ["s"]),
        ("with t as (select 1) select * from db.t", ["db.t"]),
        ("select * from (with t as (select * from q) select * from t) join t", ["q", "t"]),
        ("insert into dst select * from `odd.name`.src", ["dst", "odd.name.src"]),
        ("insert overwrite table d partition (a = 1) with t as (select * from s) select * from t", ["d", "s"]),
        ("merge into t using s on t.a = s.a when matched then delete", ["t", "s"]),
        ("delete from t where a in (select b from u)", ["t", "u"]),
        ("select exists (select 1 from e where e.k in (select k from f)) from g", ["g", "e", "f"]),
        ("create table n.m as select * from o", ["n.m", "o"]),
        ("select 'Unresolved(x) UnresolvedRelation [no]' from a, a", ["a"]),
    ],
)
def test_table_names(spark, sql, names):
    assert sorted(sqltext.table_names(spark, sql)) == sorted(names)
