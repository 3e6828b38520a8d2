"""Registered queries over the driver's tables, and the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rules
from .functions import devices, geo, text
from .operators import rows, sets
from .operators.ranges import narrowest
from .operators.numbering import running_total, work_folder
from .plans import audience, bitmaps, reports, stages, wide
from .plans.days import day_column, last_days
from .plans.warehouse import CATEGORIES, stand_in, stand_in_ip_ranges
from .sources import byteranges, cellfilter, cells, files, tables
from .streaming import due
from .streaming import rules as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

FIRST, LAST = "20240105", "20240120"
SUPPLIERS = {"dsp": (0, 1, 2, 3, 4)}
DRILL = 8
BUYERS = 'event_type = "purchase" | distinct(user_id) | count() > 11 | user_id'


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rules


def _rule(name: str, source: str, rule: str, sql: str, mode: str = "sql", rename: dict | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = rules.execute(rule, table(spark, sf_dir, source), mode)
        return out.withColumnsRenamed(rename or {})

    query(name, sql)(run)


_rule("rule_group_count_having", "events", BUYERS, "SELECT user_id FROM events WHERE event_type = 'purchase' GROUP BY user_id HAVING count(*) > 11")
_rule("rule_cmp", "orders", 'o_orderpriority != "1-URGENT" and o_totalprice >= 150000 | o_orderkey, o_orderpriority', "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_totalprice >= 150000")
_rule("rule_like_overlap", "part", 'p_type ~ "S%TEEL" or p_brand ~ "%3" | p_partkey, p_type', "SELECT p_partkey, p_type FROM part WHERE (starts_with(p_type, 'S') AND suffix(p_type, 'TEEL')) OR suffix(p_brand, '3')")
_rule("rule_or_and_leftassoc", "lineitem", 'l_returnflag = "A" or l_returnflag = "R" and l_linestatus = "F" | l_orderkey, l_linenumber', "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_returnflag = 'A' OR l_returnflag = 'R') AND l_linestatus = 'F'")
_rule("rule_math", "part", "p_size = (1 + 2) * 4 or p_size > 40 + 5 - 1 | p_partkey", "SELECT p_partkey FROM part WHERE p_size = 12 OR p_size > 44")
_rule("rule_select_multi", "customer", 'c_mktsegment = "BUILDING" | c_custkey, c_name, c_nationkey', "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'")
_rule("rule_group_sum_having", "orders", 'o_orderstatus = "F" | distinct(o_custkey) | sum(o_totalprice) > 200000', "SELECT o_custkey, sum(o_totalprice) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING sum(o_totalprice) > 200000", "table", {"sum(o_totalprice)": "total"})
_rule("rule_group_select_extra", "events", "user_id < 50 | distinct(user_id) | count() > 3 | event_type", "SELECT event_type FROM events WHERE user_id < 50 GROUP BY user_id, event_type HAVING count(*) > 3")
_rule("rule_group_only", "customer", "distinct(c_nationkey)", "SELECT DISTINCT c_nationkey FROM customer")


@query("rule_int_vs_string", "SELECT event_id, cell FROM (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN CAST(value AS INTEGER)::VARCHAR WHEN event_id % 4 = 1 THEN event_type ELSE regexp_extract(props, '([0-9]+)', 1) END AS cell FROM events) WHERE CASE WHEN regexp_full_match(cell, '[+-]?[0-9]+') THEN CAST(cell AS BIGINT) > 60 ELSE cell > '60' END")
def rule_int_vs_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    cell = F.when(F.col("event_id") % 4 == 0, F.rint("value").cast("int").cast("string")).when(F.col("event_id") % 4 == 1, F.col("event_type")).otherwise(F.regexp_extract("props", "([0-9]+)", 1))
    return rules.execute("cell > 60 | event_id, cell", ev.select("event_id", cell.alias("cell")))


@query("rule_json_path", "SELECT CAST(k AS VARCHAR) AS k FROM (SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events) WHERE k >= 90")
def rule_json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.execute_json("k >= 90 | k", table(spark, sf_dir, "events"), "props")


@query("rule_json_nested", "SELECT event_type AS kind, CAST(user_id AS VARCHAR) AS who FROM events WHERE user_id > 40 AND event_type LIKE 'c%'")
def rule_json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.to_json(F.struct(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type")).alias("e")))
    return rules.execute_json('e.user > 40 and e.type ~ "c%" | e.type, e.user', table(spark, sf_dir, "events").select(doc.alias("value"))).toDF("kind", "who")


@query("rule_executable_sql", "SELECT l_returnflag, l_linestatus FROM lineitem WHERE (l_quantity > 45 OR l_discount > 0.09) AND l_tax < 0.02 GROUP BY l_returnflag, l_linestatus HAVING count(*) > 3")
def rule_executable_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"rule_lines_{uuid.uuid4().hex}"  # views belong to all users of a session
    table(spark, sf_dir, "lineitem").withColumns({"disc": F.col("l_discount") > 0.09, "low": F.col("l_tax") < 0.02}).createOrReplaceTempView(view)
    return spark.sql(rules.executable_sql(view, "l_quantity > 45 or disc = true and low = true | distinct(l_returnflag) | count() > 3 | l_returnflag, l_linestatus"))


# The warehouse in SQL. Each query below takes what it needs of it.

_DATES = f"dt BETWEEN '{FIRST}' AND '{LAST}'"
_IDS = "(0, 1, 2, 3, 4)"
_PRELUDE = f"""
    WITH ev AS (SELECT CAST(user_id AS VARCHAR) AS visitor, strftime(ts, '%Y%m%d') AS dt, ts, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, user_id FROM events),
    logs AS (SELECT visitor AS visitorid, dt, event_type, k % 10 AS aduserid, k % 25 AS spotid, k % 27 AS ostype, '10.0.' || (k % 7) || '.' || k AS ip, k FROM ev),
    days AS (SELECT visitor, dt, count(*) AS pageviews, min(k) AS lo, max(k) AS hi FROM ev GROUP BY 1, 2),
    sess0 AS (SELECT visitor, dt, visitor || '_' || dt AS session_id, pageviews, lo % 27 AS os_id, lo % 25 AS country_id, hi % 5 AS province_id, lo % 25 AS referer_domain_id, hi % 40 AS search_keyword_id, lo % 10 AS ad FROM days),
    buyers AS (SELECT visitor AS id FROM ev WHERE event_type = 'purchase' GROUP BY 1 HAVING count(*) > 11),
    joiners AS (SELECT visitor AS id FROM ev WHERE event_type = 'signup' GROUP BY 1 HAVING count(*) > 11),
    aud AS (SELECT id FROM buyers UNION ALL SELECT id FROM joiners),
    sess AS (SELECT * FROM sess0 WHERE {_DATES} AND ad IN {_IDS} AND visitor IN (SELECT id FROM aud)),
    imp AS (SELECT * FROM logs WHERE event_type = 'view' AND {_DATES} AND aduserid IN {_IDS} AND visitorid IN (SELECT id FROM aud)),
    clk AS (SELECT * FROM logs WHERE event_type = 'click' AND {_DATES} AND aduserid IN {_IDS} AND visitorid IN (SELECT id FROM aud)),
    flow AS (SELECT visitor, dt, visitor || '_' || dt AS session_id, k AS page_url_id, k % 40 AS page_title_id FROM ev WHERE {_DATES} AND k % 10 IN {_IDS} AND visitor IN (SELECT id FROM aud)),
    widet AS (SELECT CAST(c_custkey AS VARCHAR) AS visitor_id, CAST(c_custkey % 2 AS VARCHAR) AS sex, CAST(CAST(floor(c_acctbal / 2000) AS BIGINT) AS VARCHAR) AS age, c_mktsegment AS industry, CAST(c_nationkey AS VARCHAR) AS os FROM customer),
    wrows AS (SELECT widet.* FROM widet JOIN aud ON widet.visitor_id = aud.id),
    names AS (SELECT n_nationkey AS id, n_name AS name FROM nation),
    places AS (SELECT DISTINCT CASE WHEN n_nationkey = {DRILL} THEN n_nationkey || '$' || n_regionkey ELSE CAST(n_nationkey AS VARCHAR) END AS id,
                      CASE WHEN n_nationkey = {DRILL} THEN n_name || r_name ELSE n_name END AS location FROM nation JOIN region ON n_regionkey = r_regionkey),
    kw AS (SELECT item_id AS id, CASE WHEN item_id % 9 = 0 THEN '' ELSE substring(text, 1, 12) END AS name FROM benchmark),
    urls AS (SELECT page_id AS id, CASE WHEN page_id % 11 = 0 THEN '' ELSE url END AS name FROM pages),
    titles AS (SELECT item_id AS id, substring(text, 1, 20) AS name FROM benchmark),
    cats AS (SELECT CAST(c_custkey AS VARCHAR) AS userid, unnest([CAST(c_custkey % 25 AS VARCHAR), CAST(c_custkey * 7 % 25 AS VARCHAR), CAST(c_nationkey AS VARCHAR)]) AS catid FROM customer),
    hob AS (SELECT userid, catid FROM cats JOIN aud ON aud.id = cats.userid WHERE catid IN {CATEGORIES}),
    catdim AS (SELECT CAST(p_partkey AS VARCHAR) AS catid, p_name AS name FROM part WHERE p_partkey <= 25)
"""


def place_of(ip):
    """A stand-in for a function from ip to place."""
    last = F.element_at(F.split(ip, r"\."), -1).try_cast("int")
    return F.create_map(F.lit("country"), (last % 25).cast("string"), F.lit("region"), (last % 5).cast("string"))


def _id_counts(ev: DataFrame, kind: str) -> DataFrame:
    return rules.execute(BUYERS.replace("purchase", kind), ev).select(F.col("user_id").cast("string").alias("id"))


def context(spark: SparkSession, sf_dir: str, etype: int = reports.PC) -> reports.Context:
    """Buyers and joiners; who is both is in it twice."""
    ev = table(spark, sf_dir, "events")
    both = audience.union_all([_id_counts(ev, "purchase"), _id_counts(ev, "signup")])
    key = "visitor_id" if etype == reports.PC else "did"
    return reports.Context(stand_in(spark, sf_dir), both.withColumnRenamed("id", key), FIRST, LAST, SUPPLIERS, etype, place_of, CATEGORIES, DRILL)


def _report(dimension: str, metric: str, sql: str | None, etype: int = reports.PC) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reports.build_report(context(spark, sf_dir, etype), dimension, metric)

    name = f"{dimension}_{metric}" + ("_mobile" if etype == reports.MOBILE and dimension != "mob_os" else "")
    query(name, _PRELUDE + sql if sql else None)(run)


for _d in ("sex", "age", "industry", "os"):
    _n, _e = ("mob_os", reports.MOBILE) if _d == "os" else (_d, reports.PC)
    _report(_n, "value", f"SELECT {_d}, count(*) AS cnt FROM (SELECT DISTINCT * FROM wrows) GROUP BY 1", _e)
    for _m, _kind in (("impressions", "view"), ("click", "click")):
        _report(_n, _m, f"SELECT {_d}, count(*) AS cnt FROM wrows JOIN logs ON wrows.visitor_id = logs.visitorid WHERE event_type = '{_kind}' AND {_DATES} AND aduserid IN {_IDS} GROUP BY 1", _e)
_report("sex", "impressions", f"SELECT sex, count(*) AS cnt FROM wrows JOIN logs ON wrows.visitor_id = logs.visitorid WHERE event_type = 'view' AND {_DATES} AND aduserid IN {_IDS} GROUP BY 1", reports.MOBILE)

_OSDIM = "(SELECT id, max(name) AS name FROM (SELECT id, name FROM names UNION ALL SELECT id, name || ' alias' FROM names) GROUP BY id) d"
_report("os", "visitors", f"SELECT coalesce(name, 'Unknown') AS ostypename, ostype, cnt FROM (SELECT ostype, count(*) AS cnt FROM (SELECT ostype FROM (SELECT DISTINCT visitorid, ostype FROM imp) UNION ALL SELECT os_id FROM (SELECT DISTINCT visitor, os_id FROM sess)) GROUP BY 1) LEFT JOIN {_OSDIM} ON ostype = d.id")
_report("os", "impressions", f"SELECT coalesce(name, 'Unknown') AS ostypename, ostype, cnt FROM (SELECT ostype, count(*) AS cnt FROM imp GROUP BY 1) LEFT JOIN {_OSDIM} ON ostype = d.id")
_report("os", "click", f"SELECT coalesce(name, 'Unknown') AS ostypename, ostype, cnt FROM (SELECT ostype, count(*) AS cnt FROM clk GROUP BY 1) LEFT JOIN {_OSDIM} ON ostype = d.id")
for _e in (reports.PC, reports.MOBILE):
    _report("hobby", "value", "SELECT name AS interest, cnt FROM (SELECT catid, count(*) AS cnt FROM hob GROUP BY 1) JOIN catdim USING (catid)", _e)
    for _m, _kind in (("impressions", "view"), ("click", "click")):
        _report("hobby", _m, f"SELECT name AS interest, cnt FROM (SELECT catid, count(*) AS cnt FROM hob JOIN logs ON userid = visitorid WHERE event_type = '{_kind}' AND {_DATES} AND aduserid IN {_IDS} GROUP BY 1) JOIN catdim USING (catid)", _e)
_report("hotsite", "visitors", "SELECT lower(c_mktsegment) || '.example' AS domain, count(*) AS cnt FROM customer WHERE CAST(c_custkey AS VARCHAR) IN (SELECT id FROM aud) GROUP BY 1")
_report("keyword", "session", "SELECT name, count(*) AS cnt FROM (SELECT DISTINCT search_keyword_id, session_id FROM sess) JOIN kw ON search_keyword_id = kw.id WHERE name <> '' GROUP BY 1")
_report("keyword", "pageviews", "SELECT name, count(*) AS cnt FROM sess JOIN kw ON search_keyword_id = kw.id WHERE name <> '' GROUP BY 1")
_report("keyword", "visitors", "SELECT name, CAST(sum(cnt) AS BIGINT) AS cnt FROM (SELECT search_keyword_id, count(*) AS cnt FROM sess WHERE search_keyword_id > 0 GROUP BY 1) JOIN kw ON search_keyword_id = kw.id WHERE name <> '' GROUP BY 1")
_report("page", "session", "SELECT name, cnt FROM (SELECT page_url_id, count(*) AS cnt FROM (SELECT DISTINCT page_url_id, session_id FROM flow) GROUP BY 1) JOIN urls ON page_url_id = urls.id WHERE name <> ''")
_report("page", "visitors", "SELECT name, cnt FROM (SELECT page_url_id, count(*) AS cnt FROM (SELECT DISTINCT page_url_id, visitor FROM flow) GROUP BY 1) JOIN urls ON page_url_id = urls.id WHERE name <> ''")
_report("page", "pageviews", "SELECT page_url_id, urls.name AS url, titles.name AS title, count(*) AS cnt FROM flow JOIN urls ON page_url_id = urls.id JOIN titles ON page_title_id = titles.id GROUP BY 1, 2, 3")
_PLACE = "CASE WHEN {c} = '8' THEN {c} || '$' || {r} ELSE {c} END"
_AT = " SELECT location, count(*) AS cnt FROM ({}) x JOIN places ON x.id = places.id GROUP BY 1"
_SITE = _PLACE.format(c="CAST(country_id AS VARCHAR)", r="CAST(province_id AS VARCHAR)") + " AS id"
_ADS = _PLACE.format(c="CAST(k % 25 AS VARCHAR)", r="CAST(k % 5 AS VARCHAR)") + " AS id"
_report("region", "session", _AT.format(f"SELECT {_SITE} FROM (SELECT DISTINCT visitor, session_id, country_id, province_id FROM sess)"))
_report("region", "pageviews", _AT.format(f"SELECT {_SITE} FROM sess"))
_report("region", "visitors", _AT.format(f"SELECT {_ADS} FROM (SELECT DISTINCT ip, k, visitorid FROM imp) UNION ALL SELECT {_SITE} FROM (SELECT DISTINCT country_id, province_id, visitor FROM sess)"))
_report("region", "impressions", _AT.format(f"SELECT {_ADS} FROM imp"))
_report("region", "click", _AT.format(f"SELECT {_ADS} FROM clk"))
_report("source", "session", "SELECT name, count(*) AS cnt FROM sess JOIN names ON referer_domain_id = names.id GROUP BY 1")
_report("source", "pageviews", "SELECT name, CAST(sum(pageviews) AS BIGINT) AS cnt FROM sess JOIN names ON referer_domain_id = names.id GROUP BY 1")
_report("source", "visitors", "SELECT name, count(*) AS cnt FROM (SELECT DISTINCT referer_domain_id, visitor FROM sess) JOIN names ON referer_domain_id = names.id GROUP BY 1")
_report("summary", "session", "SELECT 'sessions' AS metric, count(*) AS cnt FROM sess UNION ALL SELECT 'pageviews', CAST(coalesce(sum(pageviews), 0) AS BIGINT) FROM sess")
_report("summary", "visitors", "SELECT count(DISTINCT visitor) AS cnt FROM sess")
_report("summary", "impressions", "SELECT count(*) AS cnt FROM imp")
_report("summary", "click", "SELECT count(*) AS cnt FROM clk")
_report("depth", "session", "SELECT pageviews AS depth, 'sessions' AS metric, count(*) AS cnt FROM sess GROUP BY 1 UNION ALL SELECT pageviews, 'pageviews', pageviews * count(*) FROM sess GROUP BY 1")
_report("depth", "visitors", "SELECT depth, count(*) AS cnt FROM (SELECT visitor, max(pageviews) AS depth FROM sess GROUP BY 1) GROUP BY 1")
_report("frequency", "visitors", "SELECT CASE WHEN f >= 10 THEN '>10' ELSE CAST(f AS VARCHAR) END AS name, count(*) AS visitors, CAST(sum(f) AS BIGINT) AS impressions FROM (SELECT visitorid, count(*) AS f FROM imp GROUP BY 1) GROUP BY 1")
for _m, _t in (("impressions", "imp"), ("click", "clk")):
    for _e in (reports.PC, reports.MOBILE):
        _report("ad_summary", _m, f"SELECT dt, spotid AS spot_id, name, cnt FROM (SELECT dt, spotid, count(*) AS cnt FROM {_t} GROUP BY 1, 2) LEFT JOIN (SELECT * FROM names WHERE id < 20) p ON spotid = p.id", _e)
    _report("region", _m, _AT.format(f"SELECT {_ADS} FROM {_t}"), reports.MOBILE)
_PATHS = f"""
    , vis AS (SELECT visitor, k % 2 AS site_id, k % 6 AS page, ts, k % 12 AS ref FROM ev WHERE {_DATES} AND visitor IN (SELECT id FROM aud)),
    steps AS (SELECT visitor, site_id, lower(d.n_name) || '.example' AS domain, ts, regexp_extract('http://www.' || lower(replace(r.n_name, ' ', '')) || '.example/' || r.n_nationkey, '(\\w+\\.)+\\w+', 0) AS ref
              FROM vis JOIN nation d ON vis.page = d.n_nationkey JOIN nation r ON vis.ref = r.n_nationkey AND r.n_nationkey < 10 WHERE d.n_nationkey < 6),
    lagged AS (SELECT *, lag(ref) OVER (PARTITION BY visitor, site_id, domain ORDER BY ts, ref) AS prev FROM steps),
    lists AS (SELECT visitor, site_id, domain, string_agg(ref, '>' ORDER BY ts, ref) AS p, arg_max(ref, struct_pack(ts := ts, ref := ref)) AS last FROM lagged WHERE prev IS NULL OR prev <> ref GROUP BY 1, 2, 3),
    paths AS (SELECT CASE WHEN last = domain THEN p ELSE p || '>' || domain END AS paths, count(*) AS cnt FROM lists GROUP BY 1)"""
_report("path", "topology", _PATHS + "SELECT paths, cnt FROM paths")
_report("path", "percent", _PATHS + "SELECT paths, cnt, cnt * 100.0 / sum(cnt) OVER () AS per FROM paths")


# Places of ips by ranges


_RANGES = f"""
    , ranges AS (SELECT 167772160 + n_nationkey % 7 * 256 + n_nationkey * 4 AS first, 167772160 + n_nationkey % 7 * 256 + n_nationkey * 4 + 3 + n_nationkey % 3 * 2 AS last, n_nationkey AS c, n_regionkey AS r FROM nation
                 UNION ALL SELECT 167772160 + (r_regionkey + 2) * 256, 167772160 + (r_regionkey + 2) * 256 + 79 + 20 * r_regionkey, r_regionkey + 10, r_regionkey FROM region
                 UNION ALL SELECT 167773184, 184549375, 8, 3),
    held AS (SELECT ip, arg_min({{'c': c, 'r': r}}, last - first) AS p FROM (SELECT DISTINCT ip, k FROM logs) JOIN ranges ON 167772160 + k % 7 * 256 + k BETWEEN first AND last GROUP BY ip),
    located AS (SELECT ip, {_PLACE.format(c="CAST(p.c AS VARCHAR)", r="CAST(p.r AS VARCHAR)")} AS id FROM held)"""


def _with_ranges(spark: SparkSession, sf_dir: str) -> reports.Context:
    return replace(context(spark, sf_dir), geo=None, ip_ranges=stand_in_ip_ranges(spark, sf_dir))


@query("region_impressions_ranges", _PRELUDE + _RANGES + _AT.format("SELECT id FROM imp JOIN located USING (ip)"))
def region_impressions_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.build_report(_with_ranges(spark, sf_dir), "region", "impressions")


@query("region_visitors_ranges", _PRELUDE + _RANGES + _AT.format(f"SELECT id FROM (SELECT DISTINCT ip, visitorid FROM imp) JOIN located USING (ip) UNION ALL SELECT {_SITE} FROM (SELECT DISTINCT country_id, province_id, visitor FROM sess)"))
def region_visitors_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.build_report(_with_ranges(spark, sf_dir), "region", "visitors")


@query("order_discount_ranges", "WITH b AS (SELECT p_partkey AS band, CAST(p_retailprice * 100 AS BIGINT) AS first, CAST(p_retailprice * 100 AS BIGINT) + p_size * p_size * 4000 AS last FROM part), o AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders), best AS (SELECT o_orderkey, min((last - first, -first, band)) AS m FROM o JOIN b ON cents BETWEEN first AND last GROUP BY 1) SELECT o.o_orderkey, m[3] AS band FROM o LEFT JOIN best USING (o_orderkey)")
def order_discount_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrowest of many overlapping price bands for each order."""
    first = (F.col("p_retailprice") * 100).cast("long")
    bands = table(spark, sf_dir, "part").select(first.alias("first"), (first + F.col("p_size").cast("long") * F.col("p_size") * 4000).alias("last"), F.col("p_partkey").alias("band"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return narrowest(orders, "cents", bands).select("o_orderkey", "band")


# Reports day by day


_DAYS = "(SELECT strftime(d, '%Y%m%d') AS day FROM generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-20', INTERVAL 1 DAY) t(d) UNION ALL SELECT NULL) dd"


def _daily(dimension: str, metric: str, sql: str, total: bool = True) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reports.by_day(context(spark, sf_dir), dimension, metric, total)

    query(f"{dimension}_{metric}_by_day", _PRELUDE + sql)(run)


#: A row of a log for its day and one for the range.
_TWICE = "(SELECT *, dt AS day FROM {0} UNION ALL SELECT *, NULL FROM {0})"
_daily("summary", "visitors", f"SELECT dd.day, coalesce(cnt, 0) AS cnt FROM {_DAYS} LEFT JOIN (SELECT day, count(DISTINCT visitor) AS cnt FROM {_TWICE.format('sess')} GROUP BY 1) c ON c.day IS NOT DISTINCT FROM dd.day")
_daily("summary", "impressions", f"SELECT dd.day, coalesce(cnt, 0) AS cnt FROM {_DAYS} LEFT JOIN (SELECT dt AS day, count(*) AS cnt FROM imp GROUP BY 1) c ON c.day = dd.day WHERE dd.day IS NOT NULL", total=False)
_daily("os", "visitors", f"SELECT coalesce(name, 'Unknown') AS ostypename, ostype, cnt, day FROM (SELECT day, ostype, count(*) AS cnt FROM (SELECT day, ostype FROM (SELECT DISTINCT day, visitorid, ostype FROM {_TWICE.format('imp')}) UNION ALL SELECT day, os_id FROM (SELECT DISTINCT day, visitor, os_id FROM {_TWICE.format('sess')})) GROUP BY ALL) LEFT JOIN {_OSDIM} ON ostype = d.id")
_daily("region", "impressions", f"SELECT day, location, count(*) AS cnt FROM (SELECT day, {_ADS} FROM {_TWICE.format('imp')}) x JOIN places ON x.id = places.id GROUP BY ALL")
_daily("frequency", "visitors", f"SELECT day, CASE WHEN f >= 10 THEN '>10' ELSE CAST(f AS VARCHAR) END AS name, count(*) AS visitors, CAST(sum(f) AS BIGINT) AS impressions FROM (SELECT day, visitorid, count(*) AS f FROM {_TWICE.format('imp')} GROUP BY ALL) GROUP BY ALL")


@query("summary_last7_days", _PRELUDE + "SELECT dt AS day, count(*) AS cnt FROM imp WHERE dt >= '20240114' GROUP BY 1")
def summary_last7_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    rows_ = ctx.warehouse.impressions.filter(F.col("dt").isin(last_days(FIRST, LAST)) & F.col("aduserid").isin(ctx.supplier_ids))
    return rows_.join(ctx.audience.select(F.col("visitor_id").alias("visitorid")), "visitorid", "left_semi").groupBy(F.col("dt").alias("day")).agg(F.count(F.lit(1)).alias("cnt"))


# Audiences


def _builder(spark: SparkSession, sf_dir: str) -> audience.Builder:
    w = stand_in(spark, sf_dir)
    imp = w.impressions.withColumn("domain", F.concat(F.lit("site"), F.col("spotid") % 4))
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    tags = {1: {"op": "$and", "rules": [{"key": "campaign", "op": "in", "value": [1, 2]}, {"key": "clickCount", "op": "<", "value": 12}]}, 2: {"key": "exposeCount", "op": ">=", "value": 20}}
    return audience.Builder(imp, w.clicks, ids, tags=tags)


def _audience(name: str, tree: dict, sql: str) -> None:
    query(name, _PRELUDE + sql)(lambda spark, sf_dir: _builder(spark, sf_dir).build(tree))


_CAMP = "SELECT visitorid AS id FROM logs WHERE event_type = 'view' AND spotid IN ({})"
_CLICKS = "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer LEFT JOIN (SELECT visitorid, count(*) AS n FROM logs WHERE event_type = 'click' GROUP BY 1) ON visitorid = CAST(c_custkey AS VARCHAR) WHERE coalesce(n, 0) < {}"
_EXPOSED = "SELECT visitorid AS id FROM logs WHERE event_type = 'view' GROUP BY 1 HAVING count(*) >= {}"
_SITES = "SELECT visitorid AS id FROM logs WHERE event_type = 'view' AND spotid % 4 = 3"
_audience("audience_and", {"op": "$and", "rules": [{"key": "campaign", "op": "in", "value": [1, 2]}, {"op": "$or", "rules": [{"key": "mediaDomain", "op": "=", "value": "site3"}, {"key": "campaign", "op": "in", "value": [3, 4]}]}]}, f"{_CAMP.format('1, 2')} INTERSECT ({_SITES} UNION {_CAMP.format('3, 4')})")
_audience("audience_or", {"op": "$or", "rules": [{"key": "campaign", "op": "in", "value": [5]}, {"key": "exposeCount", "op": ">=", "value": 18}]}, f"{_CAMP.format('5')} UNION {_EXPOSED.format(18)}")
_audience("audience_counts", {"op": "$and", "rules": [{"key": "clickCount", "op": "<", "value": 12}, {"key": "exposeCount", "op": ">=", "value": 1}]}, f"{_CLICKS.format(12)} INTERSECT {_EXPOSED.format(1)}")
_audience("audience_no_clicks", {"key": "clickCount", "op": "<", "value": 1}, _CLICKS.format(1))
_audience("audience_tagref", {"op": "$and", "rules": [{"key": "tag", "op": "in", "value": [1, 2]}, {"key": "campaign", "op": "in", "value": [7, 8]}]}, f"(({_CAMP.format('1, 2')} INTERSECT {_CLICKS.format(12)}) UNION {_EXPOSED.format(20)}) INTERSECT {_CAMP.format('7, 8')}")


# The same on bitmaps


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbers of all customers and of all who are in a log."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id")).union(table(spark, sf_dir, "events").select(F.col("user_id").cast("string")))
    return bitmaps.number_ids(ids, work_folder(spark))


_TEN = {
    "op": "$or",
    "rules": [
        {"op": "$and", "rules": [{"key": "campaign", "op": "in", "value": [c, c + 1]}, {"key": "mediaDomain", "op": "=", "value": f"site{c % 4}"}, {"key": "clickCount", "op": "<", "value": 9 + c}]}
        for c in (1, 4, 7)
    ]
    + [{"key": "tag", "op": "in", "value": [1]}, {"key": "exposeCount", "op": ">=", "value": 25}],
}
_TEN_SQL = " UNION ".join(
    f"({_CAMP.format(f'{c}, {c + 1}')} INTERSECT SELECT visitorid FROM logs WHERE event_type = 'view' AND spotid % 4 = {c % 4} INTERSECT {_CLICKS.format(9 + c)})" for c in (1, 4, 7)
) + f" UNION ({_CAMP.format('1, 2')} INTERSECT {_CLICKS.format(12)}) UNION {_EXPOSED.format(25)}"


@query("audience_tree_bitmaps", _PRELUDE + _TEN_SQL)
def audience_tree_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = _numbers(spark, sf_dir)
    return bitmaps.members(bitmaps.tree_bits(_builder(spark, sf_dir), _TEN, numbers), numbers)


@query("audience_tree_stages", _PRELUDE + _TEN_SQL)
def audience_tree_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tree, stage by stage: each is saved, those that need no other side by side."""
    return stages.Run(_builder(spark, sf_dir), _TEN, stages.save_in(work_folder(spark))).wait()


@query("audience_tree_joins", _PRELUDE + _TEN_SQL)
def audience_tree_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _builder(spark, sf_dir).build(_TEN)


@query("merge_except_bitmaps", _PRELUDE + "SELECT count(*) AS cnt FROM (SELECT id FROM buyers EXCEPT SELECT id FROM joiners)")
def merge_except_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return bitmaps.size(bitmaps.merged_bits("$except", [_id_counts(ev, "purchase"), _id_counts(ev, "signup")], _numbers(spark, sf_dir)))


_ACTS = "WITH acts AS (SELECT DISTINCT event_type AS a, user_id FROM events WHERE value > 60)"


@query("kept_bitmaps", _ACTS + " SELECT a AS audience, count(*) AS cnt FROM acts GROUP BY 1 UNION ALL SELECT 'view and click', count(*) FROM (SELECT user_id FROM acts WHERE a = 'view' INTERSECT SELECT user_id FROM acts WHERE a = 'click') UNION ALL SELECT 'signup or purchase', count(DISTINCT user_id) FROM acts WHERE a IN ('signup', 'purchase')")
def kept_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of an audience for each kind of event, and of two that are combined from what is kept."""
    acts = table(spark, sf_dir, "events").filter("value > 60").select(F.col("event_type").alias("audience"), "user_id")
    path = work_folder(spark)
    bitmaps.bitmaps(acts, "audience", "user_id", _numbers(spark, sf_dir)).write.parquet(path)
    maps = spark.read.parquet(path)
    both = bitmaps.kept_size(bitmaps.combined(maps, "audience", ["view", "click"], "$and")).select(F.lit("view and click").alias("audience"), "cnt")
    either = bitmaps.kept_size(bitmaps.combined(maps, "audience", ["signup", "purchase"], "$or")).select(F.lit("signup or purchase").alias("audience"), "cnt")
    return bitmaps.kept_size(maps, "audience").unionByName(both).unionByName(either)


@query("merge_join", _PRELUDE + "SELECT id FROM buyers INTERSECT SELECT id FROM joiners")
def merge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return audience.intersect_all([_id_counts(ev, "purchase"), _id_counts(ev, "signup")])


@query("merge_union", _PRELUDE + "SELECT id FROM aud")
def merge_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return audience.union_all([_id_counts(ev, "purchase"), _id_counts(ev, "signup")])


@query("merge_except", _PRELUDE + "SELECT id FROM buyers EXCEPT SELECT id FROM joiners")
def merge_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return audience.except_all([_id_counts(ev, "purchase"), _id_counts(ev, "signup")])


@query("wide_join", _PRELUDE + "SELECT visitor_id, sex, age, industry, os FROM wrows")
def wide_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    return wide.enrich(ctx.audience, ctx.warehouse.wide, "visitor_id").drop("did")


@query("wide_distinct", _PRELUDE + "SELECT DISTINCT visitor_id, sex, age, industry, os FROM wrows")
def wide_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide.distinct_rows(wide_join(spark, sf_dir))


@query("table_count", _PRELUDE + "SELECT count(*) AS cnt FROM aud")
def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = audience.table_count(context(spark, sf_dir).audience, empty_ok=True)
    return spark.range(1).select(F.lit(n).cast("long").alias("cnt"))


@query("lbs_bbox", f"SELECT 'did' AS typ, CAST(vec_id AS VARCHAR) AS visitor_id FROM (SELECT vec_id, CAST(trunc(CAST(CAST(embedding[1] AS DOUBLE) * 180 AS FLOAT) * 1000000) AS BIGINT) AS x, CAST(trunc(CAST(CAST(embedding[2] AS DOUBLE) * 90 AS FLOAT) * 1000000) AS BIGINT) AS y FROM embeddings) WHERE x > {geo.box(4.0, 8.0, 1500000)[0]} AND x <= {geo.box(4.0, 8.0, 1500000)[1]} AND y > {geo.box(4.0, 8.0, 1500000)[2]} AND y <= {geo.box(4.0, 8.0, 1500000)[3]} GROUP BY vec_id")
def lbs_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.audience_near(stand_in(spark, sf_dir).bids, 4.0, 8.0, 1500000, FIRST, LAST)


# Devices


def device_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of several types, some wrong, some without a type."""
    c = F.col("c_custkey")
    h = F.md5(c.cast("string"))
    line = (
        F.when(c % 7 == 0, F.concat_ws(" ", F.lit("imei"), F.lpad(c.cast("string"), 15, "3")))
        .when(c % 7 == 1, F.concat_ws("\t", F.lit("midfa"), h))
        .when(c % 7 == 2, F.concat_ws(" ", F.lit("android_id"), F.substring(h, 1, 16)))
        .when(c % 7 == 3, F.concat_ws(" ", F.lit("imei"), F.substring(h, 1, 15)))
        .when(c % 7 == 4, F.substring(h, 1, 16))
        .when(c % 7 == 5, F.concat_ws("  ", F.lit("other"), h))
        .otherwise(F.lit("  "))
    )
    return table(spark, sf_dir, "customer").select(line.alias("value"))


_LINES = """WITH h AS (SELECT c_custkey AS c, md5(CAST(c_custkey AS VARCHAR)) AS h FROM customer),
    lines AS (SELECT CASE c % 7 WHEN 0 THEN 'imei' WHEN 1 THEN 'midfa' WHEN 2 THEN 'android-id' WHEN 3 THEN 'imei' WHEN 5 THEN 'other' END AS kind,
                     CASE c % 7 WHEN 0 THEN lpad(CAST(c AS VARCHAR), 15, '3') WHEN 1 THEN h WHEN 2 THEN substring(h, 1, 16) WHEN 3 THEN substring(h, 1, 15) WHEN 4 THEN substring(h, 1, 16) WHEN 5 THEN h END AS id, c % 7 AS m FROM h)"""


@query("device_line_stats", _LINES + "SELECT count(*) FILTER (m <> 6) AS all_lines, count(*) FILTER (m IN (2, 5)) AS invalid, count(*) FILTER (m IN (0, 1, 3, 4)) AS valid FROM lines")
def device_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.line_stats(device_lines(spark, sf_dir))


@query("device_normalise", _LINES + "SELECT DISTINCT kind || chr(9) || id AS value FROM (SELECT coalesce(kind, CASE WHEN m = 4 THEN 'android-id' END) AS kind, id, m FROM lines) WHERE kind IS NOT NULL AND (m <> 3 OR regexp_full_match(id, '[0-9]*'))")
def device_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.normalise(device_lines(spark, sf_dir), sub_type="did")


@query("export_lines", _PRELUDE + "SELECT CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN 'imei' ELSE 'idfa' END || chr(9) || id AS value FROM aud WHERE CAST(id AS BIGINT) % 3 <> 0")
def export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = context(spark, sf_dir, reports.MOBILE).audience
    n = F.col("did").cast("long")
    typ = F.when(n % 3 == 0, F.lit("")).when(n % 2 == 0, "imei").otherwise("idfa")
    return devices.export_lines(ids.select(typ.alias("typ"), "did"), reports.MOBILE)[0]


# Sets, order, cells


@query("sets_distinct_flatten", "SELECT c_nationkey, array_to_string(list_sort(list_distinct(flatten(list([c_custkey % 5, c_custkey % 3])))), ',') AS ids FROM customer GROUP BY 1")
def sets_distinct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.array(F.col("c_custkey") % 5, F.col("c_custkey") % 3)
    # Distinct pairs first, so that a list holds 15 of them at most.
    lists = table(spark, sf_dir, "customer").select("c_nationkey", pair.alias("p")).distinct().groupBy("c_nationkey").agg(F.collect_list("p").alias("l"))
    return lists.select("c_nationkey", F.array_join(F.array_sort(sets.distinct_flat(F.col("l"))), ",").alias("ids"))


@query("rbac_check_all_any", "SELECT c_custkey, list_has_all(o, a) AS all_ok, list_has_any(o, a) AS any_ok, list_has_any(o, a) AND len(a) <= len(o) AS any_as_before FROM (SELECT c_custkey, [c_custkey % 4, c_custkey % 6] AS o, CASE WHEN c_custkey % 2 = 0 THEN [c_custkey % 4] ELSE [1, 2, 3] END AS a FROM customer)")
def rbac_check_all_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    owned = F.array(c % 4, c % 6)
    asked = F.when(c % 2 == 0, F.array(c % 4)).otherwise(F.array(*[F.lit(i).cast("long") for i in (1, 2, 3)]))
    return table(spark, sf_dir, "customer").select(c, sets.has_all(owned, asked).alias("all_ok"), sets.has_any(owned, asked).alias("any_ok"), sets.has_any(owned, asked, True).alias("any_as_before"))


@query("rbac_user_functions", "WITH r AS (SELECT n_nationkey AS role_id, n_regionkey AS f FROM nation WHERE n_nationkey % 6 <> 5), g AS (SELECT c_custkey AS user_id, f FROM customer JOIN r ON role_id IN (c_nationkey, c_custkey % 25) UNION SELECT c_custkey, c_custkey % 5 FROM customer WHERE c_custkey % 4 = 0) SELECT c_custkey AS user_id, coalesce(string_agg(r_name, ',' ORDER BY r_name), '') AS paths FROM customer LEFT JOIN g ON user_id = c_custkey LEFT JOIN region ON r_regionkey = f AND r_regionkey <> 4 GROUP BY 1")
def rbac_user_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    users = table(spark, sf_dir, "customer").select(c.alias("user_id"), F.array(F.col("c_nationkey").cast("long"), c % 25).alias("role_ids"), F.when(c % 4 == 0, F.array(c % 5)).otherwise(F.array().cast("array<bigint>")).alias("function_ids"))
    roles = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("role_id"), F.array(F.col("n_regionkey").cast("long")).alias("function_ids"), (F.col("n_nationkey") % 6 == 5).alias("deleted"))
    functions = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("function_id"), F.col("r_name").alias("path"), (F.col("r_regionkey") == 4).alias("deleted"))
    return sets.user_functions(users, roles, functions).select("user_id", F.array_join("paths", ",").alias("paths"))


@query("page_sort", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey OFFSET 20 LIMIT 10")
def page_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.page(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["-c_acctbal", "c_custkey"], 20, 10)


@query("next_due", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1")
def next_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.next_due(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "2100-01-01", "o_orderdate", "o_orderkey")


@query("tail_lines", "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 5")
def tail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.tail(table(spark, sf_dir, "events").select("event_id", "event_type"), 5, ["event_id"])


@query("multi_key_sort", "SELECT row_number() OVER (ORDER BY n_regionkey, n_name) AS n, n_name FROM nation")
def multi_key_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = rows.page(table(spark, sf_dir, "nation").select("n_regionkey", "n_name"), ["n_regionkey", "n_name"])
    return tables.next_ids(ordered, 1, "n").select("n", "n_name")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.format_string("u%05d", "user_id").alias("row"), F.lit("e").alias("family"), F.col("event_type").alias("qualifier"), F.regexp_extract("props", "([0-9]+)", 1).alias("value"), F.col("event_id").alias("ts"))


@query("cells_scan_latest", "SELECT row, qualifier, value, ts FROM (SELECT printf('u%05d', user_id) AS row, event_type AS qualifier, regexp_extract(props, '([0-9]+)', 1) AS value, event_id AS ts, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events WHERE event_type IN ('view', 'click')) WHERE n = 1 AND row >= 'u00003' AND row < 'u00040'")
def cells_scan_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.scan(_cells(spark, sf_dir), "u00003", "u00040", [("e", "view"), ("e", "click")]).select("row", "qualifier", "value", "ts")


_CELLS_SQL = "WITH c AS (SELECT printf('u%05d', user_id) AS row, event_type AS qualifier, regexp_extract(props, '([0-9]+)', 1) AS value, event_id AS ts FROM events)"


@query("cells_filter", _CELLS_SQL + " SELECT row, qualifier, value, ts FROM c WHERE row LIKE 'u0000%' AND (qualifier = 'view' AND value >= '5' OR qualifier LIKE 'pur%')")
def cells_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_ = "PrefixFilter ('u0000') AND (QualifierFilter (=, 'binary:view') AND ValueFilter (>=, 'binary:5') OR ColumnPrefixFilter ('pur'))"
    return cellfilter.filtered(_cells(spark, sf_dir), text_).select("row", "qualifier", "value", "ts")


@query("cells_filter_rows", _CELLS_SQL + ", n AS (SELECT row, arg_max(value, ts) FILTER (qualifier = 'click') AS v, bool_and(value <> '7') AS ok FROM c GROUP BY row) SELECT row, qualifier, value, ts FROM c JOIN n USING (row) WHERE ok AND v > '4'")
def cells_filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_ = "SKIP ValueFilter (!=, 'binary:7') AND SingleColumnValueFilter ('e', 'click', >, 'binary:4', true, true)"
    return cellfilter.filtered(_cells(spark, sf_dir), text_).select("row", "qualifier", "value", "ts")


@query("cells_versions", "SELECT row, qualifier, ts FROM (SELECT printf('u%05d', user_id) AS row, event_type AS qualifier, event_id AS ts, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events WHERE user_id IN (1, 2, 3)) WHERE n <= 3")
def cells_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.get(_cells(spark, sf_dir), ["u00001", "u00002", "u00003"], versions=3).select("row", "qualifier", "ts")


@query("keyed_upsert", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 'NEW' FROM customer WHERE c_custkey % 3 = 0")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    new = old.filter("c_custkey % 3 = 0").select("c_custkey", F.lit("NEW").alias("c_mktsegment"))
    return tables.upsert(old, new, "c_custkey")


# Stores, files and modes


@query("report_store_range", "SELECT strftime(o_orderdate, '%Y%m%d') AS dt, count(*) AS cnt, 7 AS tag_id FROM orders WHERE o_orderdate < DATE '1995-01-01' OR o_orderdate >= DATE '1995-02-01' AND o_orderdate < DATE '1995-04-01' GROUP BY 1 UNION ALL SELECT strftime(o_orderdate, '%Y%m%d'), 2 * count(*), 7 FROM orders WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1995-01-20' GROUP BY 1")
def report_store_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report is stored; then January is replaced by rows that end on its 19th day."""
    path = work_folder(spark)
    days = table(spark, sf_dir, "orders").filter("o_orderdate < '1995-04-01'").groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("dt")).agg(F.count(F.lit(1)).alias("cnt"))
    tables.replace_report(days, path, 7, "orders", "00000000", "99999999")
    again = days.filter("dt >= '19950101' and dt < '19950120'").withColumn("cnt", 2 * F.col("cnt"))
    tables.replace_report(again, path, 7, "orders", "19950101", "19950131")
    return tables.read_reports(spark, path, "dt string, cnt long").select("dt", "cnt", "tag_id")


@query("export_totals", _PRELUDE + "SELECT count(*) AS total, count(*) FILTER (CAST(id AS BIGINT) % 3 <> 0) AS lines, CAST(sum(CASE WHEN CAST(id AS BIGINT) % 3 <> 0 THEN strlen(id) + 6 END) AS BIGINT) AS bytes, count(*) FILTER (CAST(id AS BIGINT) % 3 <> 0) AS in_files FROM aud")
def export_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audience is written; the counts come from the same pass, and are held against the files."""
    path, n = work_folder(spark), F.col("did").cast("long")
    ids = context(spark, sf_dir, reports.MOBILE).audience
    typ = F.when(n % 3 == 0, F.lit("")).when(n % 2 == 0, "imei").otherwise("idfa")
    told = devices.export_to(ids.select(typ.alias("typ"), "did"), reports.MOBILE, path)
    return files.read_lines(spark, path).agg(F.count(F.lit(1)).alias("in_files")).select(*[F.lit(told[k]).cast("long").alias(k) for k in ("total", "lines", "bytes")], "in_files")


def _customer_file(spark: SparkSession, sf_dir: str) -> str:
    """A folder with one file: a line for each customer, by key."""
    path = work_folder(spark)
    line = F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    table(spark, sf_dir, "customer").repartition(1).sortWithinPartitions("c_custkey").select(line.alias("value")).write.text(path)
    return path


_CUSTOMER_LINES = "WITH l AS (SELECT c_custkey AS k, c_custkey || '|' || c_name || '|' || c_mktsegment AS value FROM customer)"


@query("byte_range_lines", _CUSTOMER_LINES + " SELECT value, CAST(coalesce(sum(strlen(value) + 1) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM l")
def byte_range_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a file that is read in ranges of 9,999 bytes, and the bytes they begin at."""
    return byteranges.read_ranges(spark, _customer_file(spark, sf_dir), 9_999).select("value", "start")


@query("file_bytes_at", _CUSTOMER_LINES + ", f AS (SELECT string_agg(value || chr(10), '' ORDER BY k) AS t FROM l) SELECT 'head' AS part, substring(t, 1, 100) AS data FROM f UNION ALL SELECT 'at 777', substring(t, 778, 50) FROM f UNION ALL SELECT 'tail', substring(t, -100) FROM f")
def file_bytes_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _customer_file(spark, sf_dir)
    name = files.listing(spark, path, glob="part-*").first().path
    parts = {"head": byteranges.head_bytes(spark, name, 100), "at 777": byteranges.read_at(spark, name, 777, 50), "tail": byteranges.tail_bytes(spark, name, 100)}
    out = [df.select(F.lit(part).alias("part"), F.col("data").cast("string").alias("data")) for part, df in parts.items()]
    return out[0].unionAll(out[1]).unionAll(out[2])


_CRC32C = "list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 2197175160) ELSE c >> 1 END))"


@query(
    "block_checksum",
    _CUSTOMER_LINES
    + f""", tab AS MATERIALIZED (SELECT {_CRC32C} AS t), f AS (SELECT hex(encode(string_agg(value || chr(10), '' ORDER BY k))) AS x FROM l),
    chunks AS (SELECT i, substring(x, 1024 * i + 1, 1024) AS h FROM f, unnest(range((length(x) + 1023) // 1024)) AS u(i)),
    crcs AS (SELECT i, xor(list_reduce(list_concat([4294967295], list_transform(range(length(h) // 2), lambda j: CAST('0x' || substring(h, 2 * j + 1, 2) AS BIGINT))), lambda s, b: xor(t[xor(s, b) % 256 + 1], s >> 8)), 4294967295) AS c FROM chunks, tab),
    blocks AS (SELECT i // 8 AS b, md5(unhex(string_agg(lpad(hex(c), 8, '0'), '' ORDER BY i))) AS m FROM crcs GROUP BY 1),
    file AS (SELECT count(*) AS blocks, string_agg(m, '' ORDER BY b) AS m FROM blocks)
    SELECT blocks, md5(unhex(m || repeat('00', CAST(greatest(32, pow(2, ceil(log2(16 * blocks)))) AS INTEGER) - 16 * blocks))) AS checksum FROM file""",
)
def block_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checksum of checksums of a file of blocks of 4,096 bytes."""
    return byteranges.block_checksums(spark, _customer_file(spark, sf_dir), 4096).select("blocks", "checksum")


@query("export_partition", "SELECT CAST(c_custkey AS VARCHAR) AS value FROM customer WHERE c_mktsegment = 'BUILDING'")
def export_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("visitor_id"), F.col("c_mktsegment").alias("part"))
    return devices.export_partition(rows_, "part", "BUILDING", reports.PC)[0]


@query("csv_rule", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey > 9")
def csv_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark)
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").write.option("header", True).csv(path)
    return files.rule_over_csv(spark, path, 'c_mktsegment = "BUILDING" and c_nationkey > 9 | c_custkey, c_name')


for _f in ("max", "min", "avg"):
    _rule(f"rule_table_{_f}", "orders", f'o_orderstatus != "P" | distinct(o_orderpriority) | {_f}(o_totalprice) > 0 | o_orderpriority', f"SELECT o_orderpriority, {_f}(o_totalprice) AS made FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1", "table", {f"{_f}(o_totalprice)": "made"})


@query("scan_lines", "SELECT r_name AS value FROM region UNION ALL SELECT n_name FROM nation")
def scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a folder tree and of a second folder; empty names count for nothing."""
    path = work_folder(spark)
    table(spark, sf_dir, "region").select("r_name").write.text(f"{path}/a/deep/er")
    table(spark, sf_dir, "nation").select("n_name").write.text(f"{path}/b")
    return files.read_lines(spark, f"{path}/a", "", f"{path}/b", recursive=True)


@query(
    "split_files",
    "WITH l AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders) SELECT n // 700 AS file, count(*) AS lines, min(o_orderkey) AS first, max(o_orderkey) AS last, sum(strlen(o_orderkey || ' ' || o_orderpriority) + 1)::BIGINT AS bytes FROM l GROUP BY 1",
)
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark)
    lines = table(spark, sf_dir, "orders").repartitionByRange(8, "o_orderkey").sortWithinPartitions("o_orderkey")
    files.split_lines(lines.select(F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value")), path, 700)
    key = F.split("value", " ")[0].cast("long")
    parts = files.split_parts(spark, path).groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.min(key).alias("first"), F.max(key).alias("last"))
    sizes = files.split_files(spark, path).groupBy("file").agg(F.sum("length").alias("bytes"))
    return parts.join(sizes, "file")


@query("line_numbers", "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) + 99 AS n FROM lineitem")
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    return tables.next_ids(table(spark, sf_dir, "lineitem").select(*order).orderBy(*order), 100, "n").select("l_orderkey", "l_linenumber", "n")


@query("running_revenue", "SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS cents FROM orders")
def running_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return running_total(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], cents, "cents").select("o_orderkey", "cents")


@query("merged_file", "SELECT n_name AS value FROM nation")
def merged_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark)
    table(spark, sf_dir, "nation").select("n_name").repartition(3).write.text(f"{path}/in")
    files.merge_files(spark, f"{path}/in", f"{path}/out")
    return files.read_lines(spark, f"{path}/out")


@query("file_checksum", "SELECT md5(string_agg(r_name || chr(10), '' ORDER BY r_regionkey)) AS md5 FROM region")
def file_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark)
    table(spark, sf_dir, "region").coalesce(1).sortWithinPartitions("r_regionkey").select("r_name").write.text(path)
    return files.checksums(spark, f"{path}/part-*").select("md5")


@query("head_lines", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 5")
def head_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.head(rows.page(table(spark, sf_dir, "events").select("event_id", "event_type"), ["event_id"]), 5)


@query("head_tail_bytes", "SELECT c_custkey, substring(c_name, 1, 8) AS head, right(c_name, 4) AS tail FROM customer")
def head_tail_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name").cast("binary")
    return table(spark, sf_dir, "customer").select("c_custkey", rows.head_bytes(name, 8).cast("string").alias("head"), rows.tail_bytes(name, 4).cast("string").alias("tail"))


@query("document_update", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'SET' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer")
def document_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One field of some documents is set; their other fields stay."""
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return tables.set_fields(old, F.col("c_custkey") % 5 == 0, {"c_mktsegment": F.lit("SET")})


@query("find_by_ids", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (3, 5, 8, 100000000)")
def find_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.find(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", [3, 5, 8, 100000000])


@query("keyed_remove", "SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 1")
def keyed_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select("c_custkey")
    return tables.remove_by(old, old.filter("c_custkey % 4 = 1"), "c_custkey")


@query("orc_store", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def orc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = tables.widened(table(spark, sf_dir, "nation").filter("n_regionkey = 1").select("n_nationkey", "n_name"))
    return wide.save_orc(rows_, f"wide_{uuid.uuid4().hex}", work_folder(spark))


# Days, scans, lines


@query("day_range_desc", "SELECT strftime(d, '%Y%m%d') AS day, count(event_id) AS cnt FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM events WHERE user_id = 1) LEFT JOIN events ON CAST(ts AS DATE) = d AND user_id = 1 GROUP BY d")
def day_range_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days from a user's first event to the last, latest first, with the events of each; some have none."""
    own = table(spark, sf_dir, "events").filter("user_id = 1").select(F.date_format("ts", "yyyyMMdd").alias("day"))
    every = own.agg(F.min("day").alias("a"), F.max("day").alias("z")).filter("a is not null").select(F.explode(day_column(F.col("a"), F.col("z"))).alias("day"))
    counts = own.groupBy("day").agg(F.count(F.lit(1)).alias("cnt"))
    return every.join(counts, "day", "left").select("day", F.coalesce("cnt", F.lit(0)).alias("cnt")).orderBy(F.desc("day"))


@query("scan_parquet_pruned", "SELECT l_returnflag, count(*) AS cnt FROM lineitem WHERE l_quantity > 45 GROUP BY 1")
def scan_parquet_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.execute("l_quantity > 45 | l_returnflag", table(spark, sf_dir, "lineitem")).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("cnt"))


@query("usage_rollup", "SELECT CASE WHEN n >= 1048576 THEN printf('%.1fM', n / 1048576.0) WHEN n >= 1024 THEN printf('%.1fK', n / 1024.0) ELSE n || 'B' END AS size, source, n AS bytes FROM (SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS n FROM documents GROUP BY 1)")
def usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    return by.select(text.human_bytes(F.col("bytes")).alias("size"), "source", "bytes")


@query("csv_lines", "SELECT c_custkey || ',' || c_mktsegment || ',' AS line FROM customer")
def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = rows.csv_line(F.col("c_custkey"), F.col("c_mktsegment"), F.lit(None), F.col("c_name"), drop_last=True)
    return table(spark, sf_dir, "customer").select(line.alias("line"))


@query("line_map_udf", "SELECT reverse(c_name) AS value FROM customer")
def line_map_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.map_lines(table(spark, sf_dir, "customer").select(F.col("c_name").alias("value")), lambda s: s[::-1])


@query(
    "due_items_stream",
    "WITH m AS (SELECT user_id, event_id, event_type, epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000 + 60000 * CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) * 60 AS due, lead(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS until FROM events), "
    "e AS (SELECT max(ms) AS final FROM m) SELECT CAST(user_id AS VARCHAR) AS key, due AS due_ms, CAST(event_id AS VARCHAR) AS item FROM m, e WHERE event_type <> 'purchase' AND due <= coalesce(until, final)",
)
def due_items_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event sets when its user is due next, a purchase takes that back; what fires."""
    path = work_folder(spark)
    ev = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    hours = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    when = F.when(F.col("event_type") != "purchase", F.timestamp_millis(F.unix_millis("at") + 3_600_000 * hours))
    ev.select(F.col("user_id").cast("string").alias("key"), "at", F.col("event_id").alias("number"), when.alias("due"), F.col("event_id").cast("string").alias("item")).write.parquet(f"{path}/in")
    messages = spark.readStream.schema("key string, at timestamp, number long, due timestamp, item string").parquet(f"{path}/in")
    streams.start(due.due_items(messages), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema(due.OUT).parquet(f"{path}/out").select("key", F.unix_millis("due").alias("due_ms"), "item")


@query("stream_rule_filter", "SELECT event_type, CAST(user_id AS VARCHAR) AS user_id FROM events WHERE event_type = 'view' AND user_id > 5")
def stream_rule_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as files, through a stream that takes what is there, into files again."""
    work = work_folder(spark)
    table(spark, sf_dir, "events").select(F.to_json(F.struct("event_type", "user_id")).alias("value")).write.mode("overwrite").text(f"{work}/in")
    messages = streams.line_stream(spark, f"{work}/in")
    streams.start(streams.filter_stream(messages, 'event_type = "view" and user_id > 5 | event_type, user_id'), f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.schema("event_type string, user_id string").parquet(f"{work}/out")
