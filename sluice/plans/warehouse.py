"""The tables that reports read, and how a set of plain tables stands in for them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Warehouse:
    """All log tables have dt, a yyyyMMdd string that a real store partitions by."""

    impressions: DataFrame  # dt, visitorid, did, aduserid, spotid, ostype, ip
    clicks: DataFrame  # the same
    sessions: DataFrame  # dt, visitor_id, session_id, pageviews, os_id, country_id, province_id, referer_domain_id, search_keyword_id, ad_sf_aduser_id
    page_events: DataFrame  # dt, visitor_id, session_id, page_url_id, page_title_id, ad_sf_aduser_id
    visits: DataFrame  # dt, visitor_id, site_id, page_domain_id, begintime, referer_url_id
    bids: DataFrame  # dt, did, longitude, latitude
    wide: DataFrame  # visitor_id, did, sex, age, industry, os
    user_category: DataFrame  # userid, did, categories: ids joined by |
    user_domain: DataFrame  # userid, domain
    dim_os: DataFrame  # id (not unique), name
    dim_location: DataFrame  # country, region, country_name, region_name
    dim_source: DataFrame  # id, name
    dim_keyword: DataFrame  # id, name
    dim_url: DataFrame  # id, name
    dim_title: DataFrame  # id, name
    dim_category: DataFrame  # id, name
    dim_position: DataFrame  # id, name
    meta_domain: DataFrame  # domain_id, domain
    meta_referer: DataFrame  # url_id, url


#: Of the stand-in: categories that interest reports know.
CATEGORIES = ("3", "5", "8", "11", "13", "17", "21", "24")


def stand_in(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse made of the events, customer, nation, region, part, pages and embeddings tables."""
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    k = F.regexp_extract("props", "([0-9]+)", 1).try_cast("int")
    ev = t("events").select(F.col("user_id").cast("string").alias("visitor"), F.date_format("ts", "yyyyMMdd").alias("dt"), "ts", "event_type", k.alias("k"))
    log = [F.col("visitor").alias("visitorid"), F.col("visitor").alias("did"), "dt", (F.col("k") % 10).alias("aduserid"), (F.col("k") % 25).alias("spotid"), (F.col("k") % 27).alias("ostype"), F.concat(F.lit("10.0."), F.col("k") % 7, F.lit("."), F.col("k")).alias("ip")]
    session = F.concat_ws("_", "visitor", "dt")
    per_day = ev.groupBy("visitor", "dt").agg(F.count(F.lit(1)).alias("pageviews"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    nation, region, part = t("nation"), t("region"), t("part")
    customer = t("customer")
    names = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    point = t("embeddings").select("vec_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    return Warehouse(
        impressions=ev.filter("event_type = 'view'").select(*log),
        clicks=ev.filter("event_type = 'click'").select(*log),
        sessions=per_day.select(F.col("visitor").cast("long").alias("visitor_id"), "dt", session.alias("session_id"), "pageviews", (F.col("lo") % 27).alias("os_id"), (F.col("lo") % 25).alias("country_id"), (F.col("hi") % 5).alias("province_id"), (F.col("lo") % 25).alias("referer_domain_id"), (F.col("hi") % 40).alias("search_keyword_id"), (F.col("lo") % 10).alias("ad_sf_aduser_id")),
        page_events=ev.select(F.col("visitor").cast("long").alias("visitor_id"), "dt", session.alias("session_id"), F.col("k").alias("page_url_id"), (F.col("k") % 40).alias("page_title_id"), (F.col("k") % 10).alias("ad_sf_aduser_id")),
        visits=ev.select("visitor", "dt", (F.col("k") % 2).alias("site_id"), (F.col("k") % 6).alias("page_domain_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("begintime"), (F.col("k") % 12).alias("referer_url_id")).withColumnRenamed("visitor", "visitor_id"),
        bids=point.select(F.lit("20240110").alias("dt"), F.col("vec_id").cast("string").alias("did"), (F.col("x").cast("double") * 180).cast("string").alias("longitude"), (F.col("y").cast("double") * 90).cast("string").alias("latitude")),
        wide=customer.select(F.col("c_custkey").cast("string").alias("visitor_id"), F.col("c_custkey").cast("string").alias("did"), (F.col("c_custkey") % 2).cast("string").alias("sex"), F.floor(F.col("c_acctbal") / 2000).cast("string").alias("age"), F.col("c_mktsegment").alias("industry"), F.col("c_nationkey").cast("string").alias("os")),
        user_category=customer.select(F.col("c_custkey").cast("string").alias("userid"), F.col("c_custkey").cast("string").alias("did"), F.concat_ws("|", (F.col("c_custkey") % 25).cast("string"), (F.col("c_custkey") * 7 % 25).cast("string"), F.col("c_nationkey").cast("string")).alias("categories")),
        user_domain=customer.select(F.col("c_custkey").cast("string").alias("userid"), F.concat(F.lower("c_mktsegment"), F.lit(".example")).alias("domain")),
        dim_os=names.union(names.select("id", F.concat("name", F.lit(" alias")))),
        dim_location=nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_nationkey").alias("country"), F.col("n_regionkey").alias("region"), F.col("n_name").alias("country_name"), F.col("r_name").alias("region_name")),
        dim_source=names,
        dim_keyword=t("benchmark").select(F.col("item_id").alias("id"), F.when(F.col("item_id") % 9 == 0, F.lit("")).otherwise(F.substring("text", 1, 12)).alias("name")),
        dim_url=t("pages").select(F.col("page_id").alias("id"), F.when(F.col("page_id") % 11 == 0, F.lit("")).otherwise(F.col("url")).alias("name")),
        dim_title=t("benchmark").select(F.col("item_id").alias("id"), F.substring("text", 1, 20).alias("name")),
        dim_category=part.filter("p_partkey <= 25").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name")),
        dim_position=names.filter("id < 20"),
        meta_domain=nation.filter("n_nationkey < 6").select(F.col("n_nationkey").alias("domain_id"), F.concat(F.lower("n_name"), F.lit(".example")).alias("domain")),
        meta_referer=nation.filter("n_nationkey < 10").select(F.col("n_nationkey").alias("url_id"), F.concat(F.lit("http://www."), F.lower(F.regexp_replace("n_name", " ", "")), F.lit(".example/"), F.col("n_nationkey")).alias("url")),
    )


def stand_in_ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(first, last, country, region) of ips in 10.0.0.0/8, from nation and region: some nested, some
    touching, gaps, and one that holds most others."""
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    net, n, r = 10 << 24, F.col("n_nationkey").cast("long"), F.col("r_regionkey").cast("long")
    at = F.lit(net) + n % 7 * 256 + n * 4
    small = t("nation").select(at.alias("first"), (at + 3 + n % 3 * 2).alias("last"), F.col("n_nationkey").alias("country"), F.col("n_regionkey").alias("region"))
    start = F.lit(net) + (r + 2) * 256
    middle = t("region").select(start.alias("first"), (start + 79 + 20 * r).alias("last"), (r + 10).cast("int").alias("country"), F.col("r_regionkey").alias("region"))
    huge = t("region").filter("r_regionkey = 3").select(F.lit(net + 4 * 256).cast("long").alias("first"), F.lit(net + (1 << 24) - 1).cast("long").alias("last"), F.lit(8).alias("country"), F.col("r_regionkey").alias("region"))
    return small.unionByName(middle).unionByName(huge)
