"""Audience reports: (dimension, metric) -> a query over a warehouse and an audience.

Counts by key are taken before names are joined, so names join a few rows. Semi-joins pick the
audience's log rows; Spark takes the broadcast when the audience is small and shuffles both sides
when it isn't.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranges import ip_number, narrowest
from .days import day_column, day_list
from .warehouse import Warehouse

PC, MOBILE = 1, 2
#: The country that regions report province by province.
DRILL_COUNTRY = 10761
#: The interest categories.
HOBBIES = ("606", "790", "518", "508", "343", "148", "910", "521", "609", "522", "184", "147", "91", "399", "927", "391", "248", "446", "266", "393", "303", "394", "397", "274", "525", "528")
UNKNOWN = "Unknown"


class ReportError(ValueError):
    """The report can't be made in this context."""


@dataclass(frozen=True)
class Context:
    """One run: audience (one id column, visitor_id or did), dates, advertisers by product."""

    warehouse: Warehouse
    audience: DataFrame
    first: str  # yyyyMMdd
    last: str
    suppliers: dict[str, tuple[int, ...]] = field(default_factory=dict)
    etype: int = PC
    geo: Callable[[Column], Column] | None = None  # ip -> map with "country" and "region"
    hobbies: tuple[str, ...] = HOBBIES
    drill_country: int = DRILL_COUNTRY
    ip_ranges: DataFrame | None = None  # first, last (ips as numbers), country, region; taken before geo
    daily: bool = False  # day by day: all reports have a column more, day
    total: bool = False  # with daily: rows of the whole range too, whose day is null

    @property
    def by(self) -> list[str]:
        """What every count is grouped by, besides its own keys."""
        return ["day"] if self.daily else []

    @property
    def key(self) -> str:
        return "visitor_id" if self.etype == PC else "did"

    @property
    def log_key(self) -> str:
        return "visitorid" if self.etype == PC else "did"

    @property
    def supplier_ids(self) -> list[int]:
        return sorted({i for ids in self.suppliers.values() for i in ids})

    @property
    def days(self) -> list[str]:
        return day_list(self.first, self.last)


@dataclass(frozen=True)
class Report:
    dimension: str
    metric: str
    build: Callable[[Context], DataFrame]
    etypes: tuple[int, ...] = (PC,)
    products: tuple[str, ...] = ("dsp",)


REPORTS: dict[tuple[str, str], Report] = {}


def report(dimension: str, *metrics: str, etypes: tuple[int, ...] = (PC,), products: tuple[str, ...] = ("dsp",)):
    """Register build(ctx) or build(ctx, metric) for each metric."""

    def add(build):
        for m in metrics:
            one = build if len(metrics) == 1 else (lambda ctx, m=m: build(ctx, m))
            REPORTS[dimension, m] = Report(dimension, m, one, etypes, products)
        return build

    return add


# What all reports are made of


def _in_dates(df: DataFrame, ctx: Context) -> DataFrame:
    """Rows of the range. Day by day, each has its day; for totals it is there once more without, so
    that distinct counts of days and of the range come from one reading."""
    out = df.filter(F.col("dt").between(ctx.first, ctx.last))
    if not ctx.daily:
        return out
    return out.withColumn("day", F.explode(F.array("dt", F.lit(None))) if ctx.total else F.col("dt"))


def _all_days(ctx: Context) -> Column:
    days = day_column(ctx.first, ctx.last)
    return F.explode(F.concat(days, F.array(F.lit(None).cast("string"))) if ctx.total else days)


def _each_day(df: DataFrame, ctx: Context) -> DataFrame:
    """What doesn't hang on the day, for each day."""
    return df.withColumn("day", _all_days(ctx)) if ctx.daily else df


def _filled(df: DataFrame, ctx: Context, *sums: str) -> DataFrame:
    """Sums of the range, or of each day; days without rows have zeros."""
    if not ctx.daily:
        return df
    zeros = df.sparkSession.range(1).select(_all_days(ctx).alias("day"), *[F.lit(0).cast("long").alias(c) for c in sums])
    return df.unionByName(zeros).groupBy("day").agg(*[F.sum(c).alias(c) for c in sums])


def _audience(ctx: Context, name: str) -> DataFrame:
    return ctx.audience.select(F.col(ctx.key).cast("string").alias(name))


def _ad_log(ctx: Context, metric: str) -> DataFrame:
    log = ctx.warehouse.clicks if metric == "click" else ctx.warehouse.impressions
    return _in_dates(log, ctx).filter(F.col("aduserid").isin(ctx.supplier_ids))


def _ad_rows(ctx: Context, metric: str) -> DataFrame:
    """The audience's impressions or clicks."""
    return _ad_log(ctx, metric).join(_audience(ctx, ctx.log_key), ctx.log_key, "left_semi")


def _site_rows(ctx: Context, table: DataFrame) -> DataFrame:
    """The audience's sessions or page events. Their ids are numbers; the audience's are text."""
    rows = _in_dates(table, ctx).filter(F.col("ad_sf_aduser_id").isin(ctx.supplier_ids) & F.col("visitor_id").isNotNull())
    audience = _audience(ctx, "__id")
    return rows.join(audience, rows.visitor_id.cast("string") == audience["__id"], "left_semi")


def _sessions(ctx: Context) -> DataFrame:
    return _site_rows(ctx, ctx.warehouse.sessions)


def _pages(ctx: Context) -> DataFrame:
    return _site_rows(ctx, ctx.warehouse.page_events)


def _count(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("cnt"))


def _named(counts: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    return counts.join(dim.withColumnRenamed("id", key), key, how)


def wide_rows(ctx: Context) -> DataFrame:
    """The wide table's columns for each audience row; multiplicity is kept."""
    wide = ctx.warehouse.wide.filter(F.col(ctx.key).isNotNull() & (F.col(ctx.key) != ""))
    return wide.join(_audience(ctx, ctx.key), ctx.key)


# Demography: sex, age, industry, mobile os


def _demography(column: str, etypes: tuple[int, ...]) -> None:
    def build(ctx: Context, metric: str) -> DataFrame:
        rows = wide_rows(ctx)
        if metric == "value":
            return _each_day(_count(rows.distinct(), column), ctx)
        log = _ad_log(ctx, metric).select(*ctx.by, F.col(ctx.log_key).alias(ctx.key))
        # Log rows are counted by id first: every wide row then weighs that many.
        per_id = log.groupBy(*ctx.by, ctx.key).agg(F.count(F.lit(1)).alias("n"))
        return rows.join(per_id, ctx.key).groupBy(*ctx.by, column).agg(F.sum("n").alias("cnt"))

    name = "mob_os" if column == "os" else column
    for metric in ("value", "impressions", "click"):
        REPORTS[name, metric] = Report(name, metric, lambda ctx, m=metric: build(ctx, m), etypes, () if metric == "value" else ("dsp",))


for _column, _etypes in (("sex", (PC, MOBILE)), ("age", (PC, MOBILE)), ("industry", (PC, MOBILE)), ("os", (MOBILE,))):
    _demography(_column, _etypes)


# Operating systems


def _os_names(ctx: Context, counts: DataFrame) -> DataFrame:
    dim = ctx.warehouse.dim_os.groupBy("id").agg(F.max("name").alias("name"))
    return _named(counts, dim, "ostype", "left").select(*ctx.by, F.coalesce("name", F.lit(UNKNOWN)).alias("ostypename"), "ostype", "cnt")


@report("os", "visitors")
def os_visitors(ctx: Context) -> DataFrame:
    """Visitors by system, of both logs: one who is in both counts twice."""
    by = ctx.by
    ads = _ad_rows(ctx, "impressions").filter("visitorid is not null").select(*by, "visitorid", "ostype").distinct()
    site = _sessions(ctx).select(*by, "visitor_id", F.col("os_id").alias("ostype")).distinct()
    return _os_names(ctx, _count(ads.select(*by, "ostype").unionAll(site.select(*by, "ostype")), *by, "ostype"))


@report("os", "impressions", "click")
def os_ads(ctx: Context, metric: str) -> DataFrame:
    return _os_names(ctx, _count(_ad_rows(ctx, metric), *ctx.by, "ostype"))


# Interests


@report("hobby", "value", "impressions", "click", etypes=(PC, MOBILE))
def hobby(ctx: Context, metric: str) -> DataFrame:
    own = "userid" if ctx.etype == PC else "did"
    rows = ctx.warehouse.user_category.join(_audience(ctx, own), own)
    rows = rows.select(own, F.explode(F.split("categories", r"\|")).alias("catid")).filter(F.col("catid").isin(list(ctx.hobbies)))
    if metric == "value":
        counts = _each_day(_count(rows, "catid"), ctx)
    else:
        # Log ids are of the web log for both kinds of audience.
        per_id = _ad_log(ctx, metric).select(*ctx.by, F.col("visitorid").alias(own)).groupBy(*ctx.by, own).agg(F.count(F.lit(1)).alias("n"))
        counts = rows.join(per_id, own).groupBy(*ctx.by, "catid").agg(F.sum("n").alias("cnt"))
    return _named(counts, ctx.warehouse.dim_category, "catid").select(*ctx.by, F.col("name").alias("interest"), "cnt")


@report("hotsite", "visitors", products=())
def hotsite(ctx: Context) -> DataFrame:
    ids = _audience(ctx, "userid").distinct()
    return _each_day(_count(ctx.warehouse.user_domain.join(ids, "userid"), "domain"), ctx)


# Keywords, pages, sources


def _by_name(rows: DataFrame, key: str, dim: DataFrame, by: list[str], filled: bool = True) -> DataFrame:
    """Count by key, name the keys, add up equal names."""
    out = _named(_count(rows, *by, key), dim, key)
    if filled:
        out = out.filter("name <> ''")
    return out.groupBy(*by, "name").agg(F.sum("cnt").alias("cnt"))


@report("keyword", "session", "pageviews", "visitors")
def keyword(ctx: Context, metric: str) -> DataFrame:
    """session: distinct (keyword, session); pageviews: session rows; visitors: rows with a keyword."""
    rows = _sessions(ctx)
    if metric == "session":
        rows = rows.select(*ctx.by, "search_keyword_id", "session_id").distinct()
    elif metric == "visitors":
        rows = rows.filter("search_keyword_id > 0")
    return _by_name(rows, "search_keyword_id", ctx.warehouse.dim_keyword, ctx.by)


@report("page", "session", "visitors")
def page_distinct(ctx: Context, metric: str) -> DataFrame:
    other = "session_id" if metric == "session" else "visitor_id"
    counts = _count(_pages(ctx).select(*ctx.by, "page_url_id", other).distinct(), *ctx.by, "page_url_id")
    return _named(counts, ctx.warehouse.dim_url, "page_url_id").filter("name <> ''").select(*ctx.by, "name", "cnt")


@report("page", "pageviews")
def page_views(ctx: Context) -> DataFrame:
    counts = _count(_pages(ctx), *ctx.by, "page_url_id", "page_title_id")
    out = _named(counts, ctx.warehouse.dim_url.withColumnRenamed("name", "url"), "page_url_id")
    out = _named(out, ctx.warehouse.dim_title.withColumnRenamed("name", "title"), "page_title_id")
    return out.groupBy(*ctx.by, "page_url_id", "url", "title").agg(F.sum("cnt").alias("cnt"))


@report("source", "session", "pageviews", "visitors")
def source(ctx: Context, metric: str) -> DataFrame:
    rows = _sessions(ctx)
    if metric == "visitors":
        rows = rows.select(*ctx.by, "referer_domain_id", "visitor_id").distinct()
    amount = F.sum("pageviews") if metric == "pageviews" else F.count(F.lit(1))
    counts = rows.groupBy(*ctx.by, "referer_domain_id").agg(amount.alias("cnt"))
    return _named(counts, ctx.warehouse.dim_source, "referer_domain_id").groupBy(*ctx.by, "name").agg(F.sum("cnt").alias("cnt"))


# Regions


def _place(country: Column, region: Column, ctx: Context) -> Column:
    """Country id as text; for the country that is drilled into, country$province."""
    country = country.cast("string")
    return F.when(country == str(ctx.drill_country), F.concat(country, F.lit("$"), region.cast("string"))).otherwise(country)


def _located(counts: DataFrame, ctx: Context) -> DataFrame:
    """counts: (id, cnt) -> counts by location name."""
    dim, c = ctx.warehouse.dim_location, F.col("country")
    name = F.when(c == ctx.drill_country, F.concat("country_name", "region_name")).otherwise(F.col("country_name"))
    places = dim.select(_place(c, F.col("region"), ctx).alias("id"), name.alias("location")).distinct()
    counts = counts.filter("id <> ''").groupBy(*ctx.by, "id").agg(F.sum("cnt").alias("cnt"))
    return counts.join(places, "id").groupBy(*ctx.by, "location").agg(F.sum("cnt").alias("cnt"))


def _by_ip(rows: DataFrame, ctx: Context) -> DataFrame:
    """(id, cnt): rows by the place of their ip. They are counted by ip first, so that each ip is
    looked up once."""
    counts = _count(rows, *ctx.by, "ip")
    if ctx.ip_ranges is not None:
        where = ctx.ip_ranges.select("first", "last", "country", "region")
        out = narrowest(counts.withColumn("__ip", ip_number(F.col("ip"))), "__ip", where)
        return out.select(*ctx.by, _place(F.col("country"), F.col("region"), ctx).alias("id"), "cnt")
    if ctx.geo is None:
        raise ReportError("no ranges of ips, and no function from ip to place")
    out = counts.withColumn("__geo", ctx.geo(F.col("ip")))
    return out.select(*ctx.by, _place(F.col("__geo")["country"], F.col("__geo")["region"], ctx).alias("id"), "cnt")


def _by_site(rows: DataFrame, ctx: Context) -> DataFrame:
    """(id, cnt): rows by their country and province."""
    return _count(rows.select(*ctx.by, _place(F.col("country_id"), F.col("province_id"), ctx).alias("id")), *ctx.by, "id")


@report("region", "session", "pageviews")
def region_site(ctx: Context, metric: str) -> DataFrame:
    rows = _sessions(ctx)
    if metric == "session":
        rows = rows.select(*ctx.by, "visitor_id", "session_id", "country_id", "province_id").distinct()
    return _located(_by_site(rows, ctx), ctx)


@report("region", "visitors")
def region_visitors(ctx: Context) -> DataFrame:
    ads = _by_ip(_ad_rows(ctx, "impressions").filter("visitorid is not null").select(*ctx.by, "ip", "visitorid").distinct(), ctx)
    site = _by_site(_sessions(ctx).select(*ctx.by, "country_id", "province_id", "visitor_id").distinct(), ctx)
    return _located(ads.unionByName(site), ctx)


@report("region", "impressions", "click", etypes=(PC, MOBILE))
def region_ads(ctx: Context, metric: str) -> DataFrame:
    return _located(_by_ip(_ad_rows(ctx, metric).filter(F.col(ctx.log_key).isNotNull()), ctx), ctx)


# Summary, depth, frequency, placements


def unpivot(df: DataFrame, keys: list[str], metrics: list[str], value: str = "cnt") -> DataFrame:
    """A row per metric."""
    return df.unpivot(keys, metrics, "metric", value)


@report("summary", "session")
def summary_session(ctx: Context) -> DataFrame:
    one = _sessions(ctx).groupBy(*ctx.by).agg(F.count(F.lit(1)).alias("sessions"), F.coalesce(F.sum("pageviews"), F.lit(0)).alias("pageviews"))
    return unpivot(_filled(one, ctx, "sessions", "pageviews"), ctx.by, ["sessions", "pageviews"])


@report("summary", "visitors")
def summary_visitors(ctx: Context) -> DataFrame:
    return _filled(_sessions(ctx).groupBy(*ctx.by).agg(F.countDistinct("visitor_id").alias("cnt")), ctx, "cnt")


@report("summary", "impressions", "click")
def summary_ads(ctx: Context, metric: str) -> DataFrame:
    return _filled(_count(_ad_rows(ctx, metric), *ctx.by), ctx, "cnt")


@report("depth", "session")
def depth_session(ctx: Context) -> DataFrame:
    """Sessions by depth, and their page views (depth * sessions)."""
    by = _sessions(ctx).groupBy(*ctx.by, F.col("pageviews").alias("depth")).agg(F.count(F.lit(1)).alias("sessions"))
    return unpivot(by.withColumn("pageviews", F.col("depth") * F.col("sessions")), [*ctx.by, "depth"], ["sessions", "pageviews"])


@report("depth", "visitors")
def depth_visitors(ctx: Context) -> DataFrame:
    deepest = _sessions(ctx).groupBy(*ctx.by, "visitor_id").agg(F.max("pageviews").alias("depth"))
    return _count(deepest, *ctx.by, "depth")


@report("frequency", "visitors")
def frequency(ctx: Context, most: int = 10, label: str = ">10") -> DataFrame:
    """Visitors, and their impressions, by number of impressions; `most` and above is one row."""
    per = _ad_rows(ctx, "impressions").filter("visitorid is not null").groupBy(*ctx.by, "visitorid").agg(F.count(F.lit(1)).alias("f"))
    hist = per.groupBy(*ctx.by, "f").agg(F.count(F.lit(1)).alias("n"))
    name = F.when(F.col("f") >= most, F.lit(label)).otherwise(F.col("f").cast("string"))
    return hist.groupBy(*ctx.by, name.alias("name")).agg(F.sum("n").alias("visitors"), F.sum(F.col("n") * F.col("f")).alias("impressions"))


@report("ad_summary", "click", "impressions", etypes=(PC, MOBILE))
def ad_summary(ctx: Context, metric: str) -> DataFrame:
    counts = _count(_ad_rows(ctx, metric), *ctx.by, "dt", "spotid")
    return _named(counts, ctx.warehouse.dim_position, "spotid", "left").select(*ctx.by, "dt", F.col("spotid").alias("spot_id"), "name", "cnt")


# Paths


def domain_of(url: Column) -> Column:
    """The first dotted run of word characters; it ends at a hyphen."""
    return F.regexp_extract(url, r"(\w+\.)+\w+", 0)


def merge_runs(path: Column) -> Column:
    """An array without elements that equal the one before."""
    return F.filter(path, lambda x, i: (i == 0) | (x != F.get(path, i - 1)))


@report("path", "topology")
def path(ctx: Context) -> DataFrame:
    """How often each path of referring domains leads a visitor to a site's domain. Steps are in
    order of time (as a number), equal neighbours merged."""
    w = ctx.warehouse
    rows = _in_dates(w.visits, ctx).join(_audience(ctx, "visitor_id"), "visitor_id", "left_semi")
    rows = rows.join(w.meta_referer, rows.referer_url_id == w.meta_referer.url_id).join(w.meta_domain, rows.page_domain_id == w.meta_domain.domain_id)
    # A step goes in only if it differs from the one before it, so a visitor's list holds changes alone.
    key = [*ctx.by, "visitor_id", "site_id", "domain"]
    step = rows.select(*key, F.col("begintime").alias("at"), domain_of(F.col("url")).alias("ref"))
    before = F.lag("ref").over(Window.partitionBy(*key).orderBy("at", "ref"))
    changes = step.withColumn("before", before).filter(F.col("before").isNull() | (F.col("ref") != F.col("before")))
    lists = changes.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("at", "ref"))).alias("steps"))
    refs = lists.select(*ctx.by, "domain", F.transform("steps", lambda s: s["ref"]).alias("refs"))
    paths = refs.select(*ctx.by, F.array_join(merge_runs(F.concat("refs", F.array("domain"))), ">").alias("paths"))
    return _count(paths, *ctx.by, "paths")


@report("path", "percent")
def path_percent(ctx: Context) -> DataFrame:
    """The total is one row, or one a day: it is summed up by task and goes to all of them."""
    counts = path(ctx)
    total = F.broadcast(counts.groupBy(*ctx.by).agg(F.sum("cnt").alias("__total")).withColumnsRenamed({"day": "__day"}))
    out = counts.join(total, F.col("day").eqNullSafe(F.col("__day"))) if ctx.daily else counts.crossJoin(total)
    return out.select(*ctx.by, "paths", "cnt", (F.col("cnt") * F.lit(100.0) / F.col("__total")).alias("per"))


# Running them


def can_run(r: Report, ctx: Context) -> bool:
    """Its kind of audience, and advertisers for each product it needs."""
    return ctx.etype in r.etypes and all(ctx.suppliers.get(p) for p in r.products)


def build_report(ctx: Context, dimension: str, metric: str) -> DataFrame:
    r = REPORTS.get((dimension, metric))
    if r is None:
        raise ReportError(f"no report {dimension}.{metric}")
    if not can_run(r, ctx):
        raise ReportError(f"{dimension}.{metric} doesn't apply here")
    return r.build(ctx)


def by_day(ctx: Context, dimension: str, metric: str, total: bool = False) -> DataFrame:
    """The report for each day of the range, latest first, with its day; total: and for the whole
    range, with null as its day, last. One plan, which reads each table as often as one report does."""
    from dataclasses import replace

    out = build_report(replace(ctx, daily=True, total=total), dimension, metric)
    return out.select(*[c for c in out.columns if c != "day"], "day").orderBy(F.desc_nulls_last("day"))


#: What a full run makes, by group.
GROUPS = {
    "people": ("sex", "age", "industry", "mob_os", "os", "hobby", "region", "frequency"),
    "advertisement": ("summary", "ad_summary"),
    "landing page": ("summary", "source", "keyword", "page", "depth", "hotsite"),
    "path": ("path",),
}


def applicable(ctx: Context, group: str | None = None) -> list[Report]:
    wanted = GROUPS[group] if group else [d for g in GROUPS.values() for d in g]
    return [r for r in REPORTS.values() if r.dimension in wanted and can_run(r, ctx)]
