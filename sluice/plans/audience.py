"""Audiences: and/or/reference trees of leaf rules -> one lazy DataFrame of ids.

    {"op": "$and" | "$or", "rules": [...]} | {"key": ..., "op": ..., "value": ...}

Keys: campaign (in), mediaDomain (=), clickCount and exposeCount (compared with a number), tag (in, a
list of other tags' ids). Equal subtrees become one DataFrame, so Spark reuses their exchanges.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import OPS
from .reports import MOBILE, PC


class AudienceError(ValueError):
    """The tree can't be built."""


@dataclass(frozen=True)
class Leaf:
    key: str
    op: str
    value: object


@dataclass(frozen=True)
class Both:
    op: str  # $and, $or
    parts: tuple[Leaf | Both, ...]


def tree(data: dict) -> Leaf | Both:
    if "rules" in data:
        if data.get("op") not in ("$and", "$or"):
            raise AudienceError(f"unknown operator {data.get('op')}")
        return Both(data["op"], tuple(tree(d) for d in data["rules"]))
    if not {"key", "op", "value"} <= data.keys():
        raise AudienceError(f"not a rule: {data}")
    value = data["value"]
    return Leaf(data["key"], data["op"], tuple(value) if isinstance(value, list) else value)


def _plain(node) -> list:
    return [node.key, node.op, node.value] if isinstance(node, Leaf) else [node.op, *map(_plain, node.parts)]


def rule_hash(node) -> str:
    return hashlib.md5(json.dumps(_plain(node), sort_keys=True, default=list).encode()).hexdigest()[:12]


@dataclass
class Stage:
    name: str
    depends: list[str]
    rule: Leaf | Both
    frame: DataFrame


@dataclass
class Builder:
    """impressions and clicks: ids in `key`, spotid as campaign, domain where mediaDomain is used.
    everyone: the ids that a count below a bound is taken over."""

    impressions: DataFrame
    clicks: DataFrame
    everyone: DataFrame
    key: str = "visitorid"
    etype: int = PC
    campaign: str = "spotid"
    domain: str = "domain"
    tags: dict[int, dict] = field(default_factory=dict)
    leaves: dict[str, Callable[[Builder, Leaf], DataFrame]] = field(default_factory=dict)
    stages: dict[str, Stage] = field(default_factory=dict)

    def build(self, data: dict | Leaf | Both, _open: tuple = ()) -> DataFrame:
        """(id): distinct ids of the audience."""
        node = tree(data) if isinstance(data, dict) else data
        return self.stages[self._stage(node, _open)].frame

    def stage(self, data: dict | Leaf | Both) -> str:
        """The name of the stage of a tree, which is built with all that it needs."""
        return self._stage(tree(data) if isinstance(data, dict) else data, ())

    def _stage(self, node: Leaf | Both, open_: tuple) -> str:
        name = rule_hash(node)
        if name in self.stages:
            return name
        depends: list[str] = []
        if isinstance(node, Both):
            if not node.parts:
                raise AudienceError(f"{node.op} of nothing")
            depends = [self._stage(p, open_) for p in node.parts]
            frame = self._merged(node.op, depends)
        elif node.key == "tag":
            depends = [self._stage(t, (*open_, i)) for i, t in self.referred(node, open_)]
            if len(depends) == 1:  # another name for that stage
                return depends[0]
            frame = self._merged("$or", depends)
        else:
            frame = self.leaf(node)
        self.stages[name] = Stage(name, list(dict.fromkeys(depends)), node, frame)
        return name

    def _merged(self, op: str, names: list[str]) -> DataFrame:
        frames = [self.stages[n].frame for n in dict.fromkeys(names)]
        return intersect_all(frames) if op == "$and" else union_all(frames).distinct()

    def referred(self, node: Leaf, open_: tuple = ()) -> list[tuple[int, Leaf | Both]]:
        """The tags that a reference names, with their trees; open_: the tags it stands in."""
        if node.op in ("nin", "notin"):
            raise AudienceError("tags can't be excluded")
        if node.op != "in" or not node.value:
            raise AudienceError("tag needs `in` and at least one tag")
        for i in node.value:
            if i in open_:
                raise AudienceError(f"tag {i} refers to itself")
            if i not in self.tags:
                raise AudienceError(f"no tag {i}")
        return [(i, tree(self.tags[i])) for i in node.value]

    def leaf(self, leaf: Leaf) -> DataFrame:
        """(id): the ids of one leaf rule."""
        make = (LEAVES | self.leaves).get(leaf.key)
        if make is None:
            raise AudienceError(f"unknown key {leaf.key}")
        return make(self, leaf)

    def describe(self) -> str:
        """Stages in the order they are built, and what each needs."""
        lines = [f"{s.name} <- {', '.join(s.depends) or '-'}: {_plain(s.rule)}" for s in self.stages.values()]
        return "\n".join(lines)

    def sequence(self) -> list[str]:
        return list(self.stages)


def _ids(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("id"))


def _campaign(b: Builder, leaf: Leaf) -> DataFrame:
    if leaf.op != "in" or not leaf.value:
        raise AudienceError("campaign needs `in` and at least one campaign")
    return _ids(b.impressions.filter(F.col(b.campaign).isin(list(leaf.value))), b.key).distinct()


def _domain(b: Builder, leaf: Leaf) -> DataFrame:
    if leaf.op not in ("=", "in"):
        raise AudienceError("mediaDomain needs = or `in`")
    values = [leaf.value] if leaf.op == "=" else list(leaf.value)
    return _ids(b.impressions.filter(F.col(b.domain).isin(values)), b.key).distinct()


def _times(table: str):
    def make(b: Builder, leaf: Leaf) -> DataFrame:
        """Ids by number of log rows; ids without rows count 0."""
        if leaf.op not in OPS or not isinstance(leaf.value, int):
            raise AudienceError(f"{leaf.key} is compared with a number")
        counts = _ids(getattr(b, table), b.key).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        if not OPS[leaf.op](0, leaf.value):  # ids without rows can't match
            return counts.filter(OPS[leaf.op](F.col("n"), F.lit(leaf.value))).select("id")
        all_ = _ids(b.everyone, b.everyone.columns[0]).distinct()
        n = F.coalesce("n", F.lit(0))
        return all_.join(counts, "id", "left").filter(OPS[leaf.op](n, F.lit(leaf.value))).select("id")

    return make


LEAVES: dict[str, Callable[[Builder, Leaf], DataFrame]] = {"campaign": _campaign, "mediaDomain": _domain, "clickCount": _times("clicks"), "exposeCount": _times("impressions")}


# Merging audiences that exist


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all audiences."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def intersect_all(frames: list[DataFrame]) -> DataFrame:
    """Ids that are in every audience, once each."""
    out = frames[0].distinct()
    for f in frames[1:]:
        out = out.join(f, list(out.columns), "left_semi")
    return out


def except_all(frames: list[DataFrame]) -> DataFrame:
    """Ids of the first audience that are in no other (an extension)."""
    out = frames[0].distinct()
    for f in frames[1:]:
        out = out.join(f, list(out.columns), "left_anti")
    return out


def save_audience(ids: DataFrame, table: str) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS ... AS: a table that exists is reused."""
    spark = ids.sparkSession
    if not spark.catalog.tableExists(table):
        ids.write.format("parquet").mode("ignore").saveAsTable(table)
    return spark.table(table)


def table_count(df: DataFrame, empty_ok: bool = False) -> int:
    n = df.count()
    if not n and not empty_ok:
        raise AudienceError("the table has no rows")
    return n


def stage_name(tag: int, suppliers: list[int], etype: int, dates: tuple[str, str], rule: dict, prefix: str = "dmpstage") -> str:
    """A name that depends on nothing but what the audience is made from."""
    sid = hashlib.md5(",".join(map(str, sorted(suppliers))).encode()).hexdigest()[:8]
    return f"{prefix}.tag_{tag}_sid_{sid}_type_{etype}_date_{dates[0]}_{dates[1]}_hash_{rule_hash(tree(rule))}"


def supplier_accounts(ids: list[int], suppliers: DataFrame, id_col: str = "id", account_col: str = "account_id") -> list[int]:
    """Account ids of suppliers; all must be known."""
    rows = suppliers.filter(F.col(id_col).isin(list(set(ids)))).select(id_col, account_col).distinct().collect()
    if len({r[0] for r in rows}) != len(set(ids)):
        raise AudienceError("unknown suppliers")
    return sorted(r[1] for r in rows)


TYPES = {"pc": PC, "1": PC, "mob": MOBILE, "mobile": MOBILE, "2": MOBILE}


def etype_of(text: str) -> int:
    try:
        return TYPES[str(text).strip().lower()]
    except KeyError:
        raise AudienceError(f"unknown type {text}") from None
