"""Sets in arrays, and access rights on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_flat(lists: Column) -> Column:
    """Elements of nested arrays, once each, first seen first."""
    return F.array_distinct(F.flatten(lists))


def has_all(owned: Column, asked: Column) -> Column:
    return F.size(F.array_except(asked, owned)) == 0


def has_any(owned: Column, asked: Column, as_before: bool = False) -> Column:
    """as_before: false if more is asked than owned, whatever they share."""
    found = F.coalesce(F.arrays_overlap(owned, asked), F.lit(False))
    return found & (F.size(asked) <= F.size(owned)) if as_before else found


def user_functions(users: DataFrame, roles: DataFrame, functions: DataFrame) -> DataFrame:
    """(user_id, paths): what users may do by their roles and by their own permissions.

    users: user_id, role_ids, function_ids; roles: role_id, function_ids, deleted; functions:
    function_id, path, deleted. Deleted roles and functions grant nothing.
    """
    live = lambda df: df.filter(~F.coalesce("deleted", F.lit(False)))
    by_role = users.select("user_id", F.explode("role_ids").alias("role_id")).join(live(roles), "role_id").select("user_id", F.explode("function_ids").alias("function_id"))
    own = users.select("user_id", F.explode("function_ids").alias("function_id"))
    paths = by_role.union(own).distinct().join(live(functions), "function_id")
    have = paths.groupBy("user_id").agg(F.array_sort(F.collect_set("path")).alias("paths"))
    return users.select("user_id").join(have, "user_id", "left").select("user_id", F.coalesce("paths", F.array().cast("array<string>")).alias("paths"))
