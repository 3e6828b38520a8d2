"""Set algebra of audiences on bitmaps.

Ids get dense numbers once (a table that is kept). Then an audience is a bit for each number, and a
whole tree of and, or and except is one expression on words of 64 bits: all leaves go through one
exchange together, each id as one bit, combined in the tasks that read them. Audiences that are kept
are bitmaps of 32,768 bits by bucket, which combine and count without their ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from .audience import AudienceError, Both, Builder, Leaf, tree

WORD, LEAF = "__word", "__leaf"


def number_ids(ids: DataFrame, path: str) -> DataFrame:
    """(id, n): each distinct id with a number from 0 on, without gaps; a table at path. Null has none."""
    numbered(ids.select(F.col(ids.columns[0]).cast("string").alias("id")).filter("id is not null").distinct(), "n").write.parquet(path)
    return ids.sparkSession.read.parquet(path)


def add_ids(ids: DataFrame, numbers: DataFrame, path: str) -> DataFrame:
    """numbers and, after them, those of ids that it doesn't hold; a table at path."""
    start = numbers.agg(F.coalesce(F.max("n") + 1, F.lit(0))).first()[0]
    new = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).filter("id is not null").distinct().join(numbers, "id", "left_anti")
    numbers.unionByName(numbered(new, "n", start)).write.parquet(path)
    return ids.sparkSession.read.parquet(path)


def words(leaves: list[DataFrame], numbers: DataFrame) -> DataFrame:
    """(__word, l0, l1, ...): for each 64 numbers a word of bits a leaf. Ids without a number are an error."""
    every = None
    for k, leaf in enumerate(leaves):
        one = leaf.select(F.col(leaf.columns[0]).cast("string").alias("id"), F.lit(k).alias(LEAF)).filter("id is not null")
        every = one if every is None else every.unionByName(one)
    known = every.join(numbers, "id", "left")
    n = F.coalesce("n", F.raise_error(F.concat(F.lit("id without a number: "), "id")).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__n").bitwiseAND(63).cast("int"))
    each = [F.coalesce(F.bit_or(F.when(F.col(LEAF) == k, bit)), F.lit(0).cast("long")).alias(f"l{k}") for k in range(len(leaves))]
    return known.select(n.alias("__n"), LEAF).withColumn(WORD, F.shiftright("__n", 6)).groupBy(WORD).agg(*each)


def members(bits: DataFrame, numbers: DataFrame) -> DataFrame:
    """(id): the ids of (__word, bits)."""
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit("bits", b) == 1)
    n = bits.select(WORD, F.explode(places).alias("__bit")).select((F.col(WORD) * 64 + F.col("__bit")).alias("n"))
    return n.join(numbers, "n").select("id")


def tree_bits(builder: Builder, data: dict | Leaf | Both, numbers: DataFrame) -> DataFrame:
    """(__word, bits) of a tree of rules, all of whose leaves are read side by side. Words without a
    bit are left out."""
    leaves: dict[Leaf, int] = {}

    def expression(node: Leaf | Both, open_: tuple) -> Column:
        if isinstance(node, Both):
            if not node.parts:
                raise AudienceError(f"{node.op} of nothing")
            parts, op = [expression(p, open_) for p in node.parts], node.op
        elif node.key == "tag":
            parts, op = [expression(t, (*open_, i)) for i, t in builder.referred(node, open_)], "$or"
        else:
            return F.col(f"l{leaves.setdefault(node, len(leaves))}")
        out = parts[0]
        for p in parts[1:]:
            out = out.bitwiseAND(p) if op == "$and" else out.bitwiseOR(p)
        return out

    bits = expression(tree(data) if isinstance(data, dict) else data, ())
    frames = [builder.leaf(leaf) for leaf in leaves]
    return words(frames, numbers).select(WORD, bits.alias("bits")).filter("bits <> 0")


def merged_bits(op: str, frames: list[DataFrame], numbers: DataFrame) -> DataFrame:
    """(__word, bits) of the first of some audiences $and, $or or $except all others."""
    columns = [F.col(f"l{k}") for k in range(len(frames))]
    bits = columns[0]
    for c in columns[1:]:
        bits = {"$and": bits.bitwiseAND(c), "$or": bits.bitwiseOR(c), "$except": bits.bitwiseAND(F.bitwise_not(c))}[op]
    return words(frames, numbers).select(WORD, bits.alias("bits")).filter("bits <> 0")


def size(bits: DataFrame) -> DataFrame:
    return bits.agg(F.coalesce(F.sum(F.bit_count("bits").cast("long")), F.lit(0)).alias("cnt"))


# Bitmaps that are kept


def bitmaps(audiences: DataFrame, name: str, id_col: str, numbers: DataFrame) -> DataFrame:
    """(name, bucket, bits): a bitmap for each audience in column `name` and each 32,768 numbers."""
    known = audiences.select(name, F.col(id_col).cast("string").alias("id")).join(numbers, "id")
    by = [name, F.bitmap_bucket_number("n").alias("bucket")]
    return known.groupBy(*by).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))


def combined(maps: DataFrame, name: str, audiences: list, op: str) -> DataFrame:
    """(bucket, bits): some of the kept audiences $and-ed or $or-ed, bucket by bucket."""
    some = maps.filter(F.col(name).isin(audiences)).groupBy("bucket")
    if op == "$or":
        return some.agg(F.bitmap_or_agg("bits").alias("bits"))
    every = some.agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("__held"))
    return every.filter(F.col("__held") == len(set(audiences))).drop("__held")


def kept_size(maps: DataFrame, *by: str) -> DataFrame:
    return maps.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("cnt"))
