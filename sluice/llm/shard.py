"""Sharding by histogram sort, on DataFrame functions alone.

The key of a row is (hash of its text, hash of its id), so equal texts are neighbours in key
order. Splitters between shards are found by counting exact bytes below candidate keys: a
radix histogram over the next `BITS` bits, taken only inside the cells that still hold a
splitter, until each splitter is within tolerance of its target. Then rows move once.

A group of equal texts is cut only if its nearer edge is more than three tolerances away, so
a hot group spreads over several shards instead of making one of them too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import P, materialize

BITS = 10
LEVELS = 6  # of BITS bits each, for either half of the key
HALF = BITS * LEVELS
#: Tolerances that the edge of a group of equal texts may be from a boundary that spares the group.
GROUP = 3


def _key(col: Column) -> Column:
    """The upper HALF bits of a 64-bit hash, as a number that isn't negative."""
    return F.shiftrightunsigned(F.xxhash64(col), 64 - HALF)


def splitters(rows: DataFrame, size: str, k1: str, k2: str, n_shards: int, tolerance: float) -> list[tuple[int, int]]:
    """Keys (k1, k2) at which shards 1, 2, ... begin. Nothing but counts of at most
    (n_shards - 1) * 2**BITS cells comes to the driver in a round."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    slack, group_slack = tolerance * total / n_shards, GROUP * tolerance * total / n_shards
    goals = {s: total * s / n_shards for s in range(1, n_shards)}
    done: dict[int, tuple[int, int]] = {}
    # Per open splitter: the depth and key prefix of its cell, and exact bytes below that cell.
    open_: dict[int, tuple[int, int, float]] = {s: (0, 0, 0) for s in goals}
    while open_:
        level = min(at for at, _, _ in open_.values())
        half, depth = divmod(level, LEVELS)
        shift = HALF - BITS * (depth + 1)
        key = F.col(k2 if half else k1)
        digit = F.shiftright(key, shift).bitwiseAND(F.lit((1 << BITS) - 1))
        if level == 0:
            cell = F.lit(0)
        elif half == 0:
            cell = F.shiftright(F.col(k1), shift + BITS)
        else:
            cell = F.concat_ws("_", F.col(k1), F.shiftright(F.col(k2), shift + BITS) if depth else F.lit(0))
        here = {s: (prefix, below) for s, (at, prefix, below) in open_.items() if at == level}
        names = {prefix: prefix if half == 0 else f"{prefix >> (BITS * depth)}_{prefix & ((1 << BITS * depth) - 1)}" for prefix, _ in here.values()}
        counts: dict = {}
        of = rows.select(cell.alias("cell"), digit.alias("digit"), key.alias("key"), F.col(size).alias("size")).filter(F.col("cell").isin(list(names.values())))
        for r in of.groupBy("cell", "digit").agg(F.sum("size").alias("n"), F.min("key").alias("a"), F.max("key").alias("b"), F.count(F.lit(1)).alias("rows")).collect():
            counts.setdefault(r["cell"], []).append((r["digit"], r["n"], r["a"], r["b"], r["rows"]))
        for s, (prefix, below) in here.items():
            at, best = below, None
            for d, n, least, most, alone in sorted(counts.get(names[prefix], [])):
                if at + n >= goals[s]:
                    best = (d, at, at + n, least, most, alone)
                    break
                at += n
            if best is None:  # only by rounding of the last goal
                best = ((1 << BITS) - 1, at, at, 0, 1, 1)
            d, lo, hi, least, most, alone = best
            deeper, next_level = (prefix << BITS) | d, level + 1
            at_lo, at_hi = goals[s] - lo, hi - goals[s]
            one_key = least == most and alone > 1
            if one_key:  # nothing to gain from the rest of this half
                rest = BITS * (LEVELS - 1 - depth)
                deeper, next_level = (deeper << rest) | (least & ((1 << rest) - 1)), (half + 1) * LEVELS
            near = min(at_lo, at_hi)
            # One row can't be cut, nor can rows that agree in both keys; one text is cut only if it must be.
            if near <= slack or alone == 1 or next_level == 2 * LEVELS or (half == 0 and next_level == LEVELS and near <= group_slack):
                cut = (deeper if at_lo <= at_hi else deeper + 1) << (BITS * (2 * LEVELS - next_level))
                done[s] = (cut >> HALF, cut & ((1 << HALF) - 1))
                del open_[s]
            else:
                open_[s] = (next_level, deeper, lo)
    return [done[s] for s in sorted(done)]


def shard(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16, tolerance: float = 0.01, cells: int = 256) -> DataFrame:
    """All rows and columns of docs, with size (UTF-8 bytes of the text plus overhead),
    shard (0 .. n_shards-1, near equal in bytes) and slot (0, 1, ... in each shard).

    Null text counts as empty; null ids are one id. Repeated rows are rows of their own and
    are placed next to each other. With no rows there are no shards. Columns of docs named
    size, shard or slot are replaced.
    tolerance: how far a boundary may be from its target, as a part of a shard's bytes.
    cells: a shard's slots are dealt out in so many hash cells, so no task orders a whole shard.
    """
    k1, k2, n = f"{P}k1", f"{P}k2", f"{P}size"
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({n: (F.octet_length(text) + overhead).cast("long"), k1: _key(text), k2: _key(F.col(id_col))})
    slim = materialize(keyed.select(n, k1, k2))
    bounds = splitters(slim, n, k1, k2, n_shards, tolerance)
    a, b = F.col(k1), F.col(k2)
    at = F.lit(0)
    for x, y in bounds:
        at = at + F.when((a > F.lit(x)) | ((a == F.lit(x)) & (b >= F.lit(y))), 1).otherwise(0)
    shard_, cell, base = f"{P}shard", f"{P}cell", f"{P}base"
    in_cell = F.pmod(F.xxhash64(b, a), F.lit(cells)).cast("int")
    # At most n_shards * cells rows: a proven bound for the broadcast.
    counts = slim.select(at.alias(shard_), in_cell.alias(cell)).groupBy(shard_, cell).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(shard_).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard_, cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(base))
    ranked = (
        keyed.withColumns({shard_: at, cell: in_cell})
        .withColumn(f"{P}rank", F.row_number().over(Window.partitionBy(shard_, cell).orderBy(k1, k2, F.col(id_col))))
        .join(F.broadcast(offsets), [shard_, cell])
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("size", "shard", "slot")]
    return ranked.select(*kept, F.col(n).alias("size"), F.col(shard_).cast("int").alias("shard"), (F.col(base) + F.col(f"{P}rank") - 1).cast("long").alias("slot"))
