"""Mixing sources to target weights by capped water-filling, on DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import P, materialize, words_in

BITS = 12  # of the sampling priority, for each step of the search for a source's threshold


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """sources: (source, size, weight). Adds target: size-capped shares of share * all sizes.

    With level L, a source gets min(max_epochs * size, L * weight), and L is such that all
    targets add up to the total. Sources reach their cap in the order of cap / weight, so the
    running sums in that order give L at once: the level after the last source that is capped.
    From there on levels only fall, so it is the greatest level that fits its own source. One row per source; only those rows are ordered here.
    """
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = sources.withColumn("cap", F.lit(max_epochs) * F.col("size"))
    s = s.withColumns({
        "total": F.lit(share) * F.sum("size").over(every),
        "capped": F.coalesce(F.sum("cap").over(upto), F.lit(0.0)),
        "rest": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0)),
    })
    s = s.withColumn("level", (F.col("total") - F.col("capped")) / F.col("rest"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    s = s.withColumn("level", F.max(fits).over(every))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return s.select("source", "size", "weight", target.cast("double").alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of docs: its columns, size (words), source_size, target (its source's)
    and repeats (how often the mix takes the row; taken words are repeats * size).

    Sources by code point, null last, take the weights in turn. A source with target t and
    size s takes floor(t / s) whole repetitions of each row, and the rest of t from rows of
    least seeded priority: those below a threshold, which is the row boundary whose running
    size is nearest the rest. Rows that agree in id and text have one priority and are taken
    together. Null text has size 0; null ids are one id; an empty table gives an empty one.
    Columns of docs named like a new column are replaced.
    """
    src, size, u, fill = f"{P}source", f"{P}size", f"{P}u", f"{P}null"
    priority = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))), 64 - 5 * BITS)
    keyed = docs.withColumns({src: F.coalesce(F.col(source_col), F.lit("")), fill: F.col(source_col).isNull(), size: words_in(F.col(text_col)), u: priority})
    key = [fill, src]
    slim = materialize(keyed.select(*key, size, u))
    # One row per source and slice of the priority: hot sources are summed before they move.
    first = slim.groupBy(*key, F.shiftright(u, 4 * BITS).alias("d")).agg(F.sum(size).alias("n"))
    first = materialize(first)
    sources = first.groupBy(*key).agg(F.sum("n").alias("size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(fill, src)) - 1, F.lit(len(weights)))
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1)).withColumn("source", F.struct(*key))
    targets = materialize(water_fill(sources, share, max_epochs).select("source.*", F.col("size").alias(f"{P}all"), F.col("target").alias(f"{P}target")))
    whole = F.when(F.col(f"{P}all") > 0, F.floor(F.col(f"{P}target") / F.col(f"{P}all"))).otherwise(F.lit(0))
    goal = targets.select(*key, (F.col(f"{P}target") - whole * F.col(f"{P}all")).alias("goal"), F.lit(0).cast("long").alias("prefix"))
    # Find the slice of the priority that holds each source's threshold, then slice that one.
    hist = first
    for step in range(4):
        shift = BITS * (4 - step)
        if step:
            inside = slim.join(goal.select(*key, "prefix"), key).filter(F.shiftright(u, shift + BITS) == F.col("prefix"))
            hist = inside.groupBy(*key, F.shiftright(u, shift).alias("d")).agg(F.sum(size).alias("n"))
        run = Window.partitionBy(*key).orderBy("d")  # at most 2**BITS rows a source
        cum = hist.withColumn("upto", F.sum("n").over(run))
        hit = cum.join(goal.select(*key, "goal"), key).filter(F.col("upto") >= F.col("goal"))
        best = hit.groupBy(*key).agg(F.min(F.struct("d", "n", "upto", "goal")).alias("b"))
        goal = materialize(best.select(*key, (F.col("b.goal") - (F.col("b.upto") - F.col("b.n"))).alias("goal"), F.col("b.d").alias("prefix")))
    # Each source's last slice holds a handful of rows at any input: 2**-48 of them.
    inside = slim.join(goal, key).filter(F.shiftright(u, BITS) == F.col("prefix"))
    ties = inside.groupBy(*key, u, "goal").agg(F.sum(size).alias("n"))
    ties = ties.withColumn("upto", F.sum("n").over(Window.partitionBy(*key).orderBy(u)))
    mids = ties.withColumn("in", (F.col("goal") > 0) & (F.col("upto") - F.col("n") / 2 <= F.col("goal")))
    # The threshold: the last priority taken, or just below the first of the slice.
    cut = mids.groupBy(*key).agg(F.coalesce(F.max(F.when(F.col("in"), F.col(u))), F.min(u) - 1).alias(f"{P}cut"))
    params = materialize(targets.join(cut, key, "left").withColumn(f"{P}whole", whole.cast("int")))
    out = keyed.join(params, key)
    extra = F.when(F.col(u) <= F.col(f"{P}cut"), 1).otherwise(0)
    new = ("size", "source_size", "target", "repeats")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new], F.col(size).alias("size"), F.col(f"{P}all").alias("source_size"), F.col(f"{P}target").alias("target"), (F.col(f"{P}whole") + extra).cast("int").alias("repeats"))


def repeat(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of docs, each row as often as mix() takes it."""
    times = f"{P}times"
    out = mix(docs, **options).withColumnRenamed("repeats", times).filter(F.col(times) > 0)
    return out.withColumn(times, F.explode(F.sequence(F.lit(1), times))).select(*[F.col(f"`{c}`") for c in docs.columns])
