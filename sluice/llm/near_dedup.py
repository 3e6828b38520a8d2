"""MinHash near-dedup with DartMinHash signatures.

A text is a bag of word shingles: a region of the plane for each shingle, as wide as its count.
Hashed darts hit unit cells of (shingle, weight) x rank, Poisson(1) in each; a text catches those
that fall inside its regions. Each dart names a signature coordinate, and the text keeps its
earliest dart per coordinate. Only ranks up to (k ln k + 2k) / weight are looked at, which gives
about that many darts whatever the text's size; if a coordinate stays empty, twice the rank is.
Two texts agree in a coordinate with probability equal to their weighted Jaccard similarity.

Bands of coordinates give buckets. Equal texts count once. Every bucket first links its members
to its leader, checked on the shingles themselves. What a leader doesn't explain is compared with
the rest of its bucket in tiles of bounded size, so no link inside a bucket is lost and no pairs
are emitted but links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import P, hot_bound, materialize, spread_join
from .components import components

BANDS, ROWS = 25, 5
K = BANDS * ROWS
TILE = 384
#: Members of a bucket, or texts with one leader, that one task takes.
HOT = 1 << 14
_U = np.uint64
_CELL, _DART, _TIMES = _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB), _U(0x8EBC6AF09C88C6E3)
_RANK_BITS = 44
#: A dart count for a uniform number: cumulative Poisson(1).
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(14)])
_POISSON64 = (np.minimum(_POISSON, 1 - 2**-40) * 2.0**64).astype(np.uint64)


def strips(h: np.ndarray, first: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(strip, text number): a value for each occurrence of each shingle, so that bags of
    shingles become sets. A text of fewer words than a shingle is one shingle."""
    size = np.diff(first)
    g = tn.grams(h, shingle)
    ok = tn.gram_rows(first, shingle, len(g))
    g, row = g[ok], tn.text_of(first, len(g))[ok]
    short = np.flatnonzero((size > 0) & (size < shingle))
    if len(short):
        extra = np.array([tn.grams(h[first[r] : first[r + 1]], int(size[r]))[0] for r in short], np.uint64)
        g, row = np.concatenate([g, extra]), np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        g, row = g[order], row[order]
    own = tn.mix(g + row.astype(np.uint64) * _TIMES)
    order = np.argsort(own, kind="stable")
    seen = own[order]
    new = np.ones(len(seen), bool)
    new[1:] = seen[1:] != seen[:-1]
    begin = np.flatnonzero(new)
    again = np.empty(len(g), np.int64)
    again[order] = np.arange(len(g)) - np.repeat(begin, np.diff(np.append(begin, len(g))))
    return np.where(again == 0, g, tn.mix(g + again.astype(np.uint64) * _TIMES)), row


def dart_signatures(strip: np.ndarray, row: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """(n, k) ranks of the earliest dart per coordinate. strip: unit-width regions; row: theirs
    in ascending order. Texts without strips get the largest value everywhere."""
    none = np.iinfo(np.uint64).max
    best = np.full(n * k, none, np.uint64)
    weight = np.bincount(row, minlength=n)
    todo, darts = np.flatnonzero(weight), k * (math.log(k) + 2)
    while len(todo):
        mark = np.zeros(n, bool)
        mark[todo] = True
        use = np.flatnonzero(mark[row])
        limit = darts / np.maximum(weight, 1)
        cells = np.ceil(limit).astype(np.int64)
        upto = np.cumsum(cells[row[use]])
        start = 0
        while start < len(use):  # about a million cells at a time
            base = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, base + (1 << 19), "right")))
            some = use[start:end]
            times = cells[row[some]]
            at = np.repeat(np.arange(len(some)), times)
            cell = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            r = row[some][at]
            seed = tn.mix(strip[some][at] + cell.astype(np.uint64) * _CELL)
            count = np.searchsorted(_POISSON64, seed, "right")
            top = (limit * (1 << _RANK_BITS)).astype(np.uint64)[r]
            rank0 = cell.astype(np.uint64) << _U(_RANK_BITS)
            d = 0
            while len(seed):
                here = count > d
                seed, count, top, rank0, r = seed[here], count[here], top[here], rank0[here], r[here]
                dart = tn.mix(seed + _U((d + 1) * int(_DART) % 2**64))
                rank = rank0 + (dart >> _U(64 - _RANK_BITS))
                ok = rank < top
                coordinate = (dart[ok] & _U((1 << 20) - 1)) % _U(k)
                np.minimum.at(best, r[ok] * k + coordinate.astype(np.int64), rank[ok])
                d += 1
            start = end
        empty = (best.reshape(n, k) == none).any(1)
        todo = todo[empty[todo]]
        best.reshape(n, k)[todo] = none
        darts *= 2
    return best.reshape(n, k)


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(texts, bands) keys; the band's number is part of its key."""
    n, k = signature.shape
    parts = signature.reshape(n, k // rows, rows)
    key = np.broadcast_to(np.arange(k // rows, dtype=np.uint64) + _U(1), (n, k // rows)).copy()
    for j in range(rows):
        key = key * tn.GRAM + parts[:, :, j]
    return tn.mix(key.ravel()).reshape(n, k // rows).view(np.int64)


def _hashed(column: pa.Array):
    for row0, data, at in tn.slices(column):
        data = tn.LOWERED[data]
        starts, ends, first = tn.words(data, at)
        yield row0, tn.span_hash(data, starts, ends), first


def _prints(h: np.ndarray, first: np.ndarray) -> list[bytes]:
    """128 bits of each text's words, in their order."""
    place = np.arange(len(h), dtype=np.uint64) - np.repeat(first[:-1], np.diff(first)).astype(np.uint64)
    out = []
    for salt in (_CELL, _DART):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(tn.mix(h + place * salt), out=total[1:])
        out.append(tn.mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)))
    return [r.tobytes() for r in np.stack(out, 1)]


def _signed(shingle: int):
    def run(batches):
        for batch in batches:
            for row0, h, first in _hashed(batch.column(1)):
                n = len(first) - 1
                strip, row = strips(h, first, shingle)
                keys = bands(dart_signatures(strip, row, n))
                has = np.diff(first) > 0
                listed = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(has * keys.shape[1])]).astype(np.int32), pa.array(keys[has].ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row0, n), pa.array(_prints(h, first), pa.binary()), listed], names=["id", "print", "bands"])

    return run


def _shingled(shingle: int):
    """(node, set) of the rows (text, print) whose words have that print."""

    def run(batches):
        for batch in batches:
            for row0, h, first in _hashed(batch.column(0)):
                n = len(first) - 1
                strip, row = strips(h, first, shingle)
                at = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
                node = batch.column(1).slice(row0, n)
                same = pa.array([x == y for x, y in zip(_prints(h, first), node.to_pylist(), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([node, pa.ListArray.from_arrays(at, pa.array(strip.view(np.int64), pa.int64()))], names=["node", "set"]).filter(same)

    return run


def _similarity(a, b):
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def _tile_links(threshold: float):
    """In one tile: links between its members that join different classes, as a forest."""

    def run(table: pa.Table) -> pa.Table:
        node = table["node"].to_pylist()
        # Classes as numbers of this tile.
        cls = table["class"].combine_chunks().dictionary_encode().indices.to_numpy()
        lists = table["set"].combine_chunks()
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        _, value = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        size = np.diff(offsets)
        outside = np.flatnonzero(table["outside"].to_numpy(zero_copy_only=False))
        root = {c: c for c in set(cls.tolist())}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        order = np.argsort(value, kind="stable")
        owner = np.repeat(np.arange(len(node)), size)[order]
        cut = np.searchsorted(value[order], np.arange(value.max() + 2 if len(value) else 1))
        for o in outside.tolist():
            mine = value[offsets[o] : offsets[o + 1]]
            met = np.concatenate([owner[cut[v] : cut[v + 1]] for v in mine.tolist()]) if len(mine) else np.zeros(0, np.int64)
            both = np.bincount(met, minlength=len(node))
            like = both >= threshold * (size + size[o] - both) - 1e-9
            for m in np.flatnonzero(like & (cls != cls[o])).tolist():
                x, y = find(int(cls[o])), find(int(cls[m]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((node[o], node[m]))
        return pa.table({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})

    return run


def classes(docs: DataFrame, threshold: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col and class_id, the least id of its class.

    Texts whose bags of `shingle` lower-cased words have a weighted Jaccard similarity of at
    least threshold are linked (if they share a bucket: 0.99995 at 0.8 and more above); classes
    are connected components. Texts with the same words are one class, and so are all texts
    without words (null, empty or blank) and all rows with one id. Null ids get a null class.
    Ids are whole numbers. A node is a print: 128 bits of a text's words.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = slim.filter(F.col("id").isNotNull())
    signed = materialize(known.mapInArrow(_signed(shingle), "id long, print binary, bands array<long>"))
    hot_rows = hot_bound(signed.count() * BANDS, HOT)
    hot = lambda counted, key: counted.filter(F.col("n") > hot_rows).select(key, "n")
    first = materialize(signed.groupBy(F.col("print").alias("node")).agg(F.min("id").alias("id")))
    # One row for each print; its bands follow from it.
    keys = signed.groupBy(F.col("print").alias("node")).agg(F.first("bands").alias("bands")).select("node", F.explode("bands").alias("key"))
    # The leader: least by a hash that all bands share, so that a group has few leaders.
    lead = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("node").alias("h"), "node"))["node"].alias("leader")).filter("n > 1")
    lead = materialize(lead)
    bucket = materialize(spread_join(keys, lead, "key", hot(lead, "key"), "node"))
    near = materialize(bucket.filter("node <> leader").select("node", "leader").distinct())
    wanted = first.join(bucket.select("node").distinct(), "node").select("id", "node")
    texts = known.join(wanted, "id").withColumn("h", F.xxhash64("text")).dropDuplicates(["id", "node", "h"]).select("text", "node")
    sets = materialize(texts.mapInArrow(_shingled(shingle), "node binary, set array<long>"))
    followers = near.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    led = near.join(sets, "node").withColumnRenamed("set", "mine")
    pairs = spread_join(led, sets.select(F.col("node").alias("leader"), "set"), "leader", hot(followers, "leader"), "node")
    checked = materialize(pairs.select("node", "leader", (_similarity("mine", "set") >= threshold).alias("like")))
    links = checked.filter("like").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    label = components(links)
    # Members that aren't in their leader's class, against all of their bucket.
    named = bucket.filter("n > 2").join(label, "node", "left").withColumn("class", F.coalesce("root", "node")).select("key", "n", "node", "leader", "class")
    main = lead.filter("n > 2").select("key", "leader").join(label.select(F.col("node").alias("leader"), F.col("root").alias("main")), "leader", "left").select("key", F.coalesce("main", "leader").alias("main"))
    # Written, as it is read for three ends: else the plan would hold all of this as often.
    named = materialize(spread_join(named, main, "key", hot(lead, "key"), "node").withColumn("outside", F.col("class") != F.col("main")).drop("main", "leader"))
    open_ = named.groupBy("key").agg(F.sum(F.col("outside").cast("int")).alias("o")).filter("o > 0")
    named = materialize(spread_join(named, open_, "key", hot(lead, "key"), "node")).withColumns({"tiles": F.ceil(F.col("n") / TILE), "rows": F.ceil(F.col("o") / TILE)})
    spot = F.pmod(F.xxhash64("node"), F.col("tiles")), F.pmod(F.xxhash64("node", F.lit(1)), F.col("rows"))
    # Each member meets every part of the outsiders; each outsider goes to every part of the members.
    as_member = named.select("key", "node", "class", F.lit(False).alias("outside"), spot[0].alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("j"))
    as_outside = named.filter("outside").select("key", "node", "class", F.lit(True).alias("outside"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("i"), spot[1].alias("j"))
    placed = as_member.union(as_outside).join(sets, "node")
    more = placed.groupBy("key", "i", "j").applyInArrow(_tile_links(threshold), "a binary, b binary")
    # Rows with one id and different words, too, are one class.
    member = signed.select("id", F.col("print").alias("node")).distinct()
    several = member.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z")
    same = member.join(several, "id").filter("node <> a").select("a", F.col("node").alias("b"))
    final = components(links.union(more).union(same))
    # A class is called by its least id.
    rooted = materialize(first.join(final, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root")))
    called = materialize(rooted.groupBy("root").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    class_of = materialize(spread_join(rooted.select("node", "root"), called.drop("n"), "root", hot(called, "root"), "node").select("node", "class_id"))
    own, ids = f"{P}node", f"{P}id"
    # Alone in its class: its own least id. Rows with one id have one class.
    named_ids = member.join(class_of, "node", "left").join(first.select("node", F.col("id").alias("alone")), "node").groupBy(F.col("id").alias(ids)).agg(F.min(F.coalesce("class_id", "alone")).alias("class_id"))
    return docs.select(F.col(id_col)).join(named_ids, F.col(id_col).cast("long") == F.col(ids), "left").select(id_col, "class_id")


def dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay: of each class one row with the least id (of rows with that id
    the one whose columns have the least hash). Rows with a null id stay."""
    id_col = options.get("id_col", "doc_id")
    stays = materialize(classes(docs, **options).filter(F.col("class_id").isNotNull()).select(F.col("class_id").alias(f"{P}id")).distinct())
    kept = docs.join(stays, F.col(id_col).cast("long") == F.col(f"{P}id"), "left_semi")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = kept.groupBy(F.col(id_col).alias(f"{P}id")).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias(f"{P}row")).select(f"{P}row.*")
    return one.unionByName(docs.filter(F.col(id_col).isNull()))
