"""Benchmark decontamination by winnowing.

Of each `window - GRAM_WORDS + 1` neighbouring word grams of a text the least hash is a fingerprint,
so two texts that share a window share a fingerprint inside it. Fingerprints of documents are
joined with those of the benchmark; where one is met, the windows around it are joined with the
benchmark's windows by hash and compared word by word, and hits grow into spans of words.

What a text hits depends on the text alone, so hits are kept by text, and documents join them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import P, hot_bound, materialize, spread_join

GRAM_WORDS = 5
#: Bits of the sieve of benchmark fingerprints that tasks get, for full and for short windows: 2 to the
#: power of these at most (16 MB, and 1 MB for each length). It only keeps most documents'
#: fingerprints out of the join; a benchmark that fills it makes the join larger, not the result.
SIEVE_BITS = 27, 23
#: Documents with one window above which its join is dealt over several tasks.
HOT = 1 << 14
SPANS, ITEMS, WORDS = f"{P}spans", f"{P}items", f"{P}words"
KEYS = [f"{P}text1", f"{P}text2"]
_SPAN = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _tokens(column: pa.Array):
    for row0, data, at in tn.slices(column):
        data = tn.LOWERED[data]
        starts, ends, first = tn.words(data, at, tn.ALNUM)
        yield row0, data, starts, ends, first, tn.span_hash(data, starts, ends)


def _window_hash(h: np.ndarray, s: np.ndarray, n: int) -> np.ndarray:
    w = h[s].copy()
    for j in range(1, n):
        w = w * tn.GRAM + h[s + j]
    return tn.mix(w + np.uint64(n))


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, s: int, n: int) -> bytes:
    return b" ".join([data[a:b].tobytes() for a, b in zip(starts[s : s + n].tolist(), ends[s : s + n].tolist(), strict=True)])


def _prints(h: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the fingerprints."""
    g = tn.grams(h, GRAM_WORDS)
    at = np.flatnonzero(tn.chosen(g, window - GRAM_WORDS + 1) & tn.gram_rows(first, GRAM_WORDS, len(g)))
    return g[at], at


def _item_windows(window: int):
    """(item, n, hash, words): each item's windows of n words; for a short item all its words."""

    def run(batches):
        for batch in batches:
            for row0, data, starts, ends, first, h in _tokens(batch.column(1)):
                size = np.diff(first)
                n = np.minimum(size, window)
                s = np.concatenate([np.arange(a, a + t - k + 1) for a, t, k in zip(first[:-1], size, n, strict=True) if k] or [np.zeros(0, np.int64)]).astype(np.int64)
                row = np.searchsorted(first, s, "right") - 1
                hashes = np.zeros(len(s), np.uint64)
                for k in np.unique(n[row]).tolist():
                    of = n[row] == k
                    hashes[of] = _window_hash(h, s[of], k)
                text = [_words(data, starts, ends, x, k) for x, k in zip(s.tolist(), n[row].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row0 + row)), pa.array(n[row].astype(np.int32)), pa.array(hashes.view(np.int64)), pa.array(text, pa.binary())], names=["item", "n", "hash", "words"])

    return run


def _item_prints(window: int):
    """(n, print): fingerprints of items of window words or more; of a short item, its n words' hash."""

    def run(batches):
        for batch in batches:
            for _, _, _, _, first, h in _tokens(batch.column(1)):
                size = np.diff(first)
                g, at = _prints(h, first, window)
                g = np.unique(g[size[np.searchsorted(first, at, "right") - 1] >= window])
                short = np.flatnonzero((size > 0) & (size < window))
                own = [int(_window_hash(h, first[[r]], int(size[r]))[0]) for r in short.tolist()]
                n = np.concatenate([np.full(len(g), window), size[short]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(np.concatenate([g, np.array(own, np.uint64)]).view(np.int64))], names=["n", "print"])

    return run


def _sieve(prints: DataFrame, window: int) -> dict[int, np.ndarray]:
    """{n: bits}: which hashes, by their low bits, may be prints for windows of n words."""
    size = {}
    for r in prints.groupBy("n").count().collect():  # `window` rows at most
        size[r["n"]] = 1 << max(10, min(SIEVE_BITS[r["n"] < window], (16 * r["count"]).bit_length()))
    if not size:
        return {}
    masks = F.create_map(*[F.lit(x) for n, bits in size.items() for x in (n, bits - 1)])
    low = F.col("print").bitwiseAND(F.element_at(masks, F.col("n")).cast("long"))
    # Distinct places, as bits of 64 together: a 64th of the sieve's bits at most.
    words = prints.select("n", F.shiftright(low, 6).cast("int").alias("at"), F.expr("shiftleft(1L, cast(print & 63 as int))").alias("bit"))
    rows = words.groupBy("n", "at").agg(F.bit_or("bit").alias("bits")).toArrow()
    n, at, bits = (rows[c].to_numpy() for c in ("n", "at", "bits"))
    out = {}
    for k, total in size.items():
        plane = np.zeros(total >> 6, np.int64)
        plane[at[n == k]] = bits[n == k]
        out[k] = plane.view(np.uint8)
    return out


def _sifted(plane: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & np.uint64(8 * len(plane) - 1)).astype(np.int64)
    return (plane[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _met(sieve, window: int):
    """(text1, text2, n, print, at): prints of the documents that pass the sieve, and their places.
    Equal prints of one text are one row."""

    def run(batches):
        planes = sieve.value
        for batch in batches:
            keys = [batch.column(i) for i in (0, 1)]
            for row0, _, _, _, first, h in _tokens(batch.column(2)):
                for n, plane in planes.items():
                    if n == window:
                        g, at = _prints(h, first, window)
                    else:
                        at = np.flatnonzero(tn.gram_rows(first, n, max(0, len(h) - n + 1)))
                        g = _window_hash(h, at, n)
                    ok = _sifted(plane, g)
                    g, at = g[ok], at[ok]
                    if not len(g):
                        continue
                    row = np.searchsorted(first, at, "right") - 1
                    order = np.lexsort((at, g, row))
                    g, at, row = g[order], at[order], row[order]
                    new = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (row[1:] != row[:-1])]))
                    lists = pa.ListArray.from_arrays(np.append(new, len(g)).astype(np.int32), pa.array((at - first[row]).astype(np.int32)))
                    where = pa.array(row0 + row[new])
                    yield pa.RecordBatch.from_arrays([keys[0].take(where), keys[1].take(where), pa.array(np.full(len(new), n, np.int32)), pa.array(g[new].view(np.int64)), lists], names=[*KEYS, "n", "print", "at"])

    return run


def _windows_around(window: int):
    """(text1, text2, n, hash, at, words): the windows that hold a print that was met, once for each
    different window of a text, with all its places. Rows: text1, text2, text, met (n, at)."""

    def run(batches):
        for batch in batches:
            met = batch.column(3)
            for row0, data, starts, ends, first, h in _tokens(batch.column(2)):
                for r in range(len(first) - 1):
                    a, b = int(first[r]), int(first[r + 1])
                    by_n: dict[int, list[int]] = {}
                    for m in met[row0 + r].as_py():
                        by_n.setdefault(m["n"], []).extend(m["at"])
                    for n, places in by_n.items():
                        at = np.array(places, np.int64)
                        if n == window:
                            at = np.unique((at[:, None] - np.arange(window - GRAM_WORDS + 1)).ravel())
                            at = at[(at >= 0) & (at + n <= b - a)]
                        if not len(at):
                            continue
                        w = _window_hash(h, a + at, n)
                        order = np.lexsort((at, w))
                        w, at = w[order], at[order]
                        new = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                        lists = pa.ListArray.from_arrays(np.append(new, len(w)).astype(np.int32), pa.array(at.astype(np.int32)))
                        text = [_words(data, starts, ends, a + x, n) for x in at[new].tolist()]
                        own = [pa.array([k[row0 + r].as_py()] * len(new), pa.int64()) for k in (batch.column(0), batch.column(1))]
                        yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(new), n, np.int32)), pa.array(w[new].view(np.int64)), lists, pa.array(text, pa.binary())], names=[*KEYS, "n", "hash", "at", "words"])

    return run


def _spans(table: pa.Table) -> pa.Table:
    """One text: the words inside its hits, as spans. Rows: text1, text2, n, at, items."""
    lengths, lists = table["n"].to_pylist(), table["at"]
    a = np.concatenate([x.values.to_numpy() for x in lists]).astype(np.int64)
    n = np.repeat(np.array(lengths, np.int64), [len(x) for x in lists])
    mask = np.zeros(int((a + n).max()) + 1, np.int64)
    np.add.at(mask, a, 1)
    np.subtract.at(mask, a + n, 1)
    spans = [{"a": int(x), "b": int(y)} for x, y in zip(*tn.runs(np.cumsum(mask) > 0), strict=True)]
    items = set().union(*table["items"].to_pylist())
    nameless = any(table["nameless"].to_pylist())
    return pa.table({**{k: table[k].slice(0, 1) for k in KEYS}, SPANS: pa.array([spans], _SPAN), ITEMS: pa.array([sorted(items) + [None] * nameless], pa.list_(pa.string()))})


def text_hits(texts: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """(text1, text2, __sl_spans, __sl_items) of the texts that hold a window of the benchmark.
    texts: (text1, text2, text), may repeat. benchmark: (item, text)."""
    spark = texts.sparkSession
    prints = materialize(benchmark.mapInArrow(_item_prints(window), "n int, print long").distinct())
    # Equal windows of the benchmark are one row; a window is of few items.
    windows = benchmark.mapInArrow(_item_windows(window), "item string, n int, hash long, words binary")
    windows = windows.groupBy("n", "hash", "words").agg(F.collect_set("item").alias("items"), F.max(F.col("item").isNull()).alias("nameless"))
    sieve = spark.sparkContext.broadcast(_sieve(prints, window))
    met = materialize(texts.mapInArrow(_met(sieve, window), f"{KEYS[0]} long, {KEYS[1]} long, n int, print long, at array<int>").distinct())
    many = met.groupBy("n", "print").agg(F.count(F.lit(1)).alias("c"))
    met = met.withColumn("key", F.struct("n", "print"))
    hot_rows = hot_bound(met.count(), HOT)
    hot = many.filter(F.col("c") > hot_rows).select(F.struct("n", "print").alias("key"), F.col("c").alias("n"))
    true = spread_join(met.drop("n", "print"), prints.select(F.struct("n", "print").alias("key")), "key", hot, KEYS[0])
    per_text = materialize(true.select(*KEYS, F.struct("key.n", "at").alias("m")).groupBy(*KEYS).agg(F.collect_list("m").alias("met")))
    once = texts.join(per_text, KEYS).dropDuplicates(KEYS).select(*KEYS, "text", "met")
    around = materialize(once.mapInArrow(_windows_around(window), f"{KEYS[0]} long, {KEYS[1]} long, n int, hash long, at array<int>, words binary"))
    around = around.withColumn("key", F.struct("n", "hash", "words"))
    often = around.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > hot_bound(around.count(), HOT)).select("key", F.col("c").alias("n"))
    hits = spread_join(around.drop("n", "hash", "words"), windows.select(F.struct("n", "hash", "words").alias("key"), "items", "nameless"), "key", often, KEYS[0])
    hits = hits.select(*KEYS, F.col("key.n").alias("n"), "at", "items", "nameless")
    return hits.groupBy(*KEYS).applyInArrow(_spans, f"{KEYS[0]} long, {KEYS[1]} long, {SPANS} array<struct<a:long,b:long>>, {ITEMS} array<string>")


def _counted(keep: int):
    """The kept columns, the keys, and the number of words."""

    def run(batches):
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            for row0, data, at in tn.slices(batch.column(keep)):
                first = tn.words(tn.LOWERED[data], at, tn.ALNUM)[2]
                n[row0 : row0 + len(at) - 1] = np.diff(first)
            names = [c for i, c in enumerate(batch.schema.names) if i != keep]
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != keep), pa.array(n)], names=[*names, WORDS])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", keep: list[str] | None = None, nameless: bool = False) -> DataFrame:
    """The kept columns of docs (all by default), one row per row, and __sl_words (number of
    words), __sl_spans (word ranges [a, b) inside occurrences of benchmark windows, apart from
    each other, ascending) and __sl_items (ids of those items as strings, sorted).

    A window is `window` neighbouring words of an item, or all words of a shorter item; an
    item without words or text has none. Nor has one without id, unless nameless: then its windows
    count, and __sl_items ends with one null for all such items. Null text has no words. Repeated
    rows are rows of their own; empty tables are fine. Texts are told apart by 128 bits.
    Only a sieve of fixed size goes to the driver and to tasks, whatever the benchmark's size.
    """
    keep = docs.columns if keep is None else keep
    keys = [F.xxhash64(*salt, F.col(text_col)).alias(k) for salt, k in zip(([], [F.lit(1)]), KEYS, strict=True)]
    texts = docs.filter(F.col(text_col).isNotNull()).select(*keys, F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text")).filter("text is not null" if nameless else "item is not null and text is not null")
    # Written, so that its size is known: a small table of hits is broadcast, not the documents shuffled.
    hits = materialize(text_hits(texts, items, window))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], *keys, F.coalesce(F.col(text_col), F.lit("")).alias(f"{P}text"))
    names = f"{schema}{', ' * bool(keep)}{KEYS[0]} long, {KEYS[1]} long, {WORDS} long"
    out = kept.mapInArrow(_counted(len(keep) + 2), names).join(hits, KEYS, "left")
    none = F.array().cast("array<struct<a:long,b:long>>"), F.array().cast("array<string>")
    return out.select(*[F.col(f"`{c}`") for c in keep], WORDS, F.coalesce(SPANS, none[0]).alias(SPANS), F.coalesce(ITEMS, none[1]).alias(ITEMS))


def hit_words() -> Column:
    """Number of words in the spans of contamination()."""
    return F.aggregate(SPANS, F.lit(0).cast("long"), lambda acc, s: acc + s["b"] - s["a"])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_share: float = 0.0, **columns) -> DataFrame:
    """The rows of docs of which at most max_share of the words are in benchmark windows."""
    hits = contamination(docs, benchmark, window, **columns)
    return hits.filter(hit_words() <= F.lit(max_share) * F.col(WORDS)).select(*[F.col(f"`{c}`") for c in docs.columns])
