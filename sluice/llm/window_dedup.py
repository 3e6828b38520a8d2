"""Substring dedup of word windows, by level-wise doubling.

Levels double up to the length that is asked for: windows of 7 words and then of 13; for 100, of 7,
13, 25, 50, 100. At each level only windows are looked at whose two halves (which overlap by a
word where the length is odd) may repeat at the level before. The first level is sampled by
winnowing: each window of the second level holds one of its grams at least, and equal windows hold
the same. What may repeat at a level is told by Bloom planes for each range of hashes (repeats.py);
at the last level windows are compared by 128 bits, made of two hashes of each word. longest_repeats() goes on doubling from there
until no candidate is left.

A task keeps one document for each window that it has met, the least; only those move, packed by
hash range. So a passage that many documents share moves once per task, not once per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import P, SQUEEZED, materialize, squeezed_docs
from .repeats import is_suspected, shards_for, suspected, unzipped, zipped

#: Windows that a task gathers before it sends them on.
FLUSH = 1 << 19
#: Words of the shortest windows that are looked at, at most.
SHORTEST = 8
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
TEXT, WORDS, REMOVED = f"{P}text", f"{P}words", f"{P}removed"
ID, HASH, FOUND, MARKED, STARTS = f"{P}id", f"{P}hash", f"{P}found", f"{P}marked", f"{P}starts"


def levels(length: int) -> list[int]:
    """Lengths that double up to `length`, ascending; two at least."""
    out = [length]
    while out[0] > SHORTEST or len(out) < 2:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _hashed(column: pa.Array):
    for row0, data, at in tn.slices(column):
        starts, ends, first = tn.words(data, at)
        yield row0, tn.span_hash(data, starts, ends), first


def _chosen(h: np.ndarray, first: np.ndarray, steps: list[int]):
    """(hashes, places) of the grams of the first level that winnowing keeps."""
    g = tn.grams(h, steps[0])
    at = np.flatnonzero(tn.chosen(g, steps[1] - steps[0] + 1) & tn.gram_rows(first, steps[0], len(g)))
    return g[at], at


def _grams(steps: list[int]):
    def run(batch):
        for row0, h, first in _hashed(batch.column(1)):
            g, at = _chosen(h, first, steps)
            yield g, row0 + np.searchsorted(first, at, "right") - 1

    return run


def _open(h: np.ndarray, first: np.ndarray, found, steps: list[int], level: int, shards: int):
    """(starts, texts) of the windows of a level whose parts at the level before may repeat."""
    length, before = steps[level], steps[level - 1]
    n = len(h) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none
    if level == 1:
        g, at = _chosen(h, first, steps)
    else:
        g, at = tn.grams(h, before), np.flatnonzero(tn.gram_rows(first, before, len(h) - before + 1))
        g = g[at]
    at = at[is_suspected(g, np.searchsorted(first, at, "right") - 1, found, shards)]
    if not len(at):
        return none, none
    if level == 1:
        ok = tn.covered(len(h), np.maximum(at - (length - before), 0), np.minimum(at, length - before) + 1)[:n]
    else:
        alive = np.zeros(len(h), bool)
        alive[at] = True
        ok = alive[:n] & alive[length - before :][:n]
    s = np.flatnonzero(tn.gram_rows(first, length, n) & ok)
    return s, np.searchsorted(first, s, "right") - 1


def _open_hashes(steps: list[int], level: int, shards: int):
    def run(batch):
        # id, text (squeezed), found
        some = np.flatnonzero(batch.column(2).is_valid())
        found = batch.column(2).take(pa.array(some))
        for row0, h, first in _hashed(tn.unsqueezed(batch.column(1).take(pa.array(some)))):
            s, row = _open(h, first, found.slice(row0, len(first) - 1), steps, level, shards)
            yield window_hash(h, s, steps[level]), some[row0 + row]

    return run


def window_hash(h: np.ndarray, s: np.ndarray, length: int, by: np.uint64 = tn.GRAM) -> np.ndarray:
    w = h[s].copy()
    for j in range(1, length):
        w = w * by + h[s + j]
    return tn.mix(w)


NAMES = ["bucket", "part", "hashes", "second", "docs", "texts", "which", "places"]
_DDL = "bucket long, part long, hashes binary, second binary, docs binary, texts binary, which binary, places binary"
_MARKS = ["part", "docs", "texts", "places"]


def _cuts(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return cut, np.append(cut[1:], len(key))[: len(cut)]


def marks(doc: np.ndarray, text: np.ndarray, place: np.ndarray, parts: int) -> pa.RecordBatch:
    """Window starts that are repeats, packed by part of the documents. Such rows have a part and
    no hashes, and pass through any bucket."""
    part = (tn.mix(doc.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((place, text, doc, part))
    part, doc, text, place = part[order], doc[order], text[order], place[order]
    cut, end = _cuts(part)
    none = pa.array([None] * len(cut), pa.binary())
    docs, texts, places = (pa.array([zipped(x[a:b]) for a, b in zip(cut, end, strict=True)], pa.binary()) for x in (doc, text, place.astype(np.int32)))
    return pa.RecordBatch.from_arrays([pa.array(part[cut]), pa.array(part[cut]), none, none, docs, texts, none, places], names=NAMES)


def _groups(h: np.ndarray, second: np.ndarray):
    """(order, begins): equal windows together."""
    order = np.argsort(h)
    a, b = h[order], second[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((second, h))
        a, b = h[order], second[order]
    return order, np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))


def _candidates(steps: list[int], shards: int, id_: str):
    """Windows of the full length that may repeat. Of equal windows in one gathering, the least
    document's go on, by bucket; the others are repeats already: marks()."""
    length = steps[-1]

    def run(batches):
        rows, size, docs, texts, n = [], 0, [], [], 0
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            some = pa.array(np.flatnonzero(get(FOUND).is_valid()))
            if not len(some):
                continue
            ids, hashes, found = (get(c).take(some) for c in (id_, HASH, FOUND))
            ids, hashes = ids.cast(pa.int64()).to_numpy(), hashes.to_numpy()
            for row0, data, at in tn.slices(tn.unsqueezed(get(SQUEEZED).take(some))):
                word_at, word_end, first = tn.words(data, at)
                h = tn.span_hash(data, word_at, word_end)
                s, row = _open(h, first, found.slice(row0, len(first) - 1), steps, len(steps) - 1, shards)
                if not len(s):
                    continue
                docs.append(ids[row0 : row0 + len(first) - 1])
                texts.append(hashes[row0 : row0 + len(first) - 1])
                rows.append((window_hash(h, s, length), window_hash(tn.span_hash(data, word_at, word_end, True), s, length, _SECOND), n + row, (s - first[row]).astype(np.int32)))
                n += len(first) - 1
                size += len(s)
                if size >= FLUSH:
                    yield from send(rows, docs, texts)
                    rows, size, docs, texts, n = [], 0, [], [], 0
        if rows:
            yield from send(rows, docs, texts)

    def send(rows, docs, texts):
        docs, texts = np.concatenate(docs), np.concatenate(texts)
        h, second, row, place = (np.concatenate(x) for x in zip(*rows, strict=True))
        order, begin = _groups(h, second)
        h, second, row, place = h[order], second[order], row[order], place[order]
        doc = docs[row]
        least = np.repeat(np.minimum.reduceat(doc, begin), np.diff(np.append(begin, len(h))))
        first = doc == least
        if not first.all():
            yield marks(doc[~first], texts[row[~first]], place[~first], shards)
        h, second, row, place = h[first], second[first], row[first], place[first]
        key = (h >> np.uint64(64 - (shards.bit_length() - 1))).astype(np.int64)
        columns: list[list] = [[] for _ in range(6)]
        cut, end = _cuts(key)
        for a, b in zip(cut, end, strict=True):
            own, which = np.unique(row[a:b], return_inverse=True)
            for out, x in zip(columns, (h[a:b].tobytes(), second[a:b].tobytes(), zipped(docs[own]), texts[own].tobytes(), zipped(which.astype(np.int32)), zipped(place[a:b])), strict=True):
                out.append(x)
        none = pa.array([None] * len(cut), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(key[cut]), none, *(pa.array(c, pa.binary()) for c in columns)], names=NAMES)

    return run


def _resolve(parts: int):
    """One hash range: windows that a smaller document has, as marks."""

    def run(table: pa.Table) -> pa.Table:
        known = pc.is_valid(table["part"])
        done = table.filter(known).select(_MARKS)
        table = table.filter(pc.invert(known))
        if not table.num_rows:
            return done
        h, second = (np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table[c]]) for c in ("hashes", "second"))
        doc, text = [], []
        for docs, texts, which in zip(table["docs"], table["texts"], table["which"], strict=True):
            w = unzipped(which, np.int32)
            doc.append(unzipped(docs, np.int64)[w])
            text.append(np.frombuffer(texts.as_buffer(), np.int64)[w])
        doc, text, place = np.concatenate(doc), np.concatenate(text), np.concatenate([unzipped(x, np.int32) for x in table["places"]])
        order, begin = _groups(h, second)
        doc = doc[order]
        late = doc > np.repeat(np.minimum.reduceat(doc, begin), np.diff(np.append(begin, len(doc))))
        return pa.concat_tables([done, pa.Table.from_batches([marks(doc[late], text[order][late], place[order][late], parts)]).select(_MARKS)])

    return run


def _per_document(table: pa.Table) -> pa.Table:
    """One part of the documents: each one's window starts, and of which text they are."""
    doc, text, place = (np.concatenate([unzipped(x, k) for x in table[c]]) for c, k in (("docs", np.int64), ("texts", np.int64), ("places", np.int32)))
    order = np.lexsort((place, text, doc))
    doc, text, place = doc[order], text[order], place[order]
    cut, end = _cuts(doc)
    columns = [pa.array([zipped(x[a:b]) for a, b in zip(cut, end, strict=True)], pa.binary()) for x in (text, place)]
    return pa.table([pa.array(doc[cut]), *columns], names=["id", "texts", "starts"])


def _cut(length: int, keep: list[str]):
    def run(batches):
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            own, marked, places = get(HASH).to_numpy(), get(MARKED), get(STARTS)
            texts, totals, removed = [], [], []
            for row0, data, at in tn.slices(tn.unsqueezed(get(SQUEEZED))):
                starts, ends, first = tn.words(data, at)
                for r in range(len(at) - 1):
                    a, b = int(first[r]), int(first[r + 1])
                    stay = np.ones(b - a, bool)
                    if marked[row0 + r].is_valid:
                        s = unzipped(places[row0 + r], np.int32)[unzipped(marked[row0 + r], np.int64) == own[row0 + r]]
                        stay = ~tn.covered(b - a, s.astype(np.int64), length)
                    some = np.flatnonzero(stay) + a
                    texts.append(b" ".join([data[x:y].tobytes() for x, y in zip(starts[some].tolist(), ends[some].tolist(), strict=True)]))
                    totals.append(b - a)
                    removed.append(b - a - len(some))
            yield pa.RecordBatch.from_arrays([*map(get, keep), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())], names=[*keep, TEXT, WORDS, REMOVED])

    return run


def dedup_windows(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs (all by default), __sl_text (the words that stay, joined by one
    space), __sl_words and __sl_removed (their numbers before, and gone).

    Words are `[^\\x20\\x09-\\x0D]+`. Every word goes that is inside a window of `length` words
    whose sequence also starts in a document with a smaller id; windows are those of the input.
    Windows are compared by 128 bits. Null text has no words. Ids are whole numbers; rows with one
    id take nothing from each other, and texts of one id are told apart; rows with a null id
    count for nothing and keep all words.
    """
    keep = docs.columns if keep is None else keep
    steps, shards = levels(length), shards_for(docs, text_col)
    slim = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = suspected(slim, _grams(steps), shards)
    # All joins take the texts in one partitioning, so they are exchanged once.
    hashed = docs.withColumn(HASH, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    texts = squeezed_docs(hashed, dict.fromkeys([*keep, id_col, HASH]), text_col)

    def with_(told: DataFrame) -> DataFrame:
        return texts.join(told, F.col(id_col).cast("long") == F.col(ID), "left")

    for level in range(1, len(steps) - 1):
        rows = with_(found.select(F.col("id").alias(ID), F.col("found").alias(FOUND))).filter(F.col(FOUND).isNotNull())
        found = suspected(rows.select(ID, SQUEEZED, FOUND), _open_hashes(steps, level, shards), shards)
    rows = with_(found.select(F.col("id").alias(ID), F.col("found").alias(FOUND)))
    late = rows.mapInArrow(_candidates(steps, shards, id_col), _DDL).groupBy("bucket").applyInArrow(_resolve(shards), "part long, docs binary, texts binary, places binary")
    told = late.groupBy("part").applyInArrow(_per_document, "id long, texts binary, starts binary").select(F.col("id").alias(ID), F.col("texts").alias(MARKED), F.col("starts").alias(STARTS))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return with_(told).mapInArrow(_cut(length, keep), f"{schema}, {TEXT} string, {WORDS} long, {REMOVED} long")


def _windows(length: int):
    """(id, start, hash) of all windows."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row0, h, first in _hashed(batch.column(1)):
                s = np.flatnonzero(tn.gram_rows(first, length, max(0, len(h) - length + 1)))
                row = np.searchsorted(first, s, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(ids[row0 + row]), pa.array(s - first[row]), pa.array(window_hash(h, s, length).view(np.int64))], names=["id", "start", "hash"])

    return run


def longest_repeats(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, longest): documents that share a window of `length` words with another document, and the
    largest length * 2**k for which they share one.

    A level's windows that occur in one document alone are dropped; a window of twice the length
    starts where two neighbours are left, and its hash is made of theirs.
    """
    slim = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    level, size, found = slim.mapInArrow(_windows(length), "id long, start long, hash long"), length, None
    while True:
        shared = level.select("hash", "id").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        alive = materialize(level.join(shared, "hash", "left_semi"))
        ids = alive.select("id").distinct().withColumn("longest", F.lit(size))
        found = ids if found is None else found.unionAll(ids)
        if alive.isEmpty():
            return found.groupBy("id").agg(F.max("longest").alias("longest"))
        after = alive.select("id", (F.col("start") - size).alias("start"), F.col("hash").alias("after"))
        level, size = alive.join(after, ["id", "start"]).select("id", "start", F.xxhash64("hash", "after").alias("hash")), size * 2
