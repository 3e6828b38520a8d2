"""Words that are spelt almost alike, by bands of a letter-parity bitmask.

A word's mask has a bit for each letter, set if the letter stands in the word an odd number of times.
One inserted or deleted letter flips one bit, one replaced letter two at most. So of three bands that
a mask is split into, one at least is equal in two near words. Words are joined on equal bands; a
pair with an equal half whose lengths differ by one at most and whose masks differ in two bits at most
is then compared letter by letter. A pair is told in the first of its equal bands only.

A bucket (words that are equal in a band) of more than LIMIT words is split by the same rule again:
the other bits of the mask fall into three bands, of which one is equal in two near words. What is
too large after DEPTH such steps is dealt in tiles, each two blocks of some LIMIT words. So no task
gathers more than two such blocks, whatever the corpus holds.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import P, discard, materialize

LIMIT = 8192
DEPTH = 5
#: Cells of a matrix of pairs, or letters of words, that are looked at together; few, for the cache.
CELLS = 1 << 18
LEAD = 0xC3
#: Bytes that a text isn't cut after: letters, and all of other characters.
INSIDE = np.zeros(256, bool)
INSIDE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
ASCII = INSIDE & (np.arange(256) < 0x80)

WORD, N, SIZE, MASK, PATH, VALUE = "word", "n", f"{P}size", f"{P}mask", f"{P}path", f"{P}value"
LEFT, RIGHT, SIDE = f"{P}left", f"{P}right", f"{P}side"


def _letter_bits() -> np.ndarray:
    """A mask bit for each code point below 256: a to z have their own, of the others two whose
    codes differ by 32 (as those of most capitals and small letters) share one."""
    code = np.arange(256)
    place = np.where((code >= 97) & (code <= 122), code - 97, 26 + code % 32)
    return np.uint64(1) << place.astype(np.uint64)


BITS = _letter_bits()
N_BITS = 58


def _paths(depth: int) -> tuple[list[int], list[list[int]]]:
    """By path (children of p: 3p+1 to 3p+3; 0 is the root): the bits that are equal in its buckets,
    and the sets of bits of which each must differ, as pairs equal there are told elsewhere."""
    equal, differ = [0], [[]]
    for p in range((3**depth - 1) // 2):
        rest = [b for b in range(N_BITS) if not equal[p] >> b & 1]
        bands = [sum(1 << b for b in rest[k::3]) for k in range(3)]
        for k in range(3):
            equal.append(equal[p] | bands[k])
            differ.append(differ[p] + bands[:k])
    return equal, differ


EQUAL, DIFFER = _paths(DEPTH)


def _runs(min_chars: int, typo_every: int | None):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            parts = [pa.array([], pa.large_binary())]
            for row0, data, at in tn.pieces(batch.column(1), INSIDE):
                lead = data == LEAD
                follows = np.zeros(len(data), bool)
                follows[1:] = lead[:-1]
                starts, ends, first = tn.spans(ASCII[data] | lead | follows, at)
                row = tn.text_of(first, len(starts))
                leads = np.concatenate([[0], np.cumsum(lead)])
                size = ends - starts - (leads[ends] - leads[starts])
                long = size >= min_chars
                starts, ends, row, size = starts[long], ends[long], row[long], size[long]
                low = tn.LOWERED[data]
                if typo_every:
                    begun = np.array([zlib.crc32(f"{x}:".encode()) if x is not None else 0 for x in ids[row0 : row0 + len(at) - 1]], np.uint32)
                    named = np.array([x is not None for x in ids[row0 : row0 + len(at) - 1]], bool)
                    h = tn.crcs(low, starts, ends, begun[row])
                    hit = (h % typo_every == 0) & named[row]
                    changed = []
                    for i in np.flatnonzero(hit & (size > min_chars)):
                        w, k = low[starts[i] : ends[i]].tobytes().decode(), int(h[i]) % int(size[i])
                        changed.append((w[:k] + w[k + 1 :]).encode())
                    parts.append(pa.array(changed, pa.large_binary()))
                    starts, ends = starts[~hit], ends[~hit]
                parts.append(tn.packed(low, starts, ends))
            counts = pa.chunked_array(parts).combine_chunks().value_counts()
            yield pa.RecordBatch.from_arrays([counts.field(0).cast(pa.binary()), counts.field(1)], names=[WORD, N])
            tn.give_back()

    return run


def codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of words whose letters are below 256."""
    data, at = tn.buffers(column)
    lead = data == LEAD
    follows = np.zeros(len(data), bool)
    follows[1:] = lead[:-1]
    before = np.concatenate([[0], np.cumsum(lead)])
    return (data + np.where(follows, 0x40, 0).astype(np.uint8))[~lead], at - before[at]


def _masked(batches):
    for batch in batches:
        code, at = codes(batch.column(0))
        mask = np.bitwise_xor.reduceat(BITS[code], at[:-1]) if batch.num_rows else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(at)), pa.array(mask.view(np.int64))], names=[WORD, N, SIZE, MASK])


def one_edit(code: np.ndarray, start: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of words differ by one replaced letter, or by one letter that b has more."""
    ok = np.zeros(len(a), bool)
    for n in np.unique(size[a]):
        mine = np.flatnonzero(size[a] == n)
        step = max(1, CELLS // int(n + 1))
        for some in (mine[i : i + step] for i in range(0, len(mine), step)):
            more = size[b[some]] > n
            same, longer = some[~more], some[more]
            across = np.arange(n)
            x, y = code[start[a[same]][:, None] + across], code[start[b[same]][:, None] + across]
            ok[same] = (x != y).sum(axis=1) == 1
            x, y = code[start[a[longer]][:, None] + across], code[start[b[longer]][:, None] + np.arange(n + 1)]
            head, tail = x == y[:, :-1], (x == y[:, 1:])[:, ::-1]
            begins = np.where(head.all(axis=1), n, head.argmin(axis=1))
            ends = np.where(tail.all(axis=1), n, tail.argmin(axis=1))
            ok[longer] = begins + ends >= n
    return ok


#: DIFFER as a table; no bits: nothing more must differ.
_DIFFER = np.zeros((len(DIFFER), max(map(len, DIFFER))), np.uint64)
for _p, _bits in enumerate(DIFFER):
    _DIFFER[_p, : len(_bits)] = _bits


def _meetings(begin: np.ndarray, end: np.ndarray):
    """(i, place): each place of begin[i] to end[i], some CELLS at a time."""
    n = np.maximum(end - begin, 0)
    upto, i = np.cumsum(n), 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + CELLS, "right")))
        own = np.repeat(np.arange(i, j), n[i:j])
        yield own, np.arange(len(own)) - np.repeat(upto[i:j] - n[i:j] - (upto[i - 1] if i else 0), n[i:j]) + begin[own]
        i = j


def _candidates(tile, path, crossed, side, mask, size, half):
    """Pairs (shorter, longer) of words of one tile, by halves, masks and lengths.

    One edit leaves the first half of the letters as it is, or the second. So words are put in order by
    tile, length and half, and those that are equal there meet; then their masks tell most of them apart.
    """
    for k in (0, 2):
        place = tn.mix(tile * tn.GRAM + np.uint64(k))
        key = lambda h, n: tn.mix(tn.mix(place + n.astype(np.uint64)) ^ h)  # noqa: B023, E731
        short, long = key(half[k], size), key(half[k + 1], size - 1)
        order = np.argsort(short)
        held = short[order]
        met = np.searchsorted(held, long, "left"), np.searchsorted(held, long, "right")
        for more, (begin, end) in enumerate(((np.arange(1, len(held) + 1), np.searchsorted(held, held, "right")), met)):
            for own, other in _meetings(begin, end):
                r, c = (order[other], own) if more else (order[own], order[other])
                x = mask[r] ^ mask[c]
                ok = (np.bitwise_count(x) <= 2) & (tile[r] == tile[c]) & (size[r] + more == size[c]) & (half[k][r] == half[k + more][c])
                if k:  # equal first halves: told before
                    ok &= half[0][r] != half[more][c]
                r, c, x = r[ok], c[ok], x[ok]
                ok = ~crossed[r] | (side[r] != side[c])
                for bits in _DIFFER[path[r]].T:
                    ok &= (bits == 0) | (x & bits != 0)
                yield r[ok], c[ok]


def halves(code: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Hashes of each word's first half, of the first half of a word with a letter less, and of what
    is left of each of those lengths at the word's end."""
    begin, end = at[:-1], at[1:]
    n = end - begin
    return [tn.span_hash(code, *span) for span in ((begin, begin + n // 2), (begin, begin + (n - 1) // 2), (begin + n // 2, end), (begin + (n - 1) // 2 + 1, end))]


def _near(batches):
    """Pairs of each tile; rows come sorted by path, value, left and right."""
    for table, cut in tn.whole_groups(batches, 4):
        path, side = table.column(0).to_numpy(), table.column(4).to_numpy()
        words = table.column(5).combine_chunks() if table.column(5).num_chunks != 1 else table.column(5).chunk(0)
        mask, size = table.column(7).to_numpy().view(np.uint64), table.column(8).to_numpy()
        code, at = codes(words)
        half = halves(code, at)
        tile = np.repeat(np.arange(len(cut) - 1, dtype=np.uint64), np.diff(cut))
        crossed = table.column(2).to_numpy() != table.column(3).to_numpy()
        found = []
        for r, c in _candidates(tile, path, crossed, side, mask, size, half):
            ok = one_edit(code, at, size, r, c)
            found.append((r[ok], c[ok]))
        if found:
            r, c = (np.concatenate(x) for x in zip(*found, strict=True))
            n = table.column(6).combine_chunks()
            yield pa.RecordBatch.from_arrays([words.take(pa.array(np.concatenate([r, c]))), *[x.take(pa.array(np.concatenate([c, r]))) for x in (words, n)]], names=[WORD, "other", "n_other"])


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7, min_count: int = 2, typo_every: int | None = None) -> DataFrame:
    """(word, n): the words of docs, as variants() takes them."""
    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    told = slim.mapInArrow(_runs(min_chars, typo_every), f"{WORD} binary, {N} long")
    return told.groupBy(F.col(WORD).cast("string").alias(WORD)).agg(F.sum(N).alias(N)).filter(F.col(N) >= min_count)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other, n_other): each two near words of (word, n), both ways round."""
    words = words.mapInArrow(_masked, f"{WORD} string, {N} long, {SIZE} long, {MASK} long")
    bits = F.array(*[F.lit(b) for b in EQUAL])
    key = [PATH, VALUE]

    def split(rows: DataFrame, parent) -> DataFrame:
        rows = rows.withColumn(PATH, F.explode(F.array(*[parent * 3 + k for k in (1, 2, 3)])))
        return rows.withColumn(VALUE, F.col(MASK).bitwiseAND(F.get(bits, F.col(PATH))))

    rows, tiles, written = split(words, F.lit(0)), [], []
    for depth in range(1, DEPTH + 1):
        large = materialize(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > LIMIT))
        written.append(large)
        if large.isEmpty():
            break
        tiles.append(rows.join(large, key, "left_anti").withColumns({LEFT: F.lit(0), RIGHT: F.lit(0), SIDE: F.lit(0)}))
        rows = rows.join(large, key)
        if depth < DEPTH:
            rows = split(rows.drop("many", VALUE), F.col(PATH))
        else:
            blocks = F.ceil(F.col("many") / LIMIT).cast("int")
            rows = rows.withColumn(f"{P}block", F.pmod(F.xxhash64(WORD), blocks).cast("int")).withColumn(f"{P}with", F.explode(F.sequence(F.lit(0), blocks - 1)))
            own, other = F.col(f"{P}block"), F.col(f"{P}with")
            rows = rows.withColumns({LEFT: F.least(own, other), RIGHT: F.greatest(own, other), SIDE: (own > other).cast("int")}).drop("many")
    if not (LEFT in rows.columns):
        rows = rows.withColumns({LEFT: F.lit(0), RIGHT: F.lit(0), SIDE: F.lit(0)})
    columns = [PATH, VALUE, LEFT, RIGHT, SIDE, WORD, N, MASK, SIZE]
    every = rows.select(*columns)
    for t in tiles:
        every = every.unionByName(t.select(*columns))
    out = materialize(every.repartition(*columns[:4]).sortWithinPartitions(*columns[:4]).mapInArrow(_near, f"{WORD} string, other string, n_other long"))
    for x in written:
        discard(x)
    return out


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7, min_count: int = 2, ratio: int = 10, typo_every: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of docs and what each is a variant of.

    Words are the distinct maximal runs of letters (A to Z, a to z and U+00C0 to U+00FF), A-Z
    lower-cased, with at least min_chars letters and min_count occurrences (n) in all texts. Two are
    near if they differ by exactly one inserted, deleted or replaced letter. A word's form is its
    near word of largest n (ties: the first in code-point order) if that n is at least ratio times
    the word's own; else null. root: the last form that is met by going on from form to form; the
    word itself if it has none. n_near: the number of near words. form_n: the form's n.

    typo_every: plants misspellings, for tests: where the crc32 of "<id>:<run>" is divisible by it,
    that run has lost the letter whose number is the crc32 modulo the run's length.

    Null and empty texts have no words. Repeated rows, and rows with one id, count as often as they
    are there; a null id counts too, and has no misspellings. Other columns of docs are not read.
    """
    words = materialize(counts(docs, id_col, text_col, min_chars, min_count, typo_every))
    pairs = near_pairs(words)
    # The first: the largest n, then the least word.
    best = pairs.groupBy(WORD).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("less"), F.col("other"))).alias("best"))
    form_n = -F.col("best.less")
    joined = words.join(best, WORD, "left").select(WORD, N, F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form_n >= F.col(N) * ratio, F.struct(F.col("best.other").alias("form"), form_n.alias("form_n"))).alias("best"))
    told = materialize(joined.select(WORD, N, "n_near", "best.form", "best.form_n"))
    # From form to form n grows tenfold, so a chain is short; each round doubles how far a root lies.
    roots = materialize(told.filter("form is not null").select(WORD, F.col("form").alias("root")))
    while True:
        far = roots.select(F.col(WORD).alias("root"), F.col("root").alias("far"))
        moved = materialize(roots.join(far, "root", "left").select(WORD, F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        more = not moved.filter("moved").isEmpty()
        discard(roots)
        roots = moved.select(WORD, "root")
        if not more:
            break
    discard(words)
    discard(pairs)
    return told.join(roots, WORD, "left").select(WORD, "form", F.coalesce("root", WORD).alias("root"), N, "n_near", "form_n")
