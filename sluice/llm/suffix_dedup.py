"""Suffix-array dedup of byte strings with the difference-cover algorithm.

Which bytes repeat is read off a sorted list of suffixes: equal strings are neighbours in it. The
sort is distributed by anchors. The anchor of a string is the k-gram of least hash inside it, so
equal strings have equal anchors, and all strings that could be equal meet in one partition.
Bloom planes for each range of anchors (repeats.py) keep out text whose anchors occur once.

In a partition, stretches of text with one anchor and the same bytes count once. What is left are
stretches that share an anchor and differ somewhere. Their suffixes are sorted by difference cover:
suffixes at two of three places get names by their first three symbols; the names' sequence is
sorted by the same way, until names are unique or reach over the length that matters; suffixes at
the third place are sorted by a symbol and a rank, and merged. Then neighbours are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import P, SQUEEZED, squeezed_docs
from .repeats import is_suspected, shards_for, suspected, unzipped, zipped

ANCHOR = 20
#: Anchors that a task gathers before it sends them on.
GATHER = 1 << 19
#: Texts are looked at in pieces of so many string starts.
PIECE = 1 << 19
#: Stretches that one anchor may have before they are told apart by string.
HOT = 1 << 14
#: Stretches of one anchor in a gathering that count.
SEVERAL = 8
_U = np.uint64
_PLACE = 26
_LOW = _U((1 << _PLACE) - 1)
_SALT = _U(0xA24BAED4963EE407)


def difference_cover_ranks(s: np.ndarray, depth: int, reach: int = 1, wanted: np.ndarray | None = None) -> np.ndarray:
    """Ranks of suffixes of s (symbols >= 0) among each other, from 1: of all, or of those that begin
    at the wanted places (ascending). Suffixes that agree over `depth` base symbols may share a
    rank; a symbol of s stands for `reach` base symbols."""
    n = len(s)
    wanted = np.arange(n) if wanted is None else wanted
    t = np.concatenate([s.astype(np.int64) + 1, np.zeros(3, np.int64)])
    sample = np.concatenate([np.arange(1, n, 3), np.arange(2, n, 3)])
    rank = np.zeros(n + 3, np.int64)
    if len(sample):
        names = _dense(t[sample], t[sample + 1], t[sample + 2])
        cut = len(range(1, n, 3))
        # Ranks are needed of sampled places that are wanted or within two places after one.
        needed = np.zeros(n + 3, bool)
        for j in range(3):
            needed[wanted + j] = True
        needed = np.flatnonzero(needed[:n] & (np.arange(n) % 3 != 0))
        place = np.where(needed % 3 == 1, needed // 3, cut + needed // 3)
        if names.max() < len(sample) and 3 * reach < depth:
            # A symbol less than all others ends the first half.
            longer = np.concatenate([names[:cut], [0], names[cut:]])
            place = np.where(needed % 3 == 1, needed // 3, cut + 1 + needed // 3)
            order = np.argsort(place)
            rank[needed[order]] = difference_cover_ranks(longer, depth, 3 * reach, place[order])
        else:
            rank[needed] = names[place]
    # The rest: a symbol and the rank after it, merged by where they fall among the others.
    kind = wanted % 3
    rest = wanted[kind == 0]
    own = _dense(t[rest], rank[rest + 1])
    below, same = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64)
    for width in (1, 2):
        part = wanted[kind == width]
        if not len(part):
            continue
        part = part[np.argsort(rank[part])]
        keys = [np.concatenate([t[part + j], t[rest + j]]) for j in range(width)]
        both = _dense(*keys, np.concatenate([rank[part + width], rank[rest + width]]))
        theirs, mine = both[: len(part)], both[len(part) :]
        at = np.searchsorted(theirs, mine)
        below = np.maximum(below, np.where(at > 0, rank[part[np.maximum(at, 1) - 1]], 0))
        at = np.minimum(at, len(part) - 1)
        same = np.maximum(same, np.where(theirs[at] == mine, rank[part[at]], 0))
    value, order = 2 * rank[wanted], np.zeros(len(wanted), np.int64)
    value[kind == 0] = np.where(same > 0, 2 * same, 2 * below + 1)
    order[kind == 0] = np.where(same > 0, 0, own)
    return _dense(value, order)


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 1, without gaps, of tuples of numbers."""
    spans = [int(k.max()) + 1 if len(k) else 1 for k in keys]
    if np.prod([float(x) for x in spans]) < 2.0**62:
        one = keys[0].astype(np.int64)
        for k, span in zip(keys[1:], spans[1:], strict=True):
            one = one * span + k
        order = np.argsort(one)
        new = np.diff(one[order], prepend=-1) > 0
    else:
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for k in keys:
            new |= np.diff(k[order], prepend=-1) != 0
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def equal_strings(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A class number per start (ascending): equal if and only if the length bytes there are."""
    order = np.argsort(difference_cover_ranks(text, length, 1, starts))
    new = np.ones(len(order), bool)
    for a in range(1, len(order), 1 << 17):
        b = min(len(order), a + (1 << 17))
        x = starts[order[a - 1 : b]]
        differs = np.zeros(b - a, bool)
        for j in range(length):
            differs |= text[x[1:] + j] != text[x[:-1] + j]
        new[a:b] = differs
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


class Stretches:
    """Of a run of texts: stretches of string starts that have one anchor. start, end: starts in
    data; anchor: its hash; row: the text."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int):
        window = length - ANCHOR + 1
        n = len(data) - length + 1
        self.data = data
        if n <= 0:
            self.start = self.end = self.row = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        place = np.arange(len(data) - ANCHOR + 1)
        g = tn.span_hash(data, place, place + ANCHOR)
        # Least hash; of equal ones the last. Places are told apart by the low bits.
        m = tn.window_min((g & ~_LOW) | (_LOW - place.astype(np.uint64)), window)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))[:n]
        inside = np.arange(n) + length <= at[1:][row]
        new = np.ones(n, bool)
        new[1:] = (m[1:] != m[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], n)
        ok = inside[begin]
        self.start, self.end, self.row = begin[ok], end[ok], row[begin[ok]]
        self.anchor = g[(_LOW - (m[self.start] & _LOW)).astype(np.int64)]


def _pieces(column: pa.Array, length: int):
    """(rows, offset of the first byte in its text, bytes, offsets): texts, and long texts in parts
    that overlap by length - 1."""
    for row0, data, at in tn.slices(column, PIECE):
        if len(data) <= 4 * PIECE:
            yield row0, 0, data, at
            continue
        for a in range(0, len(data), PIECE):  # one long text
            part = data[a : a + PIECE + length - 1]
            yield row0, a, part, np.array([0, len(part)])


def _anchors(length: int):
    def run(batch):
        for row0, _, data, at in _pieces(batch.column(1), length):
            stretches = Stretches(data, at, length)
            yield stretches.anchor, row0 + stretches.row

    return run


def _open_stretches(batch, length: int, shards: int):
    """(rows, offset of the first byte in its text, bytes, offsets, start, end, row, anchor) of the
    stretches whose anchor may repeat. batch: with the columns __sl_squeezed and __sl_found."""
    get = lambda c: batch.column(batch.schema.get_field_index(c))
    some = np.flatnonzero(get(FOUND).is_valid())
    found = get(FOUND).take(pa.array(some))
    for row0, offset, data, at in _pieces(tn.unsqueezed(get(SQUEEZED).take(pa.array(some))), length):
        s = Stretches(data, at, length)
        ok = is_suspected(s.anchor, s.row, found.slice(row0, len(at) - 1), shards)
        if ok.any():
            yield some[row0 : row0 + len(at) - 1], offset, data, at, s.start[ok], s.end[ok], s.row[ok], s.anchor[ok]


_SENT = ["shard", "part", "anchors", "hashes", "docs", "texts", "which", "starts", "sizes", "bytes"]
_SENT_DDL = "shard long, part long, anchors binary, hashes binary, docs binary, texts binary, which binary, starts binary, sizes binary, bytes binary"


MARK = ["part", "docs", "texts", "starts", "sizes"]
_MARK_DDL = "part long, docs binary, texts binary, starts binary, sizes binary"


def _marks(doc: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray, parts: int) -> pa.RecordBatch:
    """Stretches that go, packed by part of the documents. Such rows have a part and no anchors, and
    pass through any shard."""
    part = (tn.mix(doc.astype(np.uint64)) % _U(parts)).astype(np.int64)
    order = np.lexsort((start, text, doc, part))
    part = part[order]
    cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    end = np.append(cut[1:], len(part))[: len(cut)]
    # A stretch has 31 starts at most.
    docs, texts, starts, sizes = (pa.array([zipped(x[a:b]) for a, b in zip(cut, end, strict=True)], pa.binary()) for x in (doc[order], text[order], start[order].astype(np.int32), size[order].astype(np.uint8)))
    none = pa.array([None] * len(cut), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(part[cut], pa.int64()), pa.array(part[cut], pa.int64()), none, none, docs, texts, none, starts, sizes, none], names=_SENT)


def _per_document(table: pa.Table) -> pa.Table:
    """One part of the documents: each one's stretches that go, and of which text they are."""
    doc, text, start, size = (np.concatenate([unzipped(x, k) for x in table[c]]) for c, k in zip(MARK[1:], (np.int64, np.int64, np.int32, np.uint8), strict=True))
    order = np.lexsort((start, text, doc))
    doc, text, start, size = (x[order] for x in (doc, text, start, size))
    cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    blobs = [pa.array([zipped(x[a:b]) for a, b in zip(cut, np.append(cut[1:], len(doc)), strict=True)], pa.binary()) for x in (text, start, size)]
    return pa.table([pa.array(doc[cut], pa.int64()), *blobs], names=[ID, TEXTS, STARTS, SIZES])


def _stretch_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """A hash of each stretch; its size is part of it."""
    return tn.mix(tn.span_hash(data, start, end + length - 1) + (end - start).astype(np.uint64) * _SALT)


def _often(length: int):
    """(anchor, n): how many different stretches of a gathering have an anchor, if they are several."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, _, data, at in _pieces(batch.column(1), length):
                s = Stretches(data, at, length)
                held.append((s.anchor, _stretch_hash(data, s.start, s.end, length)))
                size += len(s.anchor)
                if size >= GATHER:
                    yield several(held)
                    held, size = [], 0
        if size:
            yield several(held)

    def several(held):
        anchor, hashed = (np.concatenate(x) for x in zip(*held, strict=True))
        # Few anchors have several stretches: only theirs are told apart.
        value, n = np.unique(anchor, return_counts=True)
        often = np.isin(anchor, value[n >= SEVERAL])
        anchor, hashed = anchor[often], hashed[often]
        order = np.lexsort((hashed, anchor))
        anchor, hashed = anchor[order], hashed[order]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (hashed[1:] != hashed[:-1])])[: len(anchor)]
        anchor, n = np.unique(anchor[new], return_counts=True)
        some = n >= SEVERAL
        return pa.RecordBatch.from_arrays([pa.array(anchor[some].view(np.int64), pa.int64()), pa.array(n[some], pa.int64())], names=["anchor", "n"])

    return run


def hot_anchors(slim: DataFrame, length: int) -> np.ndarray:
    """Ascending: anchors of more than HOT different stretches (those of each gathering added up), so
    fewer than a HOTth of all stretches. One that has fewer than SEVERAL in each gathering isn't seen;
    it has fewer than SEVERAL for each GATHER stretches of the corpus. slim: (id, text)."""
    rows = slim.mapInArrow(_often(length), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") > HOT).select("anchor").toArrow()
    return np.sort(rows["anchor"].to_numpy().view(np.uint64)) if rows.num_rows else np.zeros(0, np.uint64)


def _candidates(hot, length: int, shards: int, id_: str):
    """Stretches whose anchor may repeat. Those of hot anchors are cut into single strings with their
    own hash for an anchor, so they spread over shards and equal ones still meet. Of equal stretches
    in one gathering the least document's go on, by anchor, their bytes once; the others are marked."""

    def run(batches):
        held, blocks, docs, texts, n, size = [], [], [], [], 0, 0
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(id_)).cast(pa.int64()).to_numpy(zero_copy_only=False)
            hashes = batch.column(batch.schema.get_field_index(HASH)).to_numpy(zero_copy_only=False)
            for rows, offset, data, at, start, end, row, anchor in _open_stretches(batch, length, shards):
                # Where the anchor lies in its stretch is part of what makes stretches equal.
                hashed = _stretch_hash(data, start, end, length)
                if len(hot.value):
                    spot = np.minimum(np.searchsorted(hot.value, anchor), len(hot.value) - 1)
                    is_hot = hot.value[spot] == anchor
                    times = np.where(is_hot, end - start, 1)
                    step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                    is_hot, anchor, hashed, row, start, end = (np.repeat(x, times) for x in (is_hot, anchor, hashed, row, start, end))
                    start = start + step
                    end = np.where(is_hot, start + 1, end)
                    own = tn.mix(tn.span_hash(data, start[is_hot], start[is_hot] + length))
                    hashed[is_hot] = own
                    anchor[is_hot] = tn.mix(own ^ anchor[is_hot])
                docs.append(ids[rows].astype(np.int64))
                texts.append(hashes[rows])
                held.append((anchor, hashed, n + row, start - at[row] + offset, end - start, np.full(len(start), len(blocks)), start))
                blocks.append(data)
                n += len(rows)
                size += len(start)
                if size >= GATHER:
                    yield from send(held, blocks, np.concatenate(docs), np.concatenate(texts))
                    held, blocks, docs, texts, n, size = [], [], [], [], 0, 0
        if held:
            yield from send(held, blocks, np.concatenate(docs), np.concatenate(texts))

    def send(held, blocks, docs, texts):
        anchor, hashed, row, start, size, block, at = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(tn.mix(anchor + hashed * _SALT))
        anchor, hashed, row, start, size, block, at = (x[order] for x in (anchor, hashed, row, start, size, block, at))
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (hashed[1:] != hashed[:-1])])
        doc = docs[row]
        least = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1] == doc
        if not least.all():
            yield _marks(doc[~least], texts[row[~least]], start[~least], size[~least], shards)
        anchor, hashed, row, start, size, block, at = (x[least] for x in (anchor, hashed, row, start, size, block, at))
        first = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (hashed[1:] != hashed[:-1])])
        key = (tn.mix(anchor) >> _U(64 - (shards.bit_length() - 1))).astype(np.int64)
        by = np.argsort(key, kind="stable")
        cut = np.flatnonzero(np.concatenate([[True], np.diff(key[by]) > 0]))
        zip_ = zstandard.ZstdCompressor(level=1)
        columns: list[list] = [[] for _ in range(8)]
        for a, b in zip(cut, np.append(cut[1:], len(by)), strict=True):
            some = by[a:b]
            own, which = np.unique(row[some], return_inverse=True)
            for out, x in zip(columns, (anchor[some], hashed[some], docs[own], texts[own], which.astype(np.int32), start[some].astype(np.int32), np.where(first, size, -size).astype(np.int8)[some]), strict=False):
                out.append(zip_.compress(np.ascontiguousarray(x).tobytes()))
            once = some[first[some]]
            spans = zip(block[once].tolist(), at[once].tolist(), (at[once] + size[once] + length - 1).tolist(), strict=True)
            columns[7].append(zip_.compress(b"".join([blocks[i][x:y] for i, x, y in spans])))
        none = pa.array([None] * len(cut), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(key[by[cut]], pa.int64()), none, *(pa.array(c, pa.binary()) for c in columns)], names=_SENT)

    return run


def _resolve(length: int, parts: int):
    """One shard: which string starts a smaller document has, too, as marks."""

    def run(table: pa.Table) -> pa.Table:
        known = pc.is_valid(table["part"])
        done = table.filter(known).select(MARK)
        table = table.filter(pc.invert(known))
        return pa.concat_tables([done, resolve(table)]) if table.num_rows else done

    def resolve(table: pa.Table) -> pa.Table:
        kinds = {"anchors": np.uint64, "hashes": np.uint64, "starts": np.int32, "sizes": np.int8}
        anchor, hashed, start, size = (np.concatenate([unzipped(x, k) for x in table[c]]) for c, k in kinds.items())
        which = [unzipped(x, np.int32) for x in table["which"]]
        doc, text = (np.concatenate([unzipped(x, np.int64)[w] for x, w in zip(table[c], which, strict=True)]) for c in ("docs", "texts"))
        raw = np.concatenate([unzipped(x, np.uint8) for x in table["bytes"]])
        # Bytes came once per stretch and gathering: where sizes are above 0.
        has = size > 0
        size = np.abs(size).astype(np.int64)
        where = np.zeros(len(size), np.int64)
        where[has] = np.cumsum(np.where(has, size + length - 1, 0))[has] - (size[has] + length - 1)
        order = np.argsort(anchor)
        family = np.empty(len(order), np.int64)
        family[order] = np.cumsum(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]]))
        # By anchor, then hash: by the upper half of the hash, if that tells them apart.
        key = (family.astype(np.uint64) << _U(32)) | (hashed >> _U(32))
        order = np.argsort(key)
        if ((np.diff(key[order]) == 0) & (np.diff(hashed[order]) != 0)).any():
            order = np.lexsort((hashed, family))
        family, hashed, doc, text, start, size, where, has = (x[order] for x in (family, hashed, doc, text, start, size, where, has))
        new = np.concatenate([[True], (family[1:] != family[:-1]) | (hashed[1:] != hashed[:-1])])
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        late = doc > np.minimum.reduceat(doc, head)[group]
        # One copy of a group's bytes: any place that has them. Its least document owns it.
        source = np.maximum.reduceat(np.where(has, np.arange(len(has)), -1), head)
        out = [(doc[late], text[late], start[late].astype(np.int64), size[late].astype(np.int64))]
        # Stretches that share their anchor with others: sort the suffixes of one copy of each.
        family = family[head]
        open_ = np.flatnonzero((np.bincount(family)[family] > 1) & (source >= 0))
        owner = np.minimum.reduceat(doc, head)
        # Some megabytes at a time, but all of an anchor together.
        upto = np.cumsum(size[head[open_]] + length) >> 21
        first = np.flatnonzero(np.concatenate([[True], family[open_][1:] != family[open_][:-1]]))
        part = np.repeat(upto[first], np.diff(np.append(first, len(open_)))) if len(open_) else upto
        for some in np.split(open_, np.flatnonzero(np.diff(part)) + 1) if len(open_) else []:
            out += _compare(some, owner, source, group, doc, text, start, size, where, raw, late, length)
        return pa.Table.from_batches([_marks(*(np.concatenate(x) for x in zip(*out, strict=True)), parts)]).select(MARK)

    return run


def _compare(some, owner, source, group, doc, text, start, size, where, raw, late, length):
    at, n = where[source[some]], size[source[some]]
    full = n + length  # a blank symbol, 0, stands between stretches
    begin = np.cumsum(full) - full
    symbols = np.zeros(int(full.sum()), np.int64)
    inside = np.arange(len(symbols)) - np.repeat(begin, full)
    live = inside < np.repeat(full - 1, full)
    symbols[live] = raw[(np.repeat(at, full) + inside)[live]].astype(np.int64) + 1
    piece = np.repeat(np.arange(len(some)), n)
    offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    cls = equal_strings(symbols, begin[piece] + offset, length)
    owner = owner[some][piece]
    least = np.full(cls.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, cls, owner)
    gone = owner > least[cls]
    # Runs of starts that go, in the stretch; then at each place where its document has it.
    edge = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1] | (piece[1:] != piece[:-1])]))
    stop = np.flatnonzero(gone & np.concatenate([~gone[1:] | (piece[1:] != piece[:-1]), [True]])) + 1
    if not len(edge):
        return []
    member = np.flatnonzero(~late)
    first = np.searchsorted(group[member], some[piece[edge]])
    last = np.searchsorted(group[member], some[piece[edge]], "right")
    times = last - first
    which = np.repeat(np.arange(len(edge)), times)
    spot = member[np.repeat(first, times) + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)]
    return [(doc[spot], text[spot], start[spot].astype(np.int64) + offset[edge][which], (stop - edge)[which])]


def _cut(length: int, keep: list[str]):
    def run(batches):
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            hashes, marked, starts, sizes = get(HASH).to_numpy(), get(TEXTS), get(STARTS), get(SIZES)
            kept, total, removed, spans = [], [], [], []
            for row0, data, at in tn.slices(tn.unsqueezed(get(SQUEEZED))):
                for r in range(len(at) - 1):
                    own = data[at[r] : at[r + 1]]
                    total.append(len(own))
                    if not marked[row0 + r].is_valid:
                        kept.append(own.tobytes())
                        removed.append(0)
                        spans.append(0)
                        continue
                    mine = unzipped(marked[row0 + r], np.int64) == hashes[row0 + r]
                    s = unzipped(starts[row0 + r], np.int32)[mine].astype(np.int64)
                    n = unzipped(sizes[row0 + r], np.uint8)[mine].astype(np.int64)
                    gone = tn.covered(len(own), s, n + length - 1)
                    kept.append(own[~gone].tobytes())
                    removed.append(int(gone.sum()))
                    spans.append(len(tn.runs(gone)[0]))
            yield pa.RecordBatch.from_arrays([*map(get, keep), pa.array(kept, pa.binary()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())], names=[*keep, KEPT, BYTES, REMOVED, SPANS])

    return run


ID, HASH, FOUND, TEXTS, STARTS, SIZES = f"{P}id", f"{P}hash", f"{P}found", f"{P}texts", f"{P}starts", f"{P}sizes"
KEPT, BYTES, REMOVED, SPANS = f"{P}kept", f"{P}bytes", f"{P}removed", f"{P}spans"


def dedup_strings(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs (all by default), __sl_kept (the bytes that stay), __sl_bytes,
    __sl_removed and __sl_spans (bytes before and gone, and maximal runs that went).

    A byte goes if it is inside a string of `length` bytes that also starts in a document with a
    smaller id; strings are those of the input. Null text is empty. Ids are whole numbers;
    rows with one id take nothing from each other; rows with a null id count for nothing and
    keep all. Stretches of text are told apart by two 64-bit hashes, the strings in them by bytes.
    """
    keep = docs.columns if keep is None else keep
    shards = shards_for(docs, text_col)
    slim = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = suspected(slim, _anchors(length), shards).select(F.col("id").alias(ID), F.col("found").alias(FOUND))
    # All joins take the texts in one partitioning, so they are exchanged once.
    hashed = docs.withColumn(HASH, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    texts = squeezed_docs(hashed, dict.fromkeys([*keep, id_col, HASH]), text_col)
    same_id = F.col(id_col).cast("long") == F.col(ID)
    open_ = texts.join(found, same_id, "left")
    hot = docs.sparkSession.sparkContext.broadcast(hot_anchors(slim, length))
    sent = open_.mapInArrow(_candidates(hot, length, shards, id_col), _SENT_DDL)
    gone = sent.groupBy("shard").applyInArrow(_resolve(length, shards), _MARK_DDL)
    marks = gone.groupBy("part").applyInArrow(_per_document, f"{ID} long, {TEXTS} binary, {STARTS} binary, {SIZES} binary")
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return texts.join(marks, same_id, "left").mapInArrow(_cut(length, keep), f"{schema}, {KEPT} binary, {BYTES} long, {REMOVED} long, {SPANS} long")
