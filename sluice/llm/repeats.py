"""What occurs in a corpus more than once, by two Bloom planes for each range of hashes.

A task gathers hashes (of lines, grams, anchors) with the ids of their documents. What repeats in
one gathering is suspected at once; each hash goes on once, to the shard of its range, packed with
others. A shard has two bit planes, as large as the number of its hashes asks for: a bit of the first
says that a hash was seen there, a bit of the second that one was seen there again. Hashes with all
their bits in the second plane are suspected, and go back to their documents, packed by id.

So nothing goes through the driver, planes never fill up, and a hash that very many documents
have moves once per gathering.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn

HASHES = 2
BITS_EACH = 8
#: Hashes that a task gathers before it sends them on.
GATHER = 1 << 19
_U = np.uint64
_NAMES = ["shard", "part", "ids", "hashes", "again", "which"]
_DDL = "shard long, part long, ids binary, hashes binary, again binary, which binary"


def zipped(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def unzipped(blob, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob.as_buffer() if isinstance(blob, pa.Scalar) else blob), kind)


def steps(x: np.ndarray) -> bytes:
    """Ascending uint32 as their differences, byte by byte, compressed."""
    return zstandard.compress(np.diff(x, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unsteps(blob) -> np.ndarray:
    d = np.frombuffer(zstandard.decompress(blob.as_buffer()), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return np.cumsum(d, dtype=np.int64).astype(np.uint32)


def shards_for(docs: DataFrame, text_col: str, each: int = 1 << 23) -> int:
    """A power of two: a shard for each `each` bytes of text; a million at most, so that a shard of 100 TB
    has 100 MB of text."""
    return shards_of(docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0, each)


def shards_of(size: int, each: int) -> int:
    return 1 << min(20, max(5, int(size // each).bit_length()))


def gathered(shards: int) -> int:
    """Hashes that a task gathers: some for each shard, so that packed rows don't become single hashes."""
    return max(GATHER, 4 * shards)


def short(h: np.ndarray, shards: int) -> np.ndarray:
    """The 32 bits of a hash below those that its shard is chosen by."""
    return ((h << _U(shards.bit_length() - 1)) >> _U(32)).astype(np.uint32)


def _by(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of equal keys."""
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return cut, np.append(cut[1:], len(key))[: len(cut)]


def _suspects(ids: np.ndarray, h32: np.ndarray, parts: int) -> pa.RecordBatch:
    """Suspected hashes, packed by part of the documents; such rows have a part, and pass through any shard."""
    part = (tn.mix(ids.astype(np.uint64)) % _U(parts)).astype(np.int64)
    order = np.lexsort((ids, part))
    part, ids, h32 = part[order], ids[order], h32[order]
    cut, end = _by(part)
    none = pa.array([None] * len(cut), pa.binary())
    blobs = [pa.array([zipped(x[a:b]) for a, b in zip(cut, end, strict=True)], pa.binary()) for x in (ids, h32)]
    return pa.RecordBatch.from_arrays([pa.array(part[cut]), pa.array(part[cut]), *blobs, none, none], names=_NAMES)


def _sent(hashes, shards: int):
    most = gathered(shards)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for h, row in hashes(batch):
                held.append((h.view(np.uint64), ids[row]))
                size += len(h)
                if size >= most:
                    yield from send(held)
                    held, size = [], 0
        if size:
            yield from send(held)

    def send(held):
        h, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(h)
        h, ids = h[order], ids[order]
        cut, end = _by(h)
        more = np.repeat(end - cut > 1, end - cut)
        if more.any():
            yield _suspects(ids[more], short(h[more], shards), shards)
        again, h, ids = end - cut > 1, h[cut], ids[cut]
        bits = shards.bit_length() - 1
        key = (h >> _U(64 - bits)).astype(np.int64)
        below = short(h, shards)  # ascending in a shard
        cut, end = _by(key)
        columns: list[list] = [[] for _ in range(4)]
        for a, b in zip(cut, end, strict=True):
            once = ids[a:b][~again[a:b]]
            own, which = np.unique(once, return_inverse=True)
            for out, x in zip(columns, (zipped(np.diff(own, prepend=0)), steps(below[a:b]), zipped(np.packbits(again[a:b])), zipped(which.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)), strict=True):
                out.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(key[cut]), pa.array([None] * len(cut), pa.int64()), *(pa.array(c, pa.binary()) for c in columns)], names=_NAMES)

    return run


def planes(pieces, bits: int) -> np.ndarray:
    """The second plane: bits where some hash was seen again. pieces: (places, again) of each
    gathering, where places is (HASHES, n)."""
    once, twice = np.zeros(1 << bits, bool), np.zeros(1 << bits, bool)
    for places, again in pieces:
        # Both places of one hash may agree; that alone is not a repeat.
        same = places[0] == places[1]
        p = np.concatenate([places[0], places[1][~same]])
        more = np.concatenate([again, again[~same]])
        p_sorted = np.sort(p)
        twice[p_sorted[1:][p_sorted[1:] == p_sorted[:-1]]] = True
        twice[p[once[p] | more]] = True
        once[p] = True
    return twice


def places(h32: np.ndarray, bits: int) -> np.ndarray:
    """HASHES places of each hash in a plane of 2**bits bits."""
    h = tn.mix(h32.astype(np.uint64) + _U(1))
    return np.stack([h >> _U(64 - bits), h & _U((1 << bits) - 1)]).astype(np.int64)


def plane_bits(n: int) -> int:
    return max(10, int(np.ceil(np.log2(max(1, n) * BITS_EACH))))


def _looked_up(shards: int):
    """One shard: which hashes are suspected. Rows with a part pass through."""

    def run(table: pa.Table) -> pa.Table:
        known = pc.is_valid(table["part"])
        done = table.filter(known).select(["part", "ids", "hashes"])
        rest = table.filter(pc.invert(known))
        if not rest.num_rows:
            return done
        below = [unsteps(x) for x in rest["hashes"]]
        again = [np.unpackbits(unzipped(x, np.uint8), count=len(b)).view(bool) for x, b in zip(rest["again"], below, strict=True)]
        size = plane_bits(sum(map(len, below)))
        twice = planes(((places(b, size), a) for b, a in zip(below, again, strict=True)), size)
        ids, found = [], []
        for b, a, own, which in zip(below, again, rest["ids"], rest["which"], strict=True):
            b = b[~a]
            hit = twice[places(b, size)].all(0)
            if hit.any():
                which = unzipped(which, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
                ids.append(np.cumsum(unzipped(own, np.int64))[which[hit]])
                found.append(b[hit])
        if not ids:
            return done
        return pa.concat_tables([done, pa.Table.from_batches([_suspects(np.concatenate(ids), np.concatenate(found), shards)]).select(["part", "ids", "hashes"])])

    return run


def _per_document(table: pa.Table) -> pa.Table:
    ids = np.concatenate([unzipped(x, np.int64) for x in table["ids"]])
    h = np.concatenate([unzipped(x, np.uint32) for x in table["hashes"]])
    order = np.lexsort((h, ids))
    ids, h = ids[order], h[order]
    new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (h[1:] != h[:-1])])
    ids, h = ids[new], h[new]
    cut, end = _by(ids)
    return pa.table({"id": pa.array(ids[cut]), "found": pa.array([steps(h[a:b]) for a, b in zip(cut, end, strict=True)], pa.binary())})


def suspected(rows: DataFrame, hashes, shards: int) -> DataFrame:
    """(id, found): of each id that has some, the 32-bit short() forms of those of its hashes that may
    occur more than once; none that does is missing.

    rows: id (a whole number, not null) first. hashes(batch): yields (64-bit hashes, row of each).
    """
    sent = rows.mapInArrow(_sent(hashes, shards), _DDL)
    told = sent.groupBy("shard").applyInArrow(_looked_up(shards), "part long, ids binary, hashes binary")
    return told.groupBy("part").applyInArrow(_per_document, "id long, found binary")


def is_suspected(h: np.ndarray, row: np.ndarray, found, shards: int) -> np.ndarray:
    """Which hashes are among the suspected of their row. found: the binary of each row, or null."""
    known = [np.zeros(0, np.int64)]
    for r, blob in enumerate(found):
        if blob.is_valid:
            known.append((r << 32) | unsteps(blob).astype(np.int64))
    known = np.concatenate(known)  # ascending
    if not len(known):
        return np.zeros(len(h), bool)
    mine = (row.astype(np.int64) << 32) | short(h, shards).astype(np.int64)
    at = np.searchsorted(known, mine)
    at[at == len(known)] = 0
    return known[at] == mine
