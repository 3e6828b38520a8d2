"""Texts of an Arrow batch as numpy arrays: words, their hashes, grams and window minima.

All of it works on the UTF-8 bytes of a slice of some megabytes at a time, so memory is bound
by the slice (or one text, if that is longer) and not by the batch.
"""

from __future__ import annotations

import ctypes
import zlib

import numpy as np
import pyarrow as pa
import zstandard

SLICE = 1 << 19
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: Of a second hash, which tells spans apart that the first one doesn't.
_OTHER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}
GRAM = np.uint64(0xD6E8FEB86659FD93)

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of `[^\x20\x09-\x0D]+`.
WORD = ~BLANK
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[0x0A] = False
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20


def _power(name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        step = np.full(max(n, SLICE + 1), _BASE if name == "up" else _INV)
        step[0] = 1
        have = _powers[name] = np.cumprod(step, dtype=np.uint64)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(at) else np.zeros(0, np.uint8)
    return raw, at - (at[0] if len(at) else 0)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except AttributeError:  # another C library
    _trim = None


def give_back() -> None:
    """Return freed memory to the system: idle workers keep what their largest batch took, else."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(column: pa.Array, limit: int = SLICE):
    """Yield (first row, bytes, offsets) of runs of rows of about limit bytes."""
    data, at = buffers(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last
    give_back()


def pieces(column: pa.Array, inside: np.ndarray, limit: int = SLICE):
    """As slices(), but a text longer than two limits comes in several slices, each cut after a byte
    that is not `inside`."""
    for row, data, at in slices(column, limit):
        a = 0
        while len(at) == 2 and len(data) - a > 2 * limit:
            b = a + limit
            while b < len(data):
                out = np.flatnonzero(~inside[data[b : b + limit]])
                if len(out):
                    b += int(out[0]) + 1
                    break
                b = min(b + limit, len(data))
            yield row, data[a:b], np.array([0, b - a])
            a = b
        if not a:
            yield row, data, at
        elif a < len(data):
            yield row, data[a:], np.array([0, len(data) - a])


def words(data: np.ndarray, at: np.ndarray, kind: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the words, and each text's first word number."""
    return spans(kind[data], at)


def spans(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the stretches of bytes that are inside."""
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    edges = at[(at > 0) & (at < len(inside))]
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def lines(data: np.ndarray, at: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, texts): byte spans of the lines, less blanks at their ends, that have at least
    min_chars code points, and the text of each."""
    starts, ends, first = words(data, at, NOT_NEWLINE)
    row = text_of(first, len(starts))
    solid = np.flatnonzero(WORD[data])
    a = np.searchsorted(solid, starts)
    b = np.searchsorted(solid, ends)
    some = np.flatnonzero(b > a)
    starts, ends, row = solid[a[some]], solid[b[some] - 1] + 1, row[some]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    long = points[ends] - points[starts] >= min_chars
    return starts[long], ends[long], row[long]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span; equal bytes, equal hash. second: another one."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_OTHER if second else _BYTE)[data] * _power("up", len(data) + 1)[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * _power("down", len(data) + 1)[starts])


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as a binary array."""
    size = ends - starts
    to = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=to[1:])
    taken = data[np.arange(to[-1]) + np.repeat(starts - to[:-1], size)]
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(to), pa.py_buffer(np.ascontiguousarray(taken))])


_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)
#: Spans longer than this get their crc32 one by one.
LANE = 64


def crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """The crc32 of each byte span, going on from the crc32 of what stands before it."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    long = int(np.searchsorted(-size[order], -LANE))
    out = np.zeros(len(size), np.uint32)
    for i in order[:long]:
        out[i] = zlib.crc32(data[starts[i] : ends[i]].data, int(begun[i]))
    order = order[long:]
    size, at = size[order], starts[order]
    state = begun[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k))  # those with more than k bytes
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + k]) & 0xFF] ^ (state[:n] >> 8)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k neighbours, as many as len(h) - k + 1; text borders are the caller's."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = h[:n].copy()
    for j in range(1, k):
        g *= GRAM
        g += h[j : j + n]
    return mix(g)


def gram_rows(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the n grams lie in one text."""
    ok = np.ones(n, bool)
    for j in range(1, k):
        cut = first[1:-1] - j
        ok[cut[(cut >= 0) & (cut < n)]] = False
    return ok


def text_of(first: np.ndarray, n: int) -> np.ndarray:
    """The text number of each of n words."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]


def window_min(g: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours."""
    m, have = g, 1
    while have < w:
        step = min(have, w - have)
        m = np.minimum(m[:-step], m[step:])
        have += step
    return m


def window_max(g: np.ndarray, w: int) -> np.ndarray:
    m, have = g, 1
    while have < w:
        step = min(have, w - have)
        m = np.maximum(m[:-step], m[step:])
        have += step
    return m


def chosen(g: np.ndarray, w: int) -> np.ndarray:
    """Which grams are the least of some window of w grams. Of grams that share a window of w,
    each run of w has one of these at least, and equal runs have the same."""
    if len(g) < w:
        return np.zeros(len(g), bool)
    # The greatest of the minima of all windows around a gram: its own value if it is one of them.
    m = np.zeros(len(g) + w - 1, g.dtype)
    m[w - 1 : len(g)] = window_min(g, w)
    return window_max(m, w) == g


def covered(n: int, starts: np.ndarray, lengths) -> np.ndarray:
    """Which of n places lie in a span that begins at starts."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.subtract.at(step, np.minimum(starts + lengths, n), 1)
    return np.cumsum(step[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of True."""
    step = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def whole_groups(batches, n_keys: int):
    """(table, cuts): rows of whole groups, and where each begins and the last ends. Batches are
    sorted by their first n_keys columns."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        new = np.ones(table.num_rows, bool)
        keys = [table.column(i).to_numpy() for i in range(n_keys)]
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        cut = np.flatnonzero(new)
        if len(cut) > 1:
            yield table.slice(0, cut[-1]).combine_chunks(), cut
        held = table.slice(cut[-1])
    if held is not None:
        yield held.combine_chunks(), np.array([0, held.num_rows])


def squeezed(batches, text: int):
    """Batches with the text column compressed, row by row, for an exchange."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, at = buffers(batch.column(text))
        blobs = pa.array([pack.compress(data[a:b].data) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
        yield batch.set_column(text, batch.schema.names[text], blobs)


def unsqueezed(column: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return pa.array([unpack.decompress(x.as_buffer()) for x in column], pa.large_binary())


END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


class Tokens:
    """Tokens of some texts: words with A-Z lower-cased, and an end each. h: their hashes; first: per
    text; row, place: of each token its text and its place there."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        data = LOWERED[data]
        starts, ends, first = words(data, at)
        n = len(at) - 1
        self.data, self.starts, self.ends = data, starts, ends
        self.first = first + np.arange(n + 1)
        #: Where the words are among the tokens.
        self.word = np.arange(len(starts)) + text_of(first, len(starts))
        self.h = np.full(len(starts) + n, END)
        self.h[self.word] = span_hash(data, starts, ends)
        self.row = np.repeat(np.arange(n), np.diff(self.first))
        self.place = np.arange(len(self.h)) - self.first[:-1][self.row]

    def before(self, k: int, of: np.ndarray | None = None) -> np.ndarray:
        """The token (or what `of` has for it) k places before each, or BEGIN."""
        of = self.h if of is None else of
        out = np.full(len(of), BEGIN)
        out[k:] = of[:-k] if len(of) > k else BEGIN
        out[self.place < k] = BEGIN
        return out
