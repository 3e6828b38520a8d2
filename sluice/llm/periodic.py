"""Periodic runs of words, by Crochemore's partition refinement.

Positions of a text are split into classes of equal factors of 1, 2, 3, ... words. A class of one
length splits by the classes of the positions that follow; of the parts that a class fell into at the
step before, all but the largest are looked at (the smaller halves), so a text of n words takes
n log n looks in all, however long its repeats are. A position knows its next neighbour in its class.
Where that is as far away as the factors are long, a square begins; squares of one period at
positions in a row are one run.

A run of at least four periods has three members or more in each class on the way there, so
smaller classes are left at once. Many texts are refined side by side, as numpy arrays; texts of like
length go together, as the longest decides how many steps are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import P

#: Bytes of text that are refined together, at least one text.
TOGETHER = 1 << 23
#: Whole periods that a run has at least, and words.
PERIODS, SHORTEST = 4, 6
RUNS, COLLAPSED, WORDS = f"{P}runs", f"{P}collapsed", f"{P}words"
_NONE = np.zeros(0, np.int64)


def _within(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of stretches that begin there and are that long."""
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


def squares(word: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, period) of the squares of primitive words with periods up to last, those in classes of
    three or more. word: a number for each position, with -1 after each text; texts share no number."""
    n = len(word)
    order = np.argsort(word, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], np.diff(word[order]) != 0])) if n else _NONE
    size = np.diff(np.append(new, n))
    large = (size >= 3) & (word[order[new]] >= 0)
    # Members of class c are perm[seg[c] : seg[c] + many[c]], in any order; loc is where they stand.
    perm, size = order[np.repeat(large, size)], size[large]
    seg, many = (np.zeros(2 * len(perm) + 2, np.int64) for _ in range(2))
    classes = len(size)
    many[:classes], seg[:classes] = size, np.cumsum(size) - size
    label = np.repeat(np.arange(classes), size)
    cls, after, before = (np.full(n, -1, np.int64) for _ in range(3))
    loc, since, hit = np.zeros(n, np.int64), np.ones(n, np.int32), np.zeros(n + 1, bool)
    cls[perm], loc[perm] = label, np.arange(len(perm))
    same = np.flatnonzero(label[1:] == label[:-1])
    after[perm[same]], before[perm[same + 1]] = perm[same + 1], perm[same]
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def told(x: np.ndarray, until: int) -> None:
        """Squares at x that were there at the step of their own length, which is before until."""
        d = after[x] - x
        ok = (after[x] >= 0) & (since[x] <= d) & (d < until)
        if ok.any():
            found.append((x[ok], d[ok]))

    todo, dead, step = perm.copy(), np.flatnonzero(cls < 0), 1
    while step < last and len(todo) + len(dead):
        step += 1
        follows = np.sort(np.concatenate([todo, dead]))
        follows = follows[1:] if len(follows) and follows[0] == 0 else follows
        follows = follows[cls[follows - 1] >= 0]
        if not len(follows):
            break
        x = follows - 1
        c, sub = cls[x], cls[follows]
        by = np.argsort(c * (classes + 1) + sub + 1, kind="stable")  # by class, part, position
        x, c, sub = x[by], c[by], sub[by]
        fresh_class = np.concatenate([[True], c[1:] != c[:-1]])
        g = np.flatnonzero(fresh_class | np.concatenate([[True], sub[1:] != sub[:-1]]))
        k = np.flatnonzero(fresh_class)
        g_size, k_size = np.diff(np.append(g, len(x))), np.diff(np.append(k, len(x)))
        g_class, own = c[g], c[k]
        g_k = np.cumsum(fresh_class)[g] - 1
        rest = many[own] - k_size
        alive = (sub[g] >= 0) & (g_size >= 3)
        best = np.maximum.reduceat(np.where(alive, g_size, 0), np.flatnonzero(fresh_class[g]))
        # The first of the largest parts of each class.
        is_best = alive & (g_size == best[g_k])
        is_best &= np.concatenate([[True], ~((g_class[1:] == g_class[:-1]) & (np.cumsum(is_best)[:-1] > (np.cumsum(is_best) - is_best)[np.flatnonzero(fresh_class[g])][g_k][1:]))])
        rest_lives, rest_dies = rest >= 3, (rest > 0) & (rest < 3)

        # Neighbours, as they will be: in a part, and in what is left of a class around what goes.
        in_part = np.repeat(alive, g_size)
        first, final = np.zeros(len(x), bool), np.zeros(len(x), bool)
        first[g], final[np.append(g[1:], len(x)) - 1] = True, True
        to = np.where(in_part & ~final, np.append(x[1:], -1), -1)
        back = np.where(in_part & ~first, np.concatenate([[-1], x[:-1]]), -1)
        changed = (to != after[x]) | ~in_part
        hit[x] = True
        some = np.repeat(rest > 0, k_size)
        s, e = x[some & ~hit[before[x]]], x[some & ~hit[after[x]]]  # hit[-1] is never set
        s, e = s[np.lexsort((s, cls[s]))], e[np.lexsort((e, cls[e]))]
        left, right = before[s], after[e]
        going = perm[_within(seg[own[rest_dies]], many[own[rest_dies]])]
        going = going[~hit[going]]
        told(x[changed], step)
        told(left[left >= 0], step)
        told(going, step)
        after[x], before[x] = to, back
        since[x[changed]] = step
        held = left >= 0
        after[left[held]], since[left[held]] = right[held], step
        before[right[right >= 0]] = left[right >= 0]

        # What goes moves to the end of its class's stretch of perm, part by part.
        tail = seg[own] + rest
        slots = _within(tail, k_size)
        there = perm[slots]
        stays = there[~hit[there]]
        vacant = loc[x][loc[x] < np.repeat(tail, k_size)]
        perm[vacant], loc[stays] = stays, vacant
        perm[slots], loc[x] = x, slots
        hit[x] = False
        many[own] = rest
        keeps = is_best & ~rest_lives[g_k]  # the class's own number goes on
        name = np.full(len(g), -1)
        fresh = alive & ~keeps
        name[keeps] = g_class[keeps]
        name[fresh] = classes + np.arange(int(fresh.sum()))
        classes += int(fresh.sum())
        seg[name[alive]], many[name[alive]] = slots[g[alive]], g_size[alive]
        cls[x] = np.repeat(name, g_size)
        cls[going] = -1
        dead = np.concatenate([x[~in_part], going])
        skip_rest = rest >= best
        part = alive & (skip_rest[g_k] | ~is_best)
        others = own[rest_lives & ~skip_rest]
        todo = np.concatenate([x[np.repeat(part, g_size)], perm[_within(seg[others], many[others])]])
    told(np.flatnonzero(cls >= 0), step + 1)
    if not found:
        return _NONE, _NONE
    x, d = (np.concatenate(v) for v in zip(*found, strict=True))
    by = np.lexsort((x, d))
    x, d = x[by], d[by]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (d[1:] != d[:-1])])
    return x[new], d[new]


def runs_of(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of the runs, by text, start and period. ids: a number for each
    distinct word, of all words; first: each text's first word, and the end."""
    found = []
    n = np.diff(first)
    rank = np.array([int(x).bit_length() // 3 for x in n])
    for r in np.unique(rank):
        mine = np.flatnonzero((rank == r) & (n >= SHORTEST))
        if not len(mine):
            continue
        size = n[mine]
        end = np.cumsum(size + 1)
        word = np.full(int(end[-1]), -1, np.int64)
        begin = end - size - 1
        at = _within(begin, size)
        which = np.repeat(np.arange(len(mine)), size)
        word[at] = ids[_within(first[mine], size)] + which * (int(ids.max()) + 1)
        x, d = squares(word, int(size.max()) // PERIODS)
        if not len(x):
            continue
        new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (x[1:] != x[:-1] + 1)]))
        row = np.append(new[1:], len(x)) - new
        start, period = x[new], d[new]
        length = row - 1 + 2 * period
        ok = length >= np.maximum(SHORTEST, PERIODS * period)
        start, length, period = start[ok], length[ok], period[ok]
        text = np.searchsorted(begin, start, "right") - 1
        found.append((mine[text], start - begin[text], length, period))
    if not found:
        return _NONE, _NONE, _NONE, _NONE
    out = [np.concatenate(v) for v in zip(*found, strict=True)]
    by = np.lexsort((out[3], out[1], out[0]))
    return tuple(v[by] for v in out)


def _found(keep: list[str], text_at: int):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for row0, data, at in tn.slices(batch.column(text_at), TOGETHER):
                starts, ends, first = tn.words(data, at)
                words = tn.packed(data, starts, ends).cast(pa.binary())
                ids = words.dictionary_encode().indices.to_numpy()
                text, start, length, period = runs_of(ids, first)
                # Words of a run after its first period go.
                begin = first[text] + start
                gone = tn.covered(len(ids), begin + period, length - period)
                kept = np.flatnonzero(~gone)
                cut = np.searchsorted(kept, first)
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), words.take(pa.array(kept))), b" ")
                runs = pa.StructArray.from_arrays([pa.array(v) for v in (start, length, period)], fields=list(kind))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(at))), pa.int32()), runs)
                some = batch.slice(row0, len(at) - 1)
                columns = [some.column(k) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(first)), lists, joined.cast(pa.string())], names=[*keep, WORDS, RUNS, COLLAPSED])

    return run


def find_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` of docs (all, if not given), and __sl_words, __sl_runs, __sl_collapsed.

    Words are `[^\\x20\\x09-\\x0D]+`. A run is a stretch of words with smallest period q (words q apart
    are equal) of at least 4q and 6 words that can't be extended to either side. __sl_runs: array of
    (start, length, period), by start and period; start is a word's number, from 0. __sl_words: the
    number of words. __sl_collapsed: the words that no run contains after its first period, joined by
    one space each.

    Null and empty texts have no words and no runs; __sl_collapsed is "". Each row stands for itself:
    ids may be null or repeated, and may have any type. A text is taken whole; a task needs some
    hundred bytes of memory for each word of TOGETHER bytes of text, or of one longer text.
    """
    keep = docs.columns if keep is None else keep
    some = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias(f"{P}text"))
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return some.mapInArrow(_found(keep, len(keep)), f"{schema}{WORDS} long, {RUNS} array<struct<start: long, length: long, period: long>>, {COLLAPSED} string")
