"""Sums over the n-grams of texts of what a table says of each n-gram: a join that is sharded by hash.

A task gathers texts. Each n-gram of a gathering goes once to the shard of its hash, packed with
others, with the units (texts, or passages of texts) that hold it; the shard looks it up and sends
back one sum for each unit. What a gathering knows itself travels with it. So no row per occurrence
moves, and neither the table nor a text's n-grams have to be in one place.

Gatherings are runs of a partition's rows, so the rows must come in the same order if a task runs
again: from files, as a scan gives them. If they don't, sums fail to match what was sent, and the
job fails instead of giving wrong results.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .repeats import unzipped, zipped

#: Occurrences that a task gathers before it sends them on.
GATHER = 1 << 20
_U = np.uint64
_SENT = ["gather", "shard", "hashes", "times", "units", "counts", "own"]
SENT = "gather long, shard long, hashes binary, times binary, units binary, counts binary, own binary"
TABLE = "shard long, hashes binary, weights binary"


def _cuts(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return cut, np.append(cut[1:], len(key))[: len(cut)]


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (h >> _U(64 - (shards.bit_length() - 1))).astype(np.int64)


def packed_table(rows: DataFrame, weights: list[str], shards: int, kind) -> DataFrame:
    """(shard, hashes, weights) of rows (hash, ...): the table that sums() looks up."""

    def run(table: pa.Table) -> pa.Table:
        h = table["hash"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        w = np.stack([table[c].to_numpy() for c in weights], 1).astype(kind)
        return pa.table({"shard": table["shard"].slice(0, 1), "hashes": pa.array([h[order].tobytes()], pa.binary()), "weights": pa.array([w[order].tobytes()], pa.binary())})

    bits = shards.bit_length() - 1
    return rows.withColumn("shard", F.shiftrightunsigned("hash", 64 - bits)).groupBy("shard").applyInArrow(run, TABLE)


def send(pieces, shards: int):
    """Batches to the shards. pieces: yields (hashes, unit of each, units, own): of some texts the
    n-grams to look up, how many units they make, and what is known of them, as a dictionary of
    arrays."""
    base, seq = TaskContext.get().partitionId() << 24, 0
    held, size, units = [], 0, 0
    for h, unit, n, own in pieces:
        held.append((h, units + unit, own))
        units += n
        size += len(h) + n
        if size >= GATHER:
            yield _packed(base | seq, held, shards)
            seq, held, size, units = seq + 1, [], 0, 0
    if held:
        yield _packed(base | seq, held, shards)


def _packed(gather: int, held, shards: int) -> pa.RecordBatch:
    h, unit = (np.concatenate([p[i] for p in held]) for i in (0, 1))
    # By hash, then unit. Hashes that agree but for their lowest bits may come in turns.
    low = _U((1 << max(1, int(unit.max(initial=0)).bit_length())) - 1)
    order = np.argsort((h & ~low) | unit.astype(np.uint64))
    h, unit = h[order], unit[order]
    new, end = _pair_cuts(h, unit)
    n, h, unit = (end - new).astype(np.uint32), h[new], unit[new].astype(np.uint32)
    cut, end = _cuts(shard_of(h, shards))
    columns: list[list] = [[] for _ in range(4)]
    for a, b in zip(cut, end, strict=True):
        first, last = _cuts(h[a:b])
        for out, x in zip(columns, (h[a:b][first].tobytes(), zipped((last - first).astype(np.uint32)), zipped(unit[a:b]), zipped(n[a:b])), strict=True):
            out.append(x)
    own = {k: np.concatenate([np.asarray(p[2][k]) for p in held]) for k in held[0][2]}
    # The gathering's name depends on what is in it, so that other contents can't be taken for these.
    stamp = np.bitwise_xor.reduce(tn.mix(h + unit * tn.GRAM)) if len(h) else _U(0)
    gather = int(tn.mix(np.array([stamp + _U(gather)]))[0] >> _U(1))
    # Its own row passes through a shard, too; it says how many sums are to come.
    own_row = pickle.dumps((len(cut), own), protocol=pickle.HIGHEST_PROTOCOL)
    m = len(cut) + 1
    blobs = [pa.array([*c, None], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array([gather] * m, pa.int64()), pa.array([*shard_of(h[cut], shards).tolist(), gather % shards], pa.int64()), *blobs, pa.array([None] * len(cut) + [own_row], pa.binary())], names=_SENT)


def _pair_cuts(h: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (unit[1:] != unit[:-1])])) if len(h) else np.zeros(0, np.int64)
    return cut, np.append(cut[1:], len(h))[: len(cut)]


def _looked_up(k: int, kind):
    """One shard: the sums of its table's weights for each gathering's units. Own rows pass through."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        through = left.filter(pc.is_valid(left["own"]))
        left = left.filter(pc.is_null(left["own"]))
        if right.num_rows:
            have, w = np.frombuffer(right["hashes"][0].as_buffer(), np.uint64), np.frombuffer(right["weights"][0].as_buffer(), kind).reshape(-1, k)
        else:
            have, w = np.zeros(0, np.uint64), np.zeros((0, k), kind)
        gathers, units, sums = [], [], []
        for gather, h, times, unit, n in zip(*(left[c] for c in ("gather", "hashes", "times", "units", "counts")), strict=True):
            h = np.frombuffer(h.as_buffer(), np.uint64)
            times, unit, n = (unzipped(x, np.uint32) for x in (times, unit, n))
            at = np.searchsorted(have, h)
            at[at == len(have)] = 0
            found = np.repeat(have[at] == h if len(have) else np.zeros(len(h), bool), times)
            some, which = np.unique(unit[found], return_inverse=True)
            place, n = np.repeat(at, times)[found], n[found]
            gathers.append(gather.as_py())
            units.append(zipped(some))
            sums.append(np.stack([np.bincount(which, w[place, i] * n, len(some)) for i in range(k)], 1).tobytes() if len(some) else b"")
        none = pa.array([None] * through.num_rows, pa.binary())
        return pa.table({
            "gather": pa.array(gathers + through["gather"].to_pylist(), pa.int64()),
            "units": pa.concat_arrays([pa.array(units, pa.binary()), none]),
            "sums": pa.concat_arrays([pa.array(sums, pa.binary()), none]),
            "own": pa.concat_arrays([pa.array([None] * len(units), pa.binary()), *through["own"].cast(pa.binary()).chunks]),
        })

    return run


def _gathered(k: int, finish):
    def run(table: pa.Table) -> pa.Table:
        own = table.filter(pc.is_valid(table["own"]))
        rest = table.filter(pc.is_null(table["own"]))
        to_come, known = pickle.loads(own["own"][0].as_py()) if own.num_rows == 1 else (-1, None)
        if to_come != rest.num_rows:
            raise RuntimeError("a task that ran again has met its rows in another order; write them to files first")
        total = np.zeros((int(known["units"].sum()), k))
        for units, sums in zip(rest["units"], rest["sums"], strict=True):
            total[unzipped(units, np.uint32)] += np.frombuffer(sums.as_buffer(), np.float64).reshape(-1, k)
        return finish(known, total)

    return run


def sums(sent: DataFrame, table: DataFrame, k: int, kind, finish, schema: str) -> DataFrame:
    """What finish(own, sums) makes of each gathering: own as it was sent (with `units`, the number of
    units of each text), and an array of k sums for each unit.

    sent: of send(), by SENT. table: of packed_table(), weights of `kind`, k for each hash.
    """
    found = sent.groupBy("shard").cogroup(table.groupBy("shard")).applyInArrow(_looked_up(k, kind), "gather long, units binary, sums binary, own binary")
    return found.groupBy("gather").applyInArrow(_gathered(k, finish), schema)
