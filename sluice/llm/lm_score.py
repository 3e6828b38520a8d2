"""LM scoring with a hashed maximum-entropy model and a class-factored softmax.

    P(token | history) = P(class | history) * P(part | class, history) * P(token | part)

A token's class follows from its end (or all of it, if it is short), its part of the class from its
hash. Both softmaxes are log-linear: a bias, and a weight for each of four features of the tokens
before (the last, a skip to the one before it, both, a skip to the third last), hashed to rows. In
features a long word stands for its end. A part's tokens have their smoothed frequencies.

Training: counts of (feature, outcome) give the first weights; then each step takes a share of the
training documents, adds up expected less observed counts over all tasks, and moves the weights
against that gradient. All steps together see every training document once. A task works on batches
of rows of weights: only rows that a batch's features hit are gathered or changed.

Counts of tokens stay sharded by hash and are joined with the documents' tokens (gramjoin.py).
Tokens so frequent that fewer than `HEADS` of them can exist are broadcast instead.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gramjoin
from . import textnum as tn
from .common import materialize
from .repeats import shards_of, unzipped, zipped

CLASSES, PARTS = 64, 32
#: Rows of each feature in the two softmaxes.
ROWS, PART_ROWS = 1 << 13, 1 << 8
FEATURES = 4
HEADS = 20_000
#: Tokens a task gathers before it sends its counts on.
GATHER = 1 << 21
BLOCKS, GROUPS = 16, 64
#: Bytes of text that a task takes in training, at least, so that its sums stay small beside them.
TASK = 1 << 25
_U = np.uint64
_SALTS = [_U(x) for x in (0x9E6C63D0676A9A99, 0xB5AD4ECEDA1CE2A9, 0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5)]
#: Shapes of the two tables of weights; the last row (of each class) is the bias. Each token has one row
#: of the first feature, so what the bias counts is the sum of that feature's rows.
SHAPES = (FEATURES * ROWS + 1, CLASSES), (CLASSES * (FEATURES * PART_ROWS + 1), PARTS)


class History:
    """Of some tokens: the class and part of each, and the rows of its features in both tables."""

    def __init__(self, t: tn.Tokens):
        size = t.ends - t.starts
        kind, end = t.h.copy(), t.h.copy()
        long = size > 3
        kind[t.word[long]] = tn.span_hash(t.data, t.ends[long] - 2, t.ends[long]) ^ _U(5)
        long = size > 4
        end[t.word[long]] = tn.span_hash(t.data, t.ends[long] - 3, t.ends[long]) ^ _U(77)
        self.cls = (tn.mix(kind) % _U(CLASSES)).astype(np.int64)
        self.part = (tn.mix(t.h + _U(99)) % _U(PARTS)).astype(np.int64)
        last, skip, third = (t.before(k, end) for k in (1, 2, 3))
        hashed = [tn.mix(x ^ s) for x, s in zip((last, skip, last * tn.GRAM + skip, third), _SALTS, strict=True)]
        top = [(h >> _U(65 - ROWS.bit_length())).astype(np.int64) for h in hashed]
        base = self.cls * (FEATURES * PART_ROWS + 1)
        self.rows = [i * ROWS + f % ROWS for i, f in enumerate(top)]
        self.part_rows = [base + i * PART_ROWS + f % PART_ROWS for i, f in enumerate(top)]

    def both(self):
        """(rows, outcome) of each softmax."""
        return (self.rows, self.cls), (self.part_rows, self.part)


def _by_class(table: np.ndarray, i: int) -> np.ndarray:
    """Table i as (classes or 1, rows, outcomes)."""
    return table.reshape((1, CLASSES)[i], -1, SHAPES[i][1])


def with_bias(weights: list[np.ndarray]) -> list[np.ndarray]:
    """Weights with the bias added to the first feature's rows."""
    out = []
    for i, w in enumerate(weights):
        w = _by_class(w.copy(), i)
        w[:, : (ROWS, PART_ROWS)[i]] += w[:, -1:]
        out.append(w.reshape(SHAPES[i]))
    return out


def fill_bias(table: np.ndarray, i: int) -> None:
    """Sets the bias rows of counts to the sums of the first feature's rows."""
    t = _by_class(table, i)
    t[:, -1] = t[:, : (ROWS, PART_ROWS)[i]].sum(1, dtype=np.float64)


#: Tokens whose outcomes are worked on together, so few that they stay in the cache.
TOGETHER = 1 << 11


def _sums(weights: np.ndarray, rows: list[np.ndarray]):
    """(slice, sums) for some tokens at a time: the sum of a token's rows of weights (with_bias()).
    The sums are overwritten at the next step."""
    z, more = (np.empty((TOGETHER, weights.shape[1]), weights.dtype) for _ in range(2))
    for i in range(0, len(rows[0]), TOGETHER):
        some = slice(i, min(i + TOGETHER, len(rows[0])))
        own, other = z[: some.stop - i], more[: some.stop - i]
        np.take(weights, rows[0][some], 0, own, "clip")  # "clip": without it, numpy buffers the output
        for r in rows[1:]:
            np.take(weights, r[some], 0, other, "clip")
            own += other
        yield some, own


def softmax(weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """(tokens, outcomes): probabilities."""
    out = np.empty((len(rows[0]), weights.shape[1]), weights.dtype)
    ones = np.ones(weights.shape[1], weights.dtype)
    for some, z in _sums(weights, rows):
        # Sums of a few logarithms of frequencies: exp() can't overflow.
        np.exp(z, out=z)
        np.divide(z, (z @ ones)[:, None], out=out[some])
    return out


def excess(weights: np.ndarray, rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """(outcomes, tokens): probabilities, less one for what each token is. Turned while it is in the cache."""
    out = np.empty((weights.shape[1], len(y)), weights.dtype)
    ones = np.ones(weights.shape[1], weights.dtype)
    for some, z in _sums(weights, rows):
        np.exp(z, out=z)
        np.divide(z, (z @ ones)[:, None], out=z)
        z[np.arange(len(z)), y[some]] -= 1
        out[:, some] = z.T
    return out


def _add(out: np.ndarray, rows: list[np.ndarray], value: np.ndarray) -> None:
    """out[r, j] += value[j] for each r of rows, also where rows repeat."""
    every, weight = np.concatenate(rows), np.empty((len(rows), value.shape[1]))
    for j, column in enumerate(value):
        weight[:] = column  # as doubles, else bincount() makes a copy
        out[:, j] += np.bincount(every, weight.ravel(), len(out))


def held_out(id_, folds: int = 5, fold: int = 1) -> bool:
    return zlib.crc32(("" if id_ is None else str(id_)).encode()) % folds == fold


def _texts(batch, training: bool, step: tuple[int, int] | None = None):
    """Tokens of the batch's texts, and their row numbers in it; of training texts only if asked,
    and of those that belong to one of several steps."""
    ids = batch.column(0).to_pylist()
    if not training:
        rows = np.arange(len(ids))
    else:
        rows = np.array([i for i, x in enumerate(ids) if not held_out(x) and (step is None or zlib.crc32(f"step {x}".encode()) % step[1] == step[0])], np.int64)
    if not len(rows):
        return
    column = batch.column(1).take(pa.array(rows)) if training else batch.column(1)
    for row0, data, at in tn.slices(column, 1 << 18):
        yield rows[row0 : row0 + len(at) - 1], tn.Tokens(data, at)


_COUNTED = "shard long, part long, hashes binary, counts binary, parts binary"
_NAMES = ["shard", "part", "hashes", "counts", "parts"]


def _counted(shards: int):
    """Counts of training tokens, by shard, and counts of (feature, outcome) by block (shards below 0)."""

    def run(batches):
        joint = [np.zeros(shape[0] * shape[1], np.int64) for shape in SHAPES]
        held, tokens, size = [], [], 0
        for batch in batches:
            for _, t in _texts(batch, True):
                past = History(t)
                held.append([[(r * shape[1] + y).astype(np.int32) for r in rows] for (rows, y), shape in zip(past.both(), SHAPES, strict=True)])
                tokens.append((t.h, past.cls * PARTS + past.part))
                size += len(t.h)
                if len(held) == 16:
                    observe(joint, held)
                    held = []
                if size >= GATHER:
                    yield counts(tokens)
                    tokens, size = [], 0
        if held:
            observe(joint, held)
        if tokens:
            yield counts(tokens)
        yield from blocks(np.concatenate(joint).astype(np.int32), True)

    def observe(joint, held):
        for i in (0, 1):
            for f in range(FEATURES):
                joint[i] += np.bincount(np.concatenate([h[i][f] for h in held]), minlength=len(joint[i]))

    def counts(tokens):
        h, part = (np.concatenate(x) for x in zip(*tokens, strict=True))
        order = np.argsort(h)
        h, part = h[order], part[order]
        new, end = gramjoin._cuts(h)
        n, h, part = end - new, h[new], part[new]
        cut, end = gramjoin._cuts(gramjoin.shard_of(h, shards))
        blobs = [pa.array([pack(x[a:b]) for a, b in zip(cut, end, strict=True)], pa.binary()) for pack, x in ((np.ndarray.tobytes, h), (zipped, n.astype(np.int64)), (zipped, part.astype(np.uint16)))]
        key = gramjoin.shard_of(h[cut], shards)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.zeros(len(key), np.int64)), *blobs], names=_NAMES)

    return run


def blocks(cells: np.ndarray, whole: bool):
    """Cells in BLOCKS pieces, as rows of shard -1, -2, ... Tasks go in GROUPS groups, so that no
    reader gets a row from every task. Whole numbers go as they are, others as halves."""
    pack = (lambda x: zstandard.compress(x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)) if whole else (lambda x: zstandard.compress((x / 64).astype(np.float16).view(np.uint8).reshape(-1, 2).T.tobytes(), 1))
    none = pa.array([b""] * BLOCKS, pa.binary())
    part = TaskContext.get().partitionId() % GROUPS
    yield pa.RecordBatch.from_arrays([pa.array([-1 - i for i in range(BLOCKS)], pa.int64()), pa.array([part] * BLOCKS, pa.int64()), none, pa.array([pack(p) for p in np.array_split(cells, BLOCKS)], pa.binary()), none], names=_NAMES)


def _added(table: pa.Table, whole: bool | None) -> bytes:
    """The sum of the rows' cells, as float32. whole: how they are packed; None: as float32."""
    total = 0.0
    for x in table["counts"]:
        if whole is None:
            one = np.frombuffer(x.as_buffer(), np.float32)
        elif whole:
            one = np.frombuffer(zstandard.decompress(x.as_buffer()), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()
        else:
            one = np.frombuffer(zstandard.decompress(x.as_buffer()), np.uint8).reshape(2, -1).T.copy().view(np.float16).ravel().astype(np.float32) * 64
        total = total + one.astype(np.float64)
    return total.astype(np.float32).tobytes()


def _summed(whole: bool | None):
    def run(table: pa.Table) -> pa.Table:
        return pa.table({"shard": table["shard"].slice(0, 1), "counts": pa.array([_added(table, whole)], pa.binary())})

    return run


def cell_sum(rows: DataFrame) -> list[np.ndarray]:
    """The sums (shard, counts as float32) of all groups, as the two tables: they have a fixed size."""
    got = {r["shard"]: np.frombuffer(r["counts"], np.float32) for r in rows.groupBy("shard").applyInArrow(_summed(None), "shard long, counts binary").collect()}
    if not got:
        return [np.zeros(shape, np.float32) for shape in SHAPES]
    cells = np.concatenate([got[-1 - i] for i in range(BLOCKS)])
    first = SHAPES[0][0] * SHAPES[0][1]
    out = [cells[:first].reshape(SHAPES[0]), cells[first:].reshape(SHAPES[1])]
    for i, table in enumerate(out):
        fill_bias(table, i)
    return out


_MERGED = "shard long, hashes binary, counts binary, pos array<int>, tokens array<long>, types array<long>"


def _merged(table: pa.Table) -> pa.Table:
    """One shard: each token's count over all training texts, and tokens and types by part. Or one
    group of a block: its sum."""
    shard = table["shard"].slice(0, 1)
    if shard[0].as_py() < 0:
        none = [pa.array([None], pa.list_(t)) for t in (pa.int32(), pa.int64(), pa.int64())]
        return pa.table([shard, pa.array([None], pa.binary()), pa.array([_added(table, True)], pa.binary()), *none], names=["shard", "hashes", "counts", "pos", "tokens", "types"])
    h = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table["hashes"]])
    n, part = (np.concatenate([unzipped(x, k) for x in table[c]]) for c, k in (("counts", np.int64), ("parts", np.uint16)))
    order = np.argsort(h)
    h, n, part = h[order], n[order], part[order]
    new, _ = gramjoin._cuts(h)
    total, kind = np.add.reduceat(n, new), part[new].astype(np.int64)
    types = np.bincount(kind, minlength=CLASSES * PARTS)
    some = np.flatnonzero(types)
    lists = [pa.array([x.tolist()], pa.list_(t)) for x, t in ((some, pa.int32()), (np.bincount(kind, total, CLASSES * PARTS).astype(np.int64)[some], pa.int64()), (types[some], pa.int64()))]
    return pa.table([shard, pa.array([h[new].tobytes()], pa.binary()), pa.array([total.tobytes()], pa.binary()), *lists], names=["shard", "hashes", "counts", "pos", "tokens", "types"])


def _gradient(weights, step: tuple[int, int]):
    """Expected less observed counts of (feature, outcome) in this step's texts."""

    def run(batches):
        off = [np.zeros(shape, np.float32, order="F") for shape in SHAPES]
        for batch in batches:
            for _, t in _texts(batch, True, step):
                for w, out, (rows, y) in zip(weights.value, off, History(t).both(), strict=True):
                    _add(out, rows, excess(w, rows, y))
        yield from blocks(np.concatenate([x.ravel() for x in off]), False)

    return run


def _shares(joint: list[np.ndarray]) -> list[np.ndarray]:
    """Per table and row: the outcomes' smoothed shares without any feature."""
    out = []
    for n, groups in zip(joint, (1, CLASSES), strict=True):
        bias = n.reshape(groups, -1, n.shape[1])[:, -1:]
        share = (bias + 0.5) / (bias.sum(2, keepdims=True) + 0.5 * n.shape[1])
        out.append(np.broadcast_to(share, (groups, n.shape[0] // groups, n.shape[1])).reshape(n.shape))
    return out


def first_weights(joint: list[np.ndarray]) -> list[np.ndarray]:
    """Smoothed log ratios of a feature's outcome frequencies to all, less than whole, as features
    overlap. joint: counts of (feature, outcome)."""
    out = []
    for n, share, groups in zip(joint, _shares(joint), (1, CLASSES), strict=True):
        w = 0.4 * (np.log((n + 20 * share) / (n.sum(1, keepdims=True) + 20)) - np.log(share))
        bias = np.arange(1, groups + 1) * (n.shape[0] // groups) - 1
        w[bias] = np.log(share[bias])
        out.append(w.astype(np.float32))
    return out


def train(docs: DataFrame, joint: list[np.ndarray], tasks: int, steps: int = 2, rate: float = 0.05, decay: float = 1.0) -> list[np.ndarray]:
    """Weights of both softmaxes. docs: (id, text), in `tasks` tasks; joint: their counts. A weight
    moves by `rate` of the gradient (less a decay) over about what a step expects; features share it."""
    weights = first_weights(joint)
    docs = docs.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, tasks))
    scale = [n.sum(1, keepdims=True) * share / max(1, steps) + 30 for n, share in zip(joint, _shares(joint), strict=True)]
    for s in range(steps):
        sent = docs.sparkSession.sparkContext.broadcast(with_bias(weights))
        rows = docs.mapInArrow(_gradient(sent, (s, steps)), _COUNTED).groupBy("shard", "part").applyInArrow(_summed(False), "shard long, counts binary")
        moves = [-rate * (g + decay * w) / n for g, w, n in zip(cell_sum(rows), weights, scale, strict=True)]
        weights = [(w + np.clip(m, -1, 1)).astype(np.float32) for w, m in zip(weights, moves, strict=True)]
        sent.destroy()
    return weights


def log_probability(weights: list[np.ndarray], past: History) -> np.ndarray:
    """log10 of P(class | history) * P(part | class, history) of each token."""
    out = np.zeros(len(past.cls))
    for w, (rows, y) in zip(weights, past.both(), strict=True):
        ones = np.ones(w.shape[1], w.dtype)
        for some, z in _sums(w, rows):
            own = z[np.arange(len(z)), y[some]].astype(np.float64)
            np.exp(z, out=z)
            out[some] += own - np.log(z @ ones)
    return out / np.log(10)


def _scored(model, shards: int):
    """Texts with what is known here (softmaxes, head tokens) and their other tokens to the shards."""

    def pieces(batches):
        weights, norm, head, head_log = model.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for rows, t in _texts(batch, False):
                past = History(t)
                part = log_probability(weights, past) - norm[past.cls * PARTS + past.part]
                at = np.searchsorted(head, t.h)
                at[at == len(head)] = 0
                is_head = head[at] == t.h if len(head) else np.zeros(len(t.h), bool)
                n = len(rows)
                known_log = np.bincount(t.row[is_head], head_log[at[is_head]], n) if len(head) else np.zeros(n)
                own = {"id": np.array([ids[i] for i in rows.tolist()], object), "units": np.ones(n, np.int64), "tokens": np.diff(t.first), "known": np.bincount(t.row[is_head], minlength=n), "part": np.bincount(t.row, part, n), "log": known_log}
                yield t.h[~is_head], t.row[~is_head], n, own

    return lambda batches: gramjoin.send(pieces(batches), shards)


HALF = float(np.log10(0.5))


def _weights(table: pa.Table) -> pa.Table:
    """One shard's counts as the weights that are joined: log10(c + 0.5) over that of no count, and 1."""
    n = np.frombuffer(table["counts"][0].as_buffer(), np.int64)
    return pa.table({"shard": table["shard"], "hashes": table["hashes"], "weights": pa.array([np.stack([np.log10(n + 0.5) - HALF, np.ones(len(n))], 1).tobytes()], pa.binary())})


def _finish(total: int, types: int):
    unit = float(np.log10(total + 0.5 * (types + 1)))

    def run(own: dict, sums: np.ndarray) -> pa.Table:
        ids, tokens = own["id"].tolist(), own["tokens"]
        logs = sums[:, 0] + own["log"] + tokens * HALF
        known = own["known"] + np.rint(sums[:, 1]).astype(np.int64)
        return pa.table({"id": pa.array(ids, pa.int64()), "held_out": pa.array([held_out(i) for i in ids]), "n_tokens": pa.array(tokens), "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(ids), total)), "base_score": pa.array(logs - unit * tokens), "score": pa.array(logs + own["part"])})

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", steps: int = 2) -> DataFrame:
    """One row per row of docs: id_col, held_out, n_tokens, n_known, train_tokens, base_score (the
    smoothed unigram's) and score (the model's log10 probability of the text).

    Tokens are words, A-Z lower-cased, and one end per text; null text has the end alone.
    Learned from texts whose crc32 of the id as text isn't 1 modulo 5; a null id counts as "".
    Repeated rows count as they stand. Ids are whole numbers. Without training texts all
    tokens are unknown. Tokens are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    tasks, shards = size // TASK + 1, shards_of(size, 1 << 24)
    few = slim.coalesce(max(spark.sparkContext.defaultParallelism, tasks))
    merged = materialize(few.mapInArrow(_counted(shards), _COUNTED).groupBy("shard", "part").applyInArrow(_merged, _MERGED))
    counts = merged.filter("shard >= 0")
    by_part = counts.select(F.explode(F.arrays_zip("pos", "tokens", "types")).alias("x")).groupBy("x.pos").agg(F.sum("x.tokens").alias("n"), F.sum("x.types").alias("v"))
    tokens, types = np.zeros(CLASSES * PARTS, np.int64), np.zeros(CLASSES * PARTS, np.int64)
    for r in by_part.collect():  # CLASSES * PARTS rows
        tokens[r["pos"]], types[r["pos"]] = r["n"], r["v"]
    total, kinds = int(tokens.sum()), int(types.sum())
    weights = train(slim, cell_sum(merged.filter("shard < 0").select("shard", "counts")), tasks, steps)
    least = max(1, -(-total // HEADS))
    heads = counts.select("hashes", "counts").mapInArrow(_frequent(least), "hash long, n long").toArrow()  # HEADS rows at most
    order = np.argsort(heads["hash"].to_numpy().view(np.uint64)) if heads.num_rows else np.zeros(0, np.int64)
    head, head_n = (heads[c].to_numpy()[order] if heads.num_rows else np.zeros(0, np.int64) for c in ("hash", "n"))
    norm = np.log10(tokens + 0.5 * (types + 1))
    model = spark.sparkContext.broadcast((with_bias(weights), norm, head.view(np.uint64), np.log10(head_n + 0.5) - HALF))
    table = counts.select("shard", "hashes", "counts").groupBy("shard").applyInArrow(_weights, gramjoin.TABLE)
    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return gramjoin.sums(slim.mapInArrow(_scored(model, shards), gramjoin.SENT), table, 2, np.float64, _finish(total, kinds), schema).withColumnRenamed("id", id_col)


def _frequent(least: int):
    def run(batches):
        for batch in batches:
            for h, n in zip(batch.column(0), batch.column(1), strict=True):
                h, n = np.frombuffer(h.as_buffer(), np.int64), np.frombuffer(n.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h[n >= least]), pa.array(n[n >= least])], names=["hash", "n"])

    return run
