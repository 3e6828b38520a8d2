"""Line dedup with two Bloom filters.

Hashes of all lines go to bit planes by hash range (repeats.py): a bit of the first plane says that
a hash was seen there, a bit of the second that one was seen there again. Only lines whose every
bit is in the second plane may repeat; only those shuffle with their text, for an exact count by
their key and the choice of the document that keeps it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum as tn
from .common import P, SQUEEZED, squeezed_docs
from .repeats import is_suspected, shards_for, suspected

FOUND, LOST, TOTAL, DROPPED = f"{P}found", f"{P}lost", f"{P}total", f"{P}dropped"


def _keys(column: pa.Array, min_chars: int):
    """(first row, lower-cased bytes, starts, ends, row, hash) of the lines that are long enough."""
    for row0, data, at in tn.slices(column):
        data = tn.LOWERED[data]
        starts, ends, row = tn.lines(data, at, min_chars)
        yield row0, data, starts, ends, row, tn.span_hash(data, starts, ends)


def _hashes(min_chars: int):
    def run(batch):
        for row0, _, _, _, row, h in _keys(batch.column(1), min_chars):
            yield h, row0 + row

    return run


def _suspected_lines(min_chars: int, shards: int, id_: str):
    """(id, key, hash) of the suspected lines."""

    def run(batches):
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            some = np.flatnonzero(get(FOUND).is_valid())
            if not len(some):
                continue
            ids, found = get(id_).take(pa.array(some)), get(FOUND).take(pa.array(some))
            for row0, data, starts, ends, row, h in _keys(tn.unsqueezed(get(SQUEEZED).take(pa.array(some))), min_chars):
                hit = np.flatnonzero(is_suspected(h, row, found.slice(row0, int(row.max(initial=-1)) + 1), shards))
                keys = [data[a:b].tobytes() for a, b in zip(starts[hit].tolist(), ends[hit].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row0 + row[hit])).cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(h[hit].view(np.int64))], names=["id", "key", "hash"])

    return run


def _cut(min_chars: int, keep: list[str]):
    def run(batches):
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            lost = get(LOST)
            texts, total, dropped = [], [], []
            for row0, data, at in tn.slices(tn.unsqueezed(get(SQUEEZED))):
                gone: dict[int, list[int]] = {}
                if len(lost.slice(row0, len(at) - 1)) - lost.slice(row0, len(at) - 1).null_count:
                    low = tn.LOWERED[data]
                    starts, ends, row = tn.lines(low, at, min_chars)
                    h = tn.span_hash(low, starts, ends).view(np.int64)
                    edge = np.searchsorted(row, np.arange(len(at)))
                    for r in range(len(at) - 1):
                        one = lost[row0 + r]
                        if one.is_valid:
                            a, b = edge[r], edge[r + 1]
                            gone[r] = starts[a:b][np.isin(h[a:b], one.values.to_numpy())].tolist()
                for r in range(len(at) - 1):
                    own = data[at[r] : at[r + 1]]
                    breaks = np.flatnonzero(own == 0x0A)
                    total.append(len(breaks) + 1)
                    dropped.append(len(gone.get(r, ())))
                    if not dropped[-1]:
                        texts.append(own.tobytes())
                        continue
                    # A line's place among the lines is the number of line ends before it.
                    which = set(np.searchsorted(breaks, np.array(gone[r]) - at[r]).tolist())
                    texts.append(b"\n".join([x for i, x in enumerate(own.tobytes().split(b"\n")) if i not in which]))
            yield pa.RecordBatch.from_arrays([*map(get, keep), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(dropped, pa.int64())], names=[*keep, f"{P}text", TOTAL, DROPPED])

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """docs with the text less its repeated lines, and n_lines, n_dropped.

    Lines are split at \\n; a line's key is the line less blanks at its ends, A-Z lower-cased. A key
    of at least min_chars code points that at least min_docs documents hold stays only in the
    document with the largest id. Null or empty text is one empty line and comes back as "".
    Ids are whole numbers. Rows with the same id count as one document, and lose the same lines.
    Rows with a null id count for nothing and keep all lines. Columns n_lines and n_dropped of
    docs are replaced. Keys are counted as they are; in one document a key is told by a 64-bit hash.
    """
    own = f"{P}id"
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped", text_col)]
    slim = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    shards = shards_for(docs, text_col)
    found = suspected(slim, _hashes(min_chars), shards).select(F.col("id").alias(own), F.col("found").alias(FOUND))
    # Both joins take the texts in one partitioning, so they are exchanged once.
    texts = squeezed_docs(docs, dict.fromkeys([*keep, id_col]), text_col)
    held = texts.join(found, F.col(id_col).cast("long") == F.col(own), "left").mapInArrow(_suspected_lines(min_chars, shards, id_col), "id long, key binary, hash long")
    # Distinct (key, id) first: a hot key is spread by the id before it is counted.
    held = held.distinct()
    common = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")).filter(F.col("n") >= min_docs)
    lost = held.join(common.select("key", "last"), "key").filter(F.col("id") < F.col("last")).groupBy(F.col("id").alias(own)).agg(F.collect_set("hash").alias(LOST))
    out = texts.join(lost, F.col(id_col).cast("long") == F.col(own), "left").drop(own)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    cut = out.mapInArrow(_cut(min_chars, keep), f"{schema}{', ' * bool(keep)}{P}text string, {TOTAL} long, {DROPPED} long")
    columns = [F.col(f"{P}text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c in (text_col, *keep)]
    return cut.select(*columns, F.col(TOTAL).alias("n_lines"), F.col(DROPPED).alias("n_dropped"))
