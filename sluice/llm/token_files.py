"""Token ids of a corpus as compressed files: canonical length-limited Huffman coding.

Texts are turned into ids once, and ids are counted over all documents. The counts give each id a
code of at most `limit` bits (package-merge); codes are canonical, so the lengths alone say what they
are. Documents are sorted by id over the cluster, and each task writes its own range of them.

The files of a folder:

* `code/`: one file; magic, number of ids, then the code length of each id, a byte each, zlib.
* `ids/`: files of segments, in the order of part and file number in their names. A segment holds
  whole documents, of SEGMENT ids together or one that is longer, and ends with a line feed.
* `index/`: Parquet; for each file its ids and documents, and how many stand before it.

A segment, all numbers little-endian: magic, its length in bytes, number of documents, ids and blocks
(8 bytes each); document ids (8 bytes each), a byte for each that is 1 where the id is null, ids in
each document (8 bytes each); for each block its ids, its first byte and its first checkpoint (8 bytes
each); bit offsets in the block of each STRIDE-th id (4 bytes each, the checkpoints); then the blocks'
bits, each block from a byte of its own on. A block has BLOCK ids at most and is read without
any other. A reader starts at all checkpoints at once and looks each code up in one table.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textnum as tn
from .common import P, discard, materialize, small_batches

MAGIC, CODE_MAGIC = b"HUFFIDS1", b"HUFFCOD1"
SEGMENT, BLOCK, STRIDE = 1 << 20, 1 << 16, 1 << 9
#: Segments in a file, and ids that a task sorts, at most (documents are whole).
SEGMENTS_A_FILE, TASK_IDS = 32, 1 << 26
#: Words whose ids a worker keeps (twice as many at most), characters of new words that are encoded
#: together, and bytes of text whose words are looked up together.
MEMO, LOT, TOGETHER = 3 << 17, 1 << 16, 1 << 22
#: Letters, and marks after them, that tokenizers of words tell apart.
#: Small letters beyond a to z: U+00DF to U+00FF, without the sign of division.
_SMALL = rb"\xc3[\x9f-\xb6\xb8-\xbf]"
_MARKED, _LETTERS = re.compile(rb"((?:[A-Za-z]|" + _SMALL + rb")+)([.,;:!?]*)"), re.compile(rb"(?:[a-z]|" + _SMALL + rb")+")
_HEAD = struct.Struct("<8sQQQQ")
_loaded: dict[str, tuple] = {}


class Memo:
    """The ids of words that were met lately: those of this round, and of the round before."""

    def __init__(self):
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        #: Whether the model alone gives the ids of lower-case letters; not known before the first lot.
        self.direct: bool | None = None
        #: How the tokenizer writes small letters beyond a to z before its model sees them.
        self.written: dict[int, str] = {}

    def get(self, word: bytes) -> bytes | None:
        ids = self.new.get(word)
        if ids is None and (ids := self.old.get(word)) is not None:
            self.new[word] = ids
        return ids

    def next_round(self, most: int) -> None:
        if len(self.new) > most:
            self.old, self.new = self.new, {}


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer, memo = Tokenizer.from_file(path), Memo()
        split = tokenizer.pre_tokenizer
        memo.written = {c: split.pre_tokenize_str(chr(c))[0][0] if split else chr(c) for c in range(0xDF, 0x100) if c != 0xF7}
        _loaded[path] = (tokenizer, memo)
    return _loaded[path]


def _learn(tokenizer, memo: Memo, words: list[bytes]) -> None:
    """Put the ids of words into memo. They are encoded side by side, as a call has its price."""
    lot: list[bytes] = []
    size = 0
    for k, w in enumerate(words):
        lot.append(w)
        size += len(w)
        if size < LOT and k + 1 < len(words):
            continue
        texts = [x.decode() for x in lot]
        begin = np.cumsum([0, *[len(x) + 1 for x in texts]])
        out = tokenizer.encode(" ".join(texts), add_special_tokens=False)
        at = np.fromiter((x[0] for x in out.offsets), np.int64, len(out.offsets))
        cut = (4 * np.searchsorted(at, begin)).tolist()
        ids = np.array(out.ids, "<u4").tobytes()
        for i, x in enumerate(lot):
            memo.new[x] = ids[cut[i] : cut[i + 1]]
        lot, size = [], 0


def _learn_letters(tokenizer, memo: Memo, words: list[bytes]) -> None:
    """As _learn(), for words of small letters alone: nothing is to be normalised or split there, so the
    model takes them as they are written. Whether that is so with this tokenizer is tried on its first words."""
    if memo.direct is None and words:
        some = words[:1000]
        _learn(tokenizer, memo, some)
        memo.direct = all(memo.new[w] == _model_ids(tokenizer.model, w, memo.written) for w in some)
        words = words[1000:]
    if memo.direct:
        model = tokenizer.model
        for w in words:
            memo.new[w] = _model_ids(model, w, memo.written)
    else:
        _learn(tokenizer, memo, words)


def _model_ids(model, word: bytes, written: dict[int, str]) -> bytes:
    text = word.decode()
    ids = [t.id for t in model.tokenize(text if text.isascii() else text.translate(written))]
    return struct.pack(f"<{len(ids)}I", *ids)


def _known(tokenizer, memo: Memo, words: list[bytes]) -> list[bytes]:
    """The ids of distinct words. Letters are looked up in lower case, without the marks after them."""
    memo.next_round(MEMO)
    now = memo.new.get
    out = [now(w) for w in words]
    parts: dict[int, tuple[bytes, ...]] = {}
    for i, ids in enumerate(out):
        if ids is None:
            w = words[i]
            m = _MARKED.fullmatch(w)
            parts[i] = (m[1].lower(), m[2]) if m and m[2] else (m[1].lower(),) if m else (w,)
    new = list(dict.fromkeys(p for some in parts.values() for p in some if memo.get(p) is None))
    plain = [_LETTERS.fullmatch(w) is not None for w in new]
    _learn_letters(tokenizer, memo, [w for w, ok in zip(new, plain, strict=True) if ok])
    _learn(tokenizer, memo, [w for w, ok in zip(new, plain, strict=True) if not ok])
    for i, some in parts.items():
        out[i] = now(some[0]) if len(some) == 1 else now(some[0]) + now(some[1])
    return out


def word_ids(path: str, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): the token ids of each text, word by word; each distinct word is looked up once."""
    tokenizer, memo = _tokenizer(path)
    starts, ends, first = tn.words(data, at)
    told = tn.packed(data, starts, ends).dictionary_encode()
    raw, cut = tn.buffers(told.dictionary)
    raw, cut = raw.tobytes(), cut.tolist()
    blobs = _known(tokenizer, memo, [raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)])
    size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    begin = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(blobs), "<u4")
    which = told.indices.to_numpy()
    each = size[which]
    to = np.zeros(len(which) + 1, np.int64)
    np.cumsum(each, out=to[1:])
    return flat[np.arange(to[-1]) + np.repeat(begin[which] - to[:-1], each)], to[first]


def text_ids(path: str, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As word_ids(), for tokenizers that don't work word by word: each text as a whole."""
    tokenizer, _ = _tokenizer(path)
    texts = [data[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)]
    out = [np.array(x.ids, "<u4") for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    return np.concatenate([np.zeros(0, "<u4"), *out]), np.cumsum([0, *map(len, out)])


def _packed_ids(path: str, end_id: int, by_word: bool):
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], "<u4")
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for row0, data, at in tn.pieces(batch.column(1), tn.WORD, TOGETHER) if by_word else tn.slices(batch.column(1)):
                ids, cut = (word_ids if by_word else text_ids)(path, data, at)
                for r in range(len(at) - 1):
                    parts[row0 + r].append(ids[cut[r] : cut[r + 1]])
            n, blobs = [], []
            for some in parts:
                ids = np.concatenate([*some, end])
                n.append(len(ids))
                blobs.append(pack.compress(ids.astype("<u2" if ids.max() < 1 << 16 else "<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(blobs, pa.binary())], names=["id", "n", "ids"])

    return run


def _unpacked(blob, n: int) -> np.ndarray:
    raw = zstandard.decompress(blob.as_buffer())
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def _counted(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        for n, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            one = np.bincount(_unpacked(blob, n))
            if len(one) > len(total):
                total, one = one, total
            total[: len(one)] += one
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(total[used].astype(np.int64))], names=["id", "n"])


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol's code, none over limit, with the least total (package-merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes of more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)  # sums may pass 2**63; ties don't matter
    is_leaf, row = [], leaves
    for _ in range(limit):
        if is_leaf:
            pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
            every = np.concatenate([leaves, pairs])
            by = np.argsort(every, kind="stable")
            row = every[by]
            is_leaf.append(by < n)
        else:
            is_leaf.append(np.ones(n, bool))
    out = np.zeros(n, np.int64)
    take = 2 * n - 2
    for flags in reversed(is_leaf):
        chosen = int(flags[:take].sum())
        out[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return out


def limit_for(symbols: int) -> int:
    """Most bits of a code: some more than all symbols need, within what a table look-up takes."""
    return min(24, max(16, (max(symbols, 2) - 1).bit_length() + 2))


class Code:
    """The canonical code of lengths (a byte for each id, 0: not used)."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.width = max(1, int(lengths.max(initial=0)))
        used = np.flatnonzero(lengths)
        used = used[np.argsort(lengths[used], kind="stable")]  # by length, then id
        size = lengths[used].astype(np.int64)
        span = np.int64(1) << (self.width - size)
        begin = np.cumsum(span) - span
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[used] = (begin >> (self.width - size)).astype(np.uint64)
        # What a window of `width` bits begins with.
        self.symbol = np.zeros(1 << self.width, np.uint32)
        self.bits = np.ones(1 << self.width, np.uint8)
        self.symbol[: span.sum()] = np.repeat(used, span)
        self.bits[: span.sum()] = np.repeat(size, span)

    @staticmethod
    def of(counts: dict[int, int]) -> Code:
        lengths = np.zeros(max(counts, default=-1) + 1, np.uint8)
        used = sorted(counts)
        lengths[used] = code_lengths(np.array([counts[i] for i in used], np.int64), limit_for(len(used)))
        return Code(lengths)

    def dump(self) -> bytes:
        return CODE_MAGIC + struct.pack("<Q", len(self.lengths)) + zlib.compress(self.lengths.tobytes())

    @staticmethod
    def load(blob: bytes) -> Code:
        if blob[:8] != CODE_MAGIC:
            raise ValueError("not a code file")
        out = np.frombuffer(zlib.decompressobj().decompress(blob[16:]), np.uint8)
        if len(out) != struct.unpack_from("<Q", blob, 8)[0]:
            raise ValueError("the code file is cut off")
        return Code(out)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bits, bit offsets of each STRIDE-th id) of one block."""
        size = self.lengths[ids].astype(np.int64)
        end = np.cumsum(size)
        begin = end - size
        window = self.codes[ids] << (64 - (begin & 31) - size).astype(np.uint64)
        word = begin >> 5
        cut = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out = np.zeros(int(end[-1]) // 32 + 2, np.uint64)
        # Codes don't overlap, so their sum is their union.
        out[word[cut]] += np.add.reduceat(window >> np.uint64(32), cut)
        out[word[cut] + 1] += np.add.reduceat(window & np.uint64(0xFFFFFFFF), cut)
        return out.astype(">u4").tobytes()[: (int(end[-1]) + 7) // 8], begin[::STRIDE].astype("<u4")

    def decode(self, data: np.ndarray, bit: np.ndarray, n: np.ndarray) -> np.ndarray:
        """n[k] ids from each bit offset on, all of them in a row."""
        padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
        window = padded[:-3] << np.uint32(24) | padded[1:-2] << np.uint32(16) | padded[2:-1] << np.uint32(8) | padded[3:]
        to = np.cumsum(n) - n
        order = np.argsort(-n, kind="stable")
        at, to, n = bit[order].astype(np.int64), to[order], n[order]
        out = np.zeros(int(n.sum()), np.uint32)
        mask, drop = np.uint32((1 << self.width) - 1), 32 - self.width
        left = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0))  # lanes that have a k-th id
        for k, live in enumerate(left.tolist()):
            p = at[:live]
            seen = window[p >> 3] >> (drop - (p & 7)).astype(np.uint32) & mask
            out[to[:live] + k] = self.symbol[seen]
            at[:live] += self.bits[seen]
        return out


def segment(code: Code, docs: list[int | None], parts: list[np.ndarray]) -> bytes:
    ids = np.concatenate(parts)
    blocks = [code.encode(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    table = np.array([[min(BLOCK, len(ids) - k * BLOCK) for k in range(len(blocks))], np.cumsum([0, *[len(b[0]) for b in blocks]])[:-1], np.cumsum([0, *[len(b[1]) for b in blocks]])[:-1]], "<u8")
    body = b"".join([
        np.array([d or 0 for d in docs], "<i8").tobytes(), bytes(d is None for d in docs), np.array([len(x) for x in parts], "<u8").tobytes(),
        table.tobytes(), *[b[1].tobytes() for b in blocks], *[b[0] for b in blocks],
    ])
    return _HEAD.pack(MAGIC, _HEAD.size + len(body), len(docs), len(ids), len(blocks)) + body


def segments(blob: memoryview):
    """(documents, ids, blocks, body) of each segment of a file."""
    at = 0
    while at < len(blob):
        magic, size, n_docs, n_ids, n_blocks = _HEAD.unpack_from(blob, at)
        if magic != MAGIC or at + size >= len(blob) or blob[at + size] != 0x0A:
            raise ValueError("not a file of token ids, or cut off")
        yield n_docs, n_ids, n_blocks, blob[at + _HEAD.size : at + size]
        at += size + 1


def read_segment(code: Code, n_docs: int, n_ids: int, n_blocks: int, body: memoryview) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, which are null, ids of each, all ids)."""
    docs = np.frombuffer(body, "<i8", n_docs)
    null = np.frombuffer(body, np.uint8, n_docs, 8 * n_docs).astype(bool)
    each = np.frombuffer(body, "<u8", n_docs, 9 * n_docs).astype(np.int64)
    size, byte, first = np.frombuffer(body, "<u8", 3 * n_blocks, 17 * n_docs).astype(np.int64).reshape(3, -1)
    lanes = -(-size // STRIDE)
    start = 17 * n_docs + 24 * n_blocks
    marks = np.frombuffer(body, "<u4", int(lanes.sum()), start).astype(np.int64)
    which = np.repeat(np.arange(n_blocks), lanes)
    bit = marks + 8 * byte[which]
    n = np.minimum(STRIDE, size[which] - STRIDE * (np.arange(len(marks)) - first[which]))
    return docs, null, each, code.decode(np.frombuffer(body, np.uint8, offset=start + 4 * len(marks)), bit, n)


def _segments(lengths: bytes):
    def run(batches):
        code = Code(np.frombuffer(zlib.decompress(lengths), np.uint8))
        docs, parts, size = [], [], 0
        for batch in batches:
            for doc, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                docs.append(doc)
                parts.append(_unpacked(blob, n))
                size += n
                if size >= SEGMENT:
                    yield pa.RecordBatch.from_arrays([pa.array([segment(code, docs, parts)], pa.binary())], names=["segment"])
                    docs, parts, size = [], [], 0
                    tn.give_back()
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([segment(code, docs, parts)], pa.binary())], names=["segment"])

    return run


def _file_columns():
    """Part and file number, from names as Spark gives them; names aren't padded enough to sort by."""
    name = F.element_at(F.split("path", "/"), -1)
    return [F.regexp_extract(name, r"^part-(\d+)", 1).cast("long").alias("part"), F.regexp_extract(name, r"-c(\d+)\.", 1).cast("long").alias("file")]


def _sizes(batches):
    for batch in batches:
        ids, docs = [], []
        for blob in batch.column(2):
            heads = [(x[1], x[0]) for x in segments(memoryview(blob.as_buffer()))]
            ids.append(sum(h[0] for h in heads))
            docs.append(sum(h[1] for h in heads))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.int64()), pa.array(docs, pa.int64())], names=["part", "file", "ids", "docs"])


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, by_word: bool = True, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all texts of docs with the tokenizer (a file of the tokenizers library, at the same path
    on all machines), add end_id to each, and write the ids to a new folder, in ascending order of
    the documents' ids.

    by_word: the tokenizer drops white space, treats what stands between blanks alike wherever it
    stands, lower-cases letters and tells them from marks such as commas; then a worker encodes a
    word once, as long as it keeps it (MEMO). Turn it off for tokenizers that don't work so.

    Null and empty texts have the end id alone. Documents with a null id come first. Rows with one id
    are documents of their own, in the order of a hash of their ids. An empty table gives a folder with
    no ids. Ids are whole numbers. Other columns of docs are not read. A task holds one segment, or
    one document if that is longer.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    packed = slim.mapInArrow(_packed_ids(tokenizer, end_id, by_word), "id long, n long, ids binary")
    packed = materialize(packed.select("id", "n", "ids", F.monotonically_increasing_id().alias("row")))
    # At most as many rows as the tokenizer has ids.
    counts = dict(packed.select("n", "ids").mapInArrow(_counted, "id long, n long").groupBy("id").agg(F.sum("n")).collect())
    code = Code.of(counts)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counts.values()) // TASK_IDS)
    order = [F.asc_nulls_first("id"), F.asc(f"{P}tie"), F.asc("row")]  # with the row, equal rows may part
    spread = packed.withColumn(f"{P}tie", F.xxhash64("ids")).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    out = spread.select("id", "n", "ids").mapInArrow(_segments(zlib.compress(code.lengths.tobytes())), "segment binary")
    with small_batches(spark):
        # The text sink writes bytes as they are, and a line feed after each row.
        out.select(F.col("segment").cast("string")).write.option("maxRecordsPerFile", SEGMENTS_A_FILE).text(f"{folder}/ids")
    spark.createDataFrame([(bytearray(code.dump()),)], "code binary").coalesce(1).select(F.col("code").cast("string")).write.text(f"{folder}/code")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/ids")
    with small_batches(spark):
        sizes = materialize(files.select(*_file_columns(), "content").mapInArrow(_sizes, "part long, file long, ids long, docs long"))
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    sums = {f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("ids", "docs")}
    sizes.withColumns(sums).coalesce(1).write.parquet(f"{folder}/index")
    discard(sizes)
    discard(packed)


def _decoded(lengths: bytes):
    def run(batches):
        code = Code(np.frombuffer(zlib.decompress(lengths), np.uint8))
        names = ["doc_id", "start", "n_tokens", "ids"]
        for batch in batches:
            for before, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                done = before
                for some in segments(memoryview(blob.as_buffer())):
                    docs, null, each, ids = read_segment(code, *some)
                    at = np.cumsum(each) - each
                    raw = pa.py_buffer(ids.astype("<u4"))
                    cut = np.concatenate([at, [len(ids)]]) * 4
                    binary = pa.Array.from_buffers(pa.large_binary(), len(docs), [None, pa.py_buffer(cut), raw]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(docs, mask=null), pa.array(at + done), pa.array(each), binary], names=names)
                    done += len(ids)
            tn.give_back()

    return run


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): each document of a folder that write_ids() has written, from its
    files. start: ids of all documents before it. ids: little-endian unsigned 32-bit numbers."""
    index = spark.read.parquet(f"{folder}/index").select("part", "file", "ids_before")
    blob = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/code").select("content").first()["content"]
    code = Code.load(bytes(blob))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/ids")
    files = files.select(*_file_columns(), "content").join(index, ["part", "file"]).select("ids_before", "content")
    return files.mapInArrow(_decoded(zlib.compress(code.lengths.tobytes())), "doc_id long, start long, n_tokens long, ids binary")
