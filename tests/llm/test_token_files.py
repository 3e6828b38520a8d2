"""Files of token ids: round trips, and codes against plain models."""

import heapq
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import common, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start long, ids long, n long"


def make_rows():
    rng = random.Random(4)
    some = ["It's", "naïve", "éte", "<|endoftext|>", "x<|startoftext|>y", "WE'LL", "don't!!", "日本語", "1234", "́a", "a b", "Σς", "İ", "--", '"q"', "😀🎉", " z", "ﬁne", "<|ENDOFTEXT|>", "Ok,", "OK!?", "ok", "THE.", "a'S", "Kelvin."]
    texts = [None, "", " \n\t ", "one", "one", *some]
    texts += ["".join(rng.choice([" ", "\n", "  ", "\x0b", "\t"]) + rng.choice(some + ["alpha", "Beta,", "gammadelta"]) for _ in range(rng.randint(1, 200))) for _ in range(40)]
    texts.append(" ".join(rng.choice(some) + str(rng.randint(0, 9999)) for _ in range(30000)))
    rows = [(97 * i % 31 - 5, t, 1, 2, 3) for i, t in enumerate(texts)]
    return rows + [rows[7], rows[7], (None, "no id", 1, 2, 3), (None, None, 1, 2, 3)]


def model(rows):
    tokenizer = Tokenizer.from_file(PATH)
    return [(r[0], [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]) for r in rows]


@pytest.mark.parametrize("small", [False, True])
def test_round_trip(spark, monkeypatch, small):
    if small:  # many segments, blocks and files
        for name, value in (("SEGMENT", 700), ("SEGMENTS_A_FILE", 2), ("MEMO", 50)):
            monkeypatch.setattr(token_files, name, value)
    rows = make_rows()
    folder = common.new_folder(spark)
    token_files.write_ids(spark.createDataFrame(rows, SCHEMA).repartition(3), folder, PATH)
    got = sorted((r.start, r.n_tokens, r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in token_files.read_ids(spark, folder).collect())
    assert sorted(((r[2], r[3]) for r in got), key=str) == sorted(model(rows), key=str)
    assert [r[2] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    assert [r[0] for r in got] == [0, *itertools.accumulate(r[1] for r in got)][:-1]
    assert all(r[1] == len(r[3]) for r in got)
    n_files = spark.read.parquet(f"{folder}/index").count()
    assert n_files > 5 if small else n_files <= 4, n_files
    # The whole text as one call gives the same ids.
    other = common.new_folder(spark)
    token_files.write_ids(spark.createDataFrame(rows[:30], SCHEMA), other, PATH, by_word=False)
    assert sorted(((r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in token_files.read_ids(spark, other).collect()), key=str) == sorted(model(rows[:30]), key=str)


def test_empty_table(spark):
    folder = common.new_folder(spark)
    token_files.write_ids(spark.createDataFrame([], SCHEMA), folder, PATH)
    assert token_files.read_ids(spark, folder).count() == 0


def huffman_total(counts):
    heap = list(counts)
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        total += a
        heapq.heappush(heap, a)
    return total


def test_code_lengths():
    rng = random.Random(2)
    for n in (1, 2, 3, 10, 200, 3000):
        counts = np.array([int(rng.paretovariate(0.5)) for _ in range(n)])
        for limit in (12, 16, 24):
            size = token_files.code_lengths(counts, limit)
            assert size.max() <= limit and (2.0**-size).sum() <= 1
        if n > 1:  # no limit in the way: as good as Huffman's
            assert (token_files.code_lengths(counts, 60) * counts).sum() == huffman_total(counts.tolist())
    # Three symbols of at most 2 bits, Fibonacci weights of at most 4: the best there is.
    fib = np.array([1, 1, 2, 3, 5, 8, 13, 21])
    best = min(sum(l * c for l, c in zip(ls, fib)) for ls in itertools.product(range(1, 5), repeat=8) if sum(2.0**-x for x in ls) <= 1)
    assert (token_files.code_lengths(fib, 4) * fib).sum() == best
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(5, np.int64), 2)


def test_blocks_are_independent():
    """Any checkpoint of a block is a place to begin."""
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 5000), 60000).astype(np.uint32)
    code = token_files.Code.load(token_files.Code.of(dict(zip(*(x.tolist() for x in np.unique(ids, return_counts=True))))).dump())
    data, marks = code.encode(ids)
    raw = np.frombuffer(data, np.uint8)
    assert code.decode(raw, np.array([0]), np.array([5000])).tolist() == ids.tolist()
    k = 4 * token_files.STRIDE
    assert code.decode(raw, marks[4:5], np.array([100])).tolist() == ids[k : k + 100].tolist()
    assert len(data) < 5000 * 2
    with pytest.raises(ValueError):
        list(token_files.segments(memoryview(b"x" * 60)))
    whole = token_files.segment(code, [7], [ids]) + b"\n"
    with pytest.raises(ValueError):
        list(token_files.segments(memoryview(whole[:-9])))


@pytest.mark.parametrize("block, stride", [(100, 7), (1, 1), (64, 64), (5000, 333)])
def test_segments_of_small_blocks(monkeypatch, block, stride):
    monkeypatch.setattr(token_files, "BLOCK", block)
    monkeypatch.setattr(token_files, "STRIDE", stride)
    rng = np.random.default_rng(2)
    parts = [rng.integers(0, 300, n).astype(np.uint32) for n in (1, 5, 700, 1, 64)]
    used, n = np.unique(np.concatenate(parts), return_counts=True)
    code = token_files.Code.of(dict(zip(used.tolist(), n.tolist(), strict=True)))
    blob = (token_files.segment(code, [3, None, 4, 4, -9], parts) + b"\n") * 2
    for some in token_files.segments(memoryview(blob)):
        docs, null, each, ids = token_files.read_segment(code, *some)
        assert docs[~null].tolist() == [3, 4, 4, -9] and null.tolist() == [False, True, False, False, False]
        assert each.tolist() == [len(x) for x in parts] and ids.tolist() == np.concatenate(parts).tolist()


def test_query_columns(spark, small):
    from sluice.llm import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op12_token_files(spark, small).collect()}
    start, tokenizer = 0, Tokenizer.from_file(PATH)
    for doc_id, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert got[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(rows)
