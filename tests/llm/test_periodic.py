"""Periodic runs against a plain model."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from sluice.llm import periodic, queries

SCHEMA = "doc_id long, text string, best string, length long, __sl_own long"


def model(w):
    """(start, length, period) of all runs, by trying each period at each place."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if length >= max(6, 4 * q):
                part = w[s : s + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((s, length, q))
            i = max(i, s + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def runs(texts):
    ids = np.array([x for w in texts for x in w], np.int64)
    out = [[] for _ in texts]
    for t, *run in zip(*(v.tolist() for v in periodic.runs_of(ids, np.cumsum([0, *map(len, texts)]))), strict=True):
        out[t].append(tuple(run))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_of(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = []
        for _ in range(rng.randint(1, 12)):
            n, k = rng.randint(0, 130), rng.choice([1, 2, 2, 3, 5, 50])
            w = [rng.randrange(k) for _ in range(n)]
            if rng.random() < 0.6 and n > 8:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 3))
                for i in range(a, n):
                    w[i] = w[a + (i - a) % p]
                w += [rng.randrange(k) for _ in range(rng.choice([0, 0, 1, 20]))]
            texts.append(w)
        if any(texts):
            assert runs(texts) == [model(w) for w in texts]


def test_all_short_words():
    """Every text of two words and up to 13 places, and of three and up to 8."""
    for k, most in ((2, 13), (3, 8)):
        texts = [list(w) for n in range(1, most + 1) for w in itertools.product(range(k), repeat=n)]
        assert runs(texts) == [model(w) for w in texts]


def test_fibonacci_and_nested():
    a, b = [0], [0, 1]
    for _ in range(12):
        a, b = b, b + a
    nested = ([1] * 6 + [2]) * 5 + [3]
    assert runs([b, nested * 4, b[:100] * 5]) == [model(w) for w in (b, nested * 4, b[:100] * 5)]


def test_find_runs(spark):
    rng = random.Random(8)
    loop = ["la", "LA", "la,", "ü素", "x\x1fy"]
    texts = [None, "", " \n\t ", "one", "no no no no no no", "no " * 5, "a\nb\x0bc\td  " * 4, "ab " * 300 + "tail", "x" * 5000]
    texts += [" ".join(rng.choice(loop) for _ in range(20)) + " " + " ".join(rng.sample(loop, 3) * rng.randint(2, 9)) + rng.choice([" end", ""]) for _ in range(40)]
    texts.append(" ".join(f"w{i % 700}" for i in range(4000)))
    rows = [(i if i % 5 else None, t, "b", 7, i) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7]]
    out = periodic.find_runs(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert out.columns == ["doc_id", "text", "best", "length", "__sl_own", periodic.WORDS, periodic.RUNS, periodic.COLLAPSED]
    got = sorted((r["__sl_own"], r["doc_id"], r["text"], r[periodic.WORDS], [tuple(x) for x in r[periodic.RUNS]], r[periodic.COLLAPSED]) for r in out.collect())
    want = []
    for doc_id, text, _, _, own in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want.append((own, doc_id, text, len(w), model(w), collapsed(w, model(w))))
    assert got == sorted(want, key=lambda r: r[0])
    assert sum(len(r[4]) for r in got) > 20
    assert periodic.find_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, small):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
        found = model(w)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want[r.doc_id] = (len(found), *tail, sha("".join(f"{s},{k},{q}\n" for s, k, q in found)), sha(collapsed(w, found)))
    out = queries.op11_periodic_runs(spark, small)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == want
    assert sum(v[0] > 0 for v in want.values()) > 5
    assert [f.dataType.simpleString() for f in out.schema[1:6]] == ["bigint"] * 5
