"""Spelling variants against a plain model."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import spelling
from sluice.llm import textnum as tn

SCHEMA = "doc_id long, text string, word string, n long, form string, other string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def model(rows, min_chars=7, min_count=2, ratio=10, typo_every=None):
    n = collections.Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = lower(run)
            h = zlib.crc32(f"{r[0]}:{run}".encode())
            if typo_every and r[0] is not None and h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_count}
    out, form = {}, {}
    for w in n:
        by = sorted((-n[o], o) for o in n if near(w, o))
        form[w] = by[0][1] if by and -by[0][0] >= ratio * n[w] else None
        out[w] = len(by)
    rows = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n[w], out[w], n[form[w]] if form[w] else None))
    return rows


def make_rows():
    rng = random.Random(9)
    base = ["".join(rng.choice("aeinrstéüÀßlo") for _ in range(rng.randint(6, 12))) for _ in range(40)] + ["aaaaaaaa", "abababab", "Straßenbahn", "x×÷ÿÞaaaab"]

    def edited(w):
        i, c = rng.randrange(len(w)), rng.choice("aeinrsté")
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])

    texts = [None, "", " 12 ", "¿Āword中", "z" * 900 + " " + "z" * 900, "z" * 901 + "," + "z" * 901]
    for _ in range(60):
        some = rng.choices(base, [1 / (i + 1) for i in range(len(base))], k=60)
        texts.append(" ".join(rng.choice(["{}", "{},", "{}2", "中{}", "× {}"]).format(edited(w) if rng.random() < 0.15 else w.upper() if rng.random() < 0.1 else w) for w in some))
    rows = [(i if i % 9 else None, t, "w", 1, "f", "o") for i, t in enumerate(texts)]
    return rows + rows[8:10]


@pytest.mark.parametrize("limit, depth, every, cells", [(8192, 5, None, 1 << 22), (8192, 5, 3, 1 << 22), (12, 5, 3, 300), (5, 2, 3, 100)])
def test_variants(spark, monkeypatch, limit, depth, every, cells):
    """Whatever a bucket may hold, and however deep bands are split, the pairs are the same."""
    monkeypatch.setattr(spelling, "LIMIT", limit)
    monkeypatch.setattr(spelling, "DEPTH", depth)
    monkeypatch.setattr(spelling, "CELLS", cells)
    rows = make_rows()
    out = spelling.variants(spark.createDataFrame(rows, SCHEMA).repartition(3), typo_every=every)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in out.collect()]
    want = model(rows, typo_every=every)
    assert len(got) == len(want) and set(got) == want
    assert sum(r[1] is not None for r in got) > 3 or every is None


def test_chains_and_ties(spark):
    """A chain of forms ends at its root; ties go to the first word."""
    rows = [(1, " ".join(["aaaaaaab"] * 2000 + ["aaaaaaac"] * 2000 + ["aaaaaacc"] * 150 + ["aaaaaccc"] * 15 + ["aaaacccc"] * 2), None, None, None, None)]
    got = {r.word: (r.form, r.root) for r in spelling.variants(spark.createDataFrame(rows, SCHEMA), ratio=7).collect()}
    assert got["aaaaaacc"] == ("aaaaaaac", "aaaaaaac") and got["aaaaaccc"] == ("aaaaaacc", "aaaaaaac") and got["aaaacccc"] == ("aaaaaccc", "aaaaaaac")
    assert got["aaaaaaab"] == (None, "aaaaaaab")
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0


def test_crcs():
    rng = random.Random(1)
    spans = [rng.randbytes(rng.choice([0, 1, 5, 30, 64, 65, 200])) for _ in range(200)]
    data = np.frombuffer(b"".join(spans), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(x) for x in spans])])
    begun = np.array([zlib.crc32(str(i).encode()) for i in range(200)], np.uint32)
    assert tn.crcs(data, at[:-1], at[1:], begun).tolist() == [zlib.crc32(str(i).encode() + x) for i, x in enumerate(spans)]


def test_long_texts_come_in_pieces():
    texts = ["ab cd", "w" * 50 + " " + "v w x " * 40, "", "q" * 300]
    got = collections.defaultdict(list)
    for row0, data, at in tn.pieces(pa.array(texts), spelling.INSIDE, 20):
        for r in range(len(at) - 1):
            got[row0 + r].append(data[at[r] : at[r + 1]].tobytes())
    assert [b"".join(got[i]).decode() for i in range(4)] == texts
    assert len(got[1]) > 5 and all(x[-1:] == b" " for x in got[1][:-1]) and len(got[3]) == 1


def test_words_of_a_tile_meet_by_halves(monkeypatch):
    """Words of one bucket: few pairs are looked at, not all; those that are near come out."""
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcdef", k=rng.choice([9, 10]))) for _ in range(1500)})
    met, plain = [], spelling._meetings

    def counting(begin, end):
        for own, other in plain(begin, end):
            met.append(len(own))
            yield own, other

    monkeypatch.setattr(spelling, "_meetings", counting)
    n = len(words)
    first = next(iter(spelling._masked([pa.RecordBatch.from_arrays([pa.array(words), pa.array([2] * n)], names=["word", "n"])])))
    same = [pa.array([0] * n) for _ in range(5)]
    names = [spelling.PATH, spelling.VALUE, spelling.LEFT, spelling.RIGHT, spelling.SIDE, "word", "n", spelling.MASK, spelling.SIZE]
    batch = pa.RecordBatch.from_arrays([*same, first.column(0), first.column(1), first.column(3), first.column(2)], names=names)
    got = sorted(x for out in spelling._near([batch]) for x in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True))
    assert got == sorted((a, b) for a in words for b in words if near(a, b)) and got
    assert sum(met) < 20 * n
