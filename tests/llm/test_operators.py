"""Each operator against a plain model on a small fixture of awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import common, decontaminate, gramjoin, line_dedup, lm_score, mixture, near_dedup, perplexity, quality_rules, queries, repeats, shard, suffix_dedup, window_dedup
from sluice.llm import textnum as tn
from sluice.llm.components import components

BLANK = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, id long, node string, shard string"


def words(text):
    return re.findall(BLANK, text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sentence(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "la", "mu", "nu", "素材", "xi.", "pi,"]) + str(rng.randint(0, 99)) for _ in range(n))


def make_rows():
    rng = random.Random(5)
    passage, line = sentence(rng, 30), "This very common line is in several documents, " + sentence(rng, 4)
    texts = [None, "", "   \n\t", "one", "one two three", "one two three", "A b\x1fc\x0bd", "x" * 300, "x" * 180, "ab" * 90]
    base = sentence(rng, 120)
    texts += [base, base, base.replace(" ", "  ", 1), base + " tail", sentence(rng, 60) + "\n" + passage + "\n" + sentence(rng, 20)]
    for i in range(12):
        lines = [sentence(rng, rng.randint(1, 25)) for _ in range(rng.randint(1, 6))]
        if i % 2:
            lines.insert(rng.randint(0, len(lines)), ("  " + line + "\r") if i % 3 else line.upper() if line.isascii() else line)
        if i % 3 == 0:
            lines.append(passage)
        texts.append("\n".join(lines))
    texts.append(" ".join(sentence(rng, 40) for _ in range(40)))
    near = base.split()
    near[60] = "changed"
    texts.append(" ".join(near))
    rows = [(100 - i if i % 2 else i, t, "en" if i % 4 else None, None if i % 7 == 0 else f"s{i % 3}", 1, 2, "k", i, "n", "sh") for i, t in enumerate(texts)]
    rows.append(rows[10])  # a row twice
    rows.append((None, base, None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def model_lines(rows, min_chars=40, min_docs=5):
    key = lambda s: lower(s.strip(" \t\n\x0b\x0c\r"))
    held = collections.defaultdict(set)
    for r in rows:
        if r[0] is not None:
            for s in (r[1] or "").split("\n"):
                if len(key(s)) >= min_chars:
                    held[key(s)].add(r[0])
    out = []
    for r in rows:
        every = (r[1] or "").split("\n")
        kept = [s for s in every if r[0] is None or len(held.get(key(s), ())) < min_docs or max(held[key(s)]) == r[0]]
        out.append((r[0], "\n".join(kept), len(every), len(every) - len(kept)))
    return out


def test_line_dedup(docs, rows, empty):
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()]
    assert sorted(got, key=str) == sorted(model_lines(rows), key=str)
    assert sum(r[3] for r in got) > 0
    assert line_dedup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("gather", [64, 1 << 19])
def test_bloom_planes_have_no_misses(spark, monkeypatch, gather):
    """Each document's hashes that occur twice are found, and few others, whatever a task gathers."""
    monkeypatch.setattr(repeats, "GATHER", gather)
    rng = random.Random(3)
    rows = [(i, [rng.randrange(1500) for _ in range(6)]) for i in range(400)]

    def hashes(batch):
        lists = batch.column(1)
        for r in range(len(lists)):
            yield tn.mix(lists[r].values.to_numpy().astype(np.uint64)), np.full(len(lists[r]), r)

    df = spark.createDataFrame(rows, "id long, v array<long>").repartition(5)
    found = {r.id: r.found for r in repeats.suspected(df, hashes, 32).collect()}
    counts = collections.Counter(v for _, vs in rows for v in vs)
    pa = pytest.importorskip("pyarrow")
    wrong = total = 0
    for i, vs in rows:
        h = tn.mix(np.array(vs, np.uint64))
        told = repeats.is_suspected(h, np.zeros(len(h), int), pa.array([bytes(found[i]) if i in found else None], pa.binary()), 32)
        assert all(t for t, v in zip(told, vs) if counts[v] > 1)
        wrong += sum(bool(t) for t, v in zip(told, vs) if counts[v] == 1)
        total += len(vs)
    assert wrong < 0.1 * total


def test_planes_never_fill_up():
    """Ten million hashes of one range, ten times what a plane of 128 MB shared by 64 ranges had room
    for: planes are as large as their hashes ask for, and few that occur once are suspected."""
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 32, 10_000_000, dtype=np.uint64).astype(np.uint32)
    bits = repeats.plane_bits(len(h))
    twice = repeats.planes([(repeats.places(h, bits), np.zeros(len(h), bool))], bits)
    assert twice[repeats.places(h[:1000], bits)].all(0).mean() < 0.1


def model_strings(rows, length):
    seen = {}
    for r in rows:
        b = (r[1] or "").encode()
        for s in range(len(b) - length + 1) if r[0] is not None else ():
            k = b[s : s + length]
            seen[k] = min(seen.get(k, r[0]), r[0])
    out = []
    for r in rows:
        b = (r[1] or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1) if r[0] is not None else ():
            if seen[b[s : s + length]] < r[0]:
                gone[s : s + length] = True
        out.append((r[0], bytes(np.frombuffer(b, np.uint8)[~gone]), len(b), int(gone.sum()), len(tn.runs(gone)[0])))
    return out


def test_suffix_dedup(docs, rows, empty):
    s = suffix_dedup
    out = s.dedup_strings(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = [(r.doc_id, bytes(r[s.KEPT]), r[s.BYTES], r[s.REMOVED], r[s.SPANS]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(model_strings(rows, 50), key=str)
    assert s.dedup_strings(empty).count() == 0


def test_suffix_dedup_of_one_id_and_long_texts(spark, monkeypatch):
    rng = random.Random(1)
    long = sentence(rng, 4000)
    rows = [(1, long), (2, long[500:900] + "x" + long[9000:9100]), (3, long[:40]), (3, long[100:200]), (0, "y" * 60), (9, "y" * 200)]
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 10)
    pieces = list(suffix_dedup._pieces(__import__("pyarrow").array([long]), 50))
    assert len(pieces) > 5 and b"".join(bytes(p[2][: 1 << 10]) for p in pieces)[: len(long.encode())] == long.encode()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    s = suffix_dedup
    got = [(r.doc_id, bytes(r[s.KEPT]), r[s.BYTES], r[s.REMOVED], r[s.SPANS]) for r in s.dedup_strings(df, keep=["doc_id"]).collect()]
    assert sorted(got, key=str) == sorted(model_strings([(*r,) for r in rows], 50), key=str)


def test_suffix_dedup_spreads_a_hot_anchor(spark, monkeypatch):
    """A phrase in every text with different neighbours; some of the texts share more."""
    rng = random.Random(13)
    phrase = "this very phrase is in each of the texts"
    around = [(sentence(rng, 6), sentence(rng, 6)) for _ in range(300)]
    rows = [(i, f"{a} {phrase} {b if i % 3 else around[i // 6][1]}") for i, (a, b) in enumerate(around)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    s = suffix_dedup
    monkeypatch.setattr(s, "HOT", 100)
    hot = s.hot_anchors(df.select(F.col("doc_id").alias("id"), "text"), 50)
    assert len(hot) > 0
    pa = pytest.importorskip("pyarrow")
    found = repeats.suspected(df.select(F.col("doc_id").alias("id"), "text"), s._anchors(50), 32).select(F.col("id").alias(s.ID), F.col("found").alias(s.FOUND))
    texts = common.squeezed_docs(df.withColumn(s.HASH, F.xxhash64("text")), ["doc_id", s.HASH], "text").join(found, F.col("doc_id") == F.col(s.ID), "left")

    def most(hot):
        run = s._candidates(spark.sparkContext.broadcast(hot), 50, 32, "doc_id")
        sent = pa.Table.from_batches(run(texts.toArrow().to_batches()))
        anchors = [repeats.unzipped(x, np.uint64) for x in sent["anchors"] if x.is_valid]
        return np.unique(np.concatenate(anchors), return_counts=True)[1].max()

    assert most(hot[:0]) > 150 >= most(hot)
    got = [(r.doc_id, bytes(r[s.KEPT]), r[s.BYTES], r[s.REMOVED], r[s.SPANS]) for r in s.dedup_strings(df, keep=["doc_id"]).collect()]
    assert sorted(got, key=str) == sorted(model_strings(rows, 50), key=str)
    assert sum(r[3] for r in got) > 0


@pytest.mark.parametrize("symbols", [1, 2, 5])
def test_difference_cover(symbols):
    rng = np.random.default_rng(symbols)
    for n in [*range(1, 30), 200]:
        s = rng.integers(0, symbols, n)
        order = sorted(range(n), key=lambda i: tuple(s[i:]))
        rank = np.empty(n, int)
        rank[order] = np.arange(1, n + 1)
        assert (suffix_dedup.difference_cover_ranks(s, 10**9) == rank).all()
        near = suffix_dedup.difference_cover_ranks(s, 4)
        assert all(near[i] < near[j] for i in range(n) for j in range(n) if tuple(s[i : i + 4]) < tuple(s[j : j + 4]))


def bag(text, k=5):
    w = words(lower(text))
    shingles = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] or ([tuple(w)] if w else [])
    seen = collections.Counter()
    out = set()
    for x in shingles:
        out.add((x, seen[x]))
        seen[x] += 1
    return frozenset(out)


def model_classes(rows, threshold=0.8):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [r for r in rows if r[0] is not None]
    bags = [bag(r[1]) for r in known]
    for i in range(len(known)):
        for j in range(i):
            both = len(bags[i] & bags[j])
            same = words(lower(known[i][1])) == words(lower(known[j][1]))
            if same or (bags[i] and bags[j] and both >= threshold * (len(bags[i]) + len(bags[j]) - both)):
                a, b = find(known[i][0]), find(known[j][0])
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_dedup(docs, rows, empty):
    want = model_classes(rows)
    got = near_dedup.classes(docs).collect()
    assert sorted((r.doc_id, r.class_id) for r in got if r.doc_id is not None) == sorted((r[0], want[r[0]]) for r in rows if r[0] is not None)
    assert [r.class_id for r in got if r.doc_id is None] == [None]
    assert any(want[i] != i for i in want)
    kept = near_dedup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))
    assert near_dedup.classes(empty).count() == 0 and near_dedup.dedup(empty).count() == 0


def test_near_dedup_of_a_large_group(spark, monkeypatch):
    """Chains within a bucket: members that their leader doesn't explain."""
    rng = random.Random(3)
    base = sentence(rng, 100).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(100)] = f"edit{rng.randint(0, 30)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(near_dedup, "TILE", 16)
    want = model_classes(rows)
    got = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_rows_of_one_id_are_one_class(spark):
    rng = random.Random(4)
    a, b = sentence(rng, 30), sentence(rng, 30)
    rows = [(5, a), (7, a), (7, b), (9, b), (8, sentence(rng, 30))]
    got = {r.doc_id: r.class_id for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {5: 5, 7: 5, 9: 5, 8: 8}


@pytest.mark.parametrize("hot", [1, 1 << 14])
def test_no_link_of_an_id_with_two_texts_is_lost(spark, monkeypatch, hot):
    """Near copies of either text of an id are in its class; groups above HOT give the same classes."""
    rng = random.Random(15)
    monkeypatch.setattr(near_dedup, "HOT", hot)

    def near(text):
        w = text.split()
        w[rng.randrange(len(w))] = f"edit{rng.randrange(9)}"
        return " ".join(w)

    a, b = sentence(rng, 60), sentence(rng, 60)
    rows = [(5, a), (5, b), (7, near(b)), (9, near(a))]
    for i in range(20, 60, 2):
        x, y = sentence(rng, 60), sentence(rng, 60)
        rows += [(i, x), (i, y), (i, x.upper()), (rng.randint(100, 120), near(x)), (rng.randint(100, 120), near(y)), (200 + i, x)]
    rows += [(300 + i, near(a)) for i in range(30)]
    want = model_classes(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.class_id) for r in near_dedup.classes(df).collect())
    assert got == sorted((r[0], want[r[0]]) for r in rows) and want[7] == want[9] == want[5] == 5
    kept = [sorted(map(tuple, near_dedup.dedup(df.repartition(n)).collect())) for n in (1, 4)]
    assert kept[0] == kept[1] and [r[0] for r in kept[0]] == sorted(set(want.values()))


def test_dart_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = tn.mix(np.arange(1, 4001, dtype=np.uint64))
    for size, both in ((20, 16), (300, 200), (2000, 1800)):
        a, b = pool[:size], pool[size - both : 2 * size - both]
        row = np.repeat([0, 1], size)
        found = [(lambda s: (s[0] == s[1]).mean())(near_dedup.dart_signatures(np.concatenate([tn.mix(a + np.uint64(t)), tn.mix(b + np.uint64(t))]), row, 2)) for t in rng.integers(1, 1 << 30, 30)]
        assert abs(np.mean(found) - both / (2 * size - both)) < 0.03


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lm_score(docs, rows, empty):
    tokens = lambda t: [*words(lower(t)), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    train = collections.Counter(x for r in rows if not held(r[0]) for x in tokens(r[1]))
    n, v = sum(train.values()), len(train)
    want = []
    for r in rows:
        t = tokens(r[1])
        want.append((r[0], held(r[0]), len(t), sum(train[x] > 0 for x in t), n, round(sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), 6)))
    got = lm_score.score(docs).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == sorted(want, key=str)
    assert all(r.score < 0 for r in got)
    assert lm_score.score(empty).count() == 0


def tokens_of(*texts):
    data = [t.encode() for t in texts]
    return tn.Tokens(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))


def test_lm_probabilities_add_up():
    rng = np.random.default_rng(2)
    t = tokens_of("The cat sat on the mat. El gato", "")
    assert t.first.tolist() == [0, 9, 10] and t.h[8] == tn.END == t.h[9]
    past = lm_score.History(t)
    for (rows, y), shape in zip(past.both(), lm_score.SHAPES):
        p = lm_score.softmax(rng.normal(size=shape).astype(np.float32), rows)  # of any weights
        assert p.shape == (10, shape[1]) and np.allclose(p.sum(1), 1, atol=1e-5) and (y < shape[1]).all()


def test_lm_gradient_is_that_of_the_likelihood(spark):
    """Against small changes of single weights."""
    rng = np.random.default_rng(5)
    texts = ["one two three two one", "two one one three", "die und der", "one"]
    w = [rng.normal(size=shape).astype(np.float32) for shape in lm_score.SHAPES]
    docs = spark.createDataFrame([(i * 5, t) for i, t in enumerate(texts) if not lm_score.held_out(i * 5)], "id long, text string").repartition(2)
    past = lm_score.History(tokens_of(*[r.text for r in docs.collect()]))
    sent = spark.sparkContext.broadcast(lm_score.with_bias(w))
    rows = docs.mapInArrow(lm_score._gradient(sent, (0, 1)), lm_score._COUNTED).groupBy("shard", "part").applyInArrow(lm_score._summed(False), "shard long, counts binary")
    got = lm_score.cell_sum(rows)
    for i, (r, y) in enumerate(past.both()):
        whole = lambda x: lm_score.with_bias([x if i == j else v for j, v in enumerate(w)])[i]  # noqa: B023, E731
        loss = lambda x: -np.log(lm_score.softmax(whole(x), r)[np.arange(len(y)), y]).sum()  # noqa: B023, E731
        bias = lm_score.FEATURES * lm_score.ROWS if i == 0 else int(past.cls[2] + 1) * (lm_score.FEATURES * lm_score.PART_ROWS + 1) - 1
        for cell in [(r[0][0], y[0]), (r[2][3], y[3]), (bias, y[2]), (bias, 0), (r[1][2], 7)]:
            up, down = w[i].astype(np.float64), w[i].astype(np.float64)
            up[cell] += 1e-4
            down[cell] -= 1e-4
            assert abs((loss(up) - loss(down)) / 2e-4 - got[i][cell]) < 2e-2


def test_lm_score_is_that_of_the_model(spark, docs, rows):
    """Counts, first weights, softmaxes and frequencies in plain loops."""
    train = [r for r in rows if not lm_score.held_out(r[0])]
    joint = [np.zeros(shape) for shape in lm_score.SHAPES]
    count, tokens, types = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for r in train:
        t = tokens_of(r[1] or "")
        past = lm_score.History(t)
        for n, (fs, y) in zip(joint, past.both()):
            for f in fs:
                for a, b in zip(f.tolist(), y.tolist()):
                    n[a, b] += 1
        for q in range(len(past.cls)):
            joint[0][-1, past.cls[q]] += 1
            joint[1][(past.cls[q] + 1) * (lm_score.FEATURES * lm_score.PART_ROWS + 1) - 1, past.part[q]] += 1
        for h, c, q in zip(t.h.tolist(), past.cls.tolist(), past.part.tolist()):
            count[h] += 1
            tokens[c, q] += 1
            types[c, q].add(h)
    w = lm_score.first_weights(joint)
    want = []
    for r in rows:
        t = tokens_of(r[1] or "")
        past = lm_score.History(t)
        total = 0.0
        for i in range(len(t.h)):
            for x, (fs, y) in zip(w, past.both()):
                bias = -1 if x is w[0] else (past.cls[i] + 1) * (lm_score.FEATURES * lm_score.PART_ROWS + 1) - 1
                z = np.exp(sum(x[f[i]].astype(np.float64) for f in fs) + x[bias])
                total += math.log10(z[y[i]] / z.sum())
            own = past.cls[i], past.part[i]
            total += math.log10((count[int(t.h[i])] + 0.5) / (tokens[own] + 0.5 * (len(types[own]) + 1)))
        want.append((str(r[0]), round(total, 2)))
    got = sorted((str(r.doc_id), r.score) for r in lm_score.score(docs, steps=0).collect())
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-3 * abs(b[1]) + 0.02 for a, b in zip(got, sorted(want), strict=True))


def test_lm_beats_the_unigram_on_held_out_text(spark, small):
    out = lm_score.score(spark.read.parquet(f"{small}/documents.parquet")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1] * 0.97  # 3 % better at least, even on 200 texts


def model_statistics(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


def test_quality_statistics(spark, docs, rows, empty):
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows if r[0]] + [(None, 0, None), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(docs, labels).collect()
    fields = lambda r: (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert sorted(map(fields, got), key=str) == sorted(((r[0], *model_statistics(r[1])) for r in rows), key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)  # one class of labels teaches nothing
    assert quality_rules.judge(empty, labels.limit(0)).count() == 0
    odd = [("a b c d e f " * 9).strip(), "w " * 4, "# $ | <b> && a\n# $ | <b> && a\n", "\n\n x \n x \n"]
    stats = quality_rules.text_statistics(spark.createDataFrame(list(enumerate(odd)), "doc_id int, text string")).orderBy("doc_id").collect()
    assert [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in stats] == [model_statistics(t) for t in odd]


def test_quality_rules_learn(spark):
    rng = random.Random(7)
    good = [(i, sentence(rng, rng.randint(30, 60)), 1) for i in range(200)]
    bad = [(1000 + i, " ".join(f"{w}###" for w in words(sentence(rng, rng.randint(30, 60)))), 0) for i in range(80)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    out = quality_rules.judge(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    got = {r.doc_id: r.kept for r in out.collect()}
    assert sum(got[i] for i, *_ in good) >= 198 and sum(got[i] for i, *_ in bad) <= 4
    rules = quality_rules.learn(quality_rules.text_statistics(df).withColumn("bad", 1 - F.col("quality")))
    assert rules and "symbol_share" in str(rules[0][0])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def model_windows(rows, length=13):
    seen = {}
    for r in rows:
        w = words(r[1])
        for s in range(len(w) - length + 1) if r[0] is not None else ():
            k = tuple(w[s : s + length])
            seen[k] = min(seen.get(k, r[0]), r[0])
    out = []
    for r in rows:
        w = words(r[1])
        gone = {j for s in range(len(w) - length + 1) if r[0] is not None and seen[tuple(w[s : s + length])] < r[0] for j in range(s, s + length)}
        out.append((r[0], " ".join(x for j, x in enumerate(w) if j not in gone), len(w), len(gone)))
    return out


def test_window_dedup(docs, rows, empty):
    d = window_dedup
    out = d.dedup_windows(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = [(r.doc_id, r[d.TEXT], r[d.WORDS], r[d.REMOVED]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(model_windows(rows), key=str)
    assert sum(r[3] for r in got) > 0 and d.dedup_windows(empty).count() == 0


def test_windows_of_one_id_with_two_texts(spark):
    """What repeats in one text of an id says nothing about its other texts."""
    rng = random.Random(14)
    x, y, z = sentence(rng, 40), sentence(rng, 40), sentence(rng, 40)
    rows = [(1, x), (2, x), (2, y), (2, x + " " + z), (3, z), (4, y)]
    d = window_dedup
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r[d.TEXT], r[d.WORDS], r[d.REMOVED]) for r in d.dedup_windows(df, keep=["doc_id"]).collect()]
    assert sorted(got) == sorted(model_windows(rows))
    assert sum(r[3] for r in got) == 160


@pytest.mark.parametrize("length", [5, 16, 30, 60])
def test_window_levels(spark, length):
    rng = random.Random(length)
    shared = sentence(rng, 200).split()
    rows = []
    for i in range(30):
        a = rng.randrange(120)
        rows.append((i, " ".join([*sentence(rng, 10).split(), *shared[a : a + rng.randint(4, 80)], *sentence(rng, 10).split()])))
    steps = window_dedup.levels(length)
    assert steps[-1] == length and all(b in (2 * a, 2 * a - 1) for a, b in zip(steps[:-1], steps[1:])) and len(steps) >= 2
    d = window_dedup
    got = [(r.doc_id, r[d.TEXT], r[d.WORDS], r[d.REMOVED]) for r in d.dedup_windows(spark.createDataFrame(rows, "doc_id long, text string"), length, keep=["doc_id"]).collect()]
    assert sorted(got) == sorted(model_windows(rows, length)) and sum(r[3] for r in got) > 0


def test_longest_repeats(docs, rows, empty):
    def longest(r):
        best, size = None, 13
        mine = words(r[1])
        while True:
            grams = {tuple(mine[i : i + size]) for i in range(len(mine) - size + 1)}
            if not any(q[0] not in (None, r[0]) and any(tuple(words(q[1])[i : i + size]) in grams for i in range(len(words(q[1])) - size + 1)) for q in rows):
                return best
            best, size = size, size * 2

    want = collections.defaultdict(int)
    for r in rows:
        if r[0] is not None and longest(r):
            want[r[0]] = max(want[r[0]], longest(r))
    assert {r.id: r.longest for r in window_dedup.longest_repeats(docs).collect()} == dict(want)
    assert window_dedup.longest_repeats(empty).count() == 0


def trusted_rows():
    rng = random.Random(8)
    good = [(i, sentence(rng, rng.randint(20, 60)), "en" if i % 2 else None) for i in range(300)]
    bad = [(1000 + i, " ".join(rng.choice("QZXJK") * rng.randint(2, 9) + "!!" for _ in range(40)), "en") for i in range(30)]
    return good, bad


def test_quality_classifier(spark, docs, empty):
    good, bad = trusted_rows()
    df = spark.createDataFrame([*good, *bad, (5000, None, "en"), (5001, "", None), (None, good[0][1], "xx")], "doc_id long, text string, lang string").withColumn("n", F.lit(1))
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in good[:200]] + [(i, 0, 0) for i, *_ in bad] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = perplexity.keep_good(df, labels)
    assert kept.columns == df.columns
    got = {r.doc_id for r in kept.collect()}
    assert len(got & {i for i, *_ in good}) >= 297 and not got & {i for i, *_ in bad} and not got & {5000, 5001} and None in got
    assert perplexity.keep_good(empty, labels).count() == 0
    assert perplexity.keep_good(docs, labels.limit(0)).count() > 0


def test_limits_are_of_all_trusted_text_outside_the_model(spark):
    """A language with 1 % of the trusted documents, far more of them than the model is trained on."""
    rng = random.Random(11)
    common_ = [(i, sentence(rng, 12), "en") for i in range(9900)]
    rare = [(20000 + i, " ".join("".join(rng.choice("бвгджзклмнпрстуфхцчшщ") for _ in range(6)) for _ in range(12)), "ru") for i in range(100)]
    df = spark.createDataFrame([*common_, *rare], "doc_id long, text string, lang string")
    labels = df.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = perplexity.classify(df, labels, max_trusted=400, keep=["doc_id", "lang"]).filter("lang = 'ru'").collect()
    assert sum(r["__sl_good"] for r in got) >= 98
    assert {r["__sl_limit"] for r in got}.isdisjoint({r["__sl_limit"] for r in perplexity.classify(df, labels, max_trusted=400, keep=["lang"]).filter("lang = 'en'").collect()})


def test_highest_window():
    rng = np.random.default_rng(3)
    at = np.array([0, 0, 5, 60, 61, 61])
    v = rng.normal(size=61)
    want = [max(v[i : min(i + 8, b)].sum() for i in range(a, max(a, b - 8) + 1)) if b > a else -np.inf for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    assert np.allclose(perplexity._highest(v, at, 8), want)


def test_single_rude_words_show(spark):
    """Ordinary prose with one or two words that toxic text has, at random places."""
    rng = random.Random(12)

    def prose(rude):
        w = sentence(rng, 60).split()
        for _ in range(rude and rng.randint(2, 3)):
            w.insert(rng.randrange(60), rng.choice(["wretched", "bumbler", "grumpfox"]))
        return " ".join(w)

    rows = [(i, prose(i % 4 == 0), "en", 1, int(i % 4 == 0)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int, toxic int")
    labels = df.filter("doc_id < 600").select("doc_id", "quality", "toxic")
    got = {r.doc_id: r["__sl_good"] for r in perplexity.classify(df.select("doc_id", "text", "lang"), labels, keep=["doc_id"]).collect()}
    unseen = range(600, 800)
    assert sum(got[i] for i in unseen if i % 4 == 0) <= 5
    assert sum(got[i] for i in unseen if i % 4) >= 144


def model_kneser_ney(texts):
    """P(token | two before) of an interpolated modified Kneser-Ney model, by the book."""
    tri = collections.Counter()
    for x in texts:
        t = ["<s>", "<s>", *words(lower(x)), "</s>"]
        tri.update(zip(t, t[1:], t[2:]))
    bi, uni = collections.Counter(), collections.Counter()
    for (a, b, c), n in tri.items():
        bi[b, c] += n if b == "<s>" else 1
    for _, c in bi:
        uni[c] += 1

    def level(counts):
        t = collections.Counter(counts.values())
        y = t[1] / (t[1] + 2 * t[2]) if t[1] and t[2] else 0.5
        d = [min(max(i - (i + 1) * y * t[i + 1] / t[i], 0.1), i) if t[i] and t[i + 1] else 0.5 for i in (1, 2, 3)]
        total, held = collections.Counter(), collections.Counter()
        for g, n in counts.items():
            g = g if isinstance(g, tuple) else (g,)
            total[g[:-1]] += n
            held[g[:-1]] += d[min(n, 3) - 1]

        def p(g, below):
            n = counts.get(g if len(g) > 1 else g[0], 0)
            if not total[g[:-1]]:
                return below
            return ((n - d[min(n, 3) - 1] if n else 0) + held[g[:-1]] * below) / total[g[:-1]]

        return p

    one, two, three = level(uni), level(bi), level(tri)
    return lambda a, b, c: three((a, b, c), two((b, c), one((c,), 1 / (len(uni) + 1)))), set(uni)


@pytest.mark.parametrize("heads", [3, 20_000])
def test_perplexity_is_that_of_kneser_ney(spark, rows, monkeypatch, heads):
    """Also of texts with unknown words; whether n-grams are broadcast or joined."""
    monkeypatch.setattr(perplexity, "HEADS", heads)
    rng = random.Random(17)
    taught = [" ".join(rng.choice("ab bc cd de ef fg gh A é".split()) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    asked = [*taught[:20], *(r[1] for r in rows), "zz ab yy", "ab ab ab cd"]
    p, vocabulary = model_kneser_ney(taught)
    assert abs(sum(p("ab", "cd", c) for c in vocabulary) + p("ab", "cd", "new") - 1) < 1e-9
    want = []
    for x in asked:
        t = ["<s>", "<s>", *words(lower(x)), "</s>"]
        loss = -sum(math.log10(p(*t[i : i + 3])) for i in range(len(t) - 2))
        want.append(10 ** (loss / (len(t) - 2)) if len(t) > 3 else None)
    training = spark.createDataFrame([(0, t) for t in taught], "set int, text string").repartition(3)
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(asked)], "doc_id long, text string, lang string").repartition(3)
    got = {r["__sl_id"]: r["__sl_perplexity"] for r in perplexity.scores(docs, training, "doc_id", "text", "lang").collect()}
    for i, w in enumerate(want):
        assert got[i] is None if w is None else abs(got[i] / w - 1) < 1e-4


def test_gathered_sums_must_match(spark):
    """A gathering whose rows are not those that were sent ends the job, not the result."""
    pa = pytest.importorskip("pyarrow")
    import pickle

    own = pickle.dumps((2, {"units": np.ones(1, int)}))
    table = pa.table({"gather": [1, 1], "units": [None, repeats.zipped(np.array([0], np.uint32))], "sums": [None, np.ones(1).tobytes()], "own": [own, None]})
    with pytest.raises(RuntimeError):
        gramjoin._gathered(1, lambda own, sums: None)(table)


def off_target(rows, shards):
    """How far each boundary between shards is from its place, in bytes. rows: (shard, size)."""
    sizes = collections.Counter()
    for at, n in rows:
        sizes[at] += n
    total, below, out = sum(sizes.values()), 0, []
    for s in range(shards - 1):
        below += sizes[s]
        out.append(abs(below - total * (s + 1) / shards))
    return out


def test_sharding(docs, rows, empty, spark):
    out = shard.shard(docs, 4)
    assert set(docs.columns) - {"size", "shard"} <= set(out.columns) and {"size", "shard", "slot"} <= set(out.columns)
    got = out.collect()
    assert len(got) == len(rows) and sum(r["size"] for r in got) == sum(16 + len((r[1] or "").encode()) for r in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in by.values())
    assert sorted((r.doc_id, r["shard"]) for r in got if r.doc_id is not None) == sorted((r.doc_id, r["shard"]) for r in shard.shard(docs.repartition(2), 4).collect() if r.doc_id is not None)
    assert shard.shard(empty).count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    # A hot text of a third of all rows is dealt over several shards; small groups stay whole.
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot " * 20)).otherwise(F.concat(F.lit("text number "), F.col("id") % 700, F.repeat(F.lit("x"), 60))).alias("text"))
    got = shard.shard(many, 10).collect()
    sizes = collections.Counter()
    places = collections.defaultdict(set)
    for r in got:
        sizes[r["shard"]] += r["size"]
        places[r.text].add(r["shard"])
    mean = sum(sizes.values()) / 10
    assert len(sizes) == 10 and all(abs(s - mean) < 0.15 * mean for s in sizes.values())
    assert max(off_target([(r["shard"], r["size"]) for r in got], 10)) <= 0.03 * mean + max(r["size"] for r in got)
    assert len(places["hot " * 20]) > 2 and sum(len(p) > 1 for t, p in places.items()) <= 2


def model_hits(docs, items, window=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    find = lambda t: re.findall(pattern, lower(t))
    out = []
    for r in docs:
        w, hit, names = find(r[1]), set(), set()
        for i, t in items:
            x = find(t)
            n = min(window, len(x))
            for s in range(len(x) - n + 1) if n and i is not None else ():
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == x[s : s + n]:
                        hit |= set(range(j, j + n))
                        names.add(str(i))
        out.append((r[0], len(w), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("bits", [(10, 10), (27, 23)])
def test_decontamination(spark, docs, rows, empty, monkeypatch, bits):
    rng = random.Random(9)
    source = " ".join(words(rows[14][1]))
    items = [(1, "ONE two!"), (2, None), (3, "..."), (4, " ".join(source.split()[40:75])), (10, sentence(rng, 20)), (11, rows[10][1][:400]), (12, "x" * 300), (None, "one"), (13, " ".join(source.split()[50:59]))]
    monkeypatch.setattr(decontaminate, "SIEVE_BITS", bits)
    monkeypatch.setattr(decontaminate, "HOT", 1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = decontaminate
    out = d.contamination(docs, bench).withColumn("hit", d.hit_words())
    got = [(r.doc_id, r[d.WORDS], r.hit, r[d.ITEMS]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(model_hits(rows, items), key=str)
    clean = d.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(h == 0 for _, _, h, _ in model_hits(rows, items))
    assert d.contamination(empty, bench).count() == 0 and d.clean(docs, bench.limit(0)).count() == len(rows)


def test_items_without_id_count_as_in_the_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    import corpus_pipeline

    rng = random.Random(14)
    a, b = sentence(rng, 14), sentence(rng, 14)
    texts = [f"x {a} y", f"{b} {a}", b, sentence(rng, 30), "short one", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, a), (7, b), (None, "short one"), (None, b), (8, None)], "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(queries.ORACLE["op9_decontamination"]).fetchall()
    got = [tuple(r) for r in queries.op9_decontamination(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()} == {r[0] for r in want if not r[2]}


def test_a_large_benchmark(spark):
    """20 MB of benchmark, of which the driver sees the sieve alone; some documents hold parts of it."""
    import resource

    items = spark.range(20_000).select(F.col("id").alias("item_id"), F.concat_ws(" ", *[F.expr(f"hex(xxhash64(id, {j}))") for j in range(60)]).alias("text"))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    part = lambda a: F.concat_ws(" ", *[F.expr(f"hex(xxhash64(7 * id, {j}))") for j in range(a, a + 12)])
    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("some words "), part(20), F.lit(" more"))).otherwise(F.concat(F.lit("own words "), F.repeat(F.concat(F.col("id"), F.lit(" ")), 30))).alias("text"))
    got = decontaminate.contamination(docs, items, keep=["doc_id"]).select("doc_id", decontaminate.hit_words().alias("hit"), decontaminate.ITEMS).collect()
    assert len(got) == 2_000
    for r in got:
        hit = r.doc_id % 2 == 0
        assert r.hit == (12 if hit else 0) and r[decontaminate.ITEMS] == ([str(7 * r.doc_id)] if hit else [])
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 300


def test_winnowing_guarantee():
    g = tn.mix(np.arange(1, 2000, dtype=np.uint64) % np.uint64(97))
    on = tn.chosen(g, 6)
    assert all(on[i : i + 6].any() for i in range(len(g) - 5))
    assert on.sum() < len(g) * 0.6
    slow = np.zeros(len(g), bool)
    for i in range(len(g) - 5):
        w = g[i : i + 6]
        slow[i : i + 6] |= w == w.min()
    assert (slow == on).all()


def model_targets(size):
    """Targets by repeated filling. size: words by source, in the order in which weights are dealt."""
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(size)}
    target, total, free = {}, 1.5 * sum(size.values()), set(size)
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: 2.0 * size[s] for s in over}
        free -= over


def test_mixing(docs, rows, empty, spark):
    out = mixture.mix(docs)
    got = out.collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    names = sorted((s for s in by if s is not None)) + [None]
    size = {s: sum(r["size"] for r in x) for s, x in by.items()}
    assert {s: {r["source_size"] for r in x} for s, x in by.items()} == {s: {n} for s, n in size.items()}
    target = model_targets({s: size[s] for s in names})
    for s, x in by.items():
        assert all(abs(r["target"] - target[s]) < 1e-6 for r in x)
        taken = sum(r["size"] * r["repeats"] for r in x)
        assert abs(taken - target[s]) <= max(r["size"] for r in x) and all(r["repeats"] <= 2 or r["size"] == 0 for r in x)
    again = mixture.mix(docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), str(r.text), r["repeats"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixture.mix(empty).count() == 0
    copies = mixture.repeat(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r["repeats"] for r in got)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_materialized_tables_go_to_the_shared_folder(spark):
    df = common.materialize(spark.range(5))
    assert all(f.startswith(common.shared_dir(spark).replace("file:///", "file:///")) or "/sluice-" in f for f in df.inputFiles())
    assert df.count() == 5
    common.discard(df)


def test_word_hashes_agree_with_words():
    text = ["ab  cd\nab", "", "é ab", "cd"]
    data, at = tn.buffers(__import__("pyarrow").array(text))
    starts, ends, first = tn.words(data, at)
    h = tn.span_hash(data, starts, ends)
    got = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert got == ["ab", "cd", "ab", "é", "ab", "cd"] and first.tolist() == [0, 3, 3, 5, 6]
    assert (h[0] == h[2]) and (h[2] == h[4]) and (h[1] == h[5]) and len(set(h.tolist())) == 3


def test_digest_is_of_bytes():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_excess_is_as_the_softmax_and_adds_up():
    """Turned, piece by piece, with nothing changed; rows that repeat are added up."""
    rng = np.random.default_rng(3)
    weights, n = rng.normal(size=(50, 7)).astype(np.float32), 2 * lm_score.TOGETHER + 5
    rows, y = [rng.integers(0, 50, n) for _ in range(4)], rng.integers(0, 7, n)
    want = lm_score.softmax(weights, rows)
    want[np.arange(n), y] -= 1
    got = lm_score.excess(weights, rows, y)
    assert np.array_equal(got, want.T)
    out, total = np.zeros((50, 7), np.float32, order="F"), np.zeros((50, 7))
    lm_score._add(out, rows, got)
    for r in rows:
        np.add.at(total, r, want.astype(np.float64))
    assert np.allclose(out, total, atol=1e-3)


def test_near_dedup_has_no_large_plan(spark, small, monkeypatch):
    """The driver plans each query again after each of its exchanges: no query may have dozens."""
    from sluice.llm import components, near_dedup

    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    seen = []
    for module in (near_dedup, components):
        monkeypatch.setattr(module, "materialize", lambda df, f=module.materialize: (seen.append(exchanges(df)), f(df))[1])
    seen.append(exchanges(near_dedup.dedup(spark.read.parquet(f"{small}/documents.parquet"))))
    assert max(seen) < 10
