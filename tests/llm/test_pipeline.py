"""The registered queries and the pipeline over the smallest tables."""

import collections
import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import perplexity, queries
from sluice.llm.common import materialize
from test_operators import lower, model_classes, model_kneser_ney, model_targets, off_target, words


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, small, name):
    df = queries.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    assert len(got) == spark.read.parquet(f"{small}/documents.parquet").count()
    if name in queries.ORACLE:
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
        want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = []
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = materialize(stage(spark, docs, small))
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        assert docs.columns[: len(columns)] == columns and (docs.columns == columns or i == len(corpus_pipeline.STAGES) - 1)
        kept.append(ids)
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept[0] for i in good) > 0.97 * len(good)
    assert sum(i in kept[0] for i in bad) < 0.5 * len(bad)
    assert docs.agg(F.countDistinct("shard")).first()[0] <= 40


def quantile(values, q):
    values = sorted(values)
    return values[max(0, math.ceil(q * len(values)) - 1)] if values else None


def left_neighbours(texts, rival):
    """(word, word before it) pairs, once each. To a rival a word that repeats is one and the same."""
    out = set()
    for x in texts:
        t = ["<s>", *words(lower(x)), "</s>"]
        out |= {("again" if rival and a == b else b, a, b) for a, b in zip(t, t[1:])}
    return collections.Counter(c for c, _, _ in out), sum(a == b for _, a, b in out)


def discounted(counts):
    t = collections.Counter(counts.values())
    y = t[1] / (t[1] + 2 * t[2]) if t[1] and t[2] else 0.5
    d = [min(max(i - (i + 1) * y * t[i + 1] / t[i], 0.1), i) if t[i] and t[i + 1] else 0.5 for i in (1, 2, 3)]
    return {c: n - d[min(n, 3) - 1] for c, n in counts.items()}


def model_ratio(trusted, texts):
    """log10 of how much likelier than the trusted unigrams the rival makes a text's best passage."""
    base, twice = left_neighbours(trusted, False)
    all0, kept0 = sum(base.values()), discounted(base)
    unknown = (all0 - sum(kept0.values())) / all0 / (len(base) + 1)
    own, _ = left_neighbours(texts, True)
    total, kept = sum(own.values()), discounted(own)
    kept = {c: x for c, x in kept.items() if own[c] >= max(perplexity.NEIGHBOURS, total // perplexity.HEADS + 1)}
    rest = 1 - sum(kept.values()) / total
    under = {c: kept0.get(c, 0) / all0 + unknown for c in kept} | {"again": (twice + 1) / all0}
    value = {c: math.log10(x / total / under[c] + rest) for c, x in kept.items()}

    def ratio(text):
        w = words(lower(text))
        v = [value.get("again" if a == b else b, math.log10(rest)) for a, b in zip(["<s>", *w], w)] + [0.0]
        return max(sum(v[i : i + perplexity.PASSAGE]) for i in range(max(1, len(v) - perplexity.PASSAGE + 1)))

    return ratio


def model_quality(docs, sides):
    """(ids that stay, ids too near a limit to tell). sides: trusted, toxic and bad ids, each with
    whether a model is trained on it."""
    text = {r.doc_id: r.text for r in docs}
    taught = [[text[i] for i, trained in side.items() if trained and i in text] for side in sides]
    p, _ = model_kneser_ney(taught[0])
    ratios = [model_ratio(taught[0], x) for x in taught[1:]]
    seen = {}
    for r in docs:
        t = ["<s>", "<s>", *words(lower(r.text)), "</s>"]
        n = len(t) - 2
        if n > 1:
            loss = -sum(math.log10(p(*t[i : i + 3])) for i in range(n))
            seen[r.doc_id] = (r.lang, sum(n - 1 >= c for c in perplexity.CLASSES), 10 ** (loss / n), *(f(r.text) for f in ratios))
    others = [[seen[i] for i, trained in side.items() if not trained and i in seen] for side in sides]

    def limit(lang, size):
        of = lambda l, c: [x[2] for x in others[0] if (l is None or x[0] == l) and (c is None or x[1] == c)]
        for l, c in ((lang, size), (lang, None), (None, size)):
            if len(of(l, c)) >= 50:
                return 1.1 * quantile(of(l, c), 0.995)
        return 1.1 * quantile(of(None, None), 0.995)

    tops = []
    for i in (0, 1):
        q, low = quantile([x[3 + i] for x in others[0]], 0.99), quantile([x[3 + i] for x in others[i + 1]], 0.05)
        tops.append(math.inf if low is None or len(others[0]) < 50 else max(0.0, q, (q + low) / 2))
    good, close = set(), set()
    for k, (lang, size, value, *above) in seen.items():
        room = [limit(lang, size) / value - 1, *(t - a for t, a in zip(tops, above))]
        if min(abs(x) for x in room) < 1e-4:
            close.add(k)
        if min(room) >= 0:
            good.add(k)
    return good, close


def test_stages_against_brute_force(spark, small):
    """Each stage's rows, given what the stage before it kept."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    before = docs.collect()
    assert len({r.doc_id for r in before}) == len(before)
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, small))
        out.append(docs.collect())
    ids = [{r.doc_id for r in rows} for rows in out]

    sides = []
    for which in (perplexity.TRUSTED, *perplexity.RIVALS):
        own = perplexity._labelled(labels, "doc_id", which)
        sides.append({r[0]: r[1] for r in own.select(perplexity.ID, perplexity._in_training(own, perplexity.MAX_TRUSTED)).collect()})
    good, close = model_quality(before, sides)
    assert ids[0] - close == good - close and len(close) <= 0.02 * len(before)

    assert ids[1] == set(model_classes([(r.doc_id, r.text) for r in out[0]]).values())

    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = collections.defaultdict(set)
    for r in spark.read.parquet(f"{small}/benchmark.parquet").collect():
        w = find(r.text)
        n = min(10, len(w))
        windows[n] |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    clean = set()
    for r in out[1]:
        w = find(r.text)
        if not any(tuple(w[i : i + n]) in windows[n] for n in windows if n for i in range(len(w) - n + 1)):
            clean.add(r.doc_id)
    assert ids[2] == clean

    size = {r.doc_id: len(words(r.text)) for r in out[2]}
    source = {r.doc_id: r.source for r in out[2]}
    by = collections.Counter()
    for k, n in size.items():
        by[source[k]] += n
    target = model_targets({s: by[s] for s in sorted(by, key=lambda s: (s is None, s))})
    times = collections.Counter(r.doc_id for r in out[3])
    for s in by:
        mine = [k for k in size if source[k] == s]
        whole = math.floor(target[s] / by[s] + 1e-12)
        assert {times[k] for k in mine} <= {whole, whole + 1}
        assert abs(sum(size[k] * times[k] for k in mine) - target[s]) <= max(size[k] for k in mine) / 2 + 1e-6

    assert collections.Counter(r.doc_id for r in out[4]) == times
    slots = collections.defaultdict(list)
    for r in out[4]:
        assert r["size"] == 16 + len((r.text or "").encode())
        slots[r["shard"]].append(r["slot"])
    assert all(0 <= s < 40 and sorted(x) == list(range(len(x))) for s, x in slots.items())
    mean = sum(r["size"] for r in out[4]) / 40
    # The copies of one row can't be told apart: there are two at most.
    assert max(off_target([(r["shard"], r["size"]) for r in out[4]], 40)) <= 0.03 * mean + max(r["size"] for r in out[4])


def test_run(spark, small, monkeypatch, tmp_path):
    from sluice.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    out = corpus_pipeline.run(spark, small)
    # Stages leave the last one's input and what it wrote itself.
    assert len(list(tmp_path.glob("sluice-*"))) <= 3
    assert out.count() > 0 and {"size", "shard", "slot"} <= set(out.columns)
