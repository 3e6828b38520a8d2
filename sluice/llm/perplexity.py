"""Quality classifier: an interpolated modified Kneser-Ney model over words, trained on trusted text;
a document's perplexity is held against quantiles of trusted text in its language. Labelled toxic and
labelled bad text give rivals: Kneser-Ney unigrams, interpolated with the trusted model's. The
passage of a document that a rival makes likeliest, against the trusted unigrams, shows single
words that a whole document's perplexity hides. Rivals don't go beyond unigrams, and leave out words
with few different left neighbours, so that they don't learn passages by heart that labelled texts
share with clean ones. To them a word that repeats the one before it is one and the same token.

An interpolated model is a sum. With g(h) the weight that a context h leaves to shorter ones,

    log P(c | a b) = W(c) + W(b c) + W(a b c),     each term 0 if the n-gram was never seen,
    W(c)     = log p(c),
    W(b c)   = log p(c | b) - log p(c)  - log g(b),
    W(a b c) = log p(c | a b) - log p(c | b) - log g(a b),

and log g(b), log g(a b) where b, a b are contexts, which is folded into W(b) and W(a b). So the log
probability of a text is the sum of one number for each of its n-grams: a join of the documents'
n-grams with the model, sharded by hash (gramjoin.py). Counts, continuation counts, discounts and
contexts are joined in Spark as well. Frequent n-grams are broadcast, in bounded number; a sieve of
bounded size keeps n-grams that no model has out of the join.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gramjoin
from . import textnum as tn
from .common import P, materialize

ORDER = 3
#: Labelled documents that a model is trained on, at most (within a few per cent). Limits are
#: of all that it isn't trained on.
MAX_TRUSTED = 2_000
TRUSTED = "quality = 1 and coalesce(toxic, 0) = 0"
#: Labels of the texts that a rival model is trained on.
RIVALS = ("toxic = 1", "quality = 0 and coalesce(toxic, 0) = 0")
#: Tokens in which a rival is held against the trusted model.
PASSAGE = 8
#: Different left neighbours that a word of a rival has, at least.
NEIGHBOURS = 4
#: N-grams of each order, and words of a rival, that are broadcast, at most; places of the sieve, as a
#: power of two.
HEADS, SIEVE_BITS = 20_000, 27
_U = np.uint64
AGAIN = _U(0x8EBC6AF09C88C6E3)
_ORDERS = (_U(0), _U(0x9E6C63D0676A9A99), _U(0xB5AD4ECEDA1CE2A9))


def for_rivals(t: tn.Tokens) -> np.ndarray:
    return np.where(t.h == t.before(1), AGAIN, t.h)


def grams(t: tn.Tokens) -> list[np.ndarray]:
    """Hashes of the n-grams of each order that end at each token."""
    a, b = t.before(2), t.before(1)
    return [t.h, gram_hash(b, t.h), gram_hash(a, b, t.h)]


def gram_hash(*h: np.ndarray) -> np.ndarray:
    out = h[0]
    for x in h[1:]:
        out = out * tn.GRAM + x
    return tn.mix(out ^ _ORDERS[len(h) - 1])


_TRIGRAMS = "set int, abc long, ab long, bc long, b long, c long, n long"


def _trigrams(batches):
    """Counts of the trigrams of rows (set, text), summed within a batch."""
    for batch in batches:
        sets = batch.column(0).to_numpy(zero_copy_only=False)
        for row0, data, at in tn.slices(batch.column(1)):
            t = tn.Tokens(data, at)
            a, b = t.before(2), t.before(1)
            abc, own = gram_hash(a, b, t.h), sets[row0 + t.row].astype(np.int64)
            order = np.lexsort((abc, own))
            cut, end = gramjoin._pair_cuts(abc[order], own[order].astype(np.uint64))
            at = order[cut]
            c = np.where(own[at] > 0, for_rivals(t)[at], t.h[at])
            columns = [abc[at], gram_hash(a[at], b[at]), gram_hash(b[at], t.h[at]), b[at], c]
            yield pa.RecordBatch.from_arrays([pa.array(own[at].astype(np.int32)), *(pa.array(x.view(np.int64)) for x in columns), pa.array(end - cut)], names=["set", "abc", "ab", "bc", "b", "c", "n"])


def _discounted(level: DataFrame) -> DataFrame:
    """level (set, ..., n) with the modified discount d of each count."""
    many: dict[int, dict[int, int]] = {}
    for r in level.filter("n <= 4").groupBy("set", "n").agg(F.count(F.lit(1)).alias("t")).collect():  # 4 rows a set
        many.setdefault(r["set"], {})[r["n"]] = r["t"]
    out = F.lit(0.5)
    for s, counts in many.items():
        t = [counts.get(i, 0) for i in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1]) if t[0] and t[1] else 0.5
        d = [min(max(i - (i + 1) * y * t[i] / t[i - 1], 0.1), i) if t[i - 1] and t[i] else 0.5 for i in (1, 2, 3)]
        own = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        out = F.when(F.col("set") == s, own).otherwise(out)
    return level.withColumn("d", out)


def kneser_ney(text: DataFrame) -> tuple[DataFrame, list[DataFrame], list[float], float, float]:
    """(model, rivals, left, unknown, start). model: rows (order, hash, w, raw) of the n-grams of set 0, the
    trusted one; w of a unigram is less that of an unknown token; raw: its count. rivals: for each
    other set rows (hash, ratio, n), log10 of how much likelier than set 0 it makes a word, and left: the
    same of all other words. unknown: log10 probability of an unknown token; start: what each text
    begins with. text: (set, text)."""
    key = ["set", "abc", "ab", "bc", "b", "c"]
    every = materialize(text.mapInArrow(_trigrams, _TRIGRAMS).groupBy(*key).agg(F.sum("n").alias("n")))
    # Lower orders count distinct left neighbours; after the begin of a text there is but one.
    first = int(tn.BEGIN.view(np.int64))
    bi = every.groupBy("set", "bc", "b", "c").agg(F.when(F.first("b") == F.lit(first), F.sum("n")).otherwise(F.count(F.lit(1))).alias("n"), F.sum("n").alias("raw"))
    bi = materialize(bi)
    uni = _discounted(materialize(bi.groupBy("set", "c").agg(F.count(F.lit(1)).alias("n"), F.sum("raw").alias("raw"))))
    totals = {r["set"]: (r["n"], r["d"], r["v"]) for r in uni.groupBy("set").agg(F.sum("n").alias("n"), F.sum("d").alias("d"), F.count(F.lit(1)).alias("v")).collect()}  # a row a set
    n, d, v = totals.get(0, (1, 1.0, 0))
    unknown = d / n / (v + 1)
    of = lambda level: level.filter("set = 0").drop("set")
    p1 = materialize(of(uni).select("c", ((F.col("n") - F.col("d")) / n + unknown).alias("p"), "raw"))
    again = bi.filter("set = 0 and b = c").agg(F.lit(int(AGAIN.view(np.int64))).alias("c"), ((F.count(F.lit(1)) + 1) / F.lit(n)).alias("under"))
    under = p1.select("c", F.col("p").alias("under")).union(again)
    rivals, left = [], []
    for s in range(1, 1 + len(RIVALS)):
        if s not in totals or 0 not in totals:
            rivals.append(None)
            left.append(0.0)
            continue
        # What its words of few neighbours have goes to the trusted unigrams, as discounts do.
        all_ = totals[s][0]
        own = uni.filter((F.col("set") == s) & (F.col("n") >= max(NEIGHBOURS, all_ // HEADS + 1)))
        rest = 1.0 - (own.agg(F.sum(F.col("n") - F.col("d"))).first()[0] or 0.0) / all_
        own = own.join(under, "c", "left").fillna({"under": unknown})
        rivals.append(own.select(F.col("c").alias("hash"), F.log10((F.col("n") - F.col("d")) / all_ / F.col("under") + rest).alias("ratio")))
        left.append(float(np.log10(rest)))
    tri, bi = (_discounted(x.filter("set = 0")).drop("set") for x in (every, bi))
    g2 = materialize(bi.groupBy("b").agg(F.sum("n").alias("all2"), (F.sum("d") / F.sum("n")).alias("g2")))
    g3 = materialize(tri.groupBy("ab").agg(F.sum("n").alias("all3"), (F.sum("d") / F.sum("n")).alias("g3")))
    log, none = F.log10, F.lit(0.0)
    p2 = bi.join(g2, "b").join(p1.select("c", F.col("p").alias("p1")), "c")
    p2 = materialize(p2.select("bc", "raw", "g2", "p1", ((F.col("n") - F.col("d")) / F.col("all2") + F.col("g2") * F.col("p1")).alias("p")))
    after = g2.select(F.col("b").alias("c"), log("g2").alias("after"))
    one = p1.join(after, "c", "left").select(F.lit(1).alias("order"), F.col("c").alias("hash"), (log("p") - float(np.log10(unknown)) + F.coalesce("after", none)).alias("w"), "raw")
    after = g3.select(F.col("ab").alias("bc"), log("g3").alias("after"))
    two = p2.join(after, "bc", "left").select(F.lit(2).alias("order"), F.col("bc").alias("hash"), (log("p") - log("p1") - log("g2") + F.coalesce("after", none)).alias("w"), "raw")
    p3 = tri.join(g3, "ab").join(p2.select("bc", F.col("p").alias("p2")), "bc")
    three = p3.select(F.lit(3).alias("order"), F.col("abc").alias("hash"), (log((F.col("n") - F.col("d")) / F.col("all3") + F.col("g3") * F.col("p2")) - log("p2") - log("g3")).alias("w"), F.col("n").alias("raw"))
    both = int(gram_hash(np.array([tn.BEGIN]), np.array([tn.BEGIN])).view(np.int64)[0])
    start = g2.filter(F.col("b") == first).select(log("g2").alias("x")).union(g3.filter(F.col("ab") == both).select(log("g3"))).agg(F.sum("x")).first()[0]
    return one.union(two).union(three), rivals, left, float(np.log10(unknown)), start or 0.0


def _sieve(table: DataFrame, n: int) -> np.ndarray:
    """A bit for the low bits of each hash of the table; 16 bits a hash, 2**SIEVE_BITS at most."""
    size = 1 << max(10, min(SIEVE_BITS, (16 * n).bit_length()))
    low = F.col("hash").bitwiseAND(F.lit(size - 1).cast("long"))
    words = table.select(F.shiftright(low, 6).cast("int").alias("at"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    rows = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    plane = np.zeros(size >> 6, np.int64)
    plane[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return plane.view(np.uint8)


def _sorted(rows: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes ascending, values) of rows (hash, value), few enough for a broadcast."""
    rows = rows.select("hash", value).toArrow()
    h = rows["hash"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], rows[value].to_numpy()[order].astype(np.float64)


def _heads(table: DataFrame) -> DataFrame:
    """HEADS n-grams of each order at most, those with the highest counts."""
    total = {r["order"]: r["n"] for r in table.groupBy("order").agg(F.sum("raw").alias("n")).collect()}  # ORDER rows
    return table.filter(reduce(lambda x, y: x | y, [(F.col("order") == o) & (F.col("raw") > n // HEADS) for o, n in total.items()], F.lit(False)))


def _at(have: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of h are there, the places of those)."""
    if not len(have):
        return np.zeros(len(h), bool), np.zeros(0, np.int64)
    at = np.searchsorted(have, h)
    at[at == len(have)] = 0
    found = have[at] == h
    return found, at[found]


def _highest(value: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Per text: the highest sum over `width` neighbours, or over all of a shorter text."""
    total = np.concatenate([[0.0], np.cumsum(value)])
    # The window that starts at each token, as far as its text goes.
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    begin = np.maximum(at[:-1][row], np.minimum(np.arange(len(value)), at[1:][row] - width))
    ends = np.minimum(begin + width, at[1:][row])
    out = np.full(len(at) - 1, -np.inf)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        out[some] = np.maximum.reduceat(total[ends] - total[begin], at[some])
    return out


def _sent(model, shards: int):
    """The n-grams of rows (id, lang, key1, key2, text) to the shards; a unit is a text."""

    def pieces(batches):
        sieve, head, head_w, rivals = model.value
        low = _U(8 * len(sieve) - 1)
        for batch in batches:
            ids, langs, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [batch.column(i).to_numpy() for i in (2, 3)]
            for row0, data, at in tn.slices(batch.column(4), 1 << 19):
                t = tn.Tokens(data, at)
                n = len(at) - 1
                known, out_h, out_row = np.zeros(n), [], []
                for h in grams(t):
                    place = (h & low).astype(np.int64)
                    some = np.flatnonzero((sieve[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
                    h, row = h[some], t.row[some]
                    here, spot = _at(head, h)
                    known += np.bincount(row[here], head_w[spot], n)
                    out_h.append(h[~here])
                    out_row.append(row[~here])
                own = {"id": np.array([ids[row0 + r] for r in range(n)], object), "lang": np.array([langs[row0 + r] for r in range(n)], object)}
                own |= {"key1": keys[0][row0 : row0 + n], "key2": keys[1][row0 : row0 + n], "tokens": np.diff(t.first), "units": np.ones(n, np.int64), "known": known}
                for c, rival in zip(RATIOS, rivals, strict=True):
                    if rival is None:
                        own[c] = np.full(n, np.nan)
                        continue
                    words, ratio, left = rival
                    here, spot = _at(words, for_rivals(t))
                    value = np.full(len(t.h), left)
                    value[here] = ratio[spot]
                    value[t.h == tn.END] = 0.0
                    own[c] = _highest(value, t.first, PASSAGE)
                yield np.concatenate(out_h), np.concatenate(out_row), n, own

    return lambda batches: gramjoin.send(pieces(batches), shards)


PERPLEXITY, N_TOKENS = f"{P}perplexity", f"{P}tokens"
RATIOS = [f"{P}rival{i}" for i in range(len(RIVALS))]
ID, LANG, KEYS = f"{P}id", f"{P}lang", [f"{P}text1", f"{P}text2"]


def _finish(unknown: float, start: float):
    """Perplexity per token of each text; a text without words has none."""
    names = [ID, LANG, *KEYS, N_TOKENS, PERPLEXITY, *RATIOS]

    def run(own: dict, sums: np.ndarray) -> pa.Table:
        n = own["tokens"]
        value = 10.0 ** (-(sums[:, 0] + own["known"] + start) / n - unknown)
        numbers = [pa.array(np.where(n > 1, x, np.nan), pa.float64(), from_pandas=True) for x in (value, *(own[c] for c in RATIOS))]
        return pa.table([pa.array(own["id"].tolist(), pa.int64()), pa.array(own["lang"].tolist(), pa.string()), pa.array(own["key1"]), pa.array(own["key2"]), pa.array(n - 1), *numbers], names=names)

    return run


def scores(docs: DataFrame, training: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(__sl_id, __sl_lang, two keys of the text, __sl_tokens (words), __sl_perplexity (null without
    words), and for each rival the log10 of how much likelier than the trusted unigrams it makes the
    PASSAGE tokens that suit it best): one row per row of docs. training: (set, text)."""
    model, rivals, left, unknown, start = kneser_ney(training)
    table = materialize(model)
    n = table.count()
    shards = 1 << max(5, (n >> 17).bit_length())
    words = [(*_sorted(r, "ratio"), x) if r is not None else None for r, x in zip(rivals, left, strict=True)]
    known = docs.sparkSession.sparkContext.broadcast((_sieve(table, n), *_sorted(_heads(table), "w"), words))
    rows = docs.select(F.col(id_col).cast("long"), F.col(lang_col).cast("string"), *text_keys(text_col), F.col(text_col))
    sent = rows.mapInArrow(_sent(known, shards), gramjoin.SENT)
    schema = f"{ID} long, {LANG} string, {KEYS[0]} long, {KEYS[1]} long, {N_TOKENS} long, {PERPLEXITY} double, {', '.join(f'{c} double' for c in RATIOS)}"
    return gramjoin.sums(sent, gramjoin.packed_table(table.select("hash", "w"), ["w"], shards, np.float32), 1, np.float32, _finish(unknown, start), schema)


def text_keys(text_col: str):
    return [F.xxhash64(*salt, F.col(text_col)).alias(k) for salt, k in zip(([], [F.lit(1)]), KEYS, strict=True)]


def _labelled(labels: DataFrame, id_col: str, which: str) -> DataFrame:
    """(__sl_id): the ids whose labels are like that, once each."""
    return labels.filter(which).select(F.col(id_col).cast("long").alias(ID)).filter(F.col(ID).isNotNull()).distinct()


def _in_training(ids: DataFrame, most: int):
    """Whether an id of ids is one of the model's: three quarters of about `most` ids, by hash."""
    stride = max(1, -(-ids.count() // most))
    return (F.pmod(F.xxhash64(ID), F.lit(stride)) == 0) & (F.pmod(F.xxhash64(F.lit("held out"), ID), F.lit(4)) != 0)


CLASS = f"{P}class"
#: Texts of one language and one length class (by words) are held against each other.
CLASSES = (12, 40, 160)


def limits(scored: DataFrame, quantile: float, slack: float, least: int = 50) -> DataFrame:
    """Rows (__sl_lang, __sl_class, q), null for any: the quantile of all perplexities times slack,
    for each language and length class, each language, each class, and all. Those of fewer
    than `least` texts are left out, but not the one of all."""
    of = scored.filter(F.col(PERPLEXITY).isNotNull()).select(F.col(LANG).alias("lang"), length_class().alias("class"), F.col(PERPLEXITY).alias("x"))
    every = [F.struct(l.alias(LANG), c.alias(CLASS)) for l in (F.col("lang"), F.lit(None).cast("string")) for c in (F.col("class"), F.lit(None).cast("int"))]
    # A text without language counts once in what is for any language.
    sets = of.select("x", F.explode(F.array_distinct(F.array(*every))).alias("s"))
    asked = sets.groupBy(f"s.{LANG}", f"s.{CLASS}").agg(F.percentile_approx("x", quantile, 10000).alias("q"), F.count(F.lit(1)).alias("n"))
    return asked.filter((F.col("n") >= least) | (F.col(LANG).isNull() & F.col(CLASS).isNull())).select(LANG, CLASS, (F.col("q") * slack).alias("q"))


def _limited(scored: DataFrame, table: DataFrame, limit_col: str) -> DataFrame:
    """scored and the most specific limit that the table of limits() has for each row."""
    any_ = {r[CLASS]: r["q"] for r in table.filter(F.col(LANG).isNull()).collect()}  # five rows at most
    both = table.filter(F.col(LANG).isNotNull() & F.col(CLASS).isNotNull()).select(F.col(LANG).alias(f"{P}l2"), F.col(CLASS).alias(f"{P}c2"), F.col("q").alias(f"{P}q2"))
    one = table.filter(F.col(LANG).isNotNull() & F.col(CLASS).isNull()).select(F.col(LANG).alias(f"{P}l1"), F.col("q").alias(f"{P}q1"))
    out = scored.join(both, (F.col(LANG) == F.col(f"{P}l2")) & (length_class() == F.col(f"{P}c2")), "left").join(one, F.col(LANG) == F.col(f"{P}l1"), "left")
    short = F.lit(any_.get(None)).cast("double")
    for c, q in any_.items():
        if c is not None:
            short = F.when(length_class() == c, q).otherwise(short)
    return out.withColumn(limit_col, F.coalesce(f"{P}q2", f"{P}q1", short)).drop(f"{P}l2", f"{P}c2", f"{P}q2", f"{P}l1", f"{P}q1")


def _rival_limit(good: DataFrame, bad: DataFrame, ratio: str, loss: float, missed: float = 0.05, least: int = 50) -> float | None:
    """The ratio that a `loss` of trusted texts are above, and not below 0, where both are as likely.
    If almost all labelled bad texts lie above it, the middle between the two. None, so no limit, of
    few trusted texts."""
    q = good.agg(F.percentile_approx(ratio, 1 - loss, 10000).alias("q"), F.count(ratio).alias("n")).first()
    low = bad.agg(F.percentile_approx(ratio, missed, 10000)).first()[0]
    if low is None or q["n"] < least:
        return None
    return max(0.0, q["q"], (q["q"] + low) / 2)


def length_class():
    out = F.lit(len(CLASSES))
    for i, top in reversed(list(enumerate(CLASSES))):
        out = F.when(F.col(N_TOKENS) < top, i).otherwise(out)
    return out


LIMIT, GOOD = f"{P}limit", f"{P}good"


def verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = 0.995, slack: float = 1.1, max_trusted: int = MAX_TRUSTED, loss: float = 0.01) -> DataFrame:
    """scores() of docs with __sl_limit and __sl_good: one row per row of docs.

    Trusted text: documents with label quality 1 and toxic not 1. A model is trained on three
    quarters of about max_trusted labelled documents at most; the limits are of all others. A document
    is good if its perplexity per token is at most the quantile of those of its language and length
    class, times slack, and no passage of it is likelier under a rival model (of toxic, of bad text)
    than the limit, which a share `loss` of trusted text is above. Text without words (null, empty or
    blank) has no perplexity and isn't good. Without trusted text there is no limit, and every
    document that has words is good. Without labelled toxic or bad text there is no such rival.
    Ids are whole numbers; rows with one id are judged one by one, and share its labels.
    """
    sides = [_labelled(labels, id_col, which) for which in (TRUSTED, *RIVALS)]
    chosen = [_in_training(ids, max_trusted) for ids in sides]
    # Some max_trusted ids a set: a proven bound for the broadcast.
    taught = reduce(DataFrame.union, [ids.filter(c).withColumn("set", F.lit(s)) for s, (ids, c) in enumerate(zip(sides, chosen, strict=True))])
    training = docs.join(F.broadcast(taught), F.col(id_col).cast("long") == F.col(ID)).select("set", F.col(text_col).alias("text"))
    scored = materialize(scores(docs, materialize(training), id_col, text_col, lang_col))
    others = reduce(DataFrame.union, [ids.filter(~c).select(F.col(ID).alias(f"{P}other"), F.lit(s).alias(f"{P}set")) for s, (ids, c) in enumerate(zip(sides, chosen, strict=True))])
    judged = materialize(scored.join(others, F.col(ID) == F.col(f"{P}other")))
    trusted = judged.filter(f"{P}set = 0")
    out = _limited(scored, materialize(limits(trusted, quantile, slack)), LIMIT)
    good = F.col(PERPLEXITY).isNotNull() & (F.col(LIMIT).isNull() | (F.col(PERPLEXITY) <= F.col(LIMIT)))
    for i, ratio in enumerate(RATIOS):
        top = _rival_limit(trusted, judged.filter(f"{P}set = {i + 1}"), ratio, loss)
        if top is not None:
            good = good & (F.coalesce(ratio, F.lit(0.0)) <= top)
    return out.withColumn(GOOD, good)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None, **options) -> DataFrame:
    """The kept columns of docs (all by default), __sl_perplexity, __sl_tokens, __sl_limit and
    __sl_good, as verdicts() finds them for their text and language."""
    keep = docs.columns if keep is None else keep
    told = verdicts(docs, labels, id_col, text_col, lang_col, **options)
    found = [PERPLEXITY, N_TOKENS, LIMIT, GOOD]
    if keep == [id_col, lang_col]:
        return told.select(F.col(ID).cast(docs.schema[id_col].dataType).alias(id_col), F.col(LANG).alias(lang_col), *found)
    # A verdict depends on the text and its language.
    once = materialize(told.select(*KEYS, LANG, *found).dropDuplicates([*KEYS, LANG]))
    other, names = [f"{P}own1", f"{P}own2"], [f"{P}k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(lang_col).cast("string").alias(f"{P}ownlang"), *[k.alias(o) for k, o in zip(text_keys(text_col), other, strict=True)])
    same = (F.col(other[0]) == F.col(KEYS[0])) & (F.col(other[1]) == F.col(KEYS[1])) & F.col(f"{P}ownlang").eqNullSafe(F.col(LANG))
    return rows.join(once, same).select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], *found)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that classify() finds good."""
    return classify(docs, labels, **options).filter(GOOD).select(*[F.col(f"`{c}`") for c in docs.columns])
