"""Quality rules as a learned decision list, on DataFrame functions alone.

Sequential covering on labelled rows: grow a conjunction of thresholds until it covers hardly
any good row, prune it on rows that growing has not seen, keep it if it is precise there, take
away what it covers, go on. The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, P, materialize

SYMBOLS = "#*$%&|<>"
#: Labelled rows that the rules are learned from, at most.
MAX_LABELLED = 20_000
FEATURES = {
    "symbol_share": lambda: F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
    "mean_word": lambda: F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
    "dup_lines": lambda: F.col("n_dup_lines").cast("double"),
    "repeat_share": lambda: F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
    "upper_share": lambda: F.col(f"{P}upper") / F.greatest(F.col("word_chars"), F.lit(1)),
    "mark_share": lambda: F.col(f"{P}marks") / F.greatest(F.col("word_chars"), F.lit(1)),
    "n_words": lambda: F.col("n_words").cast("double"),
}


def text_statistics(docs: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and two
    helper counts. Null text has no words; all counts are over the whole text."""
    text, words, starts = f"{P}text", f"{P}words", f"{P}starts"
    known = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in known], F.coalesce(F.col(text_col), F.lit("")).alias(text))
    solid = F.char_length(F.translate(text, BLANKS, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.char_length(F.btrim(x, F.lit(BLANKS))) > 0)
    out = out.withColumns({
        "word_chars": solid.cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
        f"{P}upper": F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")),
        f"{P}marks": F.char_length(text) - F.char_length(F.translate(text, "!?;:=_/\\\\", "")),
        f"{P}lines": lines,
        # One hash a word is enough to compare words of one text.
        words: F.transform(F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != ""), lambda w: F.xxhash64(w)),
    })
    # explode() of one array keeps what stands below from being computed again for each element.
    out = out.withColumn(words, F.explode(F.array(words)))
    n = F.size(words)
    shifted = F.arrays_zip(*[F.slice(words, i + 1, F.greatest(n - window + 1, F.lit(0))).alias(f"w{i}") for i in range(window)])
    hashed = F.transform(shifted, lambda z, i: F.struct(F.xxhash64(*[z[f"w{j}"] for j in range(window)]).alias("h"), i.alias("i")))
    out = out.withColumn(starts, F.explode(F.array(F.sort_array(hashed))))
    # A window is repeated if a neighbour in hash order is the same window.
    zipped = F.arrays_zip(
        F.col(starts).alias("x"),
        F.concat(F.array(F.lit(None).cast("long")), F.transform(starts, lambda s: s["h"])).alias("before"),
        F.slice(F.transform(starts, lambda s: s["h"]), 2, F.greatest(F.size(starts), F.lit(1))).alias("after"),
    )
    repeated = F.transform(F.filter(zipped, lambda z: z["x"].isNotNull() & ((z["x"]["h"] == z["before"]) | F.coalesce(z["x"]["h"] == z["after"], F.lit(False)))), lambda z: z["x"]["i"])
    out = out.withColumn(starts, F.explode(F.array(F.sort_array(repeated))))
    reach = F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("at")), lambda acc, i: F.struct((acc["n"] + F.least(F.lit(window), i - acc["at"])).alias("n"), i.alias("at")), lambda acc: acc["n"])
    # Each start covers `window` words less the overlap with the start before it.
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in known],
        F.size(words).cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size(f"{P}lines") - F.size(F.array_distinct(f"{P}lines"))).cast("long").alias("n_dup_lines"),
        reach.cast("long").alias("n_repeat_words"),
        f"{P}upper",
        f"{P}marks",
    )


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = FEATURES[self.feature]()
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


def _all(tests) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t.column()
    return out


def _place(name: str) -> Column:
    return F.col(f"{P}at_{name}")


def _passed(thresholds: list[float], value: Column) -> Column:
    """How many of the thresholds the value reaches."""
    return F.size(F.filter(F.array(*map(F.lit, thresholds)), lambda x: x <= value))


def _covered(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[Test, tuple[int, int]]:
    """(bad, good) rows that each single test covers, from one histogram of places among cuts."""
    places = F.explode(F.array(*[F.struct(F.lit(name).alias("f"), _place(name).alias("at")) for name in cuts])).alias("p")
    counts: dict[str, dict[int, tuple[int, int]]] = {name: {} for name in cuts}
    for r in rows.select("bad", places).groupBy("p.f", "p.at").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).toLocalIterator():
        counts[r["f"]][r["at"]] = (r["p"], r["n"])
    out = {}
    for name, at in cuts.items():
        for i, threshold in enumerate(at):
            for above in (True, False):
                some = [c for place, c in counts[name].items() if (place > i) == above]
                out[Test(name, above, threshold)] = (sum(p for p, _ in some), sum(n for _, n in some))
    return out


def _counted(rows: DataFrame, conditions: list[Column]) -> list[tuple[int, int]]:
    """(bad, good) rows that meet each condition."""
    ask = [F.count(F.when(c & (F.col("bad") == bad), 1)).alias(f"c{i}_{bad}") for i, c in enumerate(conditions) for bad in (1, 0)]
    r = rows.agg(*ask).first()
    return [(r[f"c{i}_1"], r[f"c{i}_0"]) for i in range(len(conditions))]


def learn(rows: DataFrame, max_rules: int = 8, max_tests: int = 3, cuts: int = 24, precision: float = 0.98, min_cover: int = 5) -> list[list[Test]]:
    """An ordered list of conjunctions that say a row is bad. rows: text_statistics() and bad
    (0 or 1). Thresholds are quantiles of the good and of the bad rows. Without both classes
    there is no rule."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", f"{P}upper", f"{P}marks")
    side = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in counts]), F.lit(3))
    # At most some MAX_LABELLED rows of a few numbers: one partition, so no step has to shuffle.
    rows = materialize(rows.select("bad", *counts, (side == 0).alias("prune")).repartition(8)).coalesce(1)
    at = [i / cuts for i in range(cuts + 1)]
    ask = [F.percentile_approx(f(), at, 2000).alias(name) for name, f in FEATURES.items()]
    found = [r.asDict() for r in rows.groupBy("bad").agg(*ask).toLocalIterator()]
    if len(found) < 2:
        return []
    thresholds = {name: sorted({float(v) for r in found for v in r[name]}) for name in FEATURES}
    rows = materialize(rows.withColumns({f"{P}at_{name}": _passed(t, FEATURES[name]()) for name, t in thresholds.items()})).coalesce(1)
    rules: list[list[Test]] = []
    left = rows
    for _ in range(max_rules):
        rule: list[Test] = []
        grow, best = left.filter(~F.col("prune")), 0.0
        for _ in range(max_tests):
            cover = _covered(grow.filter(_all(rule)), thresholds)
            # m-estimate of precision, then cover: precise and large rules first.
            scored = [((p + 0.5) / (p + n + 4), p, str(t), t) for t, (p, n) in cover.items() if p >= min_cover]
            if not scored:
                break
            score, _, _, test = max(scored, key=lambda x: x[:3])
            if score <= best + 1e-6:
                break
            rule, best = [*rule, test], score
        if not rule:
            break
        # Prune: the shortest beginning of the rule that is as precise on unseen rows.
        heads = [rule[: i + 1] for i in range(len(rule))]
        seen = _counted(left.filter("prune"), [_all(h) for h in heads])
        value = [((p + 0.5) / (p + n + 1), -len(h)) for (p, n), h in zip(seen, heads, strict=True)]
        rule = heads[max(range(len(heads)), key=lambda i: value[i])]
        p, n = _counted(left, [_all(rule)])[0]
        if p < min_cover or p < precision * (p + n):  # imprecise: look for another beginning
            thresholds = {name: t for name, t in thresholds.items() if name != rule[0].feature}
            if not thresholds:
                break
            continue
        rules.append(rule)
        left = left.filter(~_all(rule))
    return rules


def verdict(rules: list[list[Test]]) -> Column:
    """The decision list as one conditional expression: true keeps the row."""
    out = None
    for rule in rules:
        out = F.when(_all(rule), False) if out is None else out.when(_all(rule), False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """docs with the counts of text_statistics(), base_failed and kept.

    base_failed: under 10 words, or repeated 5-word windows hold over a fifth of the words.
    kept: neither base_failed nor rejected by rules learned from rows whose label is 0 (bad)
    against 1; about max_labelled labelled rows at most, chosen by hash of the id. Null labels and
    ids teach nothing. Without labels only base_failed rejects.
    """
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias(f"{P}id")).agg((1 - F.max(label_col)).cast("int").alias("bad"))
    stride = max(1, -(-known.count() // max_labelled))
    known = known.filter(F.pmod(F.xxhash64(f"{P}id"), F.lit(stride)) == 0)
    # max_labelled pairs of numbers at most, within a few per cent: small enough to broadcast.
    taught = docs.select(F.col(id_col).alias(f"{P}id"), F.col(text_col).alias("text")).join(F.broadcast(known), f"{P}id").select("text", "bad")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rules = learn(text_statistics(taught, "text").filter(~failed))  # the list is for what is left
    out = text_statistics(docs, text_col)
    out = out.withColumn("base_failed", failed)
    out = out.withColumn("kept", ~F.col("base_failed") & verdict(rules))
    return out.drop(f"{P}upper", f"{P}marks")
