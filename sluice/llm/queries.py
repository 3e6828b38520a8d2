"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, line_dedup, lm_score, mixture, near_dedup, periodic, perplexity, quality_rules, shard, spelling, suffix_dedup, token_files, window_dedup
from .common import P, new_folder, read


def _digest(text):
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", _digest(F.col("text")).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    s = suffix_dedup
    out = s.dedup_strings(docs, keep=["doc_id"])
    return out.select("doc_id", F.col(s.BYTES).alias("n_bytes"), F.col(s.REMOVED).alias("n_removed"), F.col(s.SPANS).alias("n_spans"), F.sha2(s.KEPT, 256).alias("kept_sha256"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_rules.judge(docs, read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = window_dedup.dedup_windows(docs, keep=["doc_id"])
    return out.select("doc_id", F.col(window_dedup.WORDS).alias("n_words"), F.col(window_dedup.REMOVED).alias("n_removed"), _digest(F.col(window_dedup.TEXT)).alias("kept_sha256"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = perplexity.classify(docs, read(spark, sf_dir, "labels"), keep=["doc_id", "lang"])
    return out.select("doc_id", "lang", F.col(perplexity.N_TOKENS).alias("n_words"), F.col(perplexity.PERPLEXITY).alias("perplexity"), F.col(perplexity.LIMIT).alias("limit"), F.col(perplexity.GOOD).alias("kept"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    return shard.shard(docs).select("doc_id", "size", crc, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"), keep=["doc_id"], nameless=True)
    n_hit = decontaminate.hit_words()
    items = F.col(decontaminate.ITEMS)
    return hits.select(
        "doc_id",
        F.col(decontaminate.WORDS).alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        _digest(F.array_join(items, ",")).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixture.mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def looped(docs: DataFrame) -> DataFrame:
    """docs with every tenth text made periodic from some word on, as the contract of op11 plants runs."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h, n = F.crc32(F.col("doc_id").cast("string").cast("binary")), F.greatest(F.size("w"), F.lit(1)).cast("long")
    planted = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.col("g") % n)
    planted = planted.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    turned = F.transform("w", lambda w, i: F.when(i >= F.col("a"), F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))).otherwise(w))
    return planted.select("doc_id", F.when(F.size("w") > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = looped(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.find_runs(docs, keep=["doc_id"])
    runs = F.col(periodic.RUNS)
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.floor(F.lit(-1000) * F.col("best.length") / F.col("best.less")).alias("exponent_milli"),
        _digest(lines).alias("runs_sha256"),
        _digest(F.col(periodic.COLLAPSED)).alias("collapsed_sha256"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark)
    token_files.write_ids(read(spark, sf_dir, "documents").select("doc_id", "text"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents").select("doc_id", "text"), typo_every=31)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling_variants,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op1_line_dedup": f"""
        WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM parts),
        keyed AS (SELECT doc_id, pos, line, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines),
        common AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
        told AS (SELECT keyed.*, coalesce(doc_id < last, false) AS gone FROM keyed LEFT JOIN common USING (k))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM told GROUP BY doc_id""",
    "op2_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
        win AS (SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS g FROM d, unnest(range(0, n - 49)) AS t(i)),
        least AS (SELECT g, min(doc_id) AS lo FROM win GROUP BY g),
        hit AS (SELECT DISTINCT doc_id, i FROM win JOIN least USING (g) WHERE doc_id > lo),
        fresh AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS f FROM hit),
        runs AS (SELECT doc_id, i, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM fresh),
        spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, s),
        total AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS last FROM spans GROUP BY doc_id),
        pieces AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p, a AS q FROM spans
                   UNION ALL SELECT d.doc_id, coalesce(last, 0), n FROM d LEFT JOIN total ON total.doc_id = d.doc_id),
        kept AS (SELECT d.doc_id, string_agg(substring(h, 2 * p + 1, 2 * (q - p)), '' ORDER BY p) AS t FROM pieces JOIN d USING (doc_id) GROUP BY d.doc_id)
        SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(t, ''))) AS kept_sha256
        FROM d LEFT JOIN total ON total.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op6_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS g FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
        least AS (SELECT g, min(doc_id) AS lo FROM win GROUP BY g),
        hit AS (SELECT DISTINCT doc_id, j FROM (SELECT doc_id, i FROM win JOIN least USING (g) WHERE doc_id > lo), unnest(range(i, i + 13)) AS t(j)),
        every AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
        kept AS (SELECT every.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY pos) AS t
                 FROM every LEFT JOIN hit ON hit.doc_id = every.doc_id AND hit.j = every.pos WHERE hit.j IS NULL GROUP BY every.doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op9_decontamination": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
               FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
        ns AS (SELECT DISTINCT n FROM bw),
        dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, ns, unnest(range(1, len(w) - n + 2)) AS t(i)),
        hit AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
        covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(j) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op13_spelling_variants": r"""
        WITH RECURSIVE tab AS MATERIALIZED (
          SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
        few AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL),
        coded AS (SELECT *, hex(encode(doc_id || ':' || run)) AS x FROM few),
        hashed AS (SELECT run, k, xor(list_reduce(list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: CAST('0x' || substring(x, 2 * i + 1, 2) AS BIGINT))),
                     lambda s, b: xor(t[xor(s, b) % 256 + 1], s >> 8)), 4294967295) AS h FROM coded, tab),
        typed AS (SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
        words AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
        cuts AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS cut FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
        pairs AS (SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
                  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
                  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
        best AS (SELECT word, count(*) AS n_near, min({'less': -m, 'other': other}) AS b FROM pairs GROUP BY word),
        told AS MATERIALIZED (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 10 * n THEN b.other END AS form, CASE WHEN -b.less >= 10 * n THEN -b.less END AS form_n
                 FROM words LEFT JOIN best USING (word)),
        chain AS (SELECT word, coalesce(form, word) AS root FROM told
                  UNION SELECT chain.word, told.form FROM chain JOIN told ON told.word = chain.root WHERE told.form IS NOT NULL),
        last AS (SELECT chain.word, root FROM chain JOIN told ON told.word = chain.root WHERE told.form IS NULL)
        SELECT told.word, form, root, n, n_near, form_n FROM told JOIN last USING (word)""",
}
