"""Registered queries opN_<name> and their SQL: the operators with production
parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.llm import (
    decontam, fingerprints, hard_negatives, langid, line_dedup, minhash_dedup, packing, passages, periods, secrets,
    suffix_dedup, url_filter, vector_dedup,
)
from tickforge.llm.common import table
from tickforge.llm.url_filter import Rule

#: The rules of op9.
URL_RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
             Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]


def op1_fingerprints(spark, sf_dir):
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).drop("kept")


def op3_passages(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)


def op5_secrets(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"), path_col="source")
    return found.withColumn("secret", F.sha2("secret", 256)).withColumnRenamed("secret", "secret_sha256")


def op6_minhash_dedup(spark, sf_dir):
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), pct=85)


def tokenizer_path() -> str:
    """The public vocabulary file, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op10_decontamination(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def page_outcomes(spark, sf_dir):
    """A page's labelled outcome is the label of the same number: bad if it
    is toxic or of low quality."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))


def op9_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), page_outcomes(spark, sf_dir), URL_RULES).drop("bad_low")


def op11_hard_negatives(spark, sf_dir):
    id_, label = F.col("vec_id"), F.col("label")
    whole = F.expr("forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
    rows = table(spark, sf_dir, "embeddings").where(whole).select(
        "vec_id", F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vec"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def with_periodic_tails(docs):
    """Where h = crc32(doc_id as text) is divisible by 10, the words from
    number a on repeat the p words that begin there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n, at = F.col("g"), F.col("n"), F.col("a")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words")) \
        .withColumn("n", F.size("words")).withColumn("a", F.when(n > 0, g % n)) \
        .withColumn("p", 1 + F.floor((n - at) / (3 + g % 8)))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.element_at(
        "words", (F.when(i < at, i).otherwise(at + (i - at) % F.col("p")) + 1).cast("int")))
    return rows.select("doc_id", F.when(n > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    found = periods.collapse(with_periodic_tails(table(spark, sf_dir, "documents")))
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        *[F.concat(r[c].cast("string"), F.lit(end)) for c, end in (("start", ","), ("length", ","), ("period", "\n"))]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_vector_dedup(spark, sf_dir):
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_line_dedup, op3_passages, op4_suffix_dedup, op5_secrets, op6_minhash_dedup, op7_packing,
    op8_language_id, op9_url_filter, op10_decontamination, op11_hard_negatives, op12_periodic_runs, op13_vector_dedup)}

SQL = {
    "op11_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""",
    "op13_vector_dedup": r"""
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) >= 0.9 * sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
root AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM root LEFT JOIN degree USING (vec_id)""",
    "op2_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, UNNEST(string_split(coalesce(text, ''), chr(10))) AS s,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT doc_id, i, s, translate(trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k),
marked AS (SELECT keyed.*, coalesce(owner < doc_id, false) AS gone FROM keyed LEFT JOIN owners USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(s, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op9_url_filter": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
named AS (
  SELECT *, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
    string_split(host, '.')[-1] AS suffix FROM parsed),
outcomes AS (
  SELECT host, domain, suffix, CAST(coalesce(toxic = 1 OR quality = 0, false) AS INT) AS bad
  FROM named JOIN labels ON page_id = doc_id),
h AS (SELECT host, domain, suffix, count(*) AS n, sum(bad) AS k FROM outcomes GROUP BY ALL),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL),
spread AS (
  SELECT lvl, count(*) AS g, sum(n) / 1.0 AS n, sum(k) / sum(n) AS p, sum(n * n) / 1.0 AS nn, sum(k * k / n) AS kk
  FROM (SELECT 'h' AS lvl, n, k FROM h UNION ALL SELECT 'd', n, k FROM d UNION ALL SELECT 's', n, k FROM s) GROUP BY lvl),
moments AS (
  SELECT lvl, g, p * (1 - p) AS w,
    CASE WHEN g < 2 THEN 0 ELSE (kk - n * p * p - (g - 1) * p * (1 - p)) / nullif(n - nn / n, 0) END AS v FROM spread),
weights AS (
  SELECT max(x) FILTER (lvl = 'h') AS wh, max(x) FILTER (lvl = 'd') AS wd, max(x) FILTER (lvl = 's') AS ws FROM (
    SELECT lvl, CASE WHEN g >= 2 AND v > 0 AND w > 0 THEN least(200.0, greatest(1.0, w / v - 1)) ELSE 200.0 END AS x
    FROM moments)),
whole AS (SELECT (sum(k) + 0.5) / (sum(n) + 1.0) AS rate FROM s),
s1 AS (SELECT suffix, k + ws * rate AS a, n - k + ws * (1 - rate) AS b FROM s, whole, weights),
d1 AS (SELECT domain, d.k + wd * a / (a + b) AS a, d.n - d.k + wd * (1 - a / (a + b)) AS b
       FROM d JOIN s1 USING (suffix), weights),
h1 AS (SELECT host, h.k + wh * a / (a + b) AS a, h.n - h.k + wh * (1 - a / (a + b)) AS b
       FROM h JOIN d1 USING (domain), weights),
lows AS (
  SELECT 'h' AS lvl, host AS name, a / (a + b) AS m, a + b AS t FROM h1 UNION ALL
  SELECT 'd', domain, a / (a + b), a + b FROM d1 UNION ALL SELECT 's', suffix, a / (a + b), a + b FROM s1),
low AS (SELECT lvl, name, m - 1.645 * sqrt(m * (1 - m) / (t + 1)) AS low FROM lows),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM named)
SELECT page_id, ruled.host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN coalesce(x.low, y.low, z.low, 0) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN low x ON x.lvl = 'h' AND x.name = host LEFT JOIN low y ON y.lvl = 'd' AND y.name = domain
  LEFT JOIN low z ON z.lvl = 's' AND z.name = suffix""",
}
