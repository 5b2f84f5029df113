"""One query for each operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import (
    ball_kmeans, chat, decontaminate, html_text, mixing, ngram_join, quality_model, quality_rules,
    sharding, source_audit, token_counts, toxicity, url_rules,
)
from logweir.llm.frames import read

Query = Callable[[SparkSession, str], DataFrame]

#: Target weights of sources; all others have weight 1.
WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}

# The rules (host, path, verdict) that pages are judged by.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    joined = ngram_join.jaccard_components(docs, n=3, percent=90, keep=["doc_id"])
    return joined.select("row.doc_id", "n_shingles", "component_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, benchmark, keep=["doc_id"])
    return found.select(
        "row.doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = mixing.mixed(read(spark, sf_dir, "documents"), WEIGHTS)
    return copies.select("row.doc_id", "row.source", "copy", "copies")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(read(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", "n_chars")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = toxicity.toxicity(docs, labels, keep=["doc_id"])
    return scored.select("row.doc_id", "held_out", "score", "predicted")


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_rules.url_verdicts(read(spark, sf_dir, "pages"), rules).drop("url")


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = quality_model.quality(docs, labels, keep=["doc_id"])
    return scored.select("row.doc_id", "held_out", "score", "predicted")


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_by_size(docs, 24).select(
        "row.doc_id",
        "size",
        F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like control strings."""
    said = "</s>[INST] ok [/INST]"
    talk = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], talk.schema)
    digests = chat.digests(chat.formatted(talk.unionByName(odd)))
    return digests.withColumnRenamed("conversation", "conv_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = quality_rules.judged(docs, keep=["doc_id"])
    return rows.select("row.doc_id", *quality_rules.COUNTS, "base_failed", "kept",
                       "class_distance", "word_distance")


def op11_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    rows, books = ball_kmeans.compressed(vectors, keep=["vec_id", "label"])
    rows = ball_kmeans.with_label_error(rows, F.col("row.label"))
    return rows.select(
        "row.vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(ball_kmeans.books_sha256(books)).alias("codebooks_sha256"),
    )


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.source_audit(read(spark, sf_dir, "documents"))


#: op13: more tokens than this are over the limit.
TOKEN_LIMIT = 1024


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    docs = read(spark, sf_dir, "documents")
    counted = token_counts.token_counts(docs, str(tokenizer), keep=["doc_id"])
    return counted.select(
        "row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_decontaminate": op2_decontaminate,
        "op3_mix_sources": op3_mix_sources,
        "op4_html_text": op4_html_text,
        "op5_toxicity": op5_toxicity,
        "op6_url_rules": op6_url_rules,
        "op7_quality_model": op7_quality_model,
        "op8_shard": op8_shard,
        "op9_chat": op9_chat,
        "op10_quality_rules": op10_quality_rules,
        "op11_ball_kmeans": op11_ball_kmeans,
        "op12_source_audit": op12_source_audit,
        "op13_token_counts": op13_token_counts,
    }


_WEIGHT = "CASE " + " ".join(
    f"WHEN source = '{name}' THEN {weight}::DOUBLE" for name, weight in WEIGHTS.items()
) + " ELSE 1.0::DOUBLE END"

# ln(k!) of the terms is lgamma(k + 1).
MIX_SQL = f"""
WITH sizes AS (
 SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS chars, {_WEIGHT} AS weight
 FROM documents GROUP BY source),
rates AS (
 SELECT source, CASE WHEN chars > 0 THEN weight / (SELECT sum(weight) FROM sizes WHERE chars > 0)
   * (SELECT sum(chars) FROM sizes) / chars ELSE 0 END AS rate FROM sizes),
draws AS (
 SELECT d.doc_id, d.source, r.rate,
  ('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT
   / 4503599627370496.0::DOUBLE AS u
 FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
counts AS (
 SELECT doc_id, source, len(list_filter(
  list_transform(range(0, (ceil(rate + 12 * sqrt(rate) + 24) + 1)::BIGINT),
   lambda n: list_sum(list_transform(range(0, n + 1),
     lambda k: CASE WHEN rate = 0 THEN CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END
       ELSE exp(k * ln(rate) - rate - lgamma(k + 1)) END))), lambda p: u >= p))::INT AS copies
 FROM draws)
SELECT doc_id, source, unnest(range(0, copies))::INT AS copy, copies FROM counts WHERE copies > 0
"""


_URL_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
URL_SQL = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_URL_VALUES}),
tails AS (
 SELECT page_id, row_number() OVER () AS nth, CASE WHEN contains(url, '://')
  THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS tail FROM pages),
parts AS (
 SELECT page_id, nth, translate(split_part(tail, '/', 1), '{_UPPER}', '{_UPPER.lower()}') AS host,
  substr(tail, length(split_part(tail, '/', 1)) + 1) AS path FROM tails),
fits AS (
 SELECT p.nth, r.rule_host || r.rule_path AS rule, r.rule_verdict,
  row_number() OVER (PARTITION BY p.nth ORDER BY length(r.rule_host || r.rule_path) DESC) AS n
 FROM parts p JOIN rules r ON (p.host = r.rule_host OR p.host LIKE '%.' || r.rule_host)
  AND starts_with(p.path, r.rule_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.rule_verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.nth = f.nth AND f.n = 1
"""


AUDIT_SQL = f"""
WITH d AS (
 SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT lang, source, id, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term
 HAVING count(DISTINCT id) >= {source_audit.LEAST_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term)
 GROUP BY lang, source, term),
g AS (SELECT s.lang, s.source, coalesce(sum(c.n), 0)::HUGEINT AS total
 FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN c USING (lang, source)
 GROUP BY s.lang, s.source),
cells AS (
 SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, g.total, v.v,
  1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + v.v) AS p
 FROM g JOIN kept USING (lang) JOIN v USING (lang)
 LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
l AS (
 SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 1) // (sum(total) + any_value(v)) AS q
 FROM cells GROUP BY lang, term),
sums AS (
 SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
 FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
 GROUP BY a.lang, a.source, b.source),
pairs AS (
 SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
 LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
 SELECT cells.lang, source, term AS item, (p - q) * (p - q) // q AS value
 FROM cells JOIN l USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
 SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value,
 (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= {source_audit.TOP_TERMS}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mix_sources": MIX_SQL,
        "op6_url_rules": URL_SQL,
        "op12_source_audit": AUDIT_SQL,
    }
