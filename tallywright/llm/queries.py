"""The registered queries of this folder and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.llm import chat, decontaminate, embed_dedup, licenses, ngram_join, packing, quality, secrets, token_store, toxicity
from tallywright.llm.scratch import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), k=3, numerator=90, denominator=100)


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text"))
    return chat.summarise(chat.format_examples(given.unionByName(own)))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_read(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), window=1024, end_id=0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.to_json("passages").alias("passages"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.fit(documents))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_license_scans": op2_license_scans,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_token_store": op6_token_store,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_secret_scans": op10_secret_scans,
}

OP5_SQL = r"""
WITH said AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE 0 END AS part, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 0, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, role, text) AS pos,
    count(*) OVER (PARTITION BY conv_id, part) AS n,
    length('<|im_start|>') + 1 + length('<|im_end|>') + 1 + length(role) + length(text)
      + (length(role || text) - length(replace(role || text, '\', '')))
      + (length(role) - length(replace(role, '<|', '')) + length(text) - length(replace(text, '<|', ''))) // 2
      + (length(role) - length(replace(role, chr(10), ''))) AS size
  FROM said
), summed AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id, part ORDER BY pos) AS so_far FROM numbered
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(so_far) FILTER (WHERE role = 'assistant' OR pos = n) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id, part
"""

def _op2_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def one_spelling(sql: str) -> str:
        for old, new in licenses.SPELLINGS:
            sql = f"replace({sql}, {quoted(''.join(f' {w} ' for w in old.split()))}, {quoted(''.join(f' {w} ' for w in new.split()))})"
        return sql

    lower = f"translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}')"
    spaced = f"' ' || replace(regexp_replace(regexp_replace({lower}, {quoted(licenses.COPYRIGHT)}, '', 'g'), {quoted(licenses.SIGNS)}, '  ', 'g'), chr(10), ' ' || chr(10) || ' ') || ' '"
    forms = {}
    for kind, known in (("text", licenses.known_texts()), ("notice", licenses.known_notices())):
        for k, t in reversed(known):
            forms[kind, licenses.digest_of(t)] = k
    forms |= {("text", d): k for k, d in licenses.DIGESTS}
    values = ",".join(f"({quoted(kind)}, '{d}', {quoted(k)})" for (kind, d), k in forms.items())
    return f"""
WITH known(kind, digest, license) AS (VALUES {values}),
formed AS (SELECT doc_id, row_number() OVER () AS n, {one_spelling(f'({spaced})')} AS said FROM documents),
whole AS (SELECT doc_id, n, sha256(trim(regexp_replace(said, '[ \n]+', ' ', 'g'), ' ')) AS digest FROM formed),
lines AS (SELECT n, sha256(trim(regexp_replace(line, ' +', ' ', 'g'), ' ')) AS digest FROM (SELECT n, unnest(string_split(said, chr(10))) AS line FROM formed)),
noted AS (SELECT n, count(*) AS notices, string_agg(DISTINCT license, ',' ORDER BY license) AS names FROM lines JOIN known ON kind = 'notice' AND known.digest = lines.digest GROUP BY n)
SELECT whole.doc_id, whole.digest AS text_sha256, license, coalesce(notices, 0) AS n_notices, coalesce(names, '') AS notices
FROM whole LEFT JOIN known ON kind = 'text' AND known.digest = whole.digest LEFT JOIN noted USING (n)
"""


OP1_SQL = r"""
WITH RECURSIVE said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM said
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared WHERE 100 * c >= 90 * (na + nb - c) UNION ALL SELECT b, a FROM shared WHERE 100 * c >= 90 * (na + nb - c)
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(least.b, doc_id)) AS component_id FROM sets LEFT JOIN least ON least.a = doc_id
"""

OP3_SQL = r"""
WITH RECURSIVE given AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), sound AS (
  SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM given
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
FROM given LEFT JOIN counted ON counted.a = vec_id LEFT JOIN least ON least.a = vec_id
"""

OP4_SQL = r"""
WITH said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), asked AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS said
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM asked WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS said
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM said, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), met AS (
  SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, said)
), hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS pos FROM met) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM met) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM said LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op1_ngram_jaccard_join": OP1_SQL, "op2_license_scans": _op2_sql(), "op3_embedding_near_dedup": OP3_SQL, "op4_benchmark_decontamination": OP4_SQL, "op5_chat_formatting": OP5_SQL}
