"""The registered queries of the operators, and their SQL.

Each query applies an operator with its production parameters to a whole
table and derives the columns asked for; nothing is computed beside it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.llm import (
    chat,
    htmltext,
    lexical,
    licenses,
    lm,
    mixing,
    nearest,
    packing,
    pii,
    quality,
    rules,
    simhash,
    whitening,
)
from tablegate.plans.registry import given

Query = Callable[[SparkSession, str], DataFrame]


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents", "doc_id", "text", "source")
    mixed = mixing.mix_sources(docs)
    return mixed.select(
        "doc_id",
        F.col("mix.size").alias("size"),
        F.col("mix.source_size").alias("source_size"),
        F.col("mix.target").alias("target"),
        (F.col("mix.size") * F.col("mix.copies")).alias("taken"),
    )


OP4_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sizes GROUP BY source
), caps AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER ()::BIGINT AS total FROM by_source
), ordered AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
         sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open
  FROM caps
), filled AS (
  SELECT *, (cap::DOUBLE / weight) * open + capped <= total AS is_full FROM ordered
), leveled AS (
  SELECT *, (total - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0))::BIGINT AS rest,
         (sum(CASE WHEN NOT is_full THEN weight END) OVER ())::BIGINT AS shares
  FROM filled
), targets AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN cap::DOUBLE ELSE (weight * rest)::DOUBLE / shares::DOUBLE END AS target
  FROM leveled
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets
)
SELECT s.doc_id, s.size, r.source_size, r.target,
       (s.size * (floor(r.rate) + CASE WHEN ('0x' || substr(md5('4:' || coalesce(s.doc_id::VARCHAR, '')), 1, 8))::UBIGINT / 4294967296.0
                                       < r.rate - floor(r.rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sizes s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
"""


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    found = pii.find_personal(docs)
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("pii", lambda s: s["rank"] < len(pii.BASE_KINDS))


    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = (count(kind) for kind in pii.BASE_KINDS)
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))


def op2_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents", "doc_id", "text", "lang")
    judged = rules.apply_rules(docs, given(spark, sf_dir, "labels", "doc_id", "quality"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("rejected_by", ",").alias("rejected_by"),
    )


def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(given(spark, sf_dir, "documents", "doc_id", "text"))


def op6_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-1).cast("long"), "id", role, said).toDF("conv_id", "turn", "role", "text")
    return chat.digest_examples(chat.expand_conversations(rows.unionByName(more)))


def op1_block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = given(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest.nearest_neighbours(vectors, F.col("vec_id") % nearest.QUERY_EVERY == 0)


OP1_SQL = r"""
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_main_text(given(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_gated_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(given(spark, sf_dir, "documents", "doc_id", "text"))


def op7_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    return quality.classify(docs, given(spark, sf_dir, "labels", "doc_id", "quality"))


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op9_column_generation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(given(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)


def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(given(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    parts = F.posexplode(F.arrays_zip("whitened", "explained"))
    each = done.select("vec_id", "n", "deviation", "identity_error", parts.alias("at", "part"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.col("part.whitened").alias("whitened"), F.col("part.explained").alias("explained"), "identity_error",
    )


def op12_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(given(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"].cast("long"))

    def labels(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )


def op13_shared_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents", "doc_id", "text")
    return lexical.ranked_search(docs, given(spark, sf_dir, "benchmark", "item_id", "text"))


OP13_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), words AS (
  SELECT r, doc_id, len(words)::BIGINT AS n, unnest(words) AS term FROM texts
), totals AS (
  SELECT count(DISTINCT r) AS docs, count(*) AS length FROM words
), item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), counts AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM words SEMI JOIN item_terms USING (term) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, totals GROUP BY term, docs
), earned AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // length)))) AS points
  FROM counts JOIN weights USING (term), totals
), scored AS (
  SELECT item_id, r, doc_id, sum(points)::BIGINT AS score FROM earned JOIN item_terms USING (term) GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


QUERIES: dict[str, Query] = {
    "op1_block_nearest": op1_block_nearest,
    "op2_certified_rules": op2_certified_rules,
    "op3_gated_language_model": op3_gated_language_model,
    "op4_source_mixing": op4_source_mixing,
    "op5_simhash_components": op5_simhash_components,
    "op6_chat_examples": op6_chat_examples,
    "op7_random_indexing_quality": op7_random_indexing_quality,
    "op8_page_text": op8_page_text,
    "op9_column_generation_packing": op9_column_generation_packing,
    "op10_personal_data": op10_personal_data,
    "op11_bit_sliced_whitening": op11_bit_sliced_whitening,
    "op12_license_diagonals": op12_license_diagonals,
    "op13_shared_lexical_search": op13_shared_lexical_search,
}
ORACLES: dict[str, str] = {
    "op1_block_nearest": " ".join(OP1_SQL.split()),
    "op4_source_mixing": " ".join(OP4_SQL.split()),
    "op13_shared_lexical_search": " ".join(OP13_SQL.split()),
}
