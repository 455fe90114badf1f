"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import math
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import conversations, decontaminate, hard_negatives, language, masked_lm, near_dup, page_text, pieces, quality_crf, secrets, spot_signatures, token_store, warc
from linkloom.session import find_package, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_language(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), size=4)


def piece_digests(docs: DataFrame) -> DataFrame:
    encoded = pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("starts", "ends"), 256).alias("spans_sha256"),
    )


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_text.extract_main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_store.shared_uri(spark, "tokens")
    manifest = token_store.write_shards(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return token_store.read_shards(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.score_documents(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(_table(spark, sf_dir, "pages"), token_store.shared_uri(spark, "warc"))
    records = warc.read_archives(manifest).select(
        F.substring_index("record_id", ":", -1).cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("own_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.substring_index("refers_to", ":", -1).cast("long").alias("refers_to"),
        "error",
    )
    records, _ = stored(records, "warc-records")  # without payloads: the archives are read once
    # A revisit's payload is that of the response it points to.
    responses = records.where("record_type = 'response'").drop("refers_to").withColumn("payload_bytes", F.col("own_bytes"))
    revisits = records.where("record_type = 'revisit'").drop("own_bytes").join(
        responses.select(F.col("page_id").alias("refers_to"), F.col("own_bytes").alias("payload_bytes")), "refers_to", "left"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(revisits.select(*columns))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(conversations.damaged(_table(spark, sf_dir, "conversations")))


def op13_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.spot_fingerprints(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_secret_scan": op3_secret_scan,
    "op4_decontamination": op4_decontamination,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_main_text": op6_main_text,
    "op7_token_store": op7_token_store,
    "op8_masked_lm": op8_masked_lm,
    "op9_warc": op9_warc,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_spot_signatures": op13_spot_signatures,
}

_ANCHORS = ", ".join(f"'{w}'" for w in spot_signatures.ANCHORS)

#: SQL of the queries that DuckDB can express.
ORACLE: dict[str, str] = {
    "op11_hard_negatives": """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
""",
    "op13_spot_signatures": f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
), followed AS (
  SELECT *, coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id,
    coalesce(lead(text) OVER o, first_value(text) OVER o) AS after
  FROM docs WINDOW o AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), edits AS (
  SELECT doc_id, next_id, n, text, left(text, n - n // 2) || left(after, n // 2) AS edited FROM followed
), both_texts AS (
  SELECT doc_id, 0 AS kind, text FROM edits UNION ALL SELECT doc_id, 1, edited FROM edits
), cut AS (
  SELECT doc_id, kind, regexp_split_to_array(trim(regexp_replace(lower(text), '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS words FROM both_texts
), words AS (
  SELECT doc_id, kind, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM cut
), marked AS (
  SELECT *, word IN ({_ANCHORS}) AS anchor FROM words WHERE word <> ''
), placed AS (
  SELECT *, count_if(NOT anchor) OVER o AS solid, coalesce(lead(anchor) OVER o, false) AS more
  FROM marked WINDOW o AS (PARTITION BY doc_id, kind ORDER BY pos)
), content AS (
  SELECT doc_id, kind, solid, word, lead(word) OVER o AS two, lead(word, 2) OVER o AS three
  FROM placed WHERE NOT anchor WINDOW o AS (PARTITION BY doc_id, kind ORDER BY pos)
), spots AS (
  SELECT doc_id, kind, word, solid + 1 AS solid FROM placed WHERE anchor AND NOT more
  UNION ALL SELECT DISTINCT doc_id, kind, '', 1 FROM placed
), hashed AS (
  SELECT DISTINCT s.doc_id, s.kind, left(md5(concat_ws(' ', s.word, c.word, c.two, c.three)), {spot_signatures.DIGITS}) AS spot
  FROM spots s LEFT JOIN content c ON c.doc_id = s.doc_id AND c.kind = s.kind AND c.solid = s.solid
  WHERE s.word <> '' OR c.word IS NOT NULL
), sets AS (
  SELECT doc_id, kind, list(spot ORDER BY spot) AS spots FROM hashed GROUP BY doc_id, kind
), joined AS (
  SELECT e.*, coalesce(a.spots, []) AS own, coalesce(b.spots, []) AS changed, coalesce(c.spots, []) AS following
  FROM edits e LEFT JOIN sets a ON a.doc_id = e.doc_id AND a.kind = 0
  LEFT JOIN sets b ON b.doc_id = e.doc_id AND b.kind = 1 LEFT JOIN sets c ON c.doc_id = e.next_id AND c.kind = 0
), measured AS (
  SELECT *, len(own) AS n_own, len(list_intersect(own, changed)) AS c1, len(changed) AS n1,
    len(list_intersect(own, following)) AS c2, len(following) AS n2
  FROM joined
), likened AS (
  SELECT *, CASE WHEN own = changed THEN 1.0::DOUBLE WHEN n_own = 0 OR n1 = 0 THEN 0.0::DOUBLE ELSE c1 / (n_own + n1 - c1) END AS l1,
    CASE WHEN own = following THEN 1.0::DOUBLE WHEN n_own = 0 OR n2 = 0 THEN 0.0::DOUBLE ELSE c2 / (n_own + n2 - c2) END AS l2
  FROM measured
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, array_to_string(own, '') AS fingerprint,
  array_to_string(changed, '') AS edited_fingerprint,
  CASE WHEN l1 >= {spot_signatures.LEAST}::DOUBLE THEN l1 ELSE 0.0::DOUBLE END AS near_edited,
  CASE WHEN l2 >= {spot_signatures.LEAST}::DOUBLE THEN l2 ELSE 0.0::DOUBLE END AS near_next,
  n_own::BIGINT AS n_spots,
  CASE WHEN n_own > 0 THEN floor(ln(n_own) / {-math.log(spot_signatures.LEAST)!r}::DOUBLE + 1e-9)::INTEGER END AS spot_partition
FROM likened
""",
}
