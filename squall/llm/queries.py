"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm import common, credentials, decontam, exthash, graytree, hardneg, langid, minhash, mixing, perspectives, pii, planes, shards, turnrepair
from squall.session import scratch_path


def op1_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(common.documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    profiles = langid.train(docs.where(~held_out & F.col("doc_id").isNotNull()))
    return (docs.select("doc_id", held_out.alias("held_out"), langid.predictor(profiles).alias("guess"))
            .select("doc_id", "held_out", "guess.lang_pred", "guess.score"))


@cache
def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_plane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-planes")
    planes.write(common.documents(spark, sf_dir), path, vocabulary())
    return planes.read_digest(spark, path)


def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.digest(common.documents(spark, sf_dir))


def op5_credential_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan(common.documents(spark, sf_dir))


def op6_extendible_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exthash.duplicates(common.documents(spark, sf_dir))


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(common.documents(spark, sf_dir))


def op8_perspective_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op9_block_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(common.documents(spark, sf_dir)).digest()


def op10_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_shared_list_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(hardneg.participants(rows.withColumn("label", moved)), F.col("id") % 100 == 0)


def op12_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graytree.near_duplicates(common.documents(spark, sf_dir))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turnrepair.digest(turnrepair.damaged(turns), turns)


OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
rows_ AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM shingled),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM shingled),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM rows_ a JOIN rows_ b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM sizes UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
least_ AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least_ ON u = doc_id
"""

# crc32 of a text's bytes: its table by rule, then one step for each byte.
CRC_SQL = """
  crc_table AS (SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS f
                FROM (SELECT unnest(range(256)) AS i)),
  crcs AS (SELECT t, xor(4294967295, list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT),
                                                 lambda c, b: xor(c >> 8, f[xor(c & 255, b) + 1]))) AS crc
           FROM (SELECT DISTINCT coalesce(text, '') AS t FROM documents), crc_table)"""

OP4_SQL = f"""
WITH RECURSIVE {CRC_SQL}, numbered AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents),
{shards.place_sql('numbered')}
SELECT doc_id, octet_length(encode(t)) + 1 AS size, crc AS text_crc32, 'rows' AS law, shard, slot, NULL::INTEGER AS grown_shard FROM placed JOIN crcs USING (t)
"""

QUERIES = {f.__name__: f for f in (op1_minmax_near_dedup, op2_language_id, op3_plane_tokens, op4_feistel_shards, op5_credential_formats,
                                  op6_extendible_hash_dedup, op7_bootstrapped_pii, op8_perspective_chats, op9_block_mixing, op10_pigeonhole_decontamination, op11_shared_list_negatives,
                                  op12_gray_simhash, op13_turn_repair)}
OP6_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

SQL = {"op1_minmax_near_dedup": OP1_SQL, "op4_feistel_shards": OP4_SQL, "op6_extendible_hash_dedup": OP6_SQL,
       "op8_perspective_chats": perspectives.SQL, "op11_shared_list_negatives": hardneg.SQL,
       "op13_turn_repair": turnrepair.SQL}
