"""The queries of this folder, by name, and the SQL that must agree with them."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm import langid, pitman_yor, quality, warc
from tallyguard.llm.exact import exact_groups
from tallyguard.llm.metric import near_vectors
from tallyguard.llm.packing import pack
from tallyguard.llm.pieces import encode_pieces
from tallyguard.llm.repair import repair_conversations
from tallyguard.llm.runs import periodic_runs
from tallyguard.llm.sharding import shard_rows
from tallyguard.llm.simhash import simhash_groups
from tallyguard.llm.token_files import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where SQL can state it."""

    def register(make):
        QUERIES[name] = make
        if sql is not None:
            ORACLE[name] = sql
        return make

    return register


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


@query(
    "op5_exact_dedup",
    r"""WITH t AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id,
          count(*) OVER (PARTITION BY body) AS group_size,
          doc_id = min(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
        FROM t""",
)
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = exact_groups(read(spark, folder, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op7_sharding")
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    out = shard_rows(read(spark, folder, "documents"))
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query("op4_packing")
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op10_token_files")
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(read(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op8_pieces")
def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode_pieces(read(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query(
    "op1_embedding_near_dedup",
    """WITH RECURSIVE good AS (
          SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
        SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
          least(e.vec_id, coalesce((SELECT min(r.b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS component_id,
          e.vec_id <= coalesce((SELECT min(r.b) FROM reach r WHERE r.a = e.vec_id), e.vec_id) AS kept
        FROM embeddings e""",
)
def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(read(spark, folder, "embeddings"))


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(read(spark, folder, "documents"))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    out = langid.identify(read(spark, folder, "documents"), train=~langid.held_out())
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query("op9_quality")
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    out = quality.classify(docs, labels, train=~quality.held_out())
    return out.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query("op6_lm_scoring")
def op6_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    out = pitman_yor.score_documents(read(spark, folder, "documents"), ~pitman_yor.held_out())
    return out.withColumn("held_out", pitman_yor.held_out())


@query(
    "op11_warc",
    """WITH p AS (
          SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS hex
          FROM pages),
        t AS (
          SELECT *, max(page_id) OVER (PARTITION BY body) AS first,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
              (('0x' || substr(hex, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> ((3 - i % 4) * 5)::INT) & 31)::INT, 1)), '')
              AS payload_digest
          FROM p)
        SELECT page_id, size AS payload_bytes, payload_digest,
          CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> first THEN first END AS refers_to
        FROM t""",
)
def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(read(spark, folder, "pages"))


def with_repeats(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, with words that repeat periodically from some place on in a tenth of the documents."""
    seed = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    given = F.floor(seed / 10)
    words = F.split(F.btrim(F.col(text_col), F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    count = F.size(words)
    first = (given % count).cast("int")
    period = (1 + F.floor((count - first) / (3 + given % 8))).cast("int")
    times = F.ceil((count - first) / period).cast("int")
    block = F.flatten(F.array_repeat(F.slice(words, first + 1, period), times))
    repeated = F.concat(F.slice(words, F.lit(1), first), F.slice(block, F.lit(1), count - first))
    return F.when(seed % 10 == 0, F.array_join(repeated, " ")).otherwise(F.col(text_col))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", with_repeats().alias("text"))
    return periodic_runs(docs)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with some rows marked as gone, emptied, without ends of sentences, repeated or reassigned."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        text.alias("text"),
        (kind == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    )


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair_conversations(damaged(read(spark, folder, "conversations")), gone_col="gone", copy_col="copy")
