"""The registered queries of this subpackage: thin calls of the operators on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.llm import ann, bpe, decontaminate, divergence, htmltext, langid, lm, secrets, shards, simhash, suffix_dedup, toxicity, turns
from aloft.llm.common import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(_table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    learned = langid.samples(docs.where(fold("doc_id", 4) != 2))
    made = langid.identify(docs, learned)
    return made.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    made = toxicity.score(docs, toxicity.train(docs, labels))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string")))
    return made.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted",
                       F.array_join(spans, ",").alias("spans"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), ids=False)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"),
                                       _table(spark, sf_dir, "benchmark"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = shards.interleave(_table(spark, sf_dir, "documents"), shards=40)
    return made.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "source")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.audit(_table(spark, sf_dir, "conversations"))


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_suffix_array_dedup, op3_lm_scoring, op4_language_id, op5_nearest_neighbours,
                                  op6_secret_scans, op7_toxicity, op8_simhash_near_dedup, op9_byte_bpe,
                                  op10_decontamination, op11_sharding, op12_conversation_repair,
                                  op13_divergence_audit)}

ORACLE_SQL: dict[str, str] = {"op2_suffix_array_dedup": suffix_dedup.ORACLE,
                              "op10_decontamination": decontaminate.ORACLE,
                              "op11_sharding": shards.ORACLE,
                              "op12_conversation_repair": turns.ORACLE,
                              "op13_divergence_audit": divergence.ORACLE}
