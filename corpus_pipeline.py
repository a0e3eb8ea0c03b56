"""Corpus pipeline over ``documents``: toxicity, SimHash near-dedup, benchmark decontamination,
secret scans, byte-level BPE.

Each stage takes (spark, docs, sf_dir), reads the whole Parquet table that its predecessor
wrote, and returns the rows it keeps with all columns they came with; the last one returns
the encoded documents.  Stages judge rows by ``doc_id`` and ``text`` alone, and each row for itself:
those that drop rows by a join write the table with a key of their own first, so that null and
repeated ids do no harm:

* toxicity drops documents of score 0.5 or more;
* near-dedup keeps, of each component, one row: that with the smallest doc_id (null ids survive only
  where the whole component has none; of rows that share this doc_id the first one written);
* decontamination drops documents that contain a benchmark item to 0.8 or more;
* secret scans mask every finding in the text and set ``n_chars`` anew on those rows;
* encoding gives doc_id, n_tokens, ids, ids_sha256, decoded_sha256.

Null and empty texts pass the filters (as near-duplicates of each other: one stays).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.llm import bpe, decontaminate, secrets, simhash, toxicity
from aloft.llm.common import columns_of, fold, fresh, saved
from aloft.session import require_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the label table is keyed to the original documents; those that are left serve to learn
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold("doc_id", 5) != 0)
    tagger = toxicity.train(docs, labels)
    return toxicity.keep_clean(docs, tagger)


def keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a written key for each row, and the name of its column, which ``docs`` does not use."""
    key = fresh(docs, "__key")
    return saved(docs.withColumn(key, F.monotonically_increasing_id()), name), key


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, key = keyed(docs, "near-dedup-rows")
    # ordered like doc_id with nulls last, and different for every row
    name = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"),
                    F.col(key).alias("key"))
    groups = simhash.near_duplicates(rows.select(name.alias("row"), "text"), id_col="row",
                                     shingle=3, max_bits=3)
    kept = (groups.where(F.col("row.key") == F.col("component_id.key"))
            .select(F.col("row.key").alias(key)))
    return rows.join(kept, key, "left_semi").select(columns_of(docs))


def decontaminate_docs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, key = keyed(docs, "decontamination-rows")
    leaked = decontaminate.contamination(rows, items, id_col=key).select(key).distinct()
    return rows.join(leaked, key, "left_anti").select(columns_of(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs).select("doc_id", "n_tokens", "ids", "ids_sha256",
                                          "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate_docs),
    ("secret_scans", mask_secrets),
    ("byte_bpe", encode),
]

#: the classifier and the fingerprints have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{require_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
