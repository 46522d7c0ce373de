"""The corpus pipeline: five stages over documents, each one of the numbered operators.

Every stage takes (spark, docs, sf_dir), where ``docs`` is what the stage before it kept, written as Parquet and read
again; all but the last return the columns of ``docs``. No stage needs more than the columns doc_id, text and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.llm import bpe, jaccard, mixing, quality, secrets
from lineweave.llm.common import cut, written
from lineweave.operators import tables

ORACLE_SQL = None  # trained, iterative and encoding stages: tests hold them against brute force


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels`` outside the held-out fold, doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality.in_fold())
    return quality.keep_good(docs, quality.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first by id and then text, of each group linked by 0.8 of its five-word shingles.

    Rows of one id with different texts are documents of their own; of rows with equal id and text one stays. Documents
    without an id link nothing and stay.
    """
    same = ["doc_id", "_size", "_h", "_c"]
    text = F.coalesce("text", F.lit(""))
    marked = docs.where("doc_id is not null").withColumns({"_size": F.octet_length(text), "_h": F.xxhash64(text), "_c": F.crc32(text.cast("binary"))})
    keys = cut(marked.select(same).distinct().withColumn("_key", F.monotonically_increasing_id()))
    keyed = written(marked.join(keys, same), "keyed")
    found = jaccard.near_duplicates(keyed, n=5, percent=80, doc_id="_key").select(F.col("id").alias("_key"), "component").distinct()
    first = found.join(keys, "_key").groupBy("component").agg(F.min(F.struct(*same, "_key")).alias("first")).select("first._key")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.min_by(F.struct(*docs.columns), F.struct(F.col("text").isNull(), *([F.xxhash64(*others)] if others else [])))
    kept = keyed.join(first, "_key", "left_semi").groupBy("_key").agg(row.alias("row")).select("row.*")
    return kept.unionByName(docs.where("doc_id is null")).select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secrets.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes its words, rounded to whole documents: 0, 1 or 2 times.

    Rows of one id go in equally often; documents without words are not part of a mix.
    """
    taken = mixing.mix(docs).groupBy("id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).where("size > 0")
    times = taken.select(F.col("id").alias("_id"), mixing.copies(F.col("taken"), F.col("size")).alias("_copies")).where("_copies > 0")
    mixed = docs.join(times, docs["doc_id"].eqNullSafe(times["_id"])).where(mixing.words(F.col("text")) > 0)
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, and digests of them and of what they decode to."""
    coded = bpe.decode(bpe.encode(docs))
    return coded.select(
        F.col("id").alias("doc_id"),
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.col("ids").alias("token_ids"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", drop_low_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage kept goes when the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, path = tables.written(docs, f"stage{k}")
            if before:
                tables.remove(before)
            before = path
    return docs
