"""Corpus pipeline over the driver's documents: five stages, each applying one operator of ``lapmart.llm``.

Rejected documents go, of near duplicates one stays, contaminated documents
go, secrets are cut out of the texts, and what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapmart.llm import decontam, packing, quality, secret_scan, setjoin
from lapmart.llm.common import dropped, free_name, reads, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier finds of low quality or toxic; sites are sources and languages.

    Null and empty texts are judged by their site, null sources and languages
    are sites of their own, repeated rows are judged alike, an empty table
    stays empty; all columns are kept as they are.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles of Jaccard similarity 0.8 or more: that with the smallest id.

    Rows are told apart by id and text, so rows that share an id, or have
    none, are documents of their own, and of repeated rows one stays (a null
    id comes after all others).  Null texts and texts without words link with
    nothing and all stay; an empty table stays empty.
    """
    keyed = docs.select(quality.row_key().alias("doc_id"), "text")
    found = setjoin.jaccard_components(keyed, 5, 80, 100)
    linked = written(found.where(F.col("component_id") != F.col("doc_id"))
                     .select(F.col("doc_id").alias("key"), F.col("component_id").alias("c")).distinct(), "dedup-linked")
    members = linked.union(linked.select(F.col("c").alias("key"), "c").distinct())
    ids = docs.select(quality.row_key().alias("key"), F.struct(F.col("doc_id").isNull(), "doc_id").alias("id")).distinct()
    members = written(members.join(ids, "key").select("c", F.struct("id", "key").alias("member")), "dedup-members")
    dropped(found, linked)
    stays = members.groupBy("c").agg(F.min("member").alias("stays"))
    gone = written(members.join(stays, "c").where("member.key <> stays.key").select("member.key").distinct(), "dedup-gone")
    dropped(members)
    out = quality.drop_rows(docs, gone)
    # of repeated rows one stays
    again = written(keyed.where("text IS NOT NULL").groupBy(F.col("doc_id").alias("key")).count().where("count > 1")
                    .select("key"), "dedup-repeated")
    if again.isEmpty():
        dropped(again)
        return out
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    name = free_name(out, "_key")
    marked = written(out.withColumn(name, quality.row_key()), "dedup-rest")
    again = reads(again.withColumnRenamed("key", name), again)
    repeated = marked.join(again, name, "left_semi").where(words).dropDuplicates([name])
    others = marked.where(~F.coalesce(words, F.lit(False))).union(
        marked.where(words).join(again, name, "left_anti").select(*marked.columns))
    return reads(others.union(repeated.select(*marked.columns)).drop(name), out, again, marked)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents: 5 % or more of the words lie in windows of the benchmark.

    Rows are told apart by id and text; null and empty texts have no words
    and stay; an empty table, or an empty benchmark, takes nothing away.
    """
    keyed = docs.select(quality.row_key().alias("doc_id"), "text")
    found = decontam.decontaminate(keyed, table(spark, sf_dir, "benchmark"))
    gone = written(found.where("contaminated").select(F.col("doc_id").alias("key")).distinct(), "decontam-gone")
    dropped(found)
    return quality.drop_rows(docs, gone)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts; null and empty texts stay as they are, repeated rows
    come out alike, an empty table stays empty."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 ids, related documents together; one row per piece.

    A null text is empty: its end id alone is packed.  Repeated rows and null
    ids are packed like any other; an empty table gives no rows.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 1)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_redaction),
    ("packing", pack_sequences),
]

# A fitted classifier, tests under false-discovery control and the packing's retrieval are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's rows are written and read again.

    What a stage has read is deleted once its own rows are written; the input tables stay.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        before, docs = docs, written(out, f"stage-{name}")
        dropped(out, before)
    return docs
