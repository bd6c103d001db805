"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.bpe import encode_texts
from flowloom.llm.decontaminate import leaks
from flowloom.llm.line_dedup import passage_dedup
from flowloom.llm.registry import table, workers_find_package
from flowloom.llm.simhash import simhash_groups
from flowloom.llm.toxicity import label_categories, score, train
from flowloom.operators.joining import bounded_broadcast
from flowloom.session import cut_lineage

REJECT_FROM = 0.5
KEY = "__key"


def _keyed(docs: DataFrame) -> DataFrame:
    """A key that rows share only if they are equal in id and text; a null id is a value like any other."""
    return docs.withColumn(KEY, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))


def _without(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``keys``, which are written first so that they are computed once."""
    return docs.join(bounded_broadcast(cut_lineage(keys.distinct(), "rejected")), key, "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below ``REJECT_FROM``."""
    workers_find_package(spark)
    categories = label_categories()
    chain = train(docs, table(spark, sf_dir, "labels"), categories)
    scored = score(_keyed(docs), chain, [name for name, _ in categories], doc_id=KEY)
    bad = scored.filter(F.col("p_toxic") >= REJECT_FROM).select(F.col("doc_id").alias(KEY))
    return _without(_keyed(docs), bad, KEY).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated passages of lines; ``n_chars`` follows the text."""
    workers_find_package(spark)
    out = passage_dedup(docs)
    return out.withColumn("n_chars", F.when(F.size("removed_chunks") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id, null ids last. Texts that share an id are told
    apart, and of rows equal in id and text one stays, that with the smallest other columns."""
    workers_find_package(spark)
    keyed = _keyed(docs)
    groups = simhash_groups(keyed, shingle=3, radius=2, doc_id=KEY).select(F.col("doc_id").alias(KEY), "component_id").distinct()
    texts = keyed.groupBy(KEY).agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    named = cut_lineage(groups.join(texts, KEY), "groups")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", KEY)).alias("first"))
    gone = named.join(first.select(F.col(f"first.{KEY}").alias(KEY)), KEY, "left_anti").select(KEY)
    again = named.filter("n > 1").select(KEY)
    once = _without(keyed, gone, KEY).join(bounded_broadcast(again), KEY, "left_semi").groupBy(KEY, "doc_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return _without(keyed, gone.unionByName(again), KEY).select(*docs.columns).unionByName(once.select("row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    workers_find_package(spark)
    found = leaks(_keyed(docs), table(spark, sf_dir, "benchmark"), doc_id=KEY)
    return _without(_keyed(docs), found.select(F.col("doc_id").alias(KEY)), KEY).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number of tokens, digests of its ids and of the bytes they decode to."""
    workers_find_package(spark)
    coded = encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", encoding_stage),
]

# The stages use trained models, 64-bit hashes and merges that SQL does not express; tests/llm holds a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
