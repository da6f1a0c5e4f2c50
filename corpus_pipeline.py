"""A corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

1. language: documents without a recognisable language go; a predicted language fills an empty ``lang``.
2. near_duplicates: of each component of near copies (a similarity of ``PERCENT`` or more) the document with the smallest id stays, once.
3. decontamination: documents that hold a benchmark region go.
4. secrets: every finding is replaced by a mark; documents stay, ``n_chars`` follows the text.
5. packing: the pieces of the remaining documents and their places in sequences.

Columns of ``documents`` pass through the first four stages. From stage 2 on, a row that repeats an id and text is one document;
of an id with several texts, each stays or goes by its own text. Rows without an id are kept, as nothing tells them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketloom.llm import decontam, langid, neardup, packing, secrets
from docketloom.llm.common import cut, table, unused
from docketloom.llm.queries import tokenizer_path

#: Least similarity of word shingles in stage 2; op6 has a threshold of its own.
PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = unused("language", docs)
    found = docs.withColumn(own, langid.prediction(langid.fit(docs), F.col("text"), spark))
    kept = found.filter(F.col(f"{own}.lang_pred") != langid.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", f"{own}.lang_pred")).drop(own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, mark, node = unused("several", docs), unused("text_hash", docs), unused("node", docs)
    marked = docs.withColumn(mark, F.xxhash64("text"))
    texts = marked.filter("doc_id is not null").groupBy(F.col("doc_id").alias(own)).agg(F.min(mark).alias(f"{own}_"), F.max(mark).alias("last"))
    several = cut(texts.filter(F.col(f"{own}_") < F.col("last")).drop("last"))
    if several.isEmpty():
        named = marked.withColumn(node, F.col("doc_id"))
    else:  # a further text of an id is a document of its own, behind all ids
        further = F.col(mark) != F.col(f"{own}_")
        beyond = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 3) + F.lit(1 << 62)
        named = marked.join(several, F.col("doc_id") == F.col(own), "left").withColumn(node, F.when(further, beyond).otherwise(F.col("doc_id"))).drop(own, f"{own}_")
    kept = neardup.near_duplicates(named.select(F.col(node).alias("doc_id"), "text"), percent=PERCENT).filter("kept and doc_id is not null").select(F.col("doc_id").alias(own))
    stay = named.join(kept, F.col(node) == F.col(own), "left_semi").dropDuplicates([node])
    return stay.drop(node, mark).union(docs.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", hide_secrets), ("packing", pack)]
#: SQL states neither the classifier nor the tokenizer. The tests hold language, near duplicates, decontamination and packing against
#: plain versions (letters, all pairs, edit distance, the tokenizer itself), secrets against planted values.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
