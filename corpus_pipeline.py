"""The corpus pipeline: quality rules, exact dedup, MinHash near-dedup, source mixing, packing.

Each stage works on all rows that the one before kept and its decisions take effect. Mixing
repeats a document as many times as the mix takes it, to the nearest whole number, and leaves
out documents that it takes less than half of. Rows that repeat a doc_id stay together: the verdicts hold
for all of them, and each is repeated as often as the mix takes the rows of that doc_id on average. Rows without a doc_id cannot be told apart and go in the
first stage. The last stage returns packed pieces instead of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.llm.common import documents, stash
from keymend.llm.exact_dedup import exact_dedup
from keymend.llm.minhash_forest import minhash_dedup
from keymend.llm.pack import pack
from keymend.llm.quality_rules import quality_rules
from keymend.llm.source_mix import mix_sources


def _kept(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id the verdict keeps."""
    return docs.join(verdict.filter("kept").select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts have too few words and go; an empty table stays empty."""
    return _kept(docs, quality_rules(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the smallest doc_id of each group of equal texts; null and empty texts are one group. Rows
    that repeat a kept doc_id all stay, whatever their texts, since the doc_id is what a verdict is about."""
    return _kept(docs, exact_dedup(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id; texts without a word are no
    duplicates of anything and stay."""
    return _kept(docs, minhash_dedup(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, to the nearest whole number; texts without a word have no size and go."""
    rows, mix = mix_sources(docs)
    taken = mix.groupBy("doc_id").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    sizes = rows.groupBy("doc_id").agg(F.sum("size").alias("size"))  # `taken` is of all rows of a doc_id
    times = sizes.join(taken, "doc_id").select(
        "doc_id", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("__times")).filter("__times > 0")
    repeated = docs.join(times, "doc_id").withColumn("__times", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return repeated.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; null and empty texts are one token each, an empty table gives no piece."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("minhash near-dedup", near),
    ("source mixing", mixing),
    ("best-fit packing", packing),
]

#: The similarity search and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
