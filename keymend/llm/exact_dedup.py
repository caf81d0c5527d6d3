"""Exact dedup by a heavy-hitter split (DataFrame functions only).

1. Each text is normalised and digested once (SHA-256); only `(doc_id, digest)` goes on.
2. A frequent-items sketch of the Misra-Gries family (Spark's approx_top_k, which merges) is filled where the rows are; one
   sketch of at most TRACKED * K counters a partition is sent on. A digest with more than rows/(K+1) rows
   is among its K first, since the sketch errs by 3.5 / (TRACKED * K) of the rows at most.
3. Survivors are verified: their exact sizes and smallest doc_id come from one aggregation over
   their rows, and this table of at most K rows is broadcast, so that the rows of frequent
   digests are decided where they are and never shuffled.
4. All other digests, each with at most rows/(K+1) rows, go through an ordinary shuffle.

Cases: null text counts as empty, so null and '' are copies of each other; ties on doc_id
(repeated rows) keep one doc_id, and each row appears in the result with the same verdict; a
null doc_id stays only where its group has no other; an empty table gives an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keymend.llm.common import documents, stash

#: Counters of the Misra-Gries summary, and so the largest number of rows broadcast.
COUNTERS = 256
#: Counters tracked for each of these.
TRACKED = 4


def normalised(text="text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def frequent(rows: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` values of `key`, among them every one with more than 1 / (counters + 1) of the
    rows. Counts are estimates; others may be among them."""
    tracked = TRACKED * max(counters, COUNTERS)
    top = rows.agg(F.expr(f"approx_top_k({key}, {counters}, {tracked})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias(key)).filter(F.col(key).isNotNull())


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs` (doc_id, text)."""
    rows = stash(docs.select("doc_id", F.sha2(normalised(), 256).alias("text_sha256")), "digests")
    heavy = F.broadcast(frequent(rows, "text_sha256", counters))
    winners = stash(
        rows.join(heavy, "text_sha256", "left_semi").groupBy("text_sha256")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "winners")
    # at most `counters` rows
    hot = rows.join(F.broadcast(winners), "text_sha256")
    each = Window.partitionBy("text_sha256")
    cold = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti").select(
        "text_sha256", "doc_id", F.min("doc_id").over(each).alias("keep_id"),
        F.count(F.lit(1)).over(each).alias("group_size"))
    return hot.unionByName(cold).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


OP4_SQL = r"""
with t as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = min(doc_id) over w as kept, text_sha256
from t window w as (partition by text_sha256)
"""
