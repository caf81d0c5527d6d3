"""Connected components of a distributed edge list by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keymend.llm.common import drop, stash


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node of its component) of every node of `edges` (a, b: long).

    In each round every node moves to that one of itself and its neighbours whose hash, salted by the round, is
    smallest; edges follow, and loops and doubles go. A component thus shrinks to one node in a
    number of rounds that is logarithmic in its size, also where it is a path. All joins have a
    side with one row per node."""
    edges = stash(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    where = None
    turn = 0
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.struct(F.xxhash64(F.col("b"), F.lit(turn)).alias("h"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64(F.col("a"), F.lit(turn)).alias("h"), F.col("a").alias("to"))
        moves = stash(both.groupBy("a").agg(F.min(rank).alias("m")).select(
            F.col("a").alias("node"), F.least(F.col("m"), own)["to"].alias("to")), "moves")
        spent = [edges]
        if where is None:
            where = moves.withColumnRenamed("to", "at")
            first = moves
        else:
            spent += [moves, first if turn == 1 else where]
            where = stash(where.join(moves.withColumnRenamed("node", "at"), "at", "left")
                          .select("node", F.coalesce("to", "at").alias("at")), "places")
        step = (edges.join(moves.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
                .join(moves.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
                .filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        edges = stash(step, "edges")
        drop(*spent)
        turn += 1
        if edges.isEmpty():
            break
    low = where.groupBy("at").agg(F.min("node").alias("component"))
    out = stash(where.join(low, "at").select("node", "component"), "components")
    drop(edges, first, where)
    return out
