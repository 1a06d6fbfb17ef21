"""Connected components by alternating large-star and small-star.

An edge table is rewritten round by round. Large-star: every node connects its larger neighbours to the smallest node
that it knows, itself included. Small-star: every node connects its smaller neighbours, and itself, to the smallest of
them. After about log(n) rounds each component is a star around its smallest node. Nodes meet their neighbours only by a
minimum per node, which is summed up before the shuffle, and a join, which the adaptive skew join splits for a node with
very many neighbours. Each round is a stored table, so lost executors cost no more than a part of a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import scratch_folder, through_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least.withColumnRenamed("a", "of"), F.col("a") == F.col("of")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest node, of every node of a table of edges ``a``, ``b``. Loops and null ends are
    left out, and so are nodes that have no other edge."""
    spark = edges.sparkSession

    def stored(df: DataFrame) -> tuple[DataFrame, tuple]:
        table = through_table(df, scratch_folder(spark, "edges"))
        return table, tuple(table.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now, before = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while before[0]:
        now, state = stored(_small_star(_large_star(now)))
        if state == before:
            break
        before = state
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
