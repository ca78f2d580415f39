"""Connected components by contraction, one pair of joins a round.

In each round every node moves to the node of the smallest salted hash among itself and its
neighbours, and the links are renamed; a constant share of the nodes goes away, so that the tables
shrink quickly. Both tables of a round are written to the shared folder: no lineage grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from projectmart.llm.storage import stored


def connected(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b bigint); equal roots mean one component."""
    edges = stored(links.select("a", "b"), f"{folder}/links-0")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        salt, k = F.lit(len(moves)), len(moves)

        def ranked(c: str, salt=salt):
            return F.struct(F.xxhash64(salt, F.col(c)).alias("h"), F.col(c).alias("n"))

        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = both.groupBy(F.col("a").alias("node")).agg(F.min(ranked("b")).alias("best"))
        move = move.select("node", F.least(ranked("node"), F.col("best"))["n"].alias("root"))
        move = stored(move, f"{folder}/moves-{k}")
        moves.append(move)
        renamed = (
            edges.join(move.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
            .join(move.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        edges = stored(renamed, f"{folder}/links-{k + 1}")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves[0]
    for move in moves[1:]:
        step = move.select(F.col("node").alias("root"), F.col("root").alias("next"))
        roots = roots.join(step, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root")
        )
    return roots
