"""Connected components of a distributed list of links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, written


def _ends(forest: DataFrame) -> DataFrame:
    """(node, up) of a written forest with every path halved until up is an end; the forests before it go."""
    while True:
        above = forest.select(F.col("node").alias("up"), F.col("up").alias("above"))
        if forest.join(above, "up", "left_semi").isEmpty():
            return forest
        halved = written(forest.join(above.hint("merge"), "up", "left").select("node", F.coalesce("above", "up").alias("up")), "forest")
        forget(forest)
        forest = halved


def roots_of(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (a, b), root being the least node that can be reached; nodes without links are absent.

    Rounds of contraction: every node with a smaller neighbour hangs itself on the least of them, paths of what hangs
    on what are halved to their ends, and links are renamed to those, until none is left. A node that was hung never
    comes back, so the rounds together are a forest again. Minima are partial sums and the joins are plain ones between
    written tables, so hubs need no task of their own.
    """
    tidy = lambda df: df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links, hung = written(tidy(links), "links"), []
    while not links.isEmpty():
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung.append(_ends(written(both.groupBy("a").agg(F.min("b").alias("up")).where("up < a").toDF("node", "up"), "forest")))
        left, right = hung[-1].toDF("a", "ua"), hung[-1].toDF("b", "ub")
        renamed = written(tidy(links.join(left.hint("merge"), "a", "left").join(right.hint("merge"), "b", "left").select(F.coalesce("ua", "a").alias("a"), F.coalesce("ub", "b").alias("b"))), "links")
        forget(links)
        links = renamed
    if not hung:
        return links.toDF("node", "root")
    forest = _ends(reduce(DataFrame.unionAll, hung)).toDF("node", "root")
    return forest.unionAll(forest.select("root", "root").distinct().toDF("node", "root"))
