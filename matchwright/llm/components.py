"""Connected components, by stars that grow and shrink.

Every round hangs the neighbours of each node on the least node among them
(large star, then small star; Kiveris et al., SoCC 2014) until nothing moves.
Rounds are written tables; minima are combined before they are shuffled and
joined back, so a node with very many neighbours is split like any hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.sources.staging import drop_tables, stage_table


def _hung(edges: DataFrame) -> DataFrame:
    """(a, b), a > b, of one round over such edges."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    met = large.join(least, "a")
    small = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(met.select("a", F.col("m").alias("b"))).distinct()


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of ``edges`` (a, b) reaches.

    Roots themselves have no row; loops and repeated edges do not matter.
    """
    ordered = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = stage_table(ordered.distinct(), "edges")
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    seen = now.agg(F.count("*"), mark).first()
    while seen[0]:
        last, now = now, stage_table(_hung(now), "edges")
        drop_tables(last)
        then = now.agg(F.count("*"), mark).first()
        if then == seen:
            break
        seen = then
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
