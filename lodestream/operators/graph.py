"""Connected components of links between ids, by alternating large-star and small-star rounds.

Each round is two aggregations and two joins over the links; rounds are written to the shared folder, which cuts the
lineage, and links never reach the driver. A hub's links are a hot key: minima are pre-aggregated, and the joins back
are plain sort-merge joins that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.plans.storage import materialize


def _star(links: DataFrame) -> DataFrame:
    """links a > b -> (node, centre): a large star, then a small star."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    return small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").union(least).distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of ids, in any order and with repeats -> node, component: each linked node with the least id that it
    reaches. Links of an id to itself and nulls are ignored; no links give no rows."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links)
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first())
    state = mark(links)
    while True:
        links = materialize(_star(links))
        state, before = mark(links), state
        if state == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
