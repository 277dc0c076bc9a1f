"""Connected components of a link table: distributed union-find.

Rounds of large-star and small-star (Kiveris et al., 2014): every node hangs
its larger neighbours, then its smaller ones, on its smallest neighbour,
until each node hangs on its component's smallest node. A round is
aggregations and key joins; a hub's many links are split by Spark's
skew join, and minima are taken before the shuffle. Links are written to the
shared folder after each round, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Saved


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step over links (a > b); returns links (a > b)."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hung = both.join(least, "a")
    if large:
        out = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (hung.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(least.select("a", F.col("m").alias("b"))))
    return out.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another node.

    ``root`` is the smallest node reachable. Nodes are of any ordered type;
    repeated links, self-links and either direction are fine, null ends are
    dropped; no links give no rows.
    """
    x, y = F.col(a), F.col(b)
    now = Saved(links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "links")
    seen = None
    while True:
        mark = now.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            return now.df.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.df.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = mark
        new = Saved(_star(_star(now.df, True), False), "links")
        now.drop()
        now = new
