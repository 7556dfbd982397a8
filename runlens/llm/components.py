"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two grouped minima and joins in few stages; nothing but counts reaches the driver. A node with a
third of all links is one partial minimum per task of the large star. In the joins the links of a node, two
numbers each, stream through one task. Of the written rounds only the last one stays.
"""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from runlens.sources.staging import Scope


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Point neighbours of every node at the smallest node among them and itself: its larger ones
    (large star) or its smaller ones and itself (small star). Links may come out repeated."""
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # dealt out once, for the minima and for the join
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).repartition("a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least.hint("merge"), "a")  # both grow with the links
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    # the neighbour that is the smallest stands for the node itself
    moved = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
    return joined.select(moved.alias("a"), F.col("m").alias("b"))


def connected_components(links: DataFrame, scope: Scope) -> DataFrame:
    """(node, root): the smallest node of its component for every node with a link, ``links`` being
    pairs (a, b) of long ids in any order, repeated or not."""
    links, before = links.where("a <> b"), None
    while True:
        seen = Observation()
        sign = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        star = _star(_star(links, True), False).distinct()
        links = scope.stage(star.observe(seen, F.count("*").alias("n"), sign.alias("s")), "links")
        if before is not None:
            scope.remove(scope.paths[-2])  # the round before
        now = seen.get
        if now == before or now["n"] == 0:
            break
        before = now
    roots = links.select("b").distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))


def components_of_each(graphs: list[DataFrame], scope: Scope) -> list[DataFrame]:
    """What :func:`connected_components` gives for each of some link tables, in rounds that all of them share. Ids
    are positive and far enough below 2^63 to be multiplied by the number of tables."""
    count = len(graphs)
    numbered = [g.select((F.col("a") * count + i).alias("a"), (F.col("b") * count + i).alias("b"))
                for i, g in enumerate(graphs)]
    links = numbered[0]
    for other in numbered[1:]:
        links = links.union(other)
    found = connected_components(links, scope)
    return [found.where(F.col("node") % count == i).select(
        *[F.expr(f"{c} div {count}").alias(c) for c in ("node", "root")]) for i in range(count)]
