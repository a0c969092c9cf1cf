"""Connected components of a graph that is a table of links."""

from pyspark.sql import functions as F

from kerbline.llm.frames import written


def _large_star(links):
    """Every node hands its smallest neighbour, or itself, to its larger neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links):
    """Every node hands its smallest smaller neighbour to the other smaller ones and itself."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links):
    """(node, root) of every node of ``links`` (u, v) that has a smaller one in its component, which is the root.

    Large and small stars alternate until nothing changes: O(log^2) rounds, whatever the shape. Minima are aggregated
    before each shuffle, so a node with very many links is not gathered anywhere; every round starts from written files.
    """
    links, last = written(links.where("u <> v"), "links"), None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = state
        links = written(_small_star(_large_star(links)), "links")
