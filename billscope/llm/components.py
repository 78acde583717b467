"""Connected components of a graph of links, as Spark joins that contract the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.work import in_few_files, materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links ``a``-``b``; nodes of one component share the root.

    In each round every node joins the first of itself and its neighbours in an order by hash, and that one's
    choice in turn; links between nodes that came together go. In a chain about a third of the nodes are left
    after a round, in a star one, so rounds grow with the logarithm of the longest chain. Rounds are written to
    shared storage, in as few files as their rows call for. Nothing is gathered by node: minima combine before the shuffle, and a node with many links
    is only ever joined to its one choice, which adaptive execution splits.
    """
    links = materialise(links.where("a <> b").select("a", "b").distinct(), "links")
    both = F.explode(F.array(F.struct(F.col("a").alias("node")), F.struct(F.col("b").alias("node"))))
    count = links.count()
    most = 2 * count
    nodes = links.select(both.alias("n")).select("n.node").distinct()
    found = materialise(in_few_files(nodes.withColumn("root", F.col("node")), most), "roots")
    while count:
        pairs = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
        ways = links.select(pairs.alias("p")).select("p.*")
        rank = F.struct(F.xxhash64("b").alias("rank"), F.col("b").alias("node"))
        own = F.struct(F.xxhash64("a").alias("rank"), F.col("a").alias("node"))
        first = ways.groupBy("a").agg(F.min(rank).alias("best")).select("a", F.least("best", own)["node"].alias("to"))
        first = materialise(in_few_files(first, 2 * count), "first")
        second = first.select(F.col("a").alias("to"), F.col("to").alias("beyond"))
        step = first.join(second, "to").select(F.col("a").alias("from"), F.col("beyond").alias("to"))
        step = materialise(in_few_files(step, 2 * count), "step")
        moved = found.join(step, found.root == step["from"], "left")
        found = materialise(in_few_files(moved.select("node", F.coalesce("to", "root").alias("root")), most), "roots")
        a, b = (step.select(F.col("from").alias(end), F.col("to").alias(f"{end}_to")) for end in "ab")
        merged = links.join(a, "a").join(b, "b").where("a_to <> b_to")
        ends = F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")
        links = materialise(in_few_files(merged.select(*ends).distinct(), count), "links")
        count = links.count()
    return found
