"""Connected components of an edge list as a few joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunfleet.session import written


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of the component, for every node of ``edges`` (a, b longs).

    Alternates two steps until every node hangs on its root: larger neighbours of a node are linked to
    its smallest neighbour, then the smaller ones are. Only minima are taken per node, before the
    shuffle; no list of neighbours is built. A self-loop makes a node known without a link.
    """
    nodes = edges.select("a").union(edges.select("b")).distinct().withColumnRenamed("a", "node")
    nodes = written(nodes, "nodes")
    links = written(edges.filter("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), "links")
    last = None
    for _ in range(rounds):
        # links run from the larger (a) to the smaller node (b)
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).selectExpr("a", "least(a, low) as low")
        far = links.selectExpr("a as v", "b as a").join(least, "a").selectExpr("v as a", "low as b")
        own = least.filter("low < a").selectExpr("a", "low as b")
        wide = far.union(own).distinct()
        least = wide.groupBy("a").agg(F.min("b").alias("low"))
        near = wide.join(least, "a").filter("b <> low").selectExpr("b as a", "low as b")
        links = written(near.union(least.selectExpr("a", "low as b")).distinct(), "links")
        # when nothing moves any more, every link ends in a root
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    root = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return written(nodes.join(root, "node", "left").selectExpr("node", "coalesce(root, node) as root"), "components")
