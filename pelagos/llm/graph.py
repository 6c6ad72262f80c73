"""Connected components over links of any shape, without collecting links or components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables, save


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that the (src, dst) links name; root is the least node of the component.

    Each round takes the least label of all neighbours (a map-side combined minimum), then follows labels of
    labels twice, so the rounds grow with the logarithm of a component's width. Each step reads tables written
    to the shared folder; its joins shuffle both sides anew, so that adaptive execution splits the rows of a hub.
    Null ends and loops are ignored. An empty input gives an empty result.
    """
    pairs = edges.select("src", "dst").where("src is not null and dst is not null and src != dst")
    with Tables() as t:
        both = t.save(pairs.union(pairs.select(F.col("dst"), F.col("src"))).toDF("src", "dst").distinct())
        labels = t.save(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("node"), F.least("src", "m").alias("root")))
        while True:
            heard = (
                both.join(labels, both.src == labels.node)
                .groupBy(F.col("dst").alias("at"))
                .agg(F.min("root").alias("heard"))
            )
            least = t.save(
                labels.join(heard, labels.node == F.col("at"), "left").select(
                    "node", "root", F.least("root", F.coalesce("heard", "root")).alias("new")
                )
            )
            t.drop(labels)
            if not least.where("new != root").limit(1).count():
                return save(least.select("node", "root"))
            once = t.save(_jump(least.select("node", F.col("new").alias("root"))))
            labels = t.save(_jump(once))
            t.drop(least, once)


def _jump(labels: DataFrame) -> DataFrame:
    up = labels.select(F.col("node").alias("via"), F.col("root").alias("top"))
    return labels.join(up, labels.root == up.via, "left").select("node", F.least("root", F.coalesce("top", "root")).alias("root"))
