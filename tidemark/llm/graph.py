"""Connected components of a link table, in rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node of ``links``; comp is the smallest node that
    can be reached. Each round takes the smallest label of all neighbours and
    then the label's own label, so labels travel twice as far every round; each
    round's table is written to the checkpoint folder. Self-links and repeated
    links do no harm; without links the result is empty.
    """
    one = links.select(F.col(a).alias("node"), F.col(b).alias("near"))
    both = cut(one.unionAll(one.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct())
    labels = cut(both.groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("node", "m").alias("comp")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("near"), F.col("comp").alias("theirs")), "near")
                .groupBy("node").agg(F.min("theirs").alias("m")))
        lower = cut(labels.join(near, "node").select("node", "comp", F.least("comp", "m").alias("m")))
        hop = labels.select(F.col("node").alias("m"), F.col("comp").alias("next"))
        after = cut(lower.join(hop, "m").select("node", "comp", F.least("m", "next").alias("new")))
        if after.where("new <> comp").isEmpty():
            return labels
        labels = after.select("node", F.col("new").alias("comp"))
